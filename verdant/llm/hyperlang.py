"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. A
three-letter gram is bound into one vector by multiplying the letters' vectors,
permuted by their place (rolled by 2, 1 and 0). A text's vector is the sum
(bundle) of its gram vectors; a language's prototype is the bundle of its texts.
A text gets the language whose prototype has the largest cosine with it.

Grams are counted first and bundled as one matrix product per group of texts, so
a gram vector is made once a group. Prototypes are sums of whole numbers: any
order of adding gives the same bits.

Defined results: null text, or a text without letters: language ``und``, score
0; rows without language or id teach nothing; a text whose cosine is not
positive with any prototype scores 0; equal cosines go to the first language by
code point; without any labelled text everything is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
GRAM = 3
GROUP_CHARS = 1 << 19
GROUP_TEXTS = 256
_BITS = np.uint64(21)           # of a code point
_letters: list[np.ndarray] = []
_vectors: dict[int, np.ndarray] = {}


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _letters[0]


def letter_vector(code: int) -> np.ndarray:
    """+1/-1 vector of a code point (0: the gap between words), the same on every machine."""
    if code not in _vectors:
        if len(_vectors) > 20_000:
            _vectors.clear()
        bits = np.random.Generator(np.random.Philox(key=code)).integers(0, 2, DIMENSIONS, dtype=np.int8)
        _vectors[code] = bits * np.int8(2) - np.int8(1)
    return _vectors[code]


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Bound vectors of grams, one row each."""
    out = None
    for place in range(GRAM):
        codes, at = np.unique((grams >> (_BITS * np.uint64(GRAM - 1 - place))) & np.uint64((1 << 21) - 1), return_inverse=True)
        own = np.stack([np.roll(letter_vector(int(c)), GRAM - 1 - place) for c in codes])[at]
        out = own if out is None else out * own
    return out.astype(np.float32)


def grams_of(text: str | None) -> np.ndarray:
    """The grams of a text in lower case; what lies between words is one gap."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.concatenate([[0], np.where(_is_letter()[codes], codes, 0), [0]]).astype(np.uint64)
    codes = codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]
    if len(codes) < GRAM:
        return np.empty(0, dtype=np.uint64)
    out = codes[:len(codes) - GRAM + 1].copy()
    for k in range(1, GRAM):
        out = (out << _BITS) | codes[k:len(codes) - GRAM + 1 + k]
    return out


def bundles(parts: list[tuple[int, np.ndarray]], n: int) -> np.ndarray:
    """Bundled vectors of ``n`` owners from (owner, grams)."""
    grams, at = np.unique(np.concatenate([g for _, g in parts]), return_inverse=True)
    owner = np.repeat([k for k, _ in parts], [len(g) for _, g in parts])
    counts = np.bincount(owner * len(grams) + at, minlength=n * len(grams)).reshape(n, -1)
    return counts.astype(np.float32) @ gram_vectors(grams)


def _groups(texts):
    """Lists of (position, grams): limited in letters and texts; a long text goes in slices."""
    group, size = [], 0
    for k, text in enumerate(texts):
        grams = grams_of(text)
        for a in range(0, len(grams), GROUP_CHARS):
            group.append((k, grams[a:a + GROUP_CHARS]))
            size += len(group[-1][1])
            if size >= GROUP_CHARS or len(group) >= GROUP_TEXTS:
                yield group
                group, size = [], 0
    if group:
        yield group


def _learn_batches(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        names = sorted(set(langs))
        for group in _groups(batch.column("text").to_pylist()):
            found = bundles([(names.index(langs[k]), g) for k, g in group], len(names)).astype(np.float64)
            for name, vector in zip(names, found, strict=True):
                sums[name] = sums.get(name, 0) + vector
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                                         names=["lang", "vector"])


def prototypes(labelled: DataFrame) -> dict[str, np.ndarray]:
    """Unit prototypes of the languages of rows ``(text, lang)``: one row per
    task and language is summed by component, one vector per language reaches the driver."""
    sums = (labelled.mapInArrow(_learn_batches, "lang string, vector array<double>")
            .select("lang", F.posexplode("vector").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x")))
    found: dict[str, np.ndarray] = {}
    for row in sums.collect():
        found.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["i"]] = row["x"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(found.items()) if np.any(v)}


def _predict_batches(known: dict[str, np.ndarray]):
    def run(batches):
        names = list(known)
        matrix = np.stack(list(known.values())) if known else np.zeros((0, DIMENSIONS))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            vectors: dict[int, np.ndarray] = {}
            best, score = ["und"] * len(texts), [0.0] * len(texts)

            def close(upto, vectors=vectors, best=best, score=score):
                for k in [k for k in vectors if k < upto]:
                    v = vectors.pop(k)
                    cosines = matrix @ v / max(np.linalg.norm(v), 1e-12)
                    at = int(np.argmax(cosines))
                    best[k], score[k] = names[at], float(min(1.0, max(0.0, cosines[at])))

            for group in _groups(texts) if known else ():
                first = group[0][0]
                found = bundles([(k - first, g) for k, g in group], group[-1][0] - first + 1)
                for k in {k for k, _ in group}:
                    vectors[k] = vectors.get(k, 0) + found[k - first].astype(np.float64)
                close(group[-1][0])
            close(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(best), pa.array(score)],
                names=[*(c for c in batch.schema.names if c != "text"), "lang_pred", "score"])
    return run


def in_fold(id_col: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part``; null ids count as held out."""
    return F.coalesce(F.crc32(id_col.cast("string")) % parts == part, F.lit(True))


def identify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             parts: int = 5, part: int = 0) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)``, one row per row of ``docs``.
    Prototypes are learned from all labelled rows that are not held out."""
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{lang_col}`").alias("lang"), in_fold(F.col(f"`{id_col}`"), parts, part).alias("held_out"))
    known = prototypes(rows.where("not held_out and lang is not null and text is not null").select("text", "lang"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "held_out", "text").mapInArrow(
        _predict_batches(known), f"doc_id {kind}, held_out boolean, lang_pred string, score double")
