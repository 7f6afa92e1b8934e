"""Token counts by public tokenizers.

Texts go to the tokenizer's library in batches, inside Arrow functions that
return lengths only. A batch holds about ``BATCH_BYTES`` of text, whatever the
number of texts: short ones are put together, and a text of more than
``PART_BYTES`` is split into parts that are counted by themselves.

Parts begin at safe boundaries: places between two characters that stand next
to each other in no piece of the vocabulary (a blank counts as the vocabulary's
blank mark). No merge can reach across such a place, so the parts' tokens are
the text's tokens. The library puts a blank mark before every text; a later part
is therefore counted behind a guard character that is in no piece, and the
guard's own tokens are taken off. All this is only true of a vocabulary of
merges with byte fallback whose normalisation leaves the text as it is, which is
asked of the library for each long text; otherwise, and for ``.json``
vocabularies (the library cuts these at words by itself), texts stay whole.

The vocabulary is read on the driver (it has a bounded size) and goes to the
tasks with the function; executors need no such file.

Defined results: null is the empty text with no token; special strings inside a
text are what the library takes them for by default; repeated rows are counted
each; a very long text without a safe boundary is counted whole, in memory in
proportion to it; other columns, whatever their names, are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20
PART_BYTES = 1 << 16
_BLANK = "▁"
_GUARD = "\n"
_loaded: dict[str, object] = {}


class PieceCounter:
    """Counts of a ``.model`` vocabulary."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(n) if not (
            self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))]
        self.neighbours = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
        self.guard_tokens = len(self.library.encode(_GUARD))
        # Unknown characters next to each other are one token unless they fall back to bytes.
        self.splits = any(self.library.is_byte(i) for i in range(n)) and not any(_GUARD in p for p in pieces)

    def parts(self, text: str, size: int) -> list[str]:
        """``text`` in parts of ``size`` characters or, up to a safe boundary, more."""
        plain = text.replace(" ", _BLANK)
        if not self.splits or self.library.normalize(text) != _BLANK + plain:
            return [text]
        out, start, at = [], 0, size
        while at < len(text):
            if plain[at - 1:at + 1] in self.neighbours:
                at += 1
                continue
            out.append(text[start:at])
            start, at = at, at + size
        out.append(text[start:])
        return out

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]

    def rest_counts(self, parts: list[str]) -> list[int]:
        """Counts of parts that are not the first of their text."""
        return [n - self.guard_tokens for n in self.counts([_GUARD + p for p in parts])]


class WordCounter:
    """Counts of a ``.json`` vocabulary."""

    def __init__(self, model: bytes):
        import tokenizers
        self.library = tokenizers.Tokenizer.from_str(model.decode())
        self.library.no_truncation()
        self.library.no_padding()

    def parts(self, text: str, size: int) -> list[str]:
        return [text]

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.library.encode_batch(texts, add_special_tokens=False)]

    rest_counts = counts


def counter(model: bytes, kind: str):
    """The counter of a vocabulary, loaded once a Python worker."""
    name = kind + hashlib.sha256(model).hexdigest()
    if name not in _loaded:
        _loaded[name] = {"model": PieceCounter, "json": WordCounter}[kind](model)
    return _loaded[name]


def token_counts(tokenizer, texts, batch_bytes: int = BATCH_BYTES, part_bytes: int = PART_BYTES) -> list[int]:
    """Tokens of each text of an iterable."""
    totals: list[int] = []
    firsts, rests = ([], []), ([], [])          # texts, and the places their counts go to
    waiting = 0

    def flush():
        for (parts, at), count in ((firsts, tokenizer.counts), (rests, tokenizer.rest_counts)):
            if parts:
                for k, n in zip(at, count(parts), strict=True):
                    totals[k] += n
                parts.clear(), at.clear()

    for k, text in enumerate(texts):
        totals.append(0)
        if not text:
            continue
        parts = tokenizer.parts(text, part_bytes) if len(text) > part_bytes else [text]
        for number, part in enumerate(parts):
            (firsts if number == 0 else rests)[0].append(part)
            (firsts if number == 0 else rests)[1].append(k)
            waiting += len(part) if part.isascii() else len(part.encode())
            if waiting >= batch_bytes:
                flush()
                waiting = 0
    flush()
    return totals


def _count_batches(model: bytes, kind: str):
    def run(batches):
        tokenizer = counter(model, kind)
        for batch in batches:
            column = batch.column("text").cast(pa.binary())
            texts = ((x.as_py() or b"").decode("utf-8", "replace") for x in column)     # one at a time
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.fill_null(pc.binary_length(column).cast(pa.int64()), 0),
                 pa.array(token_counts(tokenizer, texts), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per row of ``docs``, for the vocabulary file
    ``vocabulary`` (``.model`` or ``.json``, a path that the driver can open)."""
    kind = vocabulary.rsplit(".", 1)[-1]
    if kind not in ("model", "json"):
        raise ValueError(f"no counter for .{kind} vocabularies")
    with open(vocabulary, "rb") as f:
        model = f.read()
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    counted = docs.mapInArrow(_count_batches(model, kind),
                              f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
