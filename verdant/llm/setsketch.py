"""Near-duplicate documents by SetSketch registers.

A document's set are its distinct word shingles. Register i holds
``floor(1 - log_b(x_i))``, where x_i is the smallest of exponentially
distributed values that its hash gives the shingles; it is cut to 0..q+1. The
registers of a union are the larger ones of the two sets (mergeable), and two
registers agree about as often as the sets overlap (locality-sensitive).

1. One pass over the texts makes set size, registers and a 128-bit key of the
   word sequence. Copies are collapsed to the smallest id of their key.
2. Registers are cut into bands of ``rows``; documents with an equal band meet.
   With 40 bands of 5, a pair at similarity 0.8 never meets with probability
   (1 - 0.8^5)^40 = 1.3e-7.
3. Of a band's documents, only pairs with the smallest one are formed. They are
   dropped if the set sizes alone rule the similarity out, or if the likelihood
   estimate from the registers is 6 standard deviations below it.
   The rest are confirmed on full sets, the most similar pair of each document
   first and then those still in different components.
4. Where a band's documents are still in different components, all pairs
   between components are looked at: by a join in bands of up to ``SMALL_BAND``
   documents, and within blocks of ``BLOCK`` documents of larger ones. Both drop
   pairs by set sizes and likelihood as above. A block also
   skips pairs that agree in an earlier band
   or that it has connected already, confirms the rest on full sets, and returns
   the links that join components: fewer than it has documents. So no link
   between different texts is lost, and no group is expanded into pairs.

Defined results: a text with fewer words than a shingle is one shingle; without
words (or null) the set is empty and linked with nothing; rows that share an id
and text are the same document; texts that share an id but differ are judged each
by itself; a row with a null id is linked with nothing and kept; texts of any length
are treated whole; of equally similar partners the one with the larger id is
confirmed first, which changes no component; other columns may have any names; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import connected_components, whole_row, written
from verdant.operators.broadcast import broadcast_if_small

BASE = 1.001            # b: nearly the resolution of full minima in two bytes
RATE = 20.0             # a
LIMIT = 65_534          # q
BANDS, ROWS = 40, 5
SIGMAS = 6.0            # standard deviations by which an estimate may fall short of the threshold
SMALL_BAND = 32         # bands of up to so many documents are joined with themselves
BLOCK = 1024            # documents of a larger band that one task compares with as many
_CHUNK = 4096



def least_estimate(percent: int, n: int) -> float:
    """What the estimate from ``n`` registers of a pair at the threshold stays above."""
    p = percent / 100
    return p - SIGMAS * float(np.sqrt(p * (1 - p) / n))


_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(1, 2**63, size=4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, size=4096, dtype=np.uint64)


class _WordHashes(dict):
    """Hash of a word, remembered for frequent words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def words_of(text: bytes | None) -> list[bytes]:
    """Words in lower case (A-Z only). ``bytes.split`` cuts at space and \\t..\\r."""
    return text.lower().split() if text else []


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``size``-word shingles."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for k in range(width):
        out = _mixed(out + h[k:len(h) - width + 1 + k])
    return np.unique(out)


def registers(shingles: np.ndarray, n: int) -> np.ndarray:
    """``n`` SetSketch registers (uint16) of a set that is not empty."""
    least = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        values = np.multiply.outer(_MUL[:n], shingles[at:at + _CHUNK])
        values += _ADD[:n, None]
        np.minimum(least, values.min(axis=1), out=least)
    uniform = np.clip(least.astype(np.float64) / 2.0**64, 2.0**-64, 1 - 2.0**-53)
    exponential = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs from their registers (one
    row a pair) and set sizes.

    With u and v the shares of the two sizes, a register of the first is the
    larger one with probability p(u - vJ), p(x) = -log_b(1 - x(b-1)/b), and the
    other way round. The log-likelihood is concave in J; it is searched by
    golden sections, all pairs at once."""
    more, fewer = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    even = ra.shape[1] - more - fewer
    u, v = na / (na + nb), nb / (na + nb)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        a, b = np.maximum(p(u - v * j), 1e-300), np.maximum(p(v - u * j), 1e-300)
        return more * np.log(a) + fewer * np.log(b) + even * np.log(np.maximum(1 - a - b, 1e-300))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    g = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        x, y = hi - g * (hi - lo), lo + g * (hi - lo)
        up = likelihood(x) < likelihood(y)
        lo, hi = np.where(up, x, lo), np.where(up, hi, y)
    return (lo + hi) / 2


def may_reach(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, j: float) -> np.ndarray:
    """Whether ``estimate`` is at least ``j``: the log-likelihood is concave, so its slope at ``j`` tells."""
    more, fewer = (ra > rb).sum(axis=1), (ra < rb).sum(axis=1)
    even = ra.shape[1] - more - fewer
    u, v = na / (na + nb), nb / (na + nb)
    c, scale = (BASE - 1) / BASE, np.log(BASE)
    x, y = u - v * j, v - u * j
    a, b = (np.maximum(-np.log1p(-np.clip(z, 0, 1) * c) / scale, 1e-300) for z in (x, y))
    da, db = (w * c / ((1 - np.clip(z, 0, 1) * c) * scale) for w, z in ((v, x), (u, y)))
    slope = even * (da + db) / np.maximum(1 - a - b, 1e-300) - more * da / a - fewer * db / b
    return (slope >= 0) & (j <= np.minimum(u / v, v / u))


def _text_bytes(column) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _sketch_batches(size: int, n: int):
    def run(batches):
        for batch in batches:
            keys, counts, regs = [], [], []
            for value in batch.column("text").cast(pa.binary()):
                words = words_of(value.as_py())
                if not words:
                    keys.append(None), counts.append(0), regs.append(None)
                    continue
                s = shingle_set(words, size)
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                counts.append(len(s))
                regs.append(registers(s, n).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("sha"), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(regs, pa.binary())], names=["doc_id", "sha", "key", "n_shingles", "registers"])
    return run


def sketches(docs: DataFrame, size: int, n: int) -> DataFrame:
    """``(doc_id, sha, key, n_shingles, registers)`` for rows ``(doc_id, sha, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_sketch_batches(size, n), f"doc_id {kind}, sha binary, key binary, n_shingles bigint, registers binary")


def _estimate_batches(percent: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(batch.num_rows, -1)
                      for c in ("ra", "rb"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            j = estimate(ra, rb, na, nb)
            keep = pa.array(j >= least_estimate(percent, ra.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(j)], names=["a", "b", "likely"]).filter(keep)
    return run


def _links_in_block(shingle: int, percent: int, rows: int):
    """Rows ``(rep, c, side, k, n_shingles, registers, text)`` of two blocks of
    band ``k`` -> links between their components ``c``, a spanning set of them."""
    def run(key, table):
        same = key[1].as_py() == key[2].as_py()
        side, reps, c = (table.column(x).to_numpy() for x in ("side", "rep", "c"))
        sizes, texts = table.column("n_shingles").to_numpy(), table.column("text").cast(pa.binary())
        regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), dtype=np.uint16).reshape(len(reps), -1)
        band = int(table.column("k")[0].as_py())
        one = np.flatnonzero(side == 0)
        two = one if same else np.flatnonzero(side == 1)
        sets: dict[int, np.ndarray] = {}
        root: dict[int, int] = {}
        links = []

        def find(x):
            while root.get(x, x) != x:
                root[x] = root.get(root[x], root[x])
                x = root[x]
            return x

        def shingles(i):
            if i not in sets:
                sets[i] = shingle_set(words_of(texts[i].as_py()), shingle)
            return sets[i]

        for i in one.tolist():
            near = two[(c[two] != c[i]) & (100 * np.minimum(sizes[two], sizes[i]) >= percent * np.maximum(sizes[two], sizes[i]))]
            near = near[reps[near] > reps[i]] if same else near
            near = near[may_reach(regs[near], regs[i], sizes[near], sizes[i], least_estimate(percent, regs.shape[1]))]
            if not len(near):
                continue
            equal = regs[near] == regs[i]
            near = near[equal.reshape(len(near), -1, rows).all(axis=2).argmax(axis=1) == band]
            for j in near.tolist():
                x, y = find(int(c[i])), find(int(c[j]))
                if x != y:
                    a, b = shingles(i), shingles(j)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    if 100 * both >= percent * (len(a) + len(b) - both):
                        root[max(x, y)] = min(x, y)
                        links.append((int(reps[i]), int(reps[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return run


def _confirm_batches(size: int, percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for ta, tb in zip(_text_bytes(batch.column("ta")), _text_bytes(batch.column("tb")), strict=True):
                x, y = shingle_set(words_of(ta), size), shingle_set(words_of(tb), size)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")],
                                             names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _labelled(frame: DataFrame, on: str, components: DataFrame, name: str) -> DataFrame:
    """``frame`` with the component of its column ``on`` (its own id if it has no link yet)."""
    found = components.select(F.col("node").alias(on), F.col("component").alias(name))
    return frame.join(found, on, "left").withColumn(name, F.coalesce(name, on))


def duplicate_links(reps: DataFrame, texts_of, *, shingle: int, percent: int, bands: int, rows: int):
    """``(node, component)`` of the documents that are linked.

    ``reps`` has one row per text: ``(rep, n_shingles, registers)``; ``texts_of``
    gives rows ``(rep, text)`` for a frame of column ``rep``."""
    kind = reps.schema["rep"].dataType.simpleString()
    sliced = F.array(*[F.xxhash64(F.lit(k), F.substring(F.col("registers"), 2 * rows * k + 1, 2 * rows))
                       for k in range(bands)])
    banded = reps.select("rep", F.posexplode(sliced).alias("k", "band"))
    shared = banded.groupBy("band").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    entries = written(banded.join(shared, "band").select("k", "band", "rep", "pivot"), "near-bands")
    # The texts that may be compared are written once; all rounds read them.
    involved = entries.select("rep").distinct()
    texts = written(texts_of(involved).dropDuplicates(["rep"]), "near-texts")
    sketch = reps.select("rep", "n_shingles", "registers")

    def likely(pairs: DataFrame) -> DataFrame:
        a, b = (sketch.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n{x}"),
                              F.col("registers").alias(f"r{x}")) for x in "ab")
        possible = pairs.join(a, "a").join(b, "b").where(
            100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        return written(possible.mapInArrow(_estimate_batches(percent), f"a {kind}, b {kind}, likely double"), "near-likely")

    def confirmed(pairs: DataFrame) -> DataFrame:
        a, b = (texts.select(F.col("rep").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
        full = pairs.select("a", "b").join(a, "a").join(b, "b")
        return written(full.mapInArrow(_confirm_batches(shingle, percent), f"a {kind}, b {kind}"), "near-links")

    def apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
        return _labelled(_labelled(pairs, "a", components, "ca"), "b", components, "cb").where("ca <> cb")

    def united(links: DataFrame) -> DataFrame:
        return connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))

    star = likely(entries.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct())
    best = star.groupBy("b").agg(F.max(F.struct("likely", "a")).alias("m")).select("m.a", "b")
    links = confirmed(best)
    links = links.unionByName(confirmed(apart(star.join(best, ["a", "b"], "left_anti"), united(links))))
    components = written(united(links), "near-components")

    named = _labelled(entries.where("rep <> pivot").select("k", "band", "rep"), "rep", components, "c")
    mixed = named.groupBy("band").agg(F.count("*").alias("n"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    left = written(named.join(mixed.select("band", "n"), "band"), "near-left")
    if left.isEmpty():
        return components
    few = left.where(F.col("n") <= SMALL_BAND)
    one, two = (few.select("band", F.col("rep").alias(x), F.col("c").alias(f"c{x}")) for x in "ab")
    more = confirmed(likely(one.join(two, "band").where("a < b and ca <> cb").select("a", "b").distinct()))
    # Larger bands: each pair of blocks meets in one task, with registers and texts.
    many = (left.where(F.col("n") > SMALL_BAND).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).join(sketch, "rep").join(texts, "rep"))
    columns = ["k", "band", "rep", "c", "n_shingles", "registers", "text"]
    asked = many.select(*columns, F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"),
                        F.lit(0).alias("side"))
    other = (many.where("block > 0").select(*columns, F.explode(F.sequence(F.lit(0), F.col("block") - 1)).alias("i"),
                                            F.col("block").alias("j"), F.lit(1).alias("side")))
    blocked = written(asked.unionByName(other).groupBy("band", "i", "j")
                      .applyInArrow(_links_in_block(shingle, percent, rows), f"a {kind}, b {kind}"), "near-blocks")
    return written(united(links.unionByName(more).unionByName(blocked)), "near-components")


def _sha(text_col: str) -> Column:
    return F.unhex(F.substring(F.sha2(F.col(f"`{text_col}`"), 256), 1, 32)).alias("sha")


def _with_sha(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), _sha(text_col), F.col(f"`{text_col}`").alias("text"))


def classes_of(sketched: DataFrame) -> DataFrame:
    """``(key, first, sha, rep)`` for each word sequence: the id and hash of the text that stands for it, and its number
    ``rep`` in the graph: that id, or, where different texts of one id stand for something, a number below all ids for
    all but one of them."""
    whole = sketched.where("key is not null and doc_id is not null")
    # Copies: one partial row per key and task before the shuffle.
    classes = written(whole.groupBy("key").agg(F.min(F.struct("doc_id", "sha")).alias("m"))
                      .select("key", F.col("m.doc_id").alias("first"), F.col("m.sha").alias("sha")), "near-classes")
    reused = written(classes.groupBy("first").agg(F.min("key").alias("kept_key"), F.count("*").alias("n")).where("n > 1").drop("n"), "near-reused")
    least = classes.agg(F.min("first")).first()[0] or 0
    # The table is read as it was written, so its rows keep their numbers if a task is run again.
    number = F.lit(least) - 1 - F.monotonically_increasing_id()
    other = F.col("kept_key").isNotNull() & (F.col("key") != F.col("kept_key"))
    return written(classes.withColumn("number", number).join(broadcast_if_small(reused), "first", "left")
                   .select("key", "first", "sha", F.when(other, F.col("number")).otherwise(F.col("first")).alias("rep")), "near-numbers")


def judged(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
           percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(doc_id, sha, n_shingles, component_id, chosen)``, one row per row of ``docs``; ``chosen`` says whether the
    row's text is the one of its component that stays: that of the smallest id."""
    docs = _with_sha(docs, id_col, text_col)
    sketched = written(sketches(docs, shingle, bands * rows), "near-sketches")
    classes = classes_of(sketched)
    reps = written(sketched.join(classes.select("key", F.col("first").alias("doc_id"), "sha", "rep"), ["key", "doc_id", "sha"])
                   .dropDuplicates(["rep"]).select("rep", "n_shingles", "registers"), "near-reps")
    held = classes.select(F.col("first").alias("doc_id"), "sha", "rep")
    linked = duplicate_links(reps, lambda wanted: docs.join(held.join(wanted, "rep"), ["doc_id", "sha"]).select("rep", "text"), shingle=shingle, percent=percent, bands=bands, rows=rows)
    member = written(_labelled(classes, "rep", linked, "component"), "near-members")
    best = member.groupBy("component").agg(F.min(F.struct("first", "rep")).alias("best"))
    named = member.join(best, "component").select("key", F.col("best.first").alias("component_id"), "first",
                                                  F.when(F.col("rep") == F.col("best.rep"), F.col("sha")).alias("best_sha"))
    known = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (sketched.select("doc_id", "sha", "key", "n_shingles").join(named, "key", "left")
            .select("doc_id", "sha", "n_shingles", known.alias("component_id"),
                    (F.col("doc_id").isNull() | F.col("component_id").isNull()
                     | F.coalesce((F.col("sha") == F.col("best_sha")) & (F.col("doc_id") == F.col("first")), F.lit(False))).alias("chosen")))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``:
    documents are linked if ``100 * |A and B| >= percent * |A or B|``, and the
    smallest id of a component is kept."""
    return judged(docs, **options).select("doc_id", "n_shingles", "component_id",
                                          F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_one_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with the same columns: of every component those of its smallest id (one
    text, if that id is reused)."""
    gone = judged(docs, id_col=id_col, text_col=text_col, **options).where(~F.col("chosen")).select("doc_id", "sha").distinct()
    rows = docs.select(whole_row(docs), F.col(f"`{id_col}`").alias("doc_id"), _sha(text_col))
    return rows.join(gone, ["doc_id", "sha"], "left_anti").select("row.*")


ORACLE = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, sh FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS sh FROM w WHERE w IS NOT NULL)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM common JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
pairs AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT reach.doc_id, pairs.b FROM reach JOIN pairs ON reach.c = pairs.a),
comp AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, comp.component_id, d.doc_id = comp.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""
