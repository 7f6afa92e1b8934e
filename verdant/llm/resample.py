"""Importance resampling of documents towards a target distribution.

Features of a text are its words and pairs of consecutive words, repeats
counted. Every feature belongs to one of ``BUCKETS`` buckets by the crc32 of its
bytes. A bucket's gain is the logarithm of how much more frequent it is in the
target texts than in the documents; a document's weight is the mean gain of its
features, and documents are drawn without replacement by the largest weights
with Gumbel noise from a hash of their id.

1. One pass over the texts, in batches of about ``BATCH_BYTES``. A batch's words
   are found with array operations on its bytes. Its n-grams are interned in an
   open-addressed table: the 64-bit xxhash of an n-gram gives the place to look,
   equal hashes are verified byte by byte, other n-grams move on to the next
   place. A slot stores the n-gram's bucket and count, so crc32 is computed once
   for each distinct n-gram of a batch. One row a batch is written: its
   documents, slots (buckets, counts), and the slot id of every occurrence.
2. The buckets' totals are sums over the slots (occurrences are not read).
3. The gains of the slots' buckets are gathered by the occurrences' slot ids and
   summed by document.

A text longer than a batch is interned piece by piece; it needs no occurrences,
since its weight follows from its own bucket counts. So memory is bounded by a
batch and the longest word.

Ranks need no global sort: a document's rank is the number of documents with a
higher score, from counts by score (whole numbers in a range that the logarithms
bound), plus its place among those with its score.

Defined results: a null, empty or wordless text has no features and weight 0;
repeated rows are drawn each, in any order among themselves; a row with a null
id counts as text of the corpus, but has no score and is never drawn; other
columns, whatever their names, are left out; with an empty target or without
documents all the same formulas hold; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.common import written

BUCKETS = 10_000
BATCH_BYTES = 1 << 17
_LANES = 8                  # n-grams up to 64 bytes are verified in array operations, eight bytes at a time

_WIDTHS = {2: np.uint16, 4: np.uint32}
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# A word is a run of code points outside \x00-\x2F, \x3A-\x60 and \x7B-\x7F.
_IN_WORD = np.ones(256, dtype=bool)
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _IN_WORD[_lo:_hi + 1] = False


def find_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, starts, lengths, places)`` of the words of ``data`` in lower case (A-Z only): ``bytes`` has the
    words with one blank after each, ``places`` are their starts in ``data``."""
    low = _LOWER[np.frombuffer(data + b" ", dtype=np.uint8)]
    inside = _IN_WORD[low]
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    places, ends = edges[::2], edges[1::2]
    kept = inside.copy()
    kept[ends] = True
    low[ends] = 32
    lengths = ends - places
    return low[kept], np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64)[:len(lengths)], lengths, places


def _same_bytes(lanes: np.ndarray, grams: list[bytes], starts, lengths, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the n-grams ``a`` and ``b`` (numbers, of equal lengths in pairs) have the same bytes."""
    same = np.ones(len(a), dtype=bool)
    size = lengths[a]
    for k in range(_LANES):
        at = np.flatnonzero(same & (size > 8 * k))
        if not len(at):
            break
        differ = lanes[starts[a[at]] + 8 * k] ^ lanes[starts[b[at]] + 8 * k]
        spare = (8 * np.maximum(8 - (size[at] - 8 * k), 0)).astype(np.uint64)       # bits behind the end
        same[at] = (differ << spare) == 0
    for i in np.flatnonzero(same & (size > 8 * _LANES)).tolist():
        same[i] = grams[a[i]] == grams[b[i]]
    return same


def intern(text: np.ndarray, grams: list[bytes], starts: np.ndarray, lengths: np.ndarray, hash_of=xxhash.xxh64_intdigest):
    """``(slots, firsts)``: the slot id of every n-gram, and the number of one n-gram for every slot.

    All n-grams probe at once: those at a free place claim it (one of them gets it), those that equal the
    holder of their place are done, the others go on to the next place."""
    n = len(grams)
    keys = np.fromiter(map(hash_of, grams), dtype=np.uint64, count=n)
    lanes = np.ndarray((len(text),), dtype="<u8", buffer=np.concatenate([text, np.zeros(8, dtype=np.uint8)]), strides=(1,))
    mask = (1 << max(4, (2 * n).bit_length())) - 1
    holder = np.full(mask + 1, -1, dtype=np.int64)
    place = (keys & np.uint64(mask)).astype(np.int64)
    todo = np.arange(n)
    while len(todo):
        p = place[todo]
        free = holder[p] < 0
        holder[p[free]] = todo[free]
        h = holder[p]
        same = (keys[h] == keys[todo]) & (lengths[h] == lengths[todo])
        check = np.flatnonzero(same & (h != todo))
        same[check] = _same_bytes(lanes, grams, starts, lengths, todo[check], h[check])
        todo = todo[~same]
        place[todo] = (place[todo] + 1) & mask
    taken = np.flatnonzero(holder >= 0)
    number = np.empty(mask + 1, dtype=np.int64)
    number[taken] = np.arange(len(taken))
    return number[place], holder[taken]


def interned(data: bytes, doc_starts: np.ndarray, skip_first: bool = False):
    """``(words per document, slots, buckets, counts)`` of documents that lie one after the other in ``data``, with a
    byte outside words between them. ``slots`` has first the words' slots, then the pairs'. With ``skip_first``
    the first word only serves as the left one of a pair."""
    text, starts, lengths, places = find_words(data)
    doc = np.searchsorted(doc_starts, places, side="right") - 1
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    single = slice(1 if skip_first else 0, None)
    at = np.concatenate([starts[single], starts[pair]])
    size = np.concatenate([lengths[single], lengths[pair] + 1 + lengths[pair + 1] if len(pair) else lengths[:0]])
    whole = text.tobytes()
    grams = [whole[a:b] for a, b in zip(at.tolist(), (at + size).tolist(), strict=True)]
    slots, firsts = intern(text, grams, at, size)
    buckets = np.fromiter((zlib.crc32(grams[i]) % BUCKETS for i in firsts.tolist()), dtype=np.uint16, count=len(firsts))
    n_words = np.bincount(doc[single], minlength=len(doc_starts))
    return n_words, slots, buckets, np.bincount(slots, minlength=len(firsts))


def _pieces(text: bytes, size: int):
    """A long text in pieces that begin outside words."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text):                       # to the end of the word
            block = np.frombuffer(text[end:end + size], dtype=np.uint8)
            outside = np.flatnonzero(~_IN_WORD[_LOWER[block]])
            if len(outside):
                end += int(outside[0])
                break
            end += len(block)
        yield text[at:end]
        at = end


def long_text(text: bytes, batch_bytes: int) -> tuple[int, np.ndarray, np.ndarray]:
    """``(words, buckets, counts)`` of one text, piece by piece."""
    total, words, last = np.zeros(BUCKETS, dtype=np.int64), 0, b""
    for piece in _pieces(text, batch_bytes):
        piece = last + b" " + piece if last else piece
        n, _, buckets, counts = interned(piece, np.zeros(1, dtype=np.int64), skip_first=bool(last))
        total += np.bincount(buckets, weights=counts, minlength=BUCKETS).astype(np.int64)
        words += int(n.sum())
        bytes_, starts, lengths, _ = find_words(piece)
        if len(starts):
            last = bytes_[starts[-1]:starts[-1] + lengths[-1]].tobytes()
    used = np.flatnonzero(total)
    return words, used.astype(np.uint16), total[used]


def _intern_batches(batch_bytes: int):
    def rows(ids, texts, arrow):
        """One output row; ``texts`` is one long text or the texts of a batch."""
        if len(texts) == 1 and len(texts[0]) > batch_bytes:
            n, buckets, counts = long_text(texts[0], batch_bytes)
            words, slots, width = np.array([n]), None, 4
        else:
            sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
            words, slots, buckets, counts = interned(b"\n".join(texts), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
            width = 2 if len(slots) < 1 << 16 else 4             # bytes that hold a slot id or a count
            slots = slots.astype(_WIDTHS[width]).tobytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(arrow)), pa.array([words.astype(np.int64).tobytes()], pa.binary()),
             pa.array([slots], pa.binary()), pa.array([width], pa.int32()), pa.array([buckets.tobytes()], pa.binary()),
             pa.array([counts.astype(_WIDTHS[width]).tobytes()], pa.binary())],
            names=["ids", "words", "slots", "width", "buckets", "counts"])

    def run(batches):
        for batch in batches:
            arrow = batch.column("doc_id").type
            ids, texts, size = [], [], 0
            for i, x in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                text = x.as_py() or b""
                if len(text) > batch_bytes:
                    yield rows([i], [text], arrow)
                    continue
                ids.append(i), texts.append(text)
                size += len(text) + 1
                if size >= batch_bytes:
                    yield rows(ids, texts, arrow)
                    ids, texts, size = [], [], 0
            if ids:
                yield rows(ids, texts, arrow)
    return run


def interned_batches(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row a batch of rows ``(doc_id, text)``, written to the shared folder."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.mapInArrow(_intern_batches(batch_bytes), f"ids array<{kind}>, words binary, slots binary, "
                                   "width int, buckets binary, counts binary"), "resample-batches", arrow_bytes=8 << 20)


def _total_batches(batches):
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for width, b, c in zip(*(batch.column(c) for c in ("width", "buckets", "counts")), strict=True):
            counts = np.frombuffer(c.as_buffer(), dtype=_WIDTHS[width.as_py()])
            total += np.bincount(np.frombuffer(b.as_buffer(), dtype=np.uint16), weights=counts, minlength=BUCKETS).astype(np.int64)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["bucket", "n"])


def bucket_totals(batches: DataFrame) -> list[int]:
    """Occurrences by bucket: sums of the slots' counts, at most ``BUCKETS`` rows to the driver."""
    out = [0] * BUCKETS
    summed = batches.select("width", "buckets", "counts").mapInArrow(_total_batches, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for row in summed.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln of the smoothed ratio of shares) by bucket."""
    all_s, all_t = float(sum(corpus)), float(sum(target))
    return [math.floor(1000 * math.log((t + 1.0) * (all_s + BUCKETS) / ((s + 1.0) * (all_t + BUCKETS))))
            for s, t in zip(corpus, target, strict=True)]


def _weight_batches(gain: np.ndarray):
    def run(batches):
        for batch in batches:
            for ids, words, slots, width, buckets, counts in zip(
                    *(batch.column(c) for c in ("ids", "words", "slots", "width", "buckets", "counts")), strict=True):
                kind = _WIDTHS[width.as_py()]
                n_words = np.frombuffer(words.as_buffer(), dtype=np.int64)
                by_slot = gain[np.frombuffer(buckets.as_buffer(), dtype=np.uint16)]
                pairs = np.maximum(n_words - 1, 0)
                if not slots.is_valid:
                    total = np.array([(by_slot * np.frombuffer(counts.as_buffer(), dtype=kind)).sum()])
                else:
                    gathered = by_slot[np.frombuffer(slots.as_buffer(), dtype=kind)]
                    upto = np.concatenate([[0], np.cumsum(gathered)])
                    last = np.cumsum(n_words)
                    last_pair = last[-1] + np.cumsum(pairs)
                    total = upto[last] - upto[last - n_words] + upto[last_pair] - upto[last_pair - pairs]
                features = n_words + pairs
                weight = np.where(features > 0, total // np.maximum(features, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(n_words), pa.array(features), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])
    return run


def weights(docs: DataFrame, target: DataFrame, *, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)`` per row of ``docs``; both frames have rows ``(doc_id, text)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    batches = interned_batches(docs, batch_bytes)
    gain = np.array(gains(bucket_totals(batches), bucket_totals(interned_batches(target, batch_bytes))), dtype=np.int64)
    return batches.mapInArrow(_weight_batches(gain), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = 25, min_words: int = 20, seed: int = 7, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` per row of ``docs``. Of the rows with at least ``min_words`` words,
    ``percent`` percent with the highest scores are drawn and have a rank, ties to the smaller id."""
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    target = target.select(F.lit(0).alias("doc_id"), F.col(f"`{target_text}`").alias("text"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = written(weights(docs, target, batch_bytes=batch_bytes).withColumn("score", (F.col("weight") + noise).cast("long")),
                     "resample-scores", arrow_bytes=8 << 20)
    fits = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    by_score = scored.where(fits).groupBy("score").agg(F.count("*").alias("n"))
    # Scores are whole thousandths of logarithms: at most some 100,000 rows, whatever the number of documents.
    above = by_score.select("score", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0)).alias("above"))
    to_draw = percent * (by_score.agg(F.sum("n")).first()[0] or 0) // 100
    placed = scored.withColumn("fits", fits).join(F.broadcast(above), "score", "left")
    possible = F.col("fits") & (F.col("above") < to_draw)
    place = F.col("above") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features", "weight"))
    drawn = placed.where(possible).withColumn("rank", place.cast("long"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return (drawn.select(*columns, F.when(F.col("rank") <= to_draw, F.col("rank")).alias("rank"))
            .unionByName(placed.where(~F.coalesce(possible, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank"))))
