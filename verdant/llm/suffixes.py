"""Removal of long byte strings that occur more than once, by suffix arrays.

A byte goes if it is covered by a string of ``size`` bytes (a window) that also
starts anywhere else in the corpus, judged on the input. Sorting all suffixes of
a corpus in one place does not scale, so windows are dealt out first, in such a
way that equal windows meet:

1. A window's anchor is the smallest hash among its 128-byte grams. It depends
   on the window's bytes alone, so equal windows have equal anchors, and
   neighbouring windows mostly share theirs: a text falls into segments of some
   140 windows with one anchor. A gram hash that occurs once in the corpus has
   no repeated window; only segments whose anchor occurs again travel.
2. Segments are grouped by anchor, copies of a segment are counted and collapsed
   before the shuffle. The suffixes of a group of anchors are sorted in two
   stages: only those smaller than their successor (the suffix one byte later)
   are sorted directly, the others are induced from them by a scan of the
   buckets of first bytes in ascending order.
3. Neighbours in suffix order whose common prefix reaches ``size`` are repeated
   windows. Their places go back to the texts, overlapping ones are united.

With ``passage_words`` the passages of that many words that another document holds are found too: words are
split at blanks, and a passage is the same whatever blanks stand between its words. Passages are windows of words,
with anchors as above (the smallest hash among its grams of ``PASSAGE_GRAM`` words), so their segments take the same
way up to the texts. Equal segments of two texts are shared whole. Where an anchor has a segment that a single text holds
beside others, their windows are compared by the hash of their words. Nothing is removed for it; ``n_passage_words`` counts the words that shared windows cover.

An anchor whose segments exceed ``GROUP_BYTES`` is not sorted in one task: its
windows are counted by a 128-bit hash, with partial sums, which gives the same
rows. Copies of a whole text are found by their SHA-256 and travel once.

Defined results: null is the empty text (nothing removed); texts shorter than
``size`` are kept whole; repeated rows are copies of each other, whatever their
id (all words of a copy of ``passage_words`` or more are in a shared passage); a passage that one text alone repeats
isn't shared; very long texts are cut into segments like all others; other columns, whatever their names, are left out;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import n_words, written

SIZE = 400
GRAM = 128
PASSAGE_GRAM = 8            # words
CODE_BYTES = 1 << 18        # bytes of a text whose words are coded at a time
LONG_WORD = 4096            # bytes from which a word is coded by itself
BLOCK = 1 << 18             # windows of a text that are handled at a time
GROUP_BYTES = 48 << 20      # segments of one anchor that one task may sort
SORT_WINDOWS = 1 << 16      # windows that are sorted together at least, if there are so many
_BASE = np.uint64(0x5851F42D4C957F2D)
_BASE_INVERSE = np.uint64(pow(0x5851F42D4C957F2D, -1, 2**64))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[size] = tuple(tables)
    return _powers[size]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` consecutive bytes."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values: of the tail of one block
    and the head of the next."""
    n = len(h) - width + 1
    whole = np.full(-(-len(h) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    whole[:len(h)] = h
    blocks = whole.reshape(-1, width)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[width - 1:width - 1 + n])


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text."""
    edges = np.flatnonzero(np.diff(~_BLANK[np.frombuffer(text, dtype=np.uint8)], prepend=False, append=False))
    return edges[::2], edges[1::2]


def word_codes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word; only used to choose anchors."""
    data, codes = np.frombuffer(text, dtype=np.uint8), np.empty(len(starts), dtype=np.uint64)
    long = np.flatnonzero(ends - starts > LONG_WORD)
    cuts = np.unique(np.concatenate([np.searchsorted(starts, np.arange(0, len(data), CODE_BYTES)), long, long + 1, [len(starts)]]))
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        lo, hi = int(starts[a]), int(ends[b - 1])
        if b == a + 1 and hi - lo > LONG_WORD:
            codes[a] = xxhash.xxh64_intdigest(text[lo:hi])
            continue
        up, down = _power_tables(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum((data[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        codes[a:b] = (sums[ends[a:b] - lo] - sums[starts[a:b] - lo]) * down[starts[a:b] - lo]
    codes ^= codes >> np.uint64(31)
    codes *= np.uint64(0x9E3779B97F4A7C15)
    return codes ^ (codes >> np.uint64(29))


def anchor_runs(text: bytes | np.ndarray, size: int, gram: int, inside: bool = True):
    """``(anchor, start, end, again)`` arrays: the windows ``start <= i < end`` (of bytes, or of an array's numbers)
    share an anchor; ``again``: its gram occurs more than once among them (False without ``inside``)."""
    parts = []
    symbols = np.frombuffer(text, dtype=np.uint8) if isinstance(text, bytes) else text
    width = size - gram + 1
    for a in range(0, len(text) - size + 1, BLOCK):
        b = min(a + BLOCK, len(text) - size + 1)
        h = gram_hashes(symbols[a:b + size - 1], gram)
        least = sliding_minimum(h, width)
        cut = np.flatnonzero(least[1:] != least[:-1]) + 1
        start, end = np.concatenate([[0], cut]), np.concatenate([cut, [b - a]])
        anchor = least[start]
        again = (end - start > width) & inside
        near = np.arange(width)
        for at in range(0, len(start) if inside else 0, 512):  # few runs at a time: the comparison has a row of grams for each
            s, e, v = start[at:at + 512, None], end[at:at + 512, None] - 1, anchor[at:at + 512, None]
            first = np.argmax(h[s + near] == v, axis=1) + s[:, 0]
            last = e[:, 0] + width - 1 - np.argmax(h[e + near[::-1]] == v, axis=1)
            again[at:at + 512] |= first != last
        parts.append((anchor.view(np.int64), start + a, end + a, again))
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _run_batches(size: int, gram: int, passage: int | None):
    def run(batches):
        for batch in batches:
            at, found, in_words = [], [], []

            def add(k, runs, of_words, at=at, found=found, in_words=in_words):
                found.append(runs)
                at.append(np.full(len(runs[0]), k))
                in_words.append(np.full(len(runs[0]), of_words))

            for k, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                if text is not None and len(text) >= size:
                    add(k, anchor_runs(text, size, gram), False)
                if text is not None and passage:
                    starts, ends = word_places(text)
                    if len(starts) >= passage:
                        add(k, anchor_runs(word_codes(text, starts, ends), passage, min(PASSAGE_GRAM, passage), inside=False), True)
            if not found:
                continue
            anchor, start, end, again = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(np.concatenate(at))), pa.array(anchor), pa.array(start.astype(np.int64)),
                 pa.array(end.astype(np.int64)), pa.array(again), pa.array(np.concatenate(in_words))],
                names=["key", "anchor", "start", "end", "again", "in_words"])
    return run


def _segment_batches(size: int, with_bytes: bool):
    """Segments of marked texts: their bytes, or the key, start and 128-bit hash of each."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            marks = batch.column("marks").to_pylist()
            keys = batch.column("key").to_pylist()
            for text, own, key in zip(texts, marks, keys, strict=True):
                own = [m for m in own if not m["in_words"]]
                cut = [text[m["start"]:m["end"] + size - 1] for m in own]
                if with_bytes:
                    columns = {"anchor": pa.array([m["anchor"] for m in own], pa.int64()), "segment": pa.array(cut, pa.binary())}
                else:
                    columns = {"segment_key": pa.array([xxhash.xxh3_128_digest(c) for c in cut], pa.binary()),
                               "key": pa.array([key] * len(cut), pa.binary()),
                               "start": pa.array([m["start"] for m in own], pa.int64())}
                yield pa.RecordBatch.from_pydict(columns)
    return run


def suffix_order(segments: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all segments in the order of their first ``size`` bytes, by two-stage sorting.

    Returns ``(data, order, offsets)``: the joined bytes, the window starts in
    suffix order and each segment's offset. Suffixes end with their segment."""
    joined = b"".join(segments)
    data = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.array([len(s) for s in segments])
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    ends = offsets + lengths
    n = len(data)
    # 1 if a suffix is smaller than its successor; equal first bytes decide like the next
    # position, and a segment's last byte is larger than its empty successor.
    rises = np.zeros(n, dtype=np.int8)
    rises[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    rises[ends - 1] = -1
    decided = np.where(rises != 0, np.arange(n), n)
    smaller = rises[np.minimum.accumulate(decided[::-1])[::-1]] > 0
    # Windows, and what follows the last one up to the next directly sorted suffix.
    next_smaller = np.minimum.accumulate(np.where(smaller, np.arange(n), n)[::-1])[::-1]
    valid_end = ends - size + 1
    reach = np.minimum(next_smaller[np.minimum(valid_end, ends - 1)], ends - 1)
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, offsets, 1)
    np.add.at(step, reach + 1, -1)
    used = np.cumsum(step[:-1]) > 0
    end_of = np.repeat(ends, lengths)
    direct = np.flatnonzero(used & smaller)
    stops = np.minimum(direct + size, end_of[direct]).tolist()
    keys = [joined[i:j] for i, j in zip(direct.tolist(), stops, strict=True)]
    direct = direct[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    # Buckets of first bytes: larger suffixes come first, smaller ones after them.
    larger = np.flatnonzero(used & ~smaller)
    n_larger = np.bincount(data[larger], minlength=256)
    n_direct = np.bincount(data[direct], minlength=256)
    bucket = np.concatenate([[0], np.cumsum(n_larger + n_direct)])
    rank = np.full(n + 1, -1, dtype=np.int64)     # rank[end of a segment] is read as -1
    shift = np.concatenate([[0], np.cumsum(n_direct)])
    first = data[direct].astype(np.int64)
    rank[direct] = bucket[first] + n_larger[first] + np.arange(len(direct)) - shift[first]
    larger = larger[np.argsort(data[larger], kind="stable")]
    at = 0
    for c in np.flatnonzero(n_larger):
        own = larger[at:at + n_larger[c]]
        at += n_larger[c]
        last = own + 1 == end_of[own]
        after = np.where(last, -1, rank[own + 1])
        same = ~last & (data[np.minimum(own + 1, n - 1)] == c)
        wave, place = own[~same], bucket[c]
        wave = wave[np.argsort(after[~same], kind="stable")]
        waiting = np.zeros(0, dtype=bool)
        if same.any():
            waiting = np.zeros(n + 1, dtype=bool)
            waiting[own[same]] = True
        while len(wave):
            rank[wave] = place + np.arange(len(wave))
            place += len(wave)
            if not len(waiting):
                break
            before = wave - 1                     # "c" before a suffix just placed that starts with c
            wave = before[(before >= 0) & waiting[before]]
            waiting[wave] = False
    placed = np.flatnonzero(used)
    order = np.empty(len(placed), dtype=np.int64)
    order[rank[placed]] = placed
    return data, order[end_of[order] - order >= size], offsets


def repeated_windows(segments: list[bytes], size: int) -> list[np.ndarray]:
    """For each segment the starts of windows that have an equal one among all
    segments: those whose common prefix with a neighbour in suffix order reaches ``size``."""
    data, order, offsets = suffix_order(segments, size)
    common = np.zeros(max(len(order) - 1, 0), dtype=np.int64)
    if len(common):
        padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
        eights = np.ndarray(shape=(len(data),), dtype=np.uint64, buffer=padded, strides=(1,))
        alive = np.arange(len(common))
        for at in range(0, size - 7, 8):
            alive = alive[eights[order[alive] + at] == eights[order[alive + 1] + at]]
            common[alive] = at + 8
        for at in range(size - size % 8, size):
            alive = alive[data[order[alive] + at] == data[order[alive + 1] + at]]
            common[alive] = at + 1
    equal = common >= size
    hit = np.zeros(len(order), dtype=bool)
    hit[:-1] |= equal
    hit[1:] |= equal
    starts = np.sort(order[hit])
    cuts = np.searchsorted(starts, offsets)
    return [starts[a:b] - o for a, b, o in zip(cuts, [*cuts[1:], len(starts)], offsets, strict=True)]


def intervals(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive numbers as (first, past the last)."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    return starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])] + 1


def _sort_batches(size: int):
    """Rows ``(anchor, segment, n)`` in the order of anchors -> the repeated windows of each segment."""
    def found(segments: list[bytes], counts: list[int]):
        lone = repeated_windows(segments, size)
        keys, lows, highs = [], [], []
        for s, n, hit in zip(segments, counts, lone, strict=True):
            lo, hi = ([0], [len(s) - size + 1]) if n > 1 else intervals(hit)
            keys += [xxhash.xxh3_128_digest(s)] * len(lo)
            lows.extend(lo), highs.extend(hi)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(lows, pa.int64()), pa.array(highs, pa.int64())],
                                          names=["segment_key", "lo", "hi"])

    def run(batches):
        segments, counts, windows, last = [], [], 0, None
        for batch in batches:
            for anchor, segment, n in zip(*(batch.column(c).to_pylist() for c in ("anchor", "segment", "n")), strict=True):
                if anchor != last and windows >= SORT_WINDOWS:
                    yield found(segments, counts)
                    segments, counts, windows = [], [], 0
                last = anchor
                segments.append(segment), counts.append(n)
                windows += len(segment) - size + 1
        if segments:
            yield found(segments, counts)
    return run


def _window_batches(size: int):
    """Every window of a segment with its 128-bit hash, for anchors too large to sort in one task."""
    def run(batches):
        for batch in batches:
            for segment, n in zip(batch.column("segment").to_pylist(), batch.column("n").to_pylist(), strict=True):
                key = xxhash.xxh3_128_digest(segment)
                count = len(segment) - size + 1
                for a in range(0, count, 1 << 15):
                    starts = range(a, min(a + (1 << 15), count))
                    yield pa.RecordBatch.from_pydict({
                        "window": pa.array([xxhash.xxh3_128_digest(segment[i:i + size]) for i in starts], pa.binary()),
                        "segment_key": pa.array([key] * len(starts), pa.binary()),
                        "lo": pa.array(starts, pa.int64()), "n": pa.array([n] * len(starts), pa.int64())})
    return run


def _passage_batches(passage: int):
    """Segments of words of marked texts: key, start, anchor, hash and the hashes of their windows."""
    def run(batches):
        for batch in batches:
            for key, text, marks in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                                        batch.column("marks").to_pylist(), strict=True):
                own = [m for m in marks if m["in_words"]]
                if not own:
                    continue
                starts, ends = word_places(text)
                columns = {"segment_key": [], "n": [], "windows": []}
                for m in own:
                    s, e = (x[m["start"]:m["end"] + passage - 1].tolist() for x in (starts, ends))
                    words = b" ".join([text[i:j] for i, j in zip(s, e, strict=True)])
                    first = np.concatenate([[0], np.cumsum([j - i + 1 for i, j in zip(s, e, strict=True)])])
                    hashes = [xxhash.xxh3_64_intdigest(words[i:j]) for i, j in zip(first[:-passage].tolist(), (first[passage:] - 1).tolist(), strict=True)]
                    columns["segment_key"].append(xxhash.xxh3_128_digest(words))
                    columns["n"].append(len(hashes))
                    columns["windows"].append(np.array(hashes, dtype=np.uint64).view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(own), pa.binary()), pa.array([m["start"] for m in own], pa.int64()),
                     pa.array([m["anchor"] for m in own], pa.int64()), pa.array(columns["segment_key"], pa.binary()),
                     pa.array(columns["n"], pa.int64()), pa.array(columns["windows"], pa.list_(pa.int64()))],
                    names=["key", "start", "anchor", "segment_key", "n", "windows"])
    return run


def shared_words(marked: DataFrame, passage: int) -> DataFrame:
    """``(key, n_passage_words)`` of the marked texts that share a window of ``passage`` words with another text."""
    owners = written(marked.mapInArrow(_passage_batches(passage), "key binary, start bigint, anchor bigint, segment_key binary, n bigint, "
                                       "windows array<bigint>"), "passage-segments")
    holders = [F.min(F.xxhash64("key")).alias("lo"), F.max(F.xxhash64("key")).alias("hi")]
    segments = written(owners.groupBy("segment_key", "anchor").agg(*holders), "passage-distinct")
    # All windows of a segment of two texts are shared. One of a single text has to be compared with others of its anchor.
    mixed = segments.groupBy("anchor").agg(F.count("*").alias("n"), F.bool_or(F.col("lo") == F.col("hi")).alias("lone")) \
        .where("n > 1 and lone").select("anchor")
    windows = written(owners.join(mixed, "anchor", "left_semi").groupBy("segment_key", "anchor").agg(*holders, F.first("windows").alias("windows"))
                      .select("segment_key", "anchor", "lo", "hi", F.posexplode("windows").alias("i", "window")), "passage-windows")
    shared = windows.groupBy("anchor", "window").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("anchor", "window")
    hits = windows.where("lo = hi").join(shared, ["anchor", "window"], "left_semi").groupBy("segment_key").agg(F.collect_list("i").alias("hits"))
    place = lambda lo, n: F.struct(lo.alias("lo"), (lo + n + passage - 1).alias("hi"))
    own = owners.select("key", "start", "segment_key", "n")
    start = F.col("start")
    whole = own.join(segments.where("lo <> hi").select("segment_key"), "segment_key").select("key", F.array(place(start, F.col("n"))).alias("places"))
    parts = own.join(hits, "segment_key").select("key", F.transform("hits", lambda i: place(start + i, F.lit(1).cast("long"))).alias("places"))
    places = whole.unionByName(parts).groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("places"))
    none = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("total"))
    more = lambda so, p: F.greatest(p["hi"] - F.greatest(so["upto"], p["lo"]), F.lit(0).cast("long"))
    return places.select("key", F.aggregate(
        "places", none, lambda so, p: F.struct(F.greatest(so["upto"], p["hi"]).alias("upto"), (so["total"] + more(so, p)).alias("total")),
        lambda so: so["total"]).alias("n_passage_words"))


def _removed_batches(size: int):
    """Texts with the places of their repeated windows -> what is removed and the hash of the rest."""
    def run(batches):
        for batch in batches:
            out = {"key": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
            for key, text, places in zip(batch.column("key").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                                         batch.column("places").to_pylist(), strict=True):
                spans = []
                for lo, hi in sorted((p["lo"], p["hi"] + size - 1) for p in places):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                rest, at = hashlib.sha256(), 0
                for lo, hi in spans:
                    rest.update(text[at:lo])
                    at = hi
                rest.update(text[at:])
                for name, v in (("key", key), ("n_removed", sum(hi - lo for lo, hi in spans)), ("n_spans", len(spans)),
                                ("kept_sha256", rest.hexdigest()), ("spans", [{"lo": lo, "hi": hi} for lo, hi in spans])):
                    out[name].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("key", pa.binary()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                ("spans", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))]))
    return run


def repeated_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
                   gram: int = GRAM, group_bytes: int = GROUP_BYTES, passage_words: int | None = None) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans)``, one row
    per row of ``docs``; ``spans`` are the removed byte ranges ``lo <= i < hi``.
    With ``passage_words`` there is ``n_passage_words`` too."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sha = F.sha2(text, 256)
    key = F.unhex(F.substring(sha, 1, 32))
    keyed = docs.select(key.alias("key"), text.alias("text")).where(
        F.octet_length("text") >= min(size, 2 * (passage_words or size) - 1))
    meta = written(docs.select(F.col(f"`{id_col}`").alias("doc_id"), key.alias("key"), sha.alias("sha"),
                               F.octet_length(text).cast("long").alias("n_bytes"),
                               *([n_words(text).alias("n_words")] if passage_words else [])), "suffix-texts")
    copies = meta.groupBy("key").agg(F.count("*").alias("copies"))

    runs = written(keyed.mapInArrow(_run_batches(size, gram, passage_words),
                                    "key binary, anchor bigint, start bigint, end bigint, again boolean, in_words boolean"), "suffix-runs")
    # A text's own repeats count for bytes, not for words.
    place = F.when(F.col("in_words"), F.xxhash64("key")).otherwise(F.xxhash64("key", "start"))
    again = runs.groupBy("anchor").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("again").alias("again")) \
        .where("lo <> hi or again").select("anchor")
    marks = runs.join(again, "anchor").groupBy("key").agg(F.collect_set(F.struct("start", "end", "anchor", "in_words")).alias("marks"))
    marked = written(keyed.join(marks, "key").dropDuplicates(["key"]), "suffix-marked")

    segments = marked.mapInArrow(_segment_batches(size, True), "anchor bigint, segment binary") \
        .groupBy("anchor", "segment").agg(F.count("*").alias("n"))
    segments = written(segments, "suffix-segments")
    large = segments.groupBy("anchor").agg(F.sum(F.octet_length("segment")).alias("b")).where(F.col("b") > group_bytes).select("anchor")
    large = written(large, "suffix-large")
    small = segments.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    places = small.mapInArrow(_sort_batches(size), "segment_key binary, lo bigint, hi bigint")
    if not large.isEmpty():
        windows = written(segments.join(large, "anchor", "left_semi").mapInArrow(
            _window_batches(size), "window binary, segment_key binary, lo bigint, n bigint"), "suffix-windows")
        twice = windows.groupBy("window").agg(F.sum("n").alias("times")).where("times > 1").select("window")
        places = places.unionByName(windows.join(twice, "window", "left_semi")
                                    .select("segment_key", "lo", (F.col("lo") + 1).alias("hi")))
    places = written(places, "suffix-places")
    owners = marked.mapInArrow(_segment_batches(size, False), "segment_key binary, key binary, start bigint")
    by_text = owners.join(places, "segment_key").groupBy("key").agg(F.collect_list(F.struct(
        (F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))).alias("places"))
    removed = marked.select("key", "text").join(by_text, "key").mapInArrow(
        _removed_batches(size), "key binary, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<lo:bigint,hi:bigint>>")

    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= size)
    span = F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("n_bytes").alias("hi")))
    none = F.array().cast("array<struct<lo:bigint,hi:bigint>>")
    zero = F.lit(0).cast("long")
    per_text, more = meta.join(copies, "key").join(removed, "key", "left"), []
    if passage_words:
        per_text = per_text.join(shared_words(marked, passage_words), "key", "left")
        copied = (F.col("copies") > 1) & (F.col("n_words") >= passage_words)
        more = [F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_passage_words", zero)).alias("n_passage_words")]
    return per_text.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(whole, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(whole, span).otherwise(F.coalesce("spans", none)).alias("spans"), *more)
