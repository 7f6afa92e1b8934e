"""Line dedup by pairwise alignment.

1. Lines (without outer white space, those with a word) are counted by the texts
   that hold them. Only lines of two texts or more can be in a common block.
2. Documents meet through their rare lines: for every line, the fewest lines from
   it on, and the fewest up to it, that hold ``min_words`` words and are all held
   by other texts too, are a run; its key is its rarest line together with the hash of
   the run. Frequent lines (menus, greetings) thus bring nobody together unless
   a whole run consists of them. A document is aligned with the first holder of
   each of its runs: linear in the lines, however many documents hold a run.
3. The alignment is a patience diff: equal lines at both ends are matched, lines
   that occur once on either side are anchors, the longest chain of anchors in
   order is kept, and the stretches between them are aligned in the same way;
   where no line is unique, the k-th occurrences are paired. Runs of lines matched
   one by one, with ``min_words`` words or more, are deleted from the later document
   (larger id); the earlier one keeps them.
4. One alignment cannot match passages that lie in another order in the two
   documents. So the stretches that it leaves are aligned with the earlier document
   again, by themselves; if an alignment of a stretch matched short runs only,
   it is cut at these. This ends when no stretch holds a common run.

A line goes only if an alignment put it in a block. What alignments cannot reach:
a common run with a line in it that was matched elsewhere, as part of a chain of
short matches only; its pieces of fewer than ``min_words`` words stay.

Blank lines are left out of the alignment and go if they lie inside a deleted block.

Jobs: texts reach Python once, to become tables of line hashes. Alignments work on
these; an earlier document with many partners is replicated once for every
``PARTNERS`` of them, so that no task gets them all. The texts are cut by
expressions on the line ranges that stay, after one shuffle.

Defined results: null text has no lines and stays null; an exact copy of an
earlier text of ``min_words`` words or more loses all its lines; rows that share
id and text are one document; rows with a null id are neither changed nor
aligned; texts of any length are treated whole, one line of any length is one line;
of texts that first occur with the same id, the one with the smaller hash counts as the earlier;
other columns may have any names; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import n_words, whole_row, written
from verdant.operators.broadcast import broadcast_if_small

MIN_WORDS = 20
PARTNERS = 256             # alignments with one earlier document that may share a task
_DIGEST = 16


def line_table(text: bytes | None) -> tuple[bytes, bytes, bytes, int, int]:
    """(digests, word counts, numbers) of the lines with a word, and how many lines and words there are."""
    if text is None:
        return b"", b"", b"", 0, 0
    lines = text.split(b"\n")
    counts = np.array([len(x.split()) for x in lines], dtype=np.int32)
    own = np.flatnonzero(counts).astype(np.int32)
    return (b"".join(xxhash.xxh3_128_digest(lines[k].strip()) for k in own), counts[own].tobytes(), own.tobytes(),
            len(lines), int(counts.sum()))


def _line_batches(batches):
    for batch in batches:
        tables = [line_table(t.as_py()) for t in batch.column("text").cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("sha"), batch.column("key"),
             *[pa.array([t[k] for t in tables], pa.binary()) for k in (0, 1, 2)],
             *[pa.array([t[k] for t in tables], pa.int64()) for k in (3, 4)]],
            names=["doc_id", "sha", "key", "digests", "counts", "numbers", "n_lines", "n_words"])


def _line_hashes(digests: bytes) -> np.ndarray:
    """A 64-bit hash of each line: the head of its digest."""
    return np.frombuffer(digests, dtype="<i8")[::2]


def _holder_batches(batches):
    """Texts -> one row for each of their different lines."""
    for batch in batches:
        own = [np.unique(_line_hashes(d)) for d in batch.column("digests").to_pylist()]
        take = pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own) if own else np.empty(0, dtype=np.int64)),
                                          batch.column("key").take(take)], names=["line", "key"])


def _split(digests: bytes) -> list[bytes]:
    return [digests[i:i + _DIGEST] for i in range(0, len(digests), _DIGEST)]


def run_bounds(words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """The fewest lines from each line on, and up to each line, that hold ``min_words`` words, as rising ``lo <= line < hi``."""
    upto = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    ends = np.searchsorted(upto, upto[:-1] + min_words)
    starts = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
    return sorted({*((i, int(j)) for i, j in enumerate(ends) if j < len(upto)),
                   *((int(i), j + 1) for j, i in enumerate(starts) if i >= 0)})


def rare_runs(digests: bytes, counts: bytes, holders: dict[int, int], min_words: int) -> set[tuple[int, int]]:
    """``(rarest line, hash)`` of each run of ``run_bounds`` whose lines are all in ``holders`` (texts by line)."""
    lines = _line_hashes(digests).tolist()
    n = [holders.get(x, 0) for x in lines]
    alone = np.concatenate([[0], np.cumsum([x == 0 for x in n])])
    out = set()
    for lo, hi in run_bounds(np.frombuffer(counts, dtype=np.int32), min_words):
        if alone[hi] == alone[lo]:
            rarest = min(zip(n[lo:hi], lines[lo:hi], strict=True))[1]
            out.add((rarest, xxhash.xxh64_intdigest(digests[_DIGEST * lo:_DIGEST * hi]) - 2**63))
    return out


def _run_batches(min_words: int):
    def run(batches):
        for batch in batches:
            at, found = [], []
            for k in range(batch.num_rows):
                holders = {x["line"]: x["n"] for x in batch.column("shared")[k].as_py()}
                own = rare_runs(batch.column("digests")[k].as_py(), batch.column("counts")[k].as_py(), holders, min_words)
                found.extend(own)
                at.extend([k] * len(own))
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], batch.column("first").take(take),
                 batch.column("key").take(take)], names=["line", "run", "first", "key"])
    return run


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs, given in the order of the first, that also rises in the second."""
    tops, heads, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(heads[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j), heads.append(k)
        else:
            tops[pile], heads[pile] = j, k
    chain, k = [], heads[-1] if heads else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def _anchors(a: list, b: list, alo: int, ahi: int, blo: int, bhi: int) -> list[tuple[int, int]]:
    na, nb = Counter(a[alo:ahi]), Counter(b[blo:bhi])
    place = {b[j]: j for j in range(blo, bhi) if nb[b[j]] == 1}
    once = [(i, place[a[i]]) for i in range(alo, ahi) if na[a[i]] == 1 and a[i] in place]
    if not once:
        seen: Counter = Counter()
        later = {}
        for j in range(blo, bhi):
            if b[j] in na:
                later[b[j], seen[b[j]]] = j
                seen[b[j]] += 1
        seen.clear()
        for i in range(alo, ahi):
            if (a[i], seen[a[i]]) in later:
                once.append((i, later[a[i], seen[a[i]]]))
                seen[a[i]] += 1
    return _increasing(once)


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched positions (i, j) of two sequences, rising in both."""
    matched, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            matched.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            matched.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        chain = _anchors(a, b, alo, ahi, blo, bhi)
        if not chain:
            continue
        # From anchor to anchor; an anchor heads the stretch after it and is matched as its first line.
        for (i, j), (k, m) in zip([(alo, blo), *chain], [*chain, (ahi, bhi)], strict=True):
            if i < k and j < m:
                todo.append((i, k, j, m))
    return sorted(matched)


def _blocks(pairs: list[tuple[int, int]], words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Ranges of the first sequence that are matched line by line and hold ``min_words`` words."""
    out, start = [], 0
    for k in range(1, len(pairs) + 1):
        if k == len(pairs) or pairs[k] != (pairs[k - 1][0] + 1, pairs[k - 1][1] + 1):
            lo, hi = pairs[start][0], pairs[k - 1][0] + 1
            if words[lo:hi].sum() >= min_words:
                out.append((lo, hi))
            start = k
    return out


def common_blocks(later: bytes, counts: bytes, earlier: bytes, min_words: int) -> list[tuple[int, int]]:
    """Ranges ``lo <= line < hi`` of the later document that alignments with the earlier one put in blocks of
    ``min_words`` words."""
    words = np.frombuffer(counts, dtype=np.int32)
    a, b = _split(later), _split(earlier)
    # Lines that the later document lacks are in no common run, so their words do not matter.
    known = dict(zip(a, words.tolist(), strict=True))
    others = np.array([known.get(x, 0) for x in b], dtype=np.int64)
    held = {earlier[_DIGEST * i:_DIGEST * j] for i, j in run_bounds(others, min_words)}

    out, todo = [], [(0, len(a))]
    while todo:
        lo, hi = todo.pop()
        if not any(later[_DIGEST * (lo + i):_DIGEST * (lo + j)] in held for i, j in run_bounds(words[lo:hi], min_words)):
            continue
        pairs = patience(a[lo:hi], b)
        if not pairs:
            continue
        cuts = _blocks(pairs, words[lo:hi], min_words)
        out.extend((lo + i, lo + j) for i, j in cuts)
        ends = cuts or [(i, i + 1) for i, _ in pairs]
        todo.extend((lo + i, lo + j) for i, j in zip([0, *[j for _, j in ends]], [*[i for i, _ in ends], hi - lo], strict=True) if i < j)
    return out


def _align_batches(min_words: int):
    def run(batches):
        for batch in batches:
            at, lows, highs = [], [], []
            columns = [batch.column(c) for c in ("digests", "counts", "numbers", "other")]
            for k in range(batch.num_rows):
                later, counts, numbers, earlier = (c[k].as_py() for c in columns)
                number = np.frombuffer(numbers, dtype=np.int32)
                for lo, hi in common_blocks(later, counts, earlier, min_words):
                    at.append(k), lows.append(int(number[lo])), highs.append(int(number[hi - 1]) + 1)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key").take(take), batch.column("n_lines").take(take),
                                              pa.array(lows, pa.int64()), pa.array(highs, pa.int64())], names=["key", "n_lines", "lo", "hi"])
    return run


def _range_batches(batches):
    """Blocks of a text's lines, in any order -> the ranges that stay, and the number of lines that go."""
    for batch in batches:
        ranges, gone = [], []
        for n, blocks in zip(batch.column("n_lines").to_pylist(), batch.column("blocks").to_pylist(), strict=True):
            stay, end = [], 0
            for lo, hi in sorted((x["lo"], x["hi"]) for x in blocks):
                if lo > end:
                    stay.append({"at": end + 1, "size": lo - end})
                end = max(end, hi)
            if n > end:
                stay.append({"at": end + 1, "size": n - end})
            ranges.append(stay)
            gone.append(n - sum(x["size"] for x in stay))
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array(ranges, pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32())]))), pa.array(gone, pa.int64())],
            names=["key", "stay", "n_removed"])


def _key(docs: DataFrame, text_col: str) -> tuple[Column, Column]:
    sha = F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)
    return sha.alias("sha"), F.unhex(F.substring(sha, 1, 32)).alias("key")


def _partners(reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """``pairs`` with the lines of both texts; earlier texts of many pairs are replicated, their pairs dealt out."""
    many = written(pairs.groupBy("other_key").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts")).where("parts > 1"), "line-many")
    parts = F.coalesce("parts", F.lit(1))
    dealt = pairs.join(broadcast_if_small(many), "other_key", "left").select(
        "key", "other_key", F.pmod(F.xxhash64("key"), parts).cast("int").alias("part"))
    earlier = (reps.select(F.col("key").alias("other_key"), F.col("digests").alias("other")).join(broadcast_if_small(many), "other_key", "left")
               .select("other_key", "other", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part")))
    return (dealt.join(reps.select("key", "digests", "counts", "numbers", "n_lines"), "key").join(earlier, ["other_key", "part"])
            .select("key", "digests", "counts", "numbers", "n_lines", "other"))


def deleted_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS):
    """``(rows, texts)``: ``rows`` has ``(doc_id, key, sha, n_lines, n_words)`` per row of ``docs``; ``texts`` has
    ``(key, first, n_words, stay, n_removed)`` per text with an id: its first holder, and the ranges of its lines that
    stay if any go because of another text."""
    small = {"arrow_bytes": 8 << 20}
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *_key(docs, text_col))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    lines = written(keyed.mapInArrow(_line_batches, f"doc_id {kind}, sha string, key binary, digests binary, counts binary, "
                                     "numbers binary, n_lines bigint, n_words bigint"), "line-tables", **small)
    fixed = ("digests", "counts", "numbers", "n_lines", "n_words")          # equal in rows of one key
    reps = written(lines.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("first"), *[F.first(c).alias(c) for c in fixed]),
                   "line-reps")
    holders = written(reps.select("key", "digests").mapInArrow(_holder_batches, "line bigint, key binary"), "line-holders", **small)
    common = holders.groupBy("line").agg(F.count("*").alias("n")).where("n > 1")
    shared = holders.join(common, "line").groupBy("key").agg(F.collect_list(F.struct("line", "n")).alias("shared"))
    runs = written(reps.select("key", "first", "digests", "counts").join(shared, "key").mapInArrow(
        _run_batches(min_words), f"line bigint, run bigint, first {kind}, key binary"), "line-runs", **small)
    firsts = runs.groupBy("line", "run").agg(F.min(F.struct("first", "key")).alias("e"), F.count("*").alias("n")).where("n > 1")
    pairs = written(runs.join(firsts, ["line", "run"]).where("key <> e.key").select("key", F.col("e.key").alias("other_key")).distinct(),
                    "line-pairs")
    blocks = written(_partners(reps, pairs).mapInArrow(_align_batches(min_words), "key binary, n_lines bigint, lo bigint, hi bigint"),
                     "line-blocks", **small)
    per_text = blocks.groupBy("key", "n_lines").agg(F.collect_set(F.struct("lo", "hi")).alias("blocks"))
    cut = per_text.mapInArrow(_range_batches, "key binary, stay array<struct<at:int,size:int>>, n_removed bigint")
    texts = written(reps.select("key", "first", "n_words").join(cut, "key", "left"), "line-texts", **small)
    return lines.select("doc_id", "sha", "key", "n_lines", "n_words"), texts


def _rest(text: Column) -> Column:
    """The lines of ``text`` in the ranges ``stay``."""
    lines = F.split(text, "\n")
    return F.array_join(F.flatten(F.transform("stay", lambda x: F.slice(lines, x["at"], x["size"]))), "\n")


def line_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_lines, n_words, n_removed, n_removed_words, kept_sha256)``, one row per row of ``docs``."""
    rows, texts = deleted_lines(docs, id_col=id_col, text_col=text_col, min_words=min_words)
    # Only texts that lose lines are read again.
    cut = texts.where("stay is not null").select("key", "stay")
    keyed = docs.where(F.col(f"`{id_col}`").isNotNull()).select(_key(docs, text_col)[1], F.col(f"`{text_col}`").alias("text"))
    rest = written(keyed.join(broadcast_if_small(cut), "key").select("key", _rest(F.col("text")).alias("rest"))
                   .select("key", n_words(F.col("rest")).alias("rest_words"), F.sha2("rest", 256).alias("rest_sha"))
                   .dropDuplicates(["key"]), "line-rest")
    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= min_words)
    zero = F.lit(0).cast("long")
    pick = lambda whole, part, none: F.when(copy, whole).when(F.col("doc_id").isNotNull(), F.coalesce(part, none)).otherwise(none)
    return rows.join(texts.select("key", "first", "n_removed"), "key", "left").join(rest, "key", "left").select(
        "doc_id", "n_lines", "n_words", pick(F.col("n_lines"), F.col("n_removed"), zero).alias("n_removed"),
        pick(F.col("n_words"), F.col("n_words") - F.col("rest_words"), zero).alias("n_removed_words"),
        pick(F.sha2(F.lit(""), 256), F.col("rest_sha"), F.col("sha")).alias("kept_sha256"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with their remaining text; rows that lose every word go. A column
    ``n_chars`` of the remaining text is brought up to date if there is one."""
    _, texts = deleted_lines(docs, id_col=id_col, text_col=text_col, min_words=min_words)
    row = F.col("row")
    keyed = docs.select(whole_row(docs), F.when(F.col(f"`{id_col}`").isNotNull(), _key(docs, text_col)[1]).alias("key"))
    out = keyed.join(texts.select("key", "first", "n_words", "stay"), "key", "left")
    out = out.where(~F.coalesce((row[id_col] > F.col("first")) & (F.col("n_words") >= min_words), F.lit(False)))
    out = out.select("row", F.when(F.col("stay").isNotNull(), _rest(row[text_col])).alias("rest"))
    out = out.where(F.col("rest").isNull() | F.col("rest").rlike(r"[^\x20\x09-\x0D]"))
    new = {text_col: F.coalesce("rest", row[text_col])}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("rest").cast(docs.schema["n_chars"].dataType), row["n_chars"])
    return out.select(*[new.get(c, row[c]).alias(c) for c in docs.columns])
