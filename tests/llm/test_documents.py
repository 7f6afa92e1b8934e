"""The operators on documents against plain-Python versions, on awkward rows."""

import hashlib
import random
import time
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from tests.llm import fixtures as X
from verdant.llm import linedup, mixing, packing, quality, secrets, setsketch, suffixes
from verdant.llm.common import connected_components


@pytest.fixture(scope="module")
def rows():
    return X.corpus()


def duck(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    done = con.execute(sql)
    return [d[0] for d in done.description], done.fetchall()


def same_rows(df, names, expected):
    assert sorted(df.columns) == sorted(names)
    got = Counter(tuple(r) for r in df.select(*names).collect())
    assert got == Counter(expected)


# Mixing

def test_mix_report_equals_sql(spark, rows):
    rows = [r for r in rows if r[1] is None or "\0" not in r[1]]     # SQL strings end at a zero byte
    same_rows(mixing.mix_report(X.frame(spark, rows)), *duck(rows, mixing.ORACLE.format(documents="documents")))


def test_mix_targets_and_budgets(spark):
    rng = random.Random(5)
    rows = [(i, X.prose(rng, rng.randrange(1, 60)), "en", "hot" if i % 3 else f"s{i % 7}", 0) for i in range(900)]
    out = mixing.mix_report(X.frame(spark, rows)).collect()
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    total = sum(r.size for r in out)
    assert abs(sum(rs[0].target for rs in by.values()) - 1.5 * total) < 1e-6
    for rs in by.values():
        assert rs[0].target <= 2 * rs[0].source_size + 1e-9
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs)
        assert all(r.taken in (0, r.size, 2 * r.size) for r in rs)


def test_mix_excess_is_reshared_by_weight(spark):
    sized = spark.createDataFrame([(False, "a", 10), (False, "b", 1000), (False, "c", 1000)], "no_source boolean, src string, size long")
    got = {r.src: r.target for r in mixing.source_targets(sized).collect()}
    # 3015 to share; a is capped at 20; b and c share the rest 2 to 1, b is capped at 2000.
    assert got == {"a": 20.0, "b": pytest.approx(1996.6666666666667), "c": pytest.approx(998.3333333333334)}


def test_mix_nested_budgets(spark, rows):
    small = mixing.mix_report(X.frame(spark, rows), share=0.4).collect()
    large = {(r.doc_id, r.source): r.copies for r in mixing.mix_report(X.frame(spark, rows), share=0.8).collect()}
    assert all(r.copies <= large[r.doc_id, r.source] for r in small)


def test_mix_sources_rows(spark, rows):
    df = X.frame(spark, rows)
    copies = Counter()
    for r in mixing.mix_report(df).collect():
        copies[r.doc_id, r.source, r.size] += r.copies
    out = mixing.mix_sources(df)
    assert out.columns == df.columns
    got = Counter((r.doc_id, r.source, len(X.words(r.text))) for r in out.collect())
    assert got == Counter({k: v for k, v in copies.items() if v})


# Packing

def test_boundaries_are_optimal():
    from itertools import combinations
    rng = random.Random(2)
    for _ in range(30):
        lengths = sorted(rng.sample(range(1, 60), rng.randrange(1, 9)))
        counts = [rng.randrange(1, 20) for _ in lengths]
        k = rng.randrange(1, 5)

        def padding(bounds, lengths=lengths, counts=counts):
            return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))
        best = min(padding([*c, lengths[-1]]) for c in combinations(lengths[:-1], min(k, len(lengths)) - 1))
        found = packing.optimal_boundaries(lengths, counts, k)
        assert len(found) <= k and padding(found) == best


def test_pack_equals_sql(spark, rows):
    rows = [r for r in rows if r[1] is None or "\0" not in r[1]]
    options = {"max_len": 100, "n_buckets": 4, "token_budget": 400}
    got = packing.pack(X.frame(spark, rows), **options)
    same_rows(got, *duck(rows, packing.oracle(**options)))


def test_pack_holds_every_token_and_the_budget(spark, rows):
    out = packing.pack(X.frame(spark, rows), max_len=64, n_buckets=5, token_budget=256).collect()
    total = Counter()
    for r in out:
        total[r.doc_id] += r.length
    expected = Counter()
    for r in rows:
        expected[r[0]] += len(X.words(r[1]))
    assert total == expected
    assert all(r.length <= r.padded for r in out if r.length) and all(r.batch is None for r in out if not r.length)
    fill = Counter((r.bucket, r.batch) for r in out if r.length)
    width = {(r.bucket, r.batch): r.padded for r in out if r.length}
    assert all(n * width[k] <= 256 for k, n in fill.items())
    assert len({(r.bucket, r.batch, r.slot) for r in out if r.length}) == sum(fill.values())


# Quality

def test_quality_counts_and_verdicts(spark, rows):
    out = quality.judged(X.frame(spark, rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        counts = X.base_counts(r.row.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.kept and r.base_failed) and 0 <= r.quality <= 1


def test_label_model_finds_planted_rates():
    rng = random.Random(9)
    patterns = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.8
        patterns[tuple(0 if rng.random() < 0.2 else (1 if (rng.random() < a) == good else -1)
                       for a in (0.95, 0.9, 0.85, 0.8, 0.9))] += 1
    model = quality.fit_label_model(list(patterns.items()))
    assert abs(model.prior - 0.8) < 0.03
    for found, planted in zip(model.good_given_good, (0.95, 0.9, 0.85, 0.8, 0.9)):
        assert abs(found - planted) < 0.04
    assert model == quality.fit_label_model(sorted(patterns.items(), reverse=True))


def test_quality_keeps_prose_and_drops_symbols(spark):
    rng = random.Random(3)
    rows = [(i, X.prose(rng, 120), "en", "s", 0) for i in range(80)]
    rows += [(100 + i, X.prose(rng, 120).replace(" ", "*** | "), "en", "s", 0) for i in range(10)]
    kept = {r.doc_id for r in quality.keep_good(X.frame(spark, rows)).collect()}
    assert kept == set(range(80))


# Near duplicates

@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, rows, size):
    expected = X.near_duplicates(rows, size)
    out = setsketch.near_duplicates(X.frame(spark, rows), shingle=size).collect()
    assert len(out) == len(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_near_duplicate_chain_is_one_component(spark):
    rng = random.Random(11)
    words, rows = X.prose(rng, 300).split(), []
    for i in range(40):                       # each differs a little from the one before, the ends a lot
        rows.append((i * 3, " ".join(words), "en", "s", 0))
        for k in range(8):
            words[(i * 8 + k * 37) % 300] = f"new{i}x{k}"
    expected = X.near_duplicates(rows, 2)
    out = setsketch.near_duplicates(X.frame(spark, rows), shingle=2).collect()
    assert {r.doc_id: r.component_id for r in out} == {k: c for k, (_, c) in expected.items()}


def test_loose_groups_lose_no_link(spark, monkeypatch):
    """Many texts about the threshold in shared bands, in small blocks."""
    monkeypatch.setattr(setsketch, "SMALL_BAND", 4)
    monkeypatch.setattr(setsketch, "BLOCK", 9)
    rng = random.Random(4)
    base, rows = X.prose(rng, 60).split(), []
    for i in range(70):
        words = list(base)
        for _ in range(rng.randrange(3, 9)):
            words[rng.randrange(60)] = f"v{rng.randrange(4)}"
        rows.append((i, " ".join(words), "en", "s", 0))
    expected = X.near_duplicates(rows, 2)
    out = setsketch.near_duplicates(X.frame(spark, rows), shingle=2, bands=30, rows=2).collect()
    assert {r.doc_id: r.component_id for r in out} == {k: c for k, (_, c) in expected.items()}


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (800, 900))
    common = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64))
    a, b = np.union1d(a, common), np.union1d(b, common)
    ra, rb = setsketch.registers(a, 1000), setsketch.registers(b, 1000)
    assert np.array_equal(np.maximum(ra, rb), setsketch.registers(np.union1d(a, b), 1000))
    j = setsketch.estimate(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[0]
    assert abs(j - 3000 / 4700) < 0.06


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)]
    got = connected_components(spark.createDataFrame(links, "u long, v long"))
    ids = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in got.collect()} == X.components(ids, links)


# Repeated byte strings

@pytest.mark.parametrize("group_bytes", [suffixes.GROUP_BYTES, 0])
def test_repeated_bytes_equal_brute_force(spark, rows, group_bytes):
    expected = Counter(zip([r[0] for r in rows], X.repeated_bytes(rows, 100)))
    out = suffixes.repeated_bytes(X.frame(spark, rows), size=100, gram=32, group_bytes=group_bytes).collect()
    assert Counter((r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in out) == expected
    assert all(sum(s.hi - s.lo for s in r.spans) == r.n_removed for r in out)


def test_suffix_order_is_the_order_of_windows():
    rng = random.Random(8)
    for alphabet in ("ab", "abcdefgh", "a"):
        segments = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(20, 120))).encode() for _ in range(12)]
        data, order, offsets = suffixes.suffix_order(segments, 20)
        joined = b"".join(segments)
        windows = [joined[i:i + 20] for i in order]
        assert windows == sorted(windows)
        ends = np.cumsum([len(s) for s in segments])
        assert sorted(order) == [i for o, e in zip(offsets, ends) for i in range(o, e - 19)]
        count = Counter(windows)
        for s, starts in zip(segments, suffixes.repeated_windows(segments, 20)):
            assert list(starts) == [i for i in range(len(s) - 19) if count[s[i:i + 20]] > 1]


def test_blocks_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 500)
    rng = random.Random(13)
    text = bytes(rng.choice(b"abc") for _ in range(3000)) + b"z" * 700
    anchor, start, end, again = suffixes.anchor_runs(text, 100, 32)
    assert start[0] == 0 and end[-1] == len(text) - 99 and np.array_equal(start[1:], end[:-1]) and again[-1]


def test_planted_passages_on_both_sides_of_the_size(spark):
    """Passages shared by two texts: from 400 bytes on they go, whole; shorter ones, though of over 50 words, stay."""
    rng = random.Random(29)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = lambda size: (" ".join(word(5) for _ in range(200)))[:size - 1] + "."
    rows, sizes = [], {}
    for k, size in enumerate([330, 398, 399, 400, 401, 600]):
        shared = passage(size)
        for copy in (0, 1):
            sizes[2 * k + copy] = size
            rows.append((2 * k + copy, f"<{word(300)}{2 * k + copy}|{shared}|{copy}{word(300)}>", "en", "s", 0))
    assert len(X.words(passage(330))) > 50
    got = {r.doc_id: r for r in suffixes.repeated_bytes(X.frame(spark, rows)).collect()}
    for i, size in sizes.items():
        # The marks around a passage are the same in both texts.
        assert (got[i].n_removed, got[i].n_spans) == ((size + 2, 1) if size + 2 >= 400 else (0, 0)), size
        assert got[i].n_bytes == len(next(r[1] for r in rows if r[0] == i))


def shared_word_counts(rows, size):
    """Words of each row in windows of ``size`` words that another row holds."""
    words = [X.words(r[1]) for r in rows]
    holders = defaultdict(set)
    for k, w in enumerate(words):
        for i in range(len(w) - size + 1):
            holders[tuple(w[i:i + size])].add(k)
    return [len({j for i in range(len(w) - size + 1) if len(holders[tuple(w[i:i + size])]) > 1 for j in range(i, i + size)}) for w in words]


@pytest.mark.parametrize("size", [8, 51])
def test_shared_passages_equal_brute_force(spark, rows, size):
    rng = random.Random(31)
    w = [f"{k}w{rng.randrange(10**6)}" for k in range(5000)]
    passage, tail = w[:60], " " + "y" * 20_000
    rows = [*rows, (9001, " ".join(w[100:180] + passage + w[200:230]), "en", "s", 0), (9002, "\n".join(passage) + "\t" + " ".join(w[300:400]), "en", "s", 0),
            (9003, " ".join(w[400:470] * 2), "en", "s", 0), (9004, " ".join(passage[:50] + w[500:520]) + tail, "en", "s", 0),
            (9005, "a " * 3000, "en", "s", 0), (9006, "a " * 55 + "b", "en", "s", 0), (9007, " ".join(w[600:] + passage[:51]), "en", "s", 0),
            (9008, " ".join(passage[9:]), "en", "s", 0), (9009, "\u00a0".join(passage), "en", "s", 0)]
    expected = Counter(zip([r[0] for r in rows], shared_word_counts(rows, size)))
    out = suffixes.repeated_bytes(X.frame(spark, rows), passage_words=size).collect()
    assert Counter((r.doc_id, r.n_passage_words) for r in out) == expected
    plain = suffixes.repeated_bytes(X.frame(spark, rows)).collect()
    same = lambda r: (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
    assert Counter(map(same, out)) == Counter(map(same, plain))


# Line alignment

def test_patience_matches_in_order():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randrange(12) for _ in range(rng.randrange(25))]
        b = [rng.randrange(12) for _ in range(rng.randrange(25))]
        m = linedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in m)
        assert all(i < k and j < n for (i, j), (k, n) in zip(m, m[1:]))
        assert linedup.patience(a, a) == [(i, i) for i in range(len(a))]


def longest_chain(pairs):
    """Longest chain rising in both, by the quadratic program; of equal ones the latest pairs count."""
    size = []
    for k, (_, j) in enumerate(pairs):
        size.append(1 + max((size[h] for h in range(k) if pairs[h][1] < j), default=0))
    chain = []
    for k in range(len(pairs) - 1, -1, -1):
        if size[k] == (size[chain[-1]] - 1 if chain else max(size)):
            chain.append(k)
    return [pairs[k] for k in reversed(chain)]


def aligned(a, b):
    """Patience alignment of two lists of lines, written as recursion over slices."""
    if not a or not b:
        return []
    if a[0] == b[0]:
        return [(0, 0)] + [(i + 1, j + 1) for i, j in aligned(a[1:], b[1:])]
    if a[-1] == b[-1]:
        return aligned(a[:-1], b[:-1]) + [(len(a) - 1, len(b) - 1)]
    anchors = [(i, b.index(x)) for i, x in enumerate(a) if a.count(x) == 1 and b.count(x) == 1]
    if not anchors:
        rank = lambda s, i: s[:i].count(s[i])
        anchors = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x == y and rank(a, i) == rank(b, j)]
    chain = longest_chain(anchors)
    out, start = [], (0, 0)
    for end in [*chain, (len(a), len(b))] if chain else []:
        if start[0] < end[0] and start[1] < end[1]:
            out += [(i + start[0], j + start[1]) for i, j in aligned(a[start[0]:end[0]], b[start[1]:end[1]])]
        start = end
    return out


def windows_of(lines, min_words):
    """The fewest lines from each line on, and up to each line, with ``min_words`` words."""
    n, out = [len(X.words(x)) for x in lines], set()
    for i in range(len(lines)):
        ends = [j for j in range(i + 1, len(lines) + 1) if sum(n[i:j]) >= min_words]
        starts = [j for j in range(i + 1) if sum(n[j:i + 1]) >= min_words]
        out |= {(i, min(ends))} if ends else set()
        out |= {(max(starts), i + 1)} if starts else set()
    return {tuple(lines[i:j]) for i, j in out}


def deleted_by(later, earlier, min_words, align=aligned):
    """Numbers of the later lines that alignments of stretch after stretch put in blocks."""
    if not windows_of(later, min_words) & {tuple(earlier[i:j]) for i in range(len(earlier)) for j in range(i + 1, len(earlier) + 1)}:
        return set()
    pairs, blocks = align(later, earlier), []
    for i, j in pairs:
        if blocks and blocks[-1][-1] == (i - 1, j - 1):
            blocks[-1].append((i, j))
        else:
            blocks.append([(i, j)])
    blocks = [[i for i, _ in b] for b in blocks]
    found = {i for b in blocks if sum(len(X.words(later[i])) for i in b) >= min_words for i in b}
    borders = found or {i for i, _ in pairs}
    out, start = set(found), 0
    for end in [*sorted(borders), len(later)] if borders else []:
        out |= {start + i for i in deleted_by(later[start:end], earlier, min_words, align)} if start < end else set()
        start = end + 1
    return out


def line_brute(rows, min_words, align=aligned):
    """First holder of every text, and its remaining lines by plain Python: every text is aligned with the first holder
    of each of its runs."""
    first = {}
    for r in rows:
        if r[0] is not None and r[1] is not None:
            first[r[1]] = min(first.get(r[1], r[0]), r[0])
    texts = sorted(first, key=lambda t: (first[t], hashlib.sha256(t.encode()).hexdigest()))
    own = {t: [x.strip(" \t\n\v\f\r") for x in t.split("\n") if X.words(x)] for t in texts}
    holder, out = {}, {}
    for t in texts:
        runs = windows_of(own[t], min_words)
        gone = set()
        for other in {holder[x] for x in runs if x in holder}:
            gone |= deleted_by(own[t], own[other], min_words, align)
        for x in runs:
            holder.setdefault(x, t)
        raw = [x for x in t.split("\n") if X.words(x)]
        out[t] = [x for k, x in enumerate(raw) if k not in gone]
    return first, out


def test_alignments_equal_plain_ones():
    rng = random.Random(23)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghijklmnop"[:rng.randrange(2, 16)]) for _ in range(rng.randrange(12))] for _ in range(2))
        assert linedup.patience(a, b) == aligned(a, b)
    for _ in range(300):
        pool = [" ".join([c] * rng.randrange(1, 8)) for c in "abcdefghij"]
        a, b = ([rng.choice(pool) for _ in range(rng.randrange(14))] for _ in range(2))
        ta, tb = (linedup.line_table("\n".join(x).encode()) for x in (a, b))
        got = {k for lo, hi in linedup.common_blocks(ta[0], ta[1], tb[0], 8) for k in range(lo, hi)}
        assert got == (deleted_by(a, b, 8) if a and b else set()), (a, b)


def test_alignment_decides(spark, rows, monkeypatch):
    """Without its alignments the operator deletes nothing but copies."""
    monkeypatch.setattr(linedup, "patience", lambda a, b: [])
    table = linedup.line_table(next(r[1] for r in rows if r[0] == 80).encode())
    assert linedup.common_blocks(table[0], table[1], table[0], 20) == []
    monkeypatch.undo()
    assert linedup.common_blocks(table[0], table[1], table[0], 20) == [(0, len(table[0]) // 16)]


def test_hot_first_holder_is_dealt_out(spark, rows, monkeypatch):
    plain = sorted(map(tuple, linedup.line_report(X.frame(spark, rows)).collect()), key=str)
    monkeypatch.setattr(linedup, "PARTNERS", 1)
    assert sorted(map(tuple, linedup.line_report(X.frame(spark, rows)).collect()), key=str) == plain


def test_line_dedup_equals_alignment_of_all_pairs(spark, rows):
    first, rest = line_brute(rows, 20)
    out = linedup.line_report(X.frame(spark, rows)).collect()
    assert len(out) == len(rows)
    removed = Counter()
    for r in rows:
        n = 0
        if r[0] is not None and r[1] is not None:
            has = [x for x in r[1].split("\n") if X.words(x)]
            n = len(X.words(r[1])) - sum(len(X.words(x)) for x in rest[r[1]])
            if r[0] > first[r[1]] and len(X.words(r[1])) >= 20:
                n = len(X.words(r[1]))
            assert has or n == 0
        removed[r[0], n] += 1
    assert Counter((r.doc_id, r.n_removed_words) for r in out) == removed


def test_line_dedup_texts(spark, rows):
    df = X.frame(spark, rows)
    out = linedup.dedup_lines(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    passage = rows[-1]
    assert {60, 80, 3} <= set(got) and not {71, 72, 73} & set(got)      # copies go, their first holder stays
    assert got[81].text.count("\n") < got[80].text.count("\n") and got[81].n_chars == len(got[81].text)
    assert got[0].text == rows[0][1] and passage[0] is None


def test_line_dedup_of_crossed_passages(spark):
    """Every line in 20 words that an earlier text holds in a row goes, in whatever order the passages lie."""
    rng = random.Random(17)
    own = lambda: "\n".join(f"own{rng.randrange(10**9)} line" for _ in range(3))
    one, two = (X.prose(rng, 50, per_line=10) for _ in range(2))
    long = X.prose(rng, 40, per_line=40)
    tail = X.prose(rng, 30, per_line=30)
    texts = [[two, own(), one], [one, own(), two], [own(), one, own(), two], [own(), two, own(), one],          # 0..3
             [long, own(), "menu", own(), "hello"], ["menu", own(), "hello", own(), long],                       # 4, 5
             [tail, own()], [own(), tail, "signed"], [tail, "signed", own()]]                                   # 6..8
    rows = [(i, "\n".join(t), "en", "s", 0) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = {r.doc_id: r.text.split("\n") for r in linedup.dedup_lines(X.frame(spark, rows)).collect()}
    lines = {r[0]: r[1].split("\n") for r in rows}
    gone = {1: [one, two], 2: [one, two], 3: [one, two], 5: [long], 7: [tail], 8: [tail, "signed"]}
    for i, has in lines.items():
        drop = {x for t in gone.get(i, []) for x in t.split("\n")}
        assert got[i] == [x for x in has if x not in drop], i
    report = {r.doc_id: r.n_removed_words for r in linedup.line_report(X.frame(spark, rows)).collect()}
    assert report == {i: sum(len(X.words(t)) for t in gone.get(i, [])) for i in lines}


def test_reused_ids(spark):
    """Texts that share an id are judged each by itself; the two entry points agree."""
    rng = random.Random(31)
    text, other = X.prose(rng, 120), X.prose(rng, 90)
    rows = [(1, text, "en", "s", 0), (2, text + " more", "en", "s", 0), (2, other, "en", "s", 0), (3, other + " end", "en", "s", 0),
            (2, "A b c d e f", "en", "s", 0), (2, "a  b c d e f", "en", "s", 0), (4, other, "en", "s", 0)]
    df = X.frame(spark, rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in setsketch.near_duplicates(df).collect())
    n = lambda t: len(X.shingles(t, 5))
    assert got == Counter([(1, n(text), 1, True), (2, n(text) + 1, 1, False), (2, n(other), 2, True), (3, n(other) + 1, 2, False),
                           (2, 2, 2, True), (2, 2, 2, True), (4, n(other), 2, False)])
    kept = [(r.doc_id, r.text) for r in setsketch.keep_one_each(df).collect()]
    assert sorted(t for i, t in kept if i == 2 and t != other) in (["A b c d e f"], ["a  b c d e f"])
    assert {(1, text), (2, other)} <= set(kept) and len(kept) == 3


def test_slope_tells_what_the_estimate_tells():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64)) for _ in range(3)]
    pairs = [(np.concatenate([sets[0][:k], sets[1][:m]]), np.concatenate([sets[0][:k], sets[2][:q]]))
             for k in range(20, 300, 9) for m, q in ((0, 40), (20, 20), (5, 60), (60, 5))]
    ra, rb = (np.array([setsketch.registers(p[x], 200) for p in pairs]) for x in (0, 1))
    na, nb = (np.array([float(len(p[x])) for p in pairs]) for x in (0, 1))
    j = setsketch.estimate(ra, rb, na, nb)
    for limit in (0.3, 0.63, 0.8):
        clear = np.abs(j - limit) > 1e-6
        assert np.array_equal(setsketch.may_reach(ra, rb, na, nb, limit)[clear], (j >= limit)[clear])
    assert np.array_equal(setsketch.may_reach(ra, ra[3], na, na[3], 0.63), setsketch.may_reach(ra, np.tile(ra[3], (len(ra), 1)), na, np.full(len(na), na[3]), 0.63))


# Secrets

def test_secrets(spark):
    rng, rows = random.Random(2), []
    for i in range(200):
        text = X.prose(rng, 60)
        token = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        number = "".join(rng.choice("0123456789") for _ in range(16))
        extra = {0: f'token = "{token}"', 1: number, 2: f"write to someone.{i}@mail{i % 5}.example.com"}.get(i % 4, "")
        rows.append((i, text + " " + extra + " " + X.prose(rng, 5), "en", "src", 0))
    rows += [(900, None, None, None, 0), (901, "", None, None, 0), (902, "averyveryverylongplainword", None, "a/test/x.py", 0)]
    out = secrets.scan(X.frame(spark, rows)).collect()
    flagged = {r.doc_id for r in out if r.is_secret}
    assert flagged == {i for i in range(200) if i % 4 == 0}
    assert {r.doc_id for r in out} == {i for i in range(200) if i % 4 != 3} | {902}


def test_secrets_of_any_length_and_characters(spark):
    rng, rows, at = random.Random(9), [], {}
    key = lambda n, chars: "a1" + "".join(rng.choice(chars) for _ in range(n - 2))
    letters = "abcdefghkmnpqrstuvwxyz0123456789"
    for i in range(240):
        short, marked, long = key(10, letters), key(5, letters) + "!$" + key(6, letters) + "%", key(20, letters)
        text, value = [(f"password={short}", short), (f"api_key: {short}", short), (f'secret = "{marked}"', marked),
                       (f"postgres://user:{long}@host/db", long), (f"amqp://user:{marked}@host", marked),
                       (f"mail someone.{i}@mail{i % 5}.example.com", None), (f"see number: {i}", None), ("", None)][i % 8]
        rows.append((i, X.prose(rng, 40) + " " + text + " " + X.prose(rng, 5), "en", "src", 0))
        at[i] = value
    out = secrets.scan(X.frame(spark, rows)).collect()
    flagged = {(r.doc_id, r.found) for r in out if r.is_secret}
    assert {(i, v) for i, v in at.items() if v} <= flagged
    assert {i for i, _ in flagged} == {i for i, v in at.items() if v}
    assert len(out) == len({(r.doc_id, r.word_index, r.part) for r in out})


def test_secrets_in_very_long_words(spark):
    """Words of a megabyte, with and without '@', whole and in time in proportion to them."""
    rng = random.Random(4)
    n = 1 << 20
    letters = "".join(rng.choice("abcdefXYZ0123456789+/") for _ in range(n))
    words = ["x@" + "a." * (n // 2), "x@" + "." * n + "#", letters, "@".join(letters[i:i + 30] for i in range(0, n, 30)), "=" * n, "a=" * 3000]
    rows = [(k, f"mail {w} here", "en", "src", 0) for k, w in enumerate(words)] + [(9, 'token = "0123456789abcdef0123456789abcdef"', "en", "src", 0)]
    began = time.time()
    out = secrets.scan(X.frame(spark, rows)).collect()
    assert time.time() - began < 60
    size = Counter()
    for r in out:
        size[r.doc_id] += r.length
    assert size[2] == n and len([r for r in out if r.doc_id == 3]) >= n // 30 and size[9] == 32


def test_secrets_without_labels_keep_all(spark):
    out = secrets.scan(X.frame(spark, [(1, "0123456789012345678", "en", None, 0)])).collect()
    assert [(r.score, r.is_secret) for r in out] == [(1.0, True)]


# Empty tables

@pytest.mark.parametrize("run", [mixing.mix_report, mixing.mix_sources, packing.pack, quality.judged, setsketch.near_duplicates,
                                 suffixes.repeated_bytes, linedup.line_report, linedup.dedup_lines, secrets.scan])
def test_empty_table(spark, run):
    assert run(X.frame(spark, [])).collect() == []
