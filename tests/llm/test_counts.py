"""Token counts, importance resampling and conversation repair against plain-Python versions."""

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm import fixtures as X
from verdant.llm import conversations, queries, resample, tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def library_counts(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(sp.encode(t or "")) for t in texts]


AWKWARD = ["<s> </s> <unk> <0x0A>", "a\n\nb", " lead", "trail ", "two  blanks   three", "▁mark ▁▁", "　wide​", "x" * 4000, " " * 3000,
           "\n" * 500, "é" * 2000, "漢字かな" * 800, "😀" * 700, "tab\tand\rreturn", "ab" * 5000 + " end", "0123456789" * 300]


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_split_texts_count_like_whole_ones(size):
    counter = tokens.PieceCounter(open(MODEL, "rb").read())
    rng = random.Random(size)
    mixed = ["".join(rng.choice(["the ", "  ", "\n", "é", "漢", "x", "ing ", "▁", ". ", "<s>", "\t", "😀"]) for _ in range(400)) for _ in range(20)]
    for text in AWKWARD + mixed + [X.prose(rng, 500, lang) for lang in X.VOCABULARY]:
        parts = counter.parts(text, size)
        assert "".join(parts) == text
        assert tokens.token_counts(counter, [text], 300, size) == library_counts([text])
    assert len(counter.parts(mixed[0], 7)) > 20


def test_token_counts(spark):
    rows = X.corpus(seed=3) + [(900 + k, t, None, None, 0) for k, t in enumerate(AWKWARD)] + [(990, X.prose(random.Random(9), 60_000), "en", "s", 0)]
    got = tokens.count_tokens(X.frame(spark, rows), MODEL).collect()
    n = library_counts([r[1] for r in rows])
    expected = Counter((r[0], len((r[1] or "").encode()), k, k > 4096) for r, k in zip(rows, n, strict=True))
    assert Counter(tuple(r) for r in got) == expected
    assert tokens.count_tokens(X.frame(spark, []), MODEL).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_json_vocabularies(spark, name):
    rows = X.corpus(seed=5, n=20)
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    library.no_truncation(), library.no_padding()
    got = {(r.doc_id, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(X.frame(spark, rows), public_tokenizers.path(name)).collect()}
    assert got == {(r[0], len((r[1] or "").encode()), len(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows}
    with pytest.raises(ValueError):
        tokens.count_tokens(X.frame(spark, rows), "ranks.tiktoken")


def grams_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def drawn(docs, target, percent=25, min_words=20, seed=7):
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, grams_of(text)[1]))
    for text in target:
        t.update(map(bucket, grams_of(text)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        w, g = grams_of(text)
        weight = sum(gain[bucket(x)] for x in g) // len(g) if g else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(g), weight, score, None, len(w)])
    fits = sorted((r for r in rows if r[5] >= min_words and r[3] is not None), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for k, r in enumerate(fits[:percent * len(fits) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in rows)


@pytest.mark.parametrize("batch_bytes", [1 << 18, 700])
def test_resampling(spark, batch_bytes):
    rows = X.corpus(seed=6, n=70)
    target = [rows[4][1], rows[9][1], None, "", "word Word"]
    bench = spark.createDataFrame([(k, t, 1) for k, t in enumerate(target)], "item_id int, text string, n_words int")
    got = resample.resample(X.frame(spark, rows), bench, batch_bytes=batch_bytes).collect()
    assert Counter(tuple(r) for r in got) == drawn([(r[0], r[1]) for r in rows], target)


def test_resampling_of_empty_tables(spark):
    none = X.frame(spark, [])
    assert resample.resample(none, none).collect() == []
    rows = X.corpus(seed=2, n=30)
    assert Counter(map(tuple, resample.resample(X.frame(spark, rows), none).collect())) == drawn([(r[0], r[1]) for r in rows], [])


@pytest.mark.parametrize("hash_of", [None, lambda g: 7, lambda g: len(g)])
def test_interning_verifies_bytes(hash_of):
    rng = random.Random(1)
    text = " ".join(rng.choice(["a", "b" * rng.randrange(1, 70), "c" * 80, "c" * 79 + "d", "é", "ab"]) for _ in range(400)).encode()
    words, starts, lengths, _ = resample.find_words(text)
    grams = [words[a:a + n].tobytes() for a, n in zip(starts, lengths)]
    slots, firsts = resample.intern(words, grams, starts, lengths, *([hash_of] if hash_of else []))
    assert [grams[firsts[s]] for s in slots] == grams
    assert len(firsts) == len(set(grams))


def test_resample_query_at_scale_factor(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert Counter(map(tuple, queries.QUERIES["op12_importance_resampling"](spark, sf).collect())) == drawn(docs, bench)


# Conversations

def damage(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv]
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: sorted(g, key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r))) for c, g in groups.items()}


def faults_of(group):
    out, seen = [], set()
    for _, role, text in group:
        body = text.strip(" \t\n\v\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def all_repairs(group, faults, inserts):
    """Every edit sequence with at most ``inserts`` inserts, by plain enumeration: (cost, audit, rows)."""
    options = []
    for (_, role, text), fault in zip(group, faults):
        more = 3 * (fault == "truncated")
        own = [(4, "D", [])]
        if fault not in ("blank", "duplicate"):
            own += [(more, "K", [(role, text)])] + [(3 + more, "R", [(r, text)]) for r in ("user", "assistant")]
        options.append(own)
    gaps = [[(3 * len(x), "I" * len(x), [(r, "") for r in x]) for n in range(inserts + 1) for x in itertools.product(("user", "assistant"), repeat=n)]
            for _ in range(len(group) + 1)]
    for edits in itertools.product(*options):
        for put in itertools.product(*gaps):
            if sum(len(p[2]) for p in put) > inserts:
                continue
            steps = [x for pair in itertools.zip_longest(put, edits) for x in pair if x]
            yield sum(x[0] for x in steps), "".join(x[1] for x in steps), [r for x in steps for r in x[2]]


def by_enumeration(group):
    faults = faults_of(group)
    legal = (x for x in all_repairs(group, faults, len(group) + 1) if re.fullmatch("(s?(ua)+)?", "".join(r[0][:1] or "?" for r in x[2])))
    return min(legal, key=lambda x: x[:2])


def by_whole_strings(group):
    """Dynamic program over whole (cost, audit, rows), for longer conversations."""
    faults, step = faults_of(group), {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
    best = {q: (0, "", []) for q in (0, 3)}
    for i in range(len(group), -1, -1):
        if i < len(group):
            later, best = best, {}
            (_, role, text), more = group[i], 3 * (faults[i] == "truncated")
            for q in range(4):
                found = [(later[q][0] + 4, "D" + later[q][1], later[q][2])]
                if faults[i] not in ("blank", "duplicate"):
                    for r, cost, letter in ((role, 0, "K"), ("user", 3, "R"), ("assistant", 3, "R")):
                        if (q, r[:1]) in step:
                            c, a, rest = later[step[q, r[:1]]]
                            found.append((c + cost + more, letter + a, [(r, text), *rest]))
                best[q] = min(found)
        for _ in range(4):
            for q in range(4):
                for r in ("user", "assistant"):
                    if (q, r[0]) in step and step[q, r[0]] in best:
                        c, a, rest = best[step[q, r[0]]]
                        best[q] = min(best.get(q, (math.inf,)), (c + 3, "I" + a, [(r, ""), *rest]))
    return best[0]


def expected_row(conv, group, method):
    faults = faults_of(group)
    turns = [t for t, _, _ in group if t is not None]
    firsts = [r[:1] for _, r, _ in group]
    cost, audit, rows = method(group)
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for a, b in zip(firsts, firsts[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in rows).encode()).hexdigest())


SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def random_rows(rng, n_convs, longest):
    rows = []
    for c in range(n_convs):
        for t in range(rng.randrange(longest + 1)):
            rows.append((c, rng.choice([t, t, t, t + 3, t // 2, None]), rng.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]),
                         rng.choice(["Yes.", "No!", "cut", "why? ", " \n", "", None, "a\nb.", "Yes."])))
    return rows


def test_repair_is_the_lightest():
    rng = random.Random(3)
    for _ in range(250):
        group = [(t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "cut", "", "No!", "Why?"])) for t in range(rng.randrange(3))]
        assert by_enumeration(group)[:2] == by_whole_strings(group)[:2]
    for k in range(400):
        group = [(t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", "cut", "", f"n{t}."])) for t in range(rng.randrange(14))]
        codes = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        got = conversations.repair("".join(r[0] for _, r, _ in group).encode(), bytes(codes[f] for f in faults_of(group)), window=1 + k % 5)
        assert got == by_whole_strings(group)[:2]


def test_conversations(spark):
    rows = random_rows(random.Random(8), 150, 9) + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes.")]
    rows += [(c, 0, "user", "Dropped.") for c in range(1000, 1100) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).select("*", F.lit(1).alias("gone"), F.lit("x").alias("fault"))
    got = {r.conv_id: tuple(r) for r in conversations.repair_conversations(conversations.damaged(frame)).collect()}
    expected = {c: expected_row(c, g, by_whole_strings) for c, g in damage(rows).items()}
    assert got == expected
    assert any(not g for g in damage(rows).values())            # a conversation without rows
    assert conversations.repair_conversations(conversations.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_conversation_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r) for r in queries.QUERIES["op13_conversation_repair"](spark, sf).collect()}
    assert got == {c: expected_row(c, g, by_whole_strings) for c, g in damage(rows).items()}


def test_long_conversation(spark):
    """30,000 rows, over many windows and Arrow batches."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"line {rng.randrange(20_000)}" + rng.choice([".", "."," "])) for t in range(30_000)]
    row, = conversations.repair_conversations(conversations.damaged(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()
    group = damage(rows)[1]
    faults = faults_of(group)
    assert (row.blank, row.duplicate, row.truncated) == tuple(faults.count(k) for k in ("blank", "duplicate", "truncated"))
    kept = [(r, t) for (_, r, t), f in zip(group, faults)]
    out, i, state = [], 0, "a"
    for letter in row.audit:
        turn = "user" if state == "a" else "assistant"
        if letter == "I":
            out.append((turn, ""))
        elif letter != "D":
            assert letter == "R" or kept[i][0] == turn
            out.append((turn, kept[i][1]))
        i += letter != "I"
        state = state if letter == "D" else turn[0]
    assert i == len(kept) and len(out) % 2 == 0
    assert row.cost == sum({"K": 0, "R": 3, "D": 4, "I": 3}[x] for x in row.audit) + 3 * sum(
        f == "truncated" and x != "D" for f, x in zip(faults, row.audit.replace("I", "")))
    assert row.repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
