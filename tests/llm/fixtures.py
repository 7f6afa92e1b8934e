"""Small tables with the awkward cases, and plain-Python versions of the operators."""

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
# Names that the operators use for working columns.
CLASHES = ("row", "key", "size", "label", "rep", "band", "n", "copies", "first", "anchor", "w", "t", "lines", "n_words",
           "src", "no_source", "point", "component_id", "kept", "vector", "dim")

VOCABULARY = {"en": "the of and to in is was for on with that have from this river stone winter garden letter morning".split(),
              "de": "der die und zu den das nicht von sie ist des sich mit dem dass fluss stein garten brief morgen über".split(),
              "fr": "de la le et les des en un du une que est pour qui dans rivière pierre hiver jardin été".split()}


def prose(rng: random.Random, n: int, lang: str = "en", per_line: int = 12) -> str:
    words = [rng.choice(VOCABULARY[lang]) + rng.choice(["", "", "s", "en", str(rng.randrange(900))]) for _ in range(n)]
    lines = [" ".join(words[i:i + per_line]) + "." for i in range(0, n, per_line)]
    return "\n".join(lines)


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows (doc_id, text, lang, source): prose, exact copies, near copies, shared passages, and odd texts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(sorted(VOCABULARY))
        rows.append([i, prose(rng, rng.randrange(30, 160), lang), lang, f"src{rng.randrange(4)}"])
    base = prose(rng, 200)
    for k in range(8):                                        # near copies: a few words changed
        words = base.split(" ")
        for _ in range(k):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        rows.append([n + k, " ".join(words), "en", "src0"])
    for k in range(5):                                        # exact copies
        rows.append([n + 10 + k, rows[3][1], rows[3][2], "src1"])
    passage = prose(rng, 80)
    for k in range(4):                                        # a passage within different texts
        rows.append([n + 20 + k, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40), "en", "src2"])
    odd = [None, "", " \t\n\r\n ", "word", "Word WORD", "a b c d e f", "same " * 300, "x" * 3000, "\n".join(["line of ten short words that repeat again and again"] * 30),
           "   é ß 漢字 😀 " * 40, "café\u0000\u001f tab\tend " * 30, "".join(chr(97 + i % 26) for i in range(5000)), "0 1 2 3"]
    for k, text in enumerate(odd):
        rows.append([n + 40 + k, text, None if k % 3 else "en", None if k % 2 else ""])
    rows.append([n + 60, prose(rng, 6000), "en", "src3"])     # very long
    rows.append(list(rows[5]))                                # a repeated row
    rows.append([None, prose(rng, 50), "de", "src1"])         # null ids
    rows.append([None, rows[3][1], "en", "src1"])
    return [(a, b, c, d, None if b is None else len(b)) for a, b, c, d in rows]


def frame(spark, rows, clashes: bool = True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)]) if clashes else df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def components(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, size):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lower)
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def near_duplicates(rows, size, percent=80):
    """doc_id -> (set size, component)."""
    sets = {r[0]: shingles(r[1], size) for r in rows if r[0] is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    found = components(ids, links)
    return {i: (len(sets[i]), found[i]) for i in ids}


def repeated_bytes(rows, size):
    """Per row: (n_bytes, n_removed, n_spans, sha of the rest)."""
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(t[i:i + size] for t in texts for i in range(len(t) - size + 1))
    out = []
    for t in texts:
        cover = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if count[t[i:i + size]] > 1:
                cover[i:i + size] = b"\1" * size
        rest = bytes(c for c, z in zip(t, cover) if not z)
        out.append((len(t), sum(cover), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(rest).hexdigest()))
    return out


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    count, cover = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            cover.update(range(i, i + 5))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))
