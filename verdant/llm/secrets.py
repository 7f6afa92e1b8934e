"""Secret scans with a random forest that removes false positives.

Candidates are runs of 16 or more key characters inside a word, and, at any length
and of any characters, the values assigned to a credential's name (in the same
word or the next ones) and the passwords of addresses (``scheme://user:password@host``).
A forest judges
each by its length, its character classes and transitions (mean log-probability
of its letter pairs, learned from the corpus's own dictionary), the share of it
that dictionary words cover, the document's path, and the neighbouring words. It
is trained on labelled findings: by default candidates whose form settles the
matter (values assigned to a credential's name; numbers, plain words, mail
addresses and placeholders), or any table of findings with labels.

DataFrame functions and Spark's own forest only. The dictionary holds the words
of at least ``MIN_DOCS`` documents and is joined, never sent whole.

Strings and their words may be of any length: all patterns take time in proportion
to them, a string's letter pairs and dictionary words are counted under its
128-bit key, and what neighbours and word tell is worked out once a word, so that
no row of a candidate carries more than the candidate.

Defined results: null and empty texts have no candidates; repeated rows are
scanned each; a null path counts as empty; if the labelled findings lack one of
the two labels nothing can be told apart and every candidate keeps score 1;
candidates of equal features have equal scores; other columns, whatever their
names, are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import dealt_join, words, written

CANDIDATE = r"[A-Za-z0-9_+/=.\-]{16,}"
MIN_DOCS = 5
FIT_ROWS = 50_000        # labelled findings at most that the forest is trained on
TREES, DEPTH, SEED = 24, 7, 7
BEFORE = 3               # words before a candidate that may name it
# Names that credentials are assigned to, and paths that hold examples.
NAMES = r"(?i)(token|secret|passw|pwd|api[_\-]?key|apikey|auth|credential|bearer|private|access[_\-]?key)"
# A name with what may stand between it and its value, and marks that open or end a value.
ASSIGNED = NAMES + r"[\w.\-\]\[]*[\"'`]*(?::=|=>|==|[=:])"
OPENS, ENDS = r"[\"'`(<\[{]*", r"[\"'`,;]+$"
PASSWORD = r"://[^/\s:@]*:([^/\s]+)@"
# Possessive repeats and no repeated group: time in proportion to the word, and no recursion.
MAIL = r"^[\"'`(<\[{]*+(?i:mailto:)?[\w.%+\-]++@[\w.\-]++[\"'`)>\]},;:!?.]*+$"
EXAMPLES = r"(?i)(test|example|sample|fixture|mock|doc|demo|template)"
FEATURES = ("length", "digits", "uppers", "changes", "distinct", "pairs", "covered", "slashes", "dots", "equals",
            "named", "assigned", "quoted", "path_example", "path_depth", "path_kind", "before_kind", "after_kind")


def _values(w, i) -> Column:
    """The values in word ``i`` of ``w`` that are assigned to a credential's name, and passwords of addresses."""
    word, last, one_before = w[i], F.coalesce(F.get(w, i - 1), F.lit("")), F.coalesce(F.get(w, i - 2), F.lit(""))
    none = F.array().cast("array<string>")
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, "^" + OPENS, ""), ENDS, "")
    mark, named = r"^[\"'`]*(?::=|=>|==|[=:])", NAMES + r"[\w.\-\]\[]*[\"'`]*$"
    inside = F.when(F.contains(word, F.lit("=")) | F.contains(word, F.lit(":")), F.concat(
        F.when(word.rlike(ASSIGNED), F.concat(
            F.array(bare(F.regexp_extract(word, ASSIGNED + "(.*)$", 2))),
            # Parts of a list of assignments (query strings, connection strings).
            F.transform(F.regexp_extract_all(word, F.lit(ASSIGNED + OPENS + r"([^&;,]+)"), F.lit(2)), bare))).otherwise(none),
        F.regexp_extract_all(word, F.lit(PASSWORD), F.lit(1)))).otherwise(none)
    opens = F.startswith(word, F.lit("=")) | F.startswith(word, F.lit(":"))
    ends = F.endswith(last, F.lit("=")) | F.endswith(last, F.lit(":")) | F.endswith(last, F.lit("=>"))
    after = (F.when(ends & (last.rlike(ASSIGNED + "$") | (last.rlike(mark + "$") & one_before.rlike(named))), F.array(bare(word)))
             .when(opens & last.rlike(named), F.array(bare(F.regexp_replace(word, mark, "")))).otherwise(none))
    return F.array_distinct(F.filter(F.concat(inside, after), lambda x: x != ""))


def candidates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """``(doc_id, path, word_index, part, found, key, value)`` and the features of the candidate's place: ``part``
    numbers the candidates of a word, ``key`` is the hash of the string, ``value`` says whether it is a value of
    ``_values``, and ``mail`` whether the word is a mail address."""
    w = F.col("w")
    long = lambda i: (F.length(w[i]) >= 16) & w[i].rlike(CANDIDATE)
    sign = lambda x: F.coalesce(F.contains(x, F.lit("=")) | F.contains(x, F.lit(":")), F.lit(False))
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1),
                  lambda i: long(i) | ((sign(w[i]) | sign(F.get(w, i - 1))) & (F.size(_values(w, i)) > 0)))
    rows = (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("path"),
                        words(F.col(f"`{text_col}`")).alias("w"))
            .where(F.size("w") > 0).withColumn("word_index", F.explode(at)))
    i = F.col("word_index")
    start = F.greatest(i - BEFORE, F.lit(0))
    runs = F.regexp_extract_all(w[i], F.lit(CANDIDATE), F.lit(0))
    each = place_features(rows.select(
        "doc_id", "path", "word_index", w[i].alias("word"), F.slice("w", start + 1, i - start).alias("before"),
        F.get("w", i + 1).alias("after"), runs.alias("runs"), _values(w, i).alias("values")))
    # Runs keep their places; a value that is no run comes after them.
    parts = each.select("*", F.posexplode(F.concat("runs", F.array_except("values", "runs"))).alias("part", "found"))
    parts = parts.withColumn("value", F.array_contains("values", F.col("found"))).drop("runs", "values")
    yes = lambda c: F.greatest(F.col(c), F.col("value").cast("double")).alias(c)
    return parts.select(*[yes(c) if c in ("named", "assigned") else c for c in parts.columns], F.unhex(F.md5("found")).alias("key"))


def dictionary(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(entry, n)``: plain words of three letters or more with the number of their documents."""
    plain = F.filter(F.split(F.lower(F.col(f"`{text_col}`")), r"[^\p{L}]+"), lambda x: F.length(x).between(3, 40))
    return (docs.select(F.explode(F.array_distinct(plain)).alias("entry"))
            .groupBy("entry").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS))


def _pairs(text):
    """All pairs of neighbouring characters, found in one pass."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(..))"), F.lit(1))


def pair_weights(entries: DataFrame) -> DataFrame:
    """``(pair, logp)`` of pairs of ASCII letters and digits: 1,296 rows at most."""
    seen = (entries.where(F.col("entry").rlike("^[a-z]+$")).select("n", F.explode(_pairs(F.col("entry"))).alias("pair"))
            .groupBy("pair").agg(F.sum("n").alias("n")))
    total = seen.agg(F.sum("n").alias("total"))
    return seen.crossJoin(F.broadcast(total)).select("pair", F.log(F.col("n") / F.col("total")).alias("logp"))  # total: one row


def string_features(found: DataFrame, entries: DataFrame) -> DataFrame:
    """Features of the distinct strings in the columns ``(key, found)``, by key."""
    f = F.col("found")
    size = F.length(f).cast("double")
    share = lambda others: F.length(F.regexp_replace(f, others, "")) / size
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        f, "[0-9]+", "~"), "[A-Z]+", "^"), "[a-z]+", "|"), r"[_+/=.\-]+", "#")
    distinct = written(found.groupBy("key").agg(F.first("found").alias("found")), "secret-strings")
    logp = F.broadcast(pair_weights(entries))
    pairs = (distinct.select("key", F.explode(_pairs(F.lower(f))).alias("pair")).join(logp, "pair", "left")
             .groupBy("key").agg(F.avg(F.coalesce("logp", F.lit(-14.0))).alias("pairs")))
    parts = distinct.select("key", F.explode(F.regexp_extract_all(F.lower(f), F.lit("[a-z]{3,}"), F.lit(0))).alias("entry"))
    covered = (parts.join(entries.select("entry"), "entry").groupBy("key").agg(F.sum(F.length("entry")).alias("chars")))
    return distinct.join(pairs, "key", "left").join(covered, "key", "left").select(
        "key", size.alias("length"), share("[^0-9]").alias("digits"), share("[^A-Z]").alias("uppers"),
        (F.length(classes) / size).alias("changes"), (F.size(F.array_distinct(F.split(f, ""))) / size).alias("distinct"),
        F.coalesce("pairs", F.lit(-14.0)).alias("pairs"), (F.coalesce("chars", F.lit(0)) / size).alias("covered"),
        share("[^/]").alias("slashes"), share("[^.]").alias("dots"), share("[^=]").alias("equals"))


def place_features(rows: DataFrame) -> DataFrame:
    """Words with candidates, with the features of their place instead of word, neighbours and path."""
    before = F.concat_ws(" ", "before")
    word = F.col("word")
    kind = lambda c: F.pmod(F.xxhash64(F.lower(F.coalesce(c, F.lit("")))), F.lit(16)).cast("double")
    yes = lambda c: c.cast("double")
    return rows.select(
        "doc_id", "word_index", "runs", "values", yes(before.rlike(NAMES) | word.rlike(NAMES)).alias("named"),
        yes(before.rlike(r"[=:]>?\s*+$") | word.rlike(r"^[A-Za-z_\-]+[=:]")).alias("assigned"),
        yes(word.rlike("[\"'`]")).alias("quoted"), word.rlike(MAIL).alias("mail"),
        yes(F.col("path").rlike(EXAMPLES)).alias("path_example"), F.size(F.split("path", "/")).cast("double").alias("path_depth"),
        kind(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).alias("path_kind"),
        kind(F.try_element_at("before", F.lit(-1))).alias("before_kind"), kind(F.col("after")).alias("after_kind"))


def form_labels(rows: DataFrame) -> DataFrame:
    """Labelled findings among candidates with features: 1, 0, or null where the form settles nothing."""
    f = F.col("found")
    harmless = (f.rlike(r"^[0-9.\-/+=_]+$") | f.rlike(r"^[A-Za-z.\-_]+$") | F.col("mail")
                | f.rlike(r"(?i)(xxxx|example|placeholder|changeme|12345678|(.)\2{7})") | (f.rlike(r"^/|://") & ~f.rlike(PASSWORD)))
    secret = (F.col("named") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0.1) & (F.col("digits") < 1)
    return rows.withColumn("label", F.when(harmless, 0.0).when(secret, 1.0))


def scan(docs: DataFrame, *, labelled=form_labels, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
         threshold: float = 0.5) -> DataFrame:
    """``(doc_id, word_index, part, found, length, label, score, is_secret)``, one row per candidate; false
    positives have ``is_secret`` false. ``labelled`` adds the column ``label`` (1, 0 or null) to the candidates."""
    found = written(candidates(docs, id_col=id_col, text_col=text_col, path_col=path_col), "secret-found")
    entries = written(dictionary(docs, text_col), "secret-words")
    strings = written(string_features(found, entries), "secret-strings")
    rows = written(labelled(dealt_join(found, strings, "key", ("doc_id", "word_index", "part"))), "secret-rows")
    out = rows.select("doc_id", "word_index", "part", "found", F.col("length").cast("int").alias("length"), "label", *[c for c in FEATURES if c != "length"],
                      F.col("length").alias("size"))
    known = rows.where("label is not null")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not {0.0, 1.0} <= set(counts):
        return out.select("doc_id", "word_index", "part", "found", "length", "label", F.lit(1.0).alias("score"), F.lit(True).alias("is_secret"))
    part = min(1.0, FIT_ROWS / sum(counts.values()))
    fit = known.where(F.pmod(F.xxhash64("doc_id", "word_index", "part"), F.lit(1_000_000)) < int(part * 1_000_000))
    rarer = min(counts, key=counts.get)
    balance = F.when(F.col("label") == rarer, min(20.0, counts[1 - rarer] / counts[rarer])).otherwise(1.0)
    vector = VectorAssembler(inputCols=["size" if c == "length" else c for c in FEATURES], outputCol="x")
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="balance", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    model = forest.fit(vector.transform(fit.withColumn("size", F.col("length")).withColumn("balance", balance)))
    score = F.element_at(vector_to_array("probability"), 2)
    return (model.transform(vector.transform(out)).withColumn("score", score)
            .select("doc_id", "word_index", "part", "found", "length", "label", "score", (F.col("score") >= threshold).alias("is_secret")))
