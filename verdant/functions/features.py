"""Numeric text features and split hashing as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters counted as punctuation by the punctuation ratio.
PUNCTUATION = ".,;:!?"

# Knuth's multiplicative hashing constant and word sizes.
KNUTH = 2654435761
KEY_MOD = 2 ** 31
WORD = 2 ** 32


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_chars(t) -> Column:
    return F.length(_col(t)).cast("long")


def n_lines(t) -> Column:
    return F.size(F.split(_col(t), r"\r\n|\r|\n")).cast("long")


def _words(t) -> Column:
    return F.filter(F.split(_col(t), r"\s+"), lambda x: x != "")


def n_tokens(t) -> Column:
    return F.size(_words(t)).cast("long")


def n_punct(t) -> Column:
    """Punctuation marks; NULL (unknown) for an empty text."""
    t = _col(t)
    n = F.length(t)
    return F.when(n > 0, (n - F.length(F.translate(t, PUNCTUATION, ""))).cast("long"))


def n_distinct(t) -> Column:
    """Distinct lower-cased tokens; NULL (unknown) when there is no token."""
    w = _words(F.lower(_col(t)))
    return F.when(F.size(w) > 0, F.size(F.array_distinct(w)).cast("long"))


# Integer counts: their text form is the same in every engine, so the
# positional string layout round-trips exactly.
TEXT_FEATURES = (
    ("x_chars", n_chars),
    ("x_lines", n_lines),
    ("x_tokens", n_tokens),
    ("x_punct", n_punct),
    ("x_distinct", n_distinct),
)


def hash_bucket(key, buckets: int = 10000) -> Column:
    """Stable pseudo-random bucket in ``[0, buckets)`` from an integer key:
    the high bits of a 32-bit multiplicative hash. Unlike ``rand()``, it does
    not depend on partitioning, so a lost task recomputes the same split."""
    h = F.pmod(F.pmod(_col(key).cast("long"), F.lit(KEY_MOD)) * F.lit(KNUTH), F.lit(WORD))
    return F.shiftright(h * F.lit(buckets), 32).cast("int")
