"""Text column expressions. Everything here is a built-in Spark expression,
so it runs inside the JVM (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters the word tokeniser turns into a blank, in order:
# tab ( ) . , ! ? | [ ] - ; : '
WORD_SEPARATORS = "\t().,!?|[]-;:'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(s, pattern: str) -> Column:
    """``String.split(pattern)`` semantics of the JVM: trailing empty strings
    are dropped, so a non-empty string made only of separators gives ``[]``,
    while ``""`` gives ``[""]`` and a leading separator gives a leading ``""``.
    ``pattern`` must match whitespace-like separators that the trailing strip
    below removes (``\\s+`` or a single blank)."""
    s = _col(s)
    tail = pattern if pattern.endswith("+") else pattern + "+"
    trimmed = F.regexp_replace(s, tail + "$", "")
    return F.when((trimmed == "") & (s != ""), F.array().cast("array<string>")) \
        .otherwise(F.split(trimmed, pattern))


def normalize_words(s) -> Column:
    """Map the fixed separator characters to blanks and lower-case."""
    return F.lower(F.translate(_col(s), WORD_SEPARATORS, " " * len(WORD_SEPARATORS)))


def tokenize_words(s) -> Column:
    """Separators -> blank, lower-case, split on runs of whitespace."""
    return java_split(normalize_words(s), r"\s+")


def tokenize_spaces(s) -> Column:
    """Split on a single blank, no case folding; interior empties kept."""
    return java_split(s, " ")


def contains(s, needle: str = "error") -> Column:
    """Case-sensitive substring test."""
    return _col(s).contains(needle)


def utf16_low_byte_sum(s) -> Column:
    """Sum of the low bytes of the UTF-16 code units of ``s`` (non-negative).

    A code point above U+FFFF is two code units (a surrogate pair), each
    contributing its own low byte.
    """
    def low_bytes(c):
        cp = F.ascii(c).cast("long")
        off = cp - F.lit(65536)
        high = (F.lit(55296) + F.shiftright(off, 10)).bitwiseAND(255)
        low = (F.lit(56320) + off.bitwiseAND(1023)).bitwiseAND(255)
        return F.when(cp < 65536, cp.bitwiseAND(255)).otherwise(high + low)

    return F.aggregate(F.split(_col(s), ""), F.lit(0).cast("long"),
                       lambda acc, c: acc + low_bytes(c))


def checksum_from_byte_sum(byte_sum) -> Column:
    """T4 rule: two's complement negation of the low 8 bits: -(sum mod 256)."""
    return (-(_col(byte_sum).bitwiseAND(255))).cast("int")


def text_checksum(s) -> Column:
    """T4: per-string byte checksum, in -255..0; empty string -> 0."""
    return checksum_from_byte_sum(utf16_low_byte_sum(s))


def jvm_trim(s) -> Column:
    """``String.trim()``: strip every character <= U+0020 at both ends
    (blanks, tabs, CR, LF and other control characters)."""
    return F.regexp_replace(_col(s), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def strip_quotes(s) -> Column:
    """P5: remove every double quote."""
    return F.translate(_col(s), '"', "")


def question_to_zero(s) -> Column:
    """Exactly ``?`` becomes 0.0, otherwise an ANSI cast (fails loudly on
    a non-number when ``spark.sql.ansi.enabled``)."""
    s = _col(s)
    return F.when(s == "?", F.lit(0.0)).otherwise(s.cast("double"))
