"""String helpers that keep the semantics of the line-oriented original code
(Java ``String.trim`` / ``split``) while staying inside Catalyst codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's String.trim removes every char <= U+0020 at both ends;
# SQL trim only removes blanks.
JAVA_BLANKS = "".join(map(chr, range(0x21)))

# Characters the cleaner turns into one blank each:
# the digits 0-9 and  - ? , / _ ( ) [ ]
SPECIAL_CHARS_PATTERN = r"[0-9\-?,/_()\[\]]"

INT_PATTERN = r"\A[+-]?[0-9]+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_trim(c) -> Column:
    return F.btrim(_c(c), F.lit(JAVA_BLANKS))


def is_blank(c) -> Column:
    """True when the value is empty after a Java-style trim (null stays null)."""
    return java_trim(c) == ""


def clean_special_chars(c) -> Column:
    """Trim first, then one blank per digit or one of ``- ? , / _ ( ) [ ]``.

    Inner and trailing blanks produced by the replacement are kept.
    Null in, null out.
    """
    return F.regexp_replace(java_trim(c), SPECIAL_CHARS_PATTERN, " ")


def split_keep_trailing(c, sep: str = ",") -> Column:
    """``split(sep, -1)``: every field, trailing empty ones included.
    ``sep`` is a literal separator, not a pattern."""
    return F.split(_c(c), re.escape(sep), -1)


def split_trimmed(c, sep: str = ",") -> Column:
    """Fields with Java-style trim applied to each; linear in the line,
    however many blanks it holds."""
    return F.transform(split_keep_trailing(c, sep), java_trim)


def java_split_width(c, sep: str = ",") -> Column:
    """Number of fields of a Java ``split(sep)`` without limit, which drops
    trailing empty fields (``"3,Cy,Ray,50,"`` has 4)."""
    s = re.escape(sep)
    # a run of separators is entered at its first one only
    return F.size(F.split(F.regexp_replace(_c(c), rf"(?<!{s})(?:{s})++\z", ""), s, -1))


def field(arr, i: int) -> Column:
    """0-based element of an array, null beyond its end (never an error)."""
    return F.get(_c(arr), i)


def tokenize(c, sep: str = " ") -> Column:
    """Split on one separator; runs of separators give empty tokens."""
    return F.split(_c(c), re.escape(sep), -1)


def strict_int(c) -> Column:
    """Integer only for plain ``[+-]digits`` text that fits an int, else null
    (no blanks around the digits, unlike Spark's lenient cast)."""
    c = _c(c)
    return F.when(c.rlike(INT_PATTERN), c.try_cast("int"))
