"""Grouped aggregates and per-group ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# Fixed value: the decimal type in which values of up to 8 decimals add up exactly.
EXACT_TYPE = "decimal(26,8)"


def average(value, weight=None):
    """Average of a double column, each value counted ``weight`` times (a
    whole number) if given; null values do not count.

    Where all values of a group have at most 8 decimals, the sum is exact, so
    the result does not depend on the order of rows; otherwise it is the plain
    quotient of double sums."""
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    w = F.lit(1) if weight is None else F.col(weight) if isinstance(weight, str) else weight
    d = v.try_cast(EXACT_TYPE)
    n = F.sum(F.when(v.isNotNull(), w))
    exact = F.bool_and(v.isNull() | F.coalesce(d.cast("double") == v, F.lit(False)))
    return F.when(exact, F.sum(d * w.cast("decimal(11,0)")).cast("double") / n).otherwise(F.sum(v * w) / n)


def group_avg_count(df: DataFrame, keys: list[str], value: str,
                    avg_name: str = "avg_value", count_name: str = "total",
                    weight: str | None = None) -> DataFrame:
    """``avg(value)`` and ``count(1)`` per group (partial + final aggregate);
    with ``weight`` each row stands for that many.

    A text ``value`` is converted with ``try_cast`` so one bad entry becomes a
    null (ignored by avg) instead of failing the job.
    """
    v = F.col(value).try_cast("double")
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*keys).agg(average(v, weight).alias(avg_name), rows.alias(count_name))


def rank_within(df: DataFrame, partition_by: list[str], order_desc: str,
                tie_break: list[str], name: str = "seq_number") -> DataFrame:
    """``row_number()`` per partition by descending ``order_desc``; ties are
    resolved by ``tie_break`` (ascending, nulls last) so the numbering is
    reproducible.

    The rows of one partition key are sorted in one task, so apply it to
    aggregated data (as every job here does: groups, not raw rows)."""
    w = Window.partitionBy(*partition_by).orderBy(F.col(order_desc).desc(),
                                                  *[F.col(c).asc_nulls_last() for c in tie_break])
    return df.withColumn(name, F.row_number().over(w))


# Output names of the keyword count.
KEY_NAME, COUNT_NAME = "chatkeywords", "occurances"


def keyword_count(words: DataFrame, word_col: str = "word",
                  key_name: str = KEY_NAME, count_name: str = COUNT_NAME) -> DataFrame:
    """Occurrences per word (case-sensitive, punctuation kept)."""
    return (words.groupBy(F.col(word_col).alias(key_name))
                 .agg(F.count(F.lit(1)).alias(count_name)))


def top_keywords(counts: DataFrame, k: int, key: str = KEY_NAME,
                 count: str = COUNT_NAME) -> DataFrame:
    """The ``k`` most frequent keywords (ties by keyword, so the report is
    reproducible).  Planned as a per-partition top-k merged at the end: no
    partition is sorted whole and only k rows per task move."""
    return counts.orderBy(F.col(count).desc(), F.col(key).asc_nulls_last()).limit(k)
