"""A Bloom filter of a long lookup list, as an expression inside the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits in a filter: the bound on what every task gets (2 MB).
FILTER_WORDS = 1 << 18
#: Bits that a value sets in its word.
BITS = 3


def _mask(value: Column) -> Column:
    """The bits of a value: parts of a second hash choose them."""
    second = F.xxhash64(value, F.lit("bits"))
    out = F.lit(0).cast("long")
    for k in range(BITS):
        place = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def may_be_in(value: Column, lookup: DataFrame, col: str, words: int = FILTER_WORDS) -> Column:
    """False only if ``value`` is surely not among the values of ``col``.

    The filter is an aggregate over the list (partial ``bit_or`` per word in each
    task, then at most ``words`` rows) and an uncorrelated scalar subquery of the query
    that uses it.  A list of many more values than words makes it say yes more
    often, never no wrongly."""
    spark = lookup.sparkSession
    seen = lookup.where(F.col(col).isNotNull()).select(
        F.pmod(F.xxhash64(col), F.lit(words)).alias("at"), _mask(F.col(col)).alias("bits"))
    empty = spark.range(words).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    merged = seen.union(empty).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    held = merged.agg(F.sort_array(F.collect_list(F.struct("at", "bits"))).alias("v")).select("v.bits").scalar()
    mine = _mask(value)
    word = F.element_at(held, (F.pmod(F.xxhash64(value), F.lit(words)) + 1).cast("int"))
    return word.bitwiseAND(mine) == mine
