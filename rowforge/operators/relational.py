"""Joins, anti joins, set operations and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.operators.partitioning import DEFAULT_BROADCAST_ROWS, fits_broadcast, maybe_broadcast
from rowforge.operators.prefilter import may_be_in
from rowforge.session import scratch_path


def harmonise_key(df: DataFrame, key: str, to_type: str, alias: str | None = None) -> DataFrame:
    """Cast a text key to the fact's key type; bad text becomes null (and
    therefore never joins) instead of failing the job under ANSI mode."""
    return df.withColumn(alias or key, F.col(key).try_cast(to_type))


def enrich_inner_join(fact: DataFrame, lookups: list[tuple[DataFrame, Column | list | str, bool]]) -> DataFrame:
    """Inner-join a fact with several lookups.

    ``lookups`` holds (lookup, join condition, small) triples.  ``small``
    lookups are broadcast only after a bounded size check; the others are
    shuffle-joined (AQE handles skew and late broadcast conversion).
    Duplicate lookup keys multiply fact rows, as in any inner join.
    """
    out = fact
    for lk, cond, small in lookups:
        out = out.join(maybe_broadcast(lk) if small else lk, cond, "inner")
    return out


def _lookup_values(lookup: DataFrame, col: str) -> DataFrame:
    """The non-null lookup values as ``__lk``, repeats included: an anti join
    does not mind them, and without an aggregate in between both sides are
    plain shuffles, which AQE splits where a value is hot."""
    return lookup.select(F.col(col).alias("__lk")).where(F.col("__lk").isNotNull())


def _without(df: DataFrame, col: str, values: DataFrame, max_broadcast_rows: int) -> DataFrame:
    """Rows whose ``col`` is not among the values ``__lk`` (null ones stay).

    A list beyond the broadcast bound is made a Bloom filter first: rows that
    miss it are not in the list and stay where they are, and only the others are
    shuffled to the exact anti join.  (A stream, which would have to be read once
    for each of these, is shuffled whole.)"""
    if fits_broadcast(values, max_broadcast_rows):
        values = F.broadcast(values)
    elif not df.isStreaming:
        near = may_be_in(F.col(col), values, "__lk")
        found = df.where(near)
        return df.where(~near).unionAll(found.join(values, found[col] == values["__lk"], "left_anti"))
    return df.join(values, df[col] == values["__lk"], "left_anti")


def antijoin_left_anti(df: DataFrame, col: str, lookup: DataFrame, lookup_col: str, keep_null: bool = False,
                       max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose ``col`` is not in the lookup.

    Nulls are removed from the lookup (so one null there cannot empty the
    result); null values of ``col`` are dropped unless ``keep_null``.
    """
    left = df if keep_null else df.where(F.col(col).isNotNull())
    return _without(left, col, _lookup_values(lookup, lookup_col), max_broadcast_rows)


def antijoin_not_in(df: DataFrame, col: str, lookup: DataFrame, lookup_col: str,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """SQL ``NOT IN (subquery)`` semantics, null-aware: a null in the lookup
    empties the result, a null value is dropped (kept if the lookup is empty).

    One plan whatever the data: whether the lookup has a null, or any row, is
    an uncorrelated scalar subquery (one aggregate over the lookup, run with
    the query and once per micro-batch on a stream), beside an equi anti join
    that needs no nested loop.  The size check only decides how that join moves rows.
    """
    lk = lookup.select(F.col(lookup_col).alias("__lk"))
    seen = lk.agg(F.struct(F.count_if(F.col("__lk").isNull()).alias("nulls"),
                           F.count(F.lit(1)).alias("rows")).alias("s")).scalar()
    allowed = (seen["nulls"] == 0) & (F.col(col).isNotNull() | (seen["rows"] == 0))
    return _without(df.where(allowed), col, _lookup_values(lookup, lookup_col), max_broadcast_rows)


def antijoin_outer_null(df: DataFrame, col: str, lookup: DataFrame, lookup_col: str) -> DataFrame:
    """Left outer join + ``lookup IS NULL`` filter (null values are kept).

    The list's distinct values are joined, or a value it repeats would
    multiply the matched rows before the filter drops them; a list that is too
    large to broadcast is stored first, so the join's sides are plain shuffles
    and a hot value is split."""
    lk = _lookup_values(lookup, lookup_col)
    if fits_broadcast(lk):
        lk = F.broadcast(lk.distinct())
    else:
        path = scratch_path(df.sparkSession, "lookup")
        lk.distinct().write.parquet(path)
        lk = df.sparkSession.read.schema(lk.schema).parquet(path)
    return (df.join(lk, df[col] == lk["__lk"], "left_outer")
              .where(F.col("__lk").isNull()).drop("__lk"))


def rows_not_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` with no equal row in ``b`` (nulls equal nulls).

    Every copy of a matched row goes and every copy of an unmatched row
    stays -- neither ``subtract`` (distinct) nor ``exceptAll`` (multiset).
    """
    # The whole row as one struct key: struct equality treats null fields as
    # equal (and NaN / -0.0 like <=>).  Each side is shuffled once, as the
    # struct, with nothing between its exchange and the join, so AQE can
    # split a row that A repeats very often.
    row = F.struct(*[F.col(c) for c in a.columns])
    bk = b.select(row.alias("__row"))
    ak = a.select(row.alias("__row"))
    return ak.join(bk, ak["__row"] == bk["__row"], "left_anti").select("__row.*")


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept."""
    return reduce(lambda x, y: x.unionByName(y), dfs)


def dedup_exact(df: DataFrame) -> DataFrame:
    return df.distinct()


def dedup_counts(df: DataFrame) -> DataFrame:
    """total, distinct and duplicate row counts in one job.

    Rows are grouped by all columns with a partial (map-side) count, so a
    row repeated a billion times is combined before the shuffle.
    """
    return counts_of_groups(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n")), "__n")


def counts_of_groups(grouped: DataFrame, n: str) -> DataFrame:
    """The same from one row per distinct row with its number ``n``."""
    return grouped.agg(F.sum(n).alias("total_count"),
                       F.count(F.lit(1)).alias("distinct_count"),
                       (F.sum(n) - F.count(F.lit(1))).alias("duplicate_count"))
