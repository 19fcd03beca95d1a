"""Rows of several data sets stored once in a layout that distinct, counts and
difference share.

Rows are counted per distinct row and data set, with a partial count in each task,
so a row repeated a billion times is combined before the shuffle and is one row of
the store; the distinct rows are then dealt to buckets by a hash of the whole row.
Distinct rows, counts and the difference of data sets of one store are
scans of it; the difference of two stores joins them bucket by bucket.  None of
them shuffles a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HASH, COPIES = "__hash", "__copies"


def write_row_store(parts: dict[str, DataFrame], table: str, path: str, buckets: int) -> DataFrame:
    """The rows of all ``parts`` (name -> frame, the same columns) as the external
    table ``table`` with its files at ``path``: one row per distinct row, with its
    copies in all and in each part."""
    columns = next(iter(parts.values())).columns
    rows = None
    for name, df in parts.items():
        tagged = df.select(*columns, F.lit(name).alias("__part"))
        rows = tagged if rows is None else rows.unionAll(tagged)
    counted = rows.groupBy(F.xxhash64(*columns).alias(HASH), *columns).agg(
        F.count(F.lit(1)).alias(COPIES), *[F.count_if(F.col("__part") == n).alias(_copies(n)) for n in parts])
    # each bucket is one task's, and one file
    (counted.repartition(buckets, HASH).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, HASH).sortBy(HASH).saveAsTable(table))
    return counted.sparkSession.table(table)


def _copies(part: str) -> str:
    return f"{COPIES}_{part}"


def _columns(store: DataFrame) -> list[str]:
    return [c for c in store.columns if c != HASH and not c.startswith(COPIES)]


def _repeated(store: DataFrame, copies: Column) -> DataFrame:
    each = F.explode(F.sequence(F.lit(1).cast("long"), copies))
    return store.withColumn("__copy", each).select(*_columns(store))


def distinct_rows(store: DataFrame) -> DataFrame:
    return store.select(*_columns(store))


def row_counts(store: DataFrame) -> DataFrame:
    """total, distinct and duplicate row counts."""
    return store.agg(F.sum(COPIES).alias("total_count"), F.count(F.lit(1)).alias("distinct_count"),
                     (F.sum(COPIES) - F.count(F.lit(1))).alias("duplicate_count"))


def rows_not_in_part(store: DataFrame, part: str) -> DataFrame:
    """Every copy of the rows that the data set ``part`` does not have (nulls
    equal nulls)."""
    return _repeated(store.where(F.col(_copies(part)) == 0), F.col(COPIES))


def rows_not_in_store(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every copy of the rows of store ``a`` that store ``b``, of as many buckets,
    does not have (nulls equal nulls).  The hash is the join's only key, so that
    the buckets serve; rows themselves are compared where hashes are equal."""
    of_b = b.select(F.col(HASH).alias("__hash_b"), F.struct(*_columns(a)).alias("__row_b"))
    same = (F.col(HASH) == F.col("__hash_b")) & F.array_contains(F.array("__row_b"), F.struct(*_columns(a)))
    return _repeated(a.join(of_b, same, "left_anti"), F.col(COPIES))
