"""Broadcast behind a size check, and partition-balance reporting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only below these bounds; the check reads at most
# max_rows + 1 rows, so it is cheap even on a huge side.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has <= ``max_rows`` rows, and their JSON text (an
    estimate of their size that is above it for all but wide numbers) totals
    <= ``max_bytes``.  One job that stops after ``max_rows`` + 1 rows, so give
    it rows that need no shuffle."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}))
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                   F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return r["n"] <= max_rows and r["b"] <= max_bytes


def maybe_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when its size is within the bounds;
    otherwise the side is returned as is and the join shuffles (AQE may
    still convert it at run time from real sizes, and splits skewed keys)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def repartition_balance(df: DataFrame, n: int) -> DataFrame:
    """Round-robin into ``n`` partitions and report rows per partition."""
    return (df.repartition(n)
              .groupBy(F.spark_partition_id().alias("partition_id"))
              .agg(F.count(F.lit(1)).alias("rows")))


def balance_summary(df: DataFrame, n: int) -> DataFrame:
    """One row: partitions used, total rows, smallest and largest partition."""
    per = repartition_balance(df, n)
    return per.agg(F.count(F.lit(1)).alias("num_partitions"),
                   F.sum("rows").alias("total_rows"),
                   F.min("rows").alias("min_rows"),
                   F.max("rows").alias("max_rows"))
