"""Row numbers per key without sorting a key's rows in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowforge.session import scratch_path


def number_within(df: DataFrame, partition_by: list[str], order_desc: str, tie_break: list[str],
                  name: str = "seq_number", partitions: int | None = None) -> DataFrame:
    """``row_number()`` (a long) per ``partition_by`` by descending
    ``order_desc``; ties by ``tie_break`` (ascending, nulls last).

    The rows are range-partitioned by (key, order, ties), so a key that holds nearly
    all rows is spread over as many tasks as its share, and sorted there.  Rows
    are counted per (key, partition); a row's number is its place in its
    partition plus the key's rows in the partitions before.  Only these counts, at most
    one per partition for a key, meet in a window.

    The sorted rows are stored below the shared folder, as the bounds of ranges
    are drawn anew with every execution."""
    spark = df.sparkSession
    order = ([F.col(c).asc_nulls_first() for c in partition_by] + [F.col(order_desc).desc()]
             + [F.col(c).asc_nulls_last() for c in tie_break])
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .select("*", F.spark_partition_id().alias("__part"), place.alias("__row")))
    path = scratch_path(spark, "numbered")
    ranged.write.parquet(path)
    rows = spark.read.schema(ranged.schema).parquet(path)

    spans = rows.groupBy(*partition_by, "__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__row").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy(*partition_by).orderBy("__part")) - F.col("__n")
    spans = spans.select(*[F.col(c).alias(f"__{c}") for c in partition_by], F.col("__part").alias("__of"),
                         (before - F.col("__first") + 1).alias("__offset"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in partition_by])
    numbered = rows.join(spans, (F.col("__part") == F.col("__of")) & same)
    return numbered.select(*df.columns, (F.col("__row") + F.col("__offset")).alias(name))
