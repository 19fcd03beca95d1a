"""A lookup list that changes while streams use it.

A list is published in versions.  A stream takes, for each micro-batch, the newest
version there is when the batch first runs, and notes it: a batch that is replayed
after a failure sees the list it saw before, whatever was published since.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowforge.session import create_file, names_in, remove_path

KEPT_PINS = 2


def newest_version(spark: SparkSession, path: str) -> int:
    """The newest complete version of the list; -1 if there is none."""
    return max((int(n) for n in names_in(spark, f"{path}/_complete") if n.isdigit()), default=-1)


def publish(spark: SparkSession, path: str, values: DataFrame) -> int:
    """Write the next version of the list (one publisher at a time)."""
    version = newest_version(spark, path) + 1
    values.write.mode("overwrite").parquet(f"{path}/version={version}")
    create_file(spark, f"{path}/_complete/{version}")
    return version


def read_version(spark: SparkSession, path: str, version: int, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/version={version}")


def pinned_version(spark: SparkSession, path: str, pins: str, batch_id: int) -> int:
    """The version that batch ``batch_id`` of the stream with the folder ``pins``
    uses: the one noted for it, or else the newest, which is noted now."""
    noted = dict(n.split("-") for n in names_in(spark, pins) if not n.startswith("."))
    if str(batch_id) in noted:
        return int(noted[str(batch_id)])
    version = newest_version(spark, path)
    if version < 0:
        raise ValueError(f"no version of the list has been published in {path}")
    create_file(spark, f"{pins}/{batch_id}-{version}")
    old = str(batch_id - KEPT_PINS)
    if old in noted:
        remove_path(spark, f"{pins}/{old}-{noted[old]}")
    return version
