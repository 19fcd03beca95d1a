"""File and table writers.

Output stays parallel (one file per task) unless ``single_file`` is asked
for; then ``repartition(1)`` is used rather than ``coalesce(1)`` so the
upstream stages keep their parallelism and only the final write is one task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.session import create_file, names_in


def _one(df: DataFrame, single_file: bool) -> DataFrame:
    return df.repartition(1) if single_file else df


def delimited_line(df: DataFrame, sep: str = ",", name: str = "value") -> DataFrame:
    """Each row as one delimited text line (nulls become empty fields)."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                        for c in df.columns]).alias(name))


def write_text(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists",
               single_file: bool = False) -> None:
    _one(delimited_line(df, sep), single_file).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False,
              sep: str = ",", single_file: bool = False, **options) -> None:
    w = _one(df, single_file).write.mode(mode).option("header", header).option("sep", sep)
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               single_file: bool = False) -> None:
    """JSON lines; null fields are omitted, so read back with a schema."""
    _one(df, single_file).write.mode(mode).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  single_file: bool = False, partition_by: list[str] | None = None) -> None:
    w = _one(df, single_file).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, user: str | None = None,
               password: str | None = None, driver: str | None = None,
               mode: str = "overwrite", num_partitions: int | None = None,
               batchsize: int = 10000, truncate: bool = True) -> None:
    """JDBC table write.  Credentials come from the caller (never from code);
    ``num_partitions`` caps concurrent connections (coalesces the frame);
    ``truncate`` keeps the table definition on overwrite."""
    w = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
         .option("batchsize", batchsize).option("truncate", truncate))
    if num_partitions:
        w = w.option("numPartitions", num_partitions)
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            w = w.option(k, v)
    w.save()


def append_files_to_location(df: DataFrame, location: str, table: str | None = None,
                             sep: str = ",") -> None:
    """Append delimited files into an external table's folder, then refresh
    the table's file listing so the new files are visible."""
    df.write.mode("append").option("sep", sep).csv(location)
    if table:
        df.sparkSession.catalog.refreshTable(table)


def _jobs(location: str) -> str:
    return location.rstrip("/") + "__jobs"


def append_once(df: DataFrame, location: str, job: str, fmt: str = "csv", **options) -> bool:
    """Append ``df`` as the output of ``job`` (letters, digits, ``-._``), once.

    A job's files have a folder of their own, and its name is listed beside the
    table when they are complete; readers (``read_appended``) take listed folders
    only.  So the same append tried again leaves one copy, and one that died
    leaves nothing that can be seen.  False if the job was listed already."""
    spark = df.sparkSession
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", job):
        raise ValueError(f"not a job name: {job!r}")
    if job in names_in(spark, _jobs(location)):
        return False
    df.write.mode("overwrite").format(fmt).options(**options).save(f"{location}/{job}")
    create_file(spark, f"{_jobs(location)}/{job}")
    return True


def read_appended(spark: SparkSession, location: str, schema, fmt: str = "csv", **options) -> DataFrame:
    """The rows of all jobs whose appends are complete."""
    done = sorted(n for n in names_in(spark, _jobs(location)) if not n.startswith("."))
    reader = spark.read.schema(schema).format(fmt).options(**options)
    return reader.load([f"{location}/{job}" for job in done]) if done else spark.createDataFrame([], schema)


def overwrite_table_from_view(spark: SparkSession, table: str, df: DataFrame,
                              columns: list[str]) -> None:
    """``INSERT OVERWRITE TABLE t SELECT cols FROM view``."""
    spark.sql(f"INSERT OVERWRITE TABLE {table} SELECT {', '.join(columns)} FROM {{src}}",
              src=df)
