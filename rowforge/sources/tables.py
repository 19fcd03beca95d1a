"""Catalog tables: external delimited tables, FROM-first scans, views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowforge.session import scratch_path


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")


def kept_rows(spark: SparkSession, df: DataFrame, db: str) -> DataFrame:
    """The frame's rows stored in the shared folder, so that the scratch
    database they came from can be dropped at once."""
    path = scratch_path(spark, "kept", db)
    df.write.parquet(path)
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.read.schema(df.schema).parquet(path)


def create_external_csv_table(spark: SparkSession, table: str, columns_ddl: str,
                              location: str, sep: str = ",") -> None:
    """Delimited text table over files at ``location``; dropping the table
    leaves the files in place."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns_ddl}) USING csv "
              f"OPTIONS (sep '{sep}') LOCATION '{location}'")


def scan_from_first(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """``FROM t SELECT cols`` (FROM-first SQL)."""
    return spark.sql(f"FROM {table} SELECT {', '.join(columns)}")


def select_from_view(spark: SparkSession, df: DataFrame, view: str,
                     columns: list[str]) -> DataFrame:
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT {', '.join(columns)} FROM {view}")
