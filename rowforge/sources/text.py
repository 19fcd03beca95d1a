"""Plain text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line in column ``value``; LF and CRLF endings are removed.
    Files are split across tasks, so huge files read in parallel."""
    return spark.read.text(path)
