"""One-column lookup lists (stop words, code lists)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.functions.text import java_trim


def read_lookup_list(spark: SparkSession, path, name: str = "stopword") -> DataFrame:
    """Trimmed, non-blank values of a one-value-per-line file, repeats included.

    The result is meant for an anti/semi join, which does not mind repeats: so
    nothing has to be shuffled for its size to be checked, and nothing stands between
    an exchange and a join of it.
    """
    v = java_trim(F.col("value"))
    return (spark.read.text(path).select(v.alias(name))
            .where(F.length(F.col(name)) > 0))


def lookup_from_values(spark: SparkSession, values, name: str = "stopword") -> DataFrame:
    """Small fixed list as a one-column frame built from literals, so it is
    planned JVM-side (no Python worker, no Python RDD scan)."""
    vals = list(values)
    if not vals:
        return spark.range(0).select(F.lit(None).cast("string").alias(name))
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in vals])).alias(name))
