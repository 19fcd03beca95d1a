"""Splitting one data set into several outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.functions.text import java_split_width
from rowforge.session import create_file, names_in, remove_path


def split_by_width(lines: DataFrame, widths: dict[str, int], sep: str = ",",
                   col: str = "value", label: str = "side") -> DataFrame:
    """Label each line by its Java-split field count (trailing empty fields
    do not count); lines of any other width get no label and are dropped.
    One scan; callers filter on ``label`` (or write ``partitionBy(label)``).
    """
    w = java_split_width(F.col(col), sep)
    lab = None
    for name, n in widths.items():
        lab = (F.when(w == n, F.lit(name)) if lab is None else lab.when(w == n, F.lit(name)))
    return lines.select(lab.alias(label), F.col(col)).where(F.col(label).isNotNull())


def split_by_null(df: DataFrame, probe: str) -> tuple[DataFrame, DataFrame]:
    """(rows where ``probe`` is not null, rows where it is null)."""
    return df.where(F.col(probe).isNotNull()), df.where(F.col(probe).isNull())


def write_split_by(df: DataFrame, col: str, path: str, fmt: str = "parquet",
                   mode: str = "overwrite", layout: str = "rebalance",
                   files_per_value: int = 4) -> None:
    """All splits in one pass: one directory per value of ``col``; readers
    prune to the directories they filter on.

    layout:
      ``rebalance`` (default) -- rows go to tasks by value and AQE splits
        any oversized value (a date holding a third of all rows) into
        advisory-size tasks and merges small ones, so file sizes follow the
        data whatever its skew;
      ``salted`` -- exactly ``files_per_value`` hash buckets per value;
      ``local`` -- no shuffle: each task writes the values it holds (up to
        tasks x values small files).
    """
    if layout == "rebalance":
        df = df.hint("rebalance", col)
    elif layout == "salted":
        bucket = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_value))
        df = df.repartition(F.col(col), bucket)
    elif layout != "local":
        raise ValueError(f"unknown layout {layout!r}")
    df.write.mode(mode).partitionBy(col).format(fmt).save(path)


def _done(path: str) -> str:
    return path.rstrip("/") + "__done"


def rewrite_splits(df: DataFrame, col: str, path: str, values: list, fmt: str = "parquet") -> None:
    """Write the splits of these ``values`` of ``col`` (dates, for example), and
    no others, again or for the first time.

    Their folders are replaced (one whose value has no row any more goes); all
    other files stay as they are.  A value is listed as complete
    beside the splits once its folder is; while it is written it is not listed, so a
    run that died is seen and can be repeated."""
    spark = df.sparkSession
    names = {v: str(v) for v in values}
    for name in names.values():
        remove_path(spark, f"{_done(path)}/{name}")
    some = df.where(F.col(col).isin(list(names)))
    found = {r[0] for r in some.select(F.col(col).cast("string")).distinct().collect()}
    (some.hint("rebalance", col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(col).format(fmt).save(path))
    for name in names.values():
        if name not in found:
            remove_path(spark, f"{path}/{col}={name}")
        create_file(spark, f"{_done(path)}/{name}")


def complete_values(spark: SparkSession, path: str) -> list[str]:
    """The values whose splits are complete, as text in order."""
    return sorted(n for n in names_in(spark, _done(path)) if not n.startswith("."))
