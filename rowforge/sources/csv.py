"""CSV with an explicit schema.  Schemas are always given: inference costs a
full extra pass and takes the width from the first line only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv_typed(spark: SparkSession, path, schema: StructType,
                   date_format: str = "yyyy-MM-dd", header: bool = True,
                   null_value: str = "", mode: str = "DROPMALFORMED",
                   store_path: str | None = None, **options) -> DataFrame:
    """Typed CSV; with DROPMALFORMED rows that are too short, too long, or
    hold a value that does not parse as its column type are dropped.

    The CSV parser only converts the columns a query reads, so on its own
    DROPMALFORMED drops a different set of rows for different projections (a
    count, or a select without one column, keeps rows a full read drops).
    ``store_path`` (a folder under the shared checkpoint dir), which that
    mode therefore requires, fixes the set: every column is parsed once, the
    typed rows are written as Parquet and all consumers read that table --
    which also cuts lineage to the raw text.
    """
    if store_path is None and mode.upper() == "DROPMALFORMED":
        raise ValueError("DROPMALFORMED needs store_path: the rows it drops would depend on the columns read")
    r = (spark.read.schema(schema)
         .option("header", header)
         .option("dateFormat", date_format)
         .option("nullValue", null_value)
         .option("mode", mode))
    for k, v in options.items():
        r = r.option(k, v)
    df = r.csv(path)
    if store_path is None:
        return df
    df.write.mode("overwrite").parquet(store_path)
    return spark.read.schema(schema).parquet(store_path)


# Causes of a rejected row that are not about one column.
TOO_FEW, TOO_MANY, UNREADABLE = "too_few_columns", "too_many_columns", "unreadable"
MARK = "\x01end\x01"


def read_csv_with_rejects(spark: SparkSession, path, schema: StructType, store_path: str,
                          date_format: str = "yyyy-MM-dd", header: bool = True, null_value: str = "",
                          **options) -> tuple[DataFrame, DataFrame]:
    """Typed CSV of which nothing is dropped: (typed rows, rejected rows).

    The typed rows are those that DROPMALFORMED keeps.  A rejected row has its
    ``line`` and a ``cause``: too few or too many columns, or ``bad_<column>`` of each
    value that does not parse as its type, joined by commas.  One
    permissive parse writes both, partitioned by status, to ``store_path`` (below the
    shared checkpoint folder); the fields of the few rejected lines are cut again,
    as text, to find the cause."""
    line = "__line"
    r = spark.read.schema(StructType([*schema.fields, StructField(line, StringType())]))
    settings = {"header": header, "dateFormat": date_format, "nullValue": null_value, **options}
    for k, v in {**settings, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": line}.items():
        r = r.option(k, v)
    # the line is cut with one more field, a mark: where it comes out tells how many there are
    # (an empty field and a missing one are both null)
    text = {k: str(v) for k, v in {**options, "nullValue": null_value, "mode": "PERMISSIVE"}.items()}
    cut = F.from_csv(F.concat(line, F.lit(text.get("sep", ",") + MARK)),
                     ", ".join(f"f{i} string" for i in range(len(schema) + 1)), text)
    *fields, last = [cut[f"f{i}"] for i in range(len(schema) + 1)]
    short = F.exists(F.array(*fields), lambda f: F.coalesce(F.endswith(f, F.lit(MARK)), F.lit(False)))
    bad = [F.when(c.isNotNull() & (c != null_value) & F.col(f.name).isNull(), f"bad_{f.name}")
           for c, f in zip(fields, schema.fields)]
    cause = (F.when(short, TOO_FEW).when(~F.equal_null(last, F.lit(MARK)), TOO_MANY)
             .otherwise(F.coalesce(F.nullif(F.concat_ws(",", *bad), F.lit("")), F.lit(UNREADABLE))))
    # the parser's rows are fenced, so that no column of the parse is pruned
    rows = r.csv(path).withColumn("__row", F.explode(F.array(F.struct(*schema.names, line))))
    rows = rows.select("__row.*").select("*", F.when(F.col(line).isNotNull(), cause).alias("cause"))
    status = F.when(F.col(line).isNull(), "kept").otherwise("rejected")
    rows = rows.withColumn("status", status).withColumnRenamed(line, "line")
    rows.write.mode("overwrite").partitionBy("status").parquet(store_path)
    stored = spark.read.schema(rows.schema).parquet(store_path)
    return (stored.where("status = 'kept'").select(*schema.names),
            stored.where("status = 'rejected'").select("line", "cause"))


def string_schema(width: int, prefix: str = "_c") -> StructType:
    return StructType([StructField(f"{prefix}{i}", StringType(), True) for i in range(width)])


def read_csv_strings(spark: SparkSession, path, width: int, sep: str = ",",
                     **options) -> DataFrame:
    """Ragged CSV as ``width`` string columns ``_c0..``; short rows are padded
    with nulls and empty fields read as null."""
    r = spark.read.schema(string_schema(width)).option("sep", sep)
    for k, v in options.items():
        r = r.option(k, v)
    return r.csv(path)
