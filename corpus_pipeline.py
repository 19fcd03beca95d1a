"""The corpus pipeline: language ID, near-duplicates, personal data, mixing of
sources, packing.  Each stage is a function of (spark, docs, sf_dir); all but
the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowforge.llm import language_id, packing, pseudonyms, source_mixing
from rowforge.llm.near_dedup import one_of_each
from rowforge.operators.partitioning import maybe_broadcast
from rowforge.session import read_table, remove_path, scratch_path

#: A document goes if the languages of its spans, however many, are less sure than this.
MIN_CONFIDENCE = 0.4


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose spans have no sure language, go;
    mixed ones stay.  A missing lang is filled with the one of most letters."""
    model = language_id.train(docs)
    found = language_id.identify(docs, model).where(
        (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("confidence") >= MIN_CONFIDENCE))
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, one of the smallest id."""
    return one_of_each(docs, n=5, threshold_pct=80)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = pseudonyms.pseudonymise(docs, pseudonyms.session_key(spark))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which they are to be read."""
    return source_mixing.mix(docs).orderBy("mix_order", "doc_id").select(*docs.columns)


def file_number(path: Column) -> Column:
    """The number that Spark gives a file it writes: names sort by their text
    only as long as all numbers have five digits."""
    return F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("long")


def in_read_order(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with ``place``, the number of each row in the order of the
    table: by file number and row for a table that is read as it is, else by
    partition and row.  Rows are counted per file, and only these counts are
    added up in one task.  Their table, a row per file, is broadcast behind a
    check of its size; otherwise the planner chooses the join."""
    part, row = F.spark_partition_id(), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    if docs._jdf.queryExecution().analyzed().children().isEmpty():
        try:
            docs = docs.select("*", F.col("_metadata.file_path").alias("__part"),
                               F.col("_metadata.row_index").alias("__row"))
        except AnalysisException:          # not from files
            pass
    if "__part" not in docs.columns:
        docs = docs.select("*", part.alias("__part"), row.alias("__row"))
    is_file = docs.schema["__part"].dataType.simpleString() == "string"
    order = [file_number(F.col("__part")), "__part"] if is_file else ["__part"]
    counts = docs.groupBy("__part").agg(F.count("*").alias("n"))
    before = counts.select("__part", (F.sum("n").over(Window.orderBy(*order)) - F.col("n")).alias("__before"))
    return (docs.join(maybe_broadcast(before), "__part").withColumn("place", F.col("__before") + F.col("__row"))
            .drop("__part", "__row", "__before"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of neighbours in the mixed order; their names sort in that order."""
    return packing.pack(in_read_order(spark, docs), place_col="place")


STAGES = [
    ("language_id", keep_known_language),
    ("near_dedup", drop_near_duplicates),
    ("pseudonyms", hide_personal_data),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Hashes, a trained model and a greedy search: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage has written goes once the next one is written."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
