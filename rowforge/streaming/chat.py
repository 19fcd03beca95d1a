"""The chat keyword job on a stream: text lines -> (id, chat, type) ->
customer tokens -> stop words removed (stream-static anti join) -> counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rowforge.operators.aggregate import keyword_count
from rowforge.operators.relational import antijoin_left_anti, antijoin_not_in
from rowforge.plans.chat import filter_by_role, parse_messages, tokens
from rowforge.session import hadoop_path

CONVERSATION_SCHEMA = StructType([
    StructField("conv_id", LongType()), StructField("turn", LongType()),
    StructField("role", StringType()), StructField("text", StringType())])


def text_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files in a directory as a stream of lines (column ``value``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def parquet_stream(spark: SparkSession, path: str, schema: StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table, one file or a folder of part files, as a stream."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    fs, p = hadoop_path(spark, path)
    if fs.getFileStatus(p).isDirectory():
        return r.parquet(path)
    # a stream reads folders only: the file's, cut down to the file
    return r.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())


def customer_words(lines: DataFrame, role: str = "c") -> DataFrame:
    """(id, word) for the customer's messages (stateless)."""
    return tokens(filter_by_role(parse_messages(lines), role))


def words_without_stop(words: DataFrame, stop: DataFrame, stop_col: str = "stopword",
                       null_aware: bool = False) -> DataFrame:
    """Stream-static anti join; the static side is size-checked and broadcast."""
    if null_aware:
        return antijoin_not_in(words, "word", stop, stop_col)
    return antijoin_left_anti(words, "word", stop, stop_col)


def stream_keyword_counts(words: DataFrame) -> DataFrame:
    """Running count per keyword (state grows with the vocabulary; run in
    complete or update mode)."""
    return keyword_count(words)
