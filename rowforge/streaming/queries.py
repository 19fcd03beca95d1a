"""Registered streaming jobs.  Each runs to completion (``availableNow``) on
its own checkpoint below the shared checkpoint folder and returns what its
sink holds afterwards, read back as a batch frame.  ``files_per_trigger``
limits the files of a micro-batch; by default Spark takes all there are."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rowforge.operators.aggregate import COUNT_NAME, KEY_NAME, keyword_count
from rowforge.plans import chat, queries as batch, render
from rowforge.session import scratch_path, table_path
from rowforge.sources.lookup import lookup_from_values
from rowforge.sources.tables import create_database, kept_rows
from rowforge.streaming import chat as sc
from rowforge.streaming import ledger, lists
from rowforge.streaming.runner import (
    compact_versions, read_latest_versions, read_newest_version, read_result, run_append_to_files,
    run_complete_to_versions, run_to_table, run_update_to_versions,
)


def _chat_text_dir(spark: SparkSession, sf: str) -> str:
    return batch._rendered(spark, sf, "chat",
                           lambda: render.chat_lines(batch._t(spark, sf, "conversations")))


def _lines(spark, sf, files: int | None) -> DataFrame:
    return sc.text_stream(spark, _chat_text_dir(spark, sf), files)


def _conversations(spark, sf, files: int | None) -> DataFrame:
    return sc.parquet_stream(spark, table_path(sf, "conversations"), sc.CONVERSATION_SCHEMA, files)


def _stop_list(spark, sf) -> DataFrame:
    """The stop words as loaded from a list of text lines."""
    return batch._stop_file(spark, sf)


def _n_state(spark) -> int:
    """State partitions for a new checkpoint: the cluster's default
    parallelism (cores here, all executor cores on a cluster)."""
    return spark.sparkContext.defaultParallelism


def _paths(spark, name):
    return scratch_path(spark, "stream", name, "out"), scratch_path(spark, "stream", name, "ckpt")


def q_stream_file_source(spark, sf, files_per_trigger: int | None = None):
    out, ck = _paths(spark, "messages")
    msgs = chat.parse_messages(_lines(spark, sf, files_per_trigger))
    q = run_append_to_files(msgs, out, ck)
    return read_result(spark, out, msgs.schema, ran=q)


def q_stream_tokens(spark, sf, files_per_trigger: int | None = None):
    out, ck = _paths(spark, "tokens")
    words = sc.customer_words(_lines(spark, sf, files_per_trigger))
    q = run_append_to_files(words, out, ck)
    return read_result(spark, out, words.schema, ran=q)


def q_stream_append(spark, sf, files_per_trigger: int | None = None):
    out, ck = _paths(spark, "words")
    words = sc.words_without_stop(sc.customer_words(_lines(spark, sf, files_per_trigger)), _stop_list(spark, sf))
    q = run_append_to_files(words, out, ck)
    return read_result(spark, out, words.schema, ran=q)


def q_stream_complete(spark, sf, files_per_trigger: int | None = None):
    out, ck = _paths(spark, "keywords")
    words = sc.words_without_stop(sc.customer_words(_lines(spark, sf, files_per_trigger)), _stop_list(spark, sf))
    counts = sc.stream_keyword_counts(words)
    q = run_complete_to_versions(counts, out, ck, n_state=_n_state(spark), rocksdb=True)
    return read_newest_version(spark, out, counts.schema, ran=q)


def q_stream_update(spark, sf, files_per_trigger: int | None = None):
    """Keyword counts in update mode: each batch writes only changed keys;
    the versions are compacted into a snapshot and the reader takes the
    latest value per keyword."""
    out, ck = _paths(spark, "keyword_versions")
    words = sc.words_without_stop(sc.customer_words(_lines(spark, sf, files_per_trigger)), _stop_list(spark, sf))
    counts = sc.stream_keyword_counts(words)
    run_update_to_versions(counts, out, ck, n_state=_n_state(spark), rocksdb=True)
    compact_versions(spark, out, counts.schema, ["chatkeywords"])
    return read_latest_versions(spark, out, counts.schema, ["chatkeywords"])


def q_stream_result_read(spark, sf, files_per_trigger: int | None = None):
    """Stream into a catalog table, then read the result by its name; the
    stop words are removed with the null-aware ``NOT IN`` form."""
    db = f"rf_{uuid.uuid4().hex[:12]}"
    create_database(spark, db, scratch_path(spark, "warehouse"))
    table = f"{db}.chat_words"
    _, ck = _paths(spark, "table")
    words = sc.words_without_stop(sc.customer_words(_lines(spark, sf, files_per_trigger)), _stop_list(spark, sf),
                                  null_aware=True)
    run_to_table(words, table, ck)
    return kept_rows(spark, spark.table(table).select("id", "word"), db)


_COUNTS = f"{KEY_NAME} string, {COUNT_NAME} long"


def q_stream_one_pass(spark, sf, files_per_trigger: int | None = None):
    """Words and keyword counts from one pass over the stream, both read at
    the same batch: the counts, and the words written for each of them."""
    out, ck = _paths(spark, "one_pass")
    words = sc.words_without_stop(sc.customer_words(_lines(spark, sf, files_per_trigger)), _stop_list(spark, sf))
    ledger.run_to_ledger(words, out, ck, "words", {"keywords": keyword_count}, formats={"keywords": "json"})
    upto = ledger.compact_sums(spark, out, "keywords", _COUNTS, [KEY_NAME], fmt="json")
    counts = ledger.read_sums(spark, out, "keywords", _COUNTS, [KEY_NAME], fmt="json", upto=upto)
    written = ledger.read_rows(spark, out, "words", words.schema, upto=upto)
    return counts.join(keyword_count(written, count_name="words_written"), KEY_NAME, "full_outer")


def q_stream_changing_list(spark, sf, files_per_trigger: int | None = None):
    """Customer words of a folder that grows, without the words of a list that
    changes: even conversations come while it is half as long, odd ones later."""
    (out, ck), folder = _paths(spark, "changing_list"), scratch_path(spark, "stream", "chat_growing")
    stop, pins = scratch_path(spark, "stream", "stop_list"), f"{out}/_pins"
    conversations = batch._t(spark, sf, "conversations")
    schema = "stopword string"

    def without_list(words, batch_id):
        session = words.sparkSession
        version = lists.pinned_version(session, stop, pins, batch_id)
        return sc.words_without_stop(words, lists.read_version(session, stop, version, schema))

    for k, values in enumerate((chat.DEFAULT_STOP_WORDS[::2], chat.DEFAULT_STOP_WORDS)):
        lists.publish(spark, stop, lookup_from_values(spark, values))
        render.chat_lines(conversations.where(conversations["conv_id"] % 2 == k)).write.mode("append").text(folder)
        words = sc.customer_words(sc.text_stream(spark, folder, files_per_trigger))
        ledger.run_to_ledger(words, out, ck, "words", {}, each=without_list)
    return ledger.read_rows(spark, out, "words", words.schema)


def q_stream_to_parquet(spark, sf, files_per_trigger: int | None = None):
    """Parquet file sink, run twice on one checkpoint: the second run finds
    no new input and adds nothing (exactly-once)."""
    out, ck = _paths(spark, "conv_words")
    ran = []
    for _ in range(2):
        toks = chat.conversation_tokens(_conversations(spark, sf, files_per_trigger))
        words = sc.words_without_stop(toks, _stop_list(spark, sf))
        ran.append(run_append_to_files(words, out, ck))
    return read_result(spark, out, words.schema, ran=ran[0])


def q_stream_agg_to_json(spark, sf, files_per_trigger: int | None = None):
    out, ck = _paths(spark, "conv_keywords")
    toks = chat.conversation_tokens(_conversations(spark, sf, files_per_trigger))
    counts = sc.stream_keyword_counts(sc.words_without_stop(toks, _stop_list(spark, sf)))
    q = run_complete_to_versions(counts, out, ck, fmt="json", n_state=_n_state(spark), rocksdb=True)
    return read_newest_version(spark, out, counts.schema, fmt="json", ran=q)


STREAM_QUERIES = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_stream_") and callable(fn)
}
