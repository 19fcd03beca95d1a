import os

import pytest
from pyspark.errors import AnalysisException

from rowforge.plans import chat
from rowforge.sources.lookup import lookup_from_values
from rowforge.streaming import chat as sc
from rowforge.streaming.runner import (
    read_newest_version, read_result, run_append_to_files, run_complete_to_versions, run_to_memory,
    use_rocksdb_state,
)

# Three customers and two agents (id~text~type): agents' lines with commas,
# repeated words, and words of the stop list.
CHAT = [
    "7~good day~c",
    "90~welcome, what brings you here~a",
    "7~the router blinks red and the router is hot~c",
    "90~please unplug it, wait, then try again~a",
    "7~still red~c",
    "90~a technician will call, thanks for waiting~a",
    "8~hello there~c",
    "91~hello, how may we help~a",
    "8~invoice of june shows a fee twice~c",
    "91~which fee, the late one~a",
    "8~the late fee of june~c",
    "91~removed, a corrected invoice is on its way~a",
    "9~good evening~c",
    "90~good evening, go ahead~a",
    "9~move my line to a new flat~c",
    "90~done, new flat noted~a",
    "9~thanks a lot~c",
    "90~you are welcome~a",
]
STOP = ["the", "and", "is", "of", "a", "to", "my"]
N_TOKENS, N_KEPT, N_WORDS = 39, 27, 22
TWICE = {"good", "router", "red", "june", "fee"}


def write_chat(path, rows, name):
    d = path.replace("file:", "")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", newline="") as f:
        f.write("\r\n".join(rows))


def test_golden_chat_keywords(spark, scratch):
    src = scratch("chat_src")
    write_chat(src, CHAT, "chat.txt")
    lines = sc.text_stream(spark, src)
    words = sc.customer_words(lines)
    kept = sc.words_without_stop(words, lookup_from_values(spark, STOP))
    run_to_memory(words, "golden_tokens")
    run_to_memory(kept, "golden_words")
    run_to_memory(sc.stream_keyword_counts(kept), "golden_counts", mode="complete")
    assert spark.table("golden_tokens").count() == N_TOKENS
    assert spark.table("golden_words").count() == N_KEPT
    counts = {r.chatkeywords: r.occurances for r in spark.table("golden_counts").collect()}
    assert len(counts) == N_WORDS
    assert {k for k, v in counts.items() if v == 2} == TWICE
    by_id = {}
    for r in spark.table("golden_words").collect():
        by_id.setdefault(r.id, []).append(r.word)
    assert sorted(by_id["8"]) == sorted("hello there invoice june shows fee twice late fee june".split())


def test_null_aware_not_in_on_stream(spark, scratch):
    src = scratch("chat_src2")
    write_chat(src, CHAT, "chat.txt")
    kept = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src)),
                                 lookup_from_values(spark, STOP), null_aware=True)
    run_to_memory(kept, "golden_words_notin")
    assert spark.table("golden_words_notin").count() == N_KEPT


def test_file_sink_exactly_once_on_rerun(spark, scratch):
    src, out, ck = scratch("rerun_src"), scratch("rerun_out"), scratch("rerun_ck")
    write_chat(src, CHAT[:6], "a.txt")

    def run():
        run_append_to_files(chat.parse_messages(sc.text_stream(spark, src)), out, ck)
        return spark.read.parquet(out).count()

    assert run() == 6
    assert run() == 6            # nothing new: nothing added
    write_chat(src, CHAT[6:9], "b.txt")
    assert run() == 9            # only the new file's rows


def test_complete_mode_overwrites_per_batch(spark, scratch):
    use_rocksdb_state(spark)
    src, out, ck = scratch("cm_src"), scratch("cm_out"), scratch("cm_ck")
    for i, part in enumerate([CHAT[:6], CHAT[6:12], CHAT[12:]]):
        write_chat(src, part, f"p{i}.txt")
    kept = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src, 1)),
                                 lookup_from_values(spark, STOP))
    counts = sc.stream_keyword_counts(kept)
    run_complete_to_versions(counts, out, ck)
    df = read_newest_version(spark, out, counts.schema)
    assert df.count() == N_WORDS and df.select("chatkeywords").distinct().count() == N_WORDS
    assert {r.chatkeywords for r in df.collect() if r.occurances == 2} == TWICE
    # the newest two of three versions stay, and an unfinished one does not show
    assert sorted(f for f in os.listdir(out.replace("file:", "")) if f[0] != ".") == ["batch_id=1", "batch_id=2"]
    df.limit(1).write.parquet(f"{out}/batch_id=3")
    assert read_newest_version(spark, out, counts.schema).count() == N_WORDS


def test_read_result_of_a_stream_with_no_input(spark, scratch):
    src, out, ck = scratch("empty_src"), scratch("empty_out"), scratch("empty_ck")
    os.makedirs(src.replace("file:", ""), exist_ok=True)
    kept = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src)),
                                 lookup_from_values(spark, STOP))
    counts = sc.stream_keyword_counts(kept)
    q = run_complete_to_versions(counts, out, ck)
    df = read_newest_version(spark, out, counts.schema, ran=q)
    assert df.count() == 0 and df.columns == ["chatkeywords", "occurances"]
    assert read_result(spark, out + "_none", counts.schema, ran=q).count() == 0
    with pytest.raises(AnalysisException):     # a missing output is no empty result
        read_result(spark, out + "_none", counts.schema)


def test_update_mode_versions_give_current_counts(spark, scratch):
    from rowforge.streaming.runner import read_latest_versions, run_update_to_versions
    use_rocksdb_state(spark)
    src, out, ck = scratch("up_src"), scratch("up_out"), scratch("up_ck")
    for i, part in enumerate([CHAT[:6], CHAT[6:12], CHAT[12:]]):
        write_chat(src, part, f"p{i}.txt")
    kept = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src, 1)),
                                 lookup_from_values(spark, STOP))
    counts = sc.stream_keyword_counts(kept)
    run_update_to_versions(counts, out, ck)
    raw = spark.read.parquet(out)
    assert raw.select("batch_id").distinct().count() == 3
    assert raw.count() < N_WORDS * 3          # only changed keys per batch
    cur = {r.chatkeywords: r.occurances
           for r in read_latest_versions(spark, out, counts.schema, ["chatkeywords"]).collect()}
    assert len(cur) == N_WORDS and {k for k, v in cur.items() if v == 2} == TWICE


def test_complete_mode_recovers_after_a_failed_batch(spark, scratch):
    """A micro-batch dies half way (its offsets are logged, its output is
    not committed); rerunning on the same checkpoint replays that batch and
    the overwrite leaves exactly the right counts."""
    from pyspark.errors import StreamingQueryException
    use_rocksdb_state(spark)
    src, out, ck = scratch("fail_src"), scratch("fail_out"), scratch("fail_ck")
    for i, part in enumerate([CHAT[:6], CHAT[6:12], CHAT[12:]]):
        write_chat(src, part, f"p{i}.txt")

    def counts():
        kept = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src, 1)),
                                     lookup_from_values(spark, STOP))
        return sc.stream_keyword_counts(kept)

    def flaky(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        if batch_id == 1:
            raise RuntimeError("lost in the middle of batch 1")

    q = (counts().writeStream.outputMode("complete").foreachBatch(flaky)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(120)
    run_complete_to_versions(counts(), out, ck)
    got = {r.chatkeywords: r.occurances for r in read_newest_version(spark, out, counts().schema).collect()}
    assert len(got) == N_WORDS and {k for k, v in got.items() if v == 2} == TWICE


def test_state_partitions_leave_session_setting_alone(spark, scratch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    src, out, ck = scratch("sp_src"), scratch("sp_out"), scratch("sp_ck")
    write_chat(src, CHAT, "c.txt")
    kept = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src)),
                                 lookup_from_values(spark, STOP))
    store_key = "spark.sql.streaming.stateStore.providerClass"
    store_before = spark.conf.get(store_key, None)
    counts = sc.stream_keyword_counts(kept)
    run_complete_to_versions(counts, out, ck, n_state=3, rocksdb=True)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get(store_key, None) == store_before
    assert read_newest_version(spark, out, counts.schema).count() == N_WORDS
    offsets = os.path.join(ck.replace("file:", ""), "offsets", "0")
    text = open(offsets).read()
    assert '"spark.sql.shuffle.partitions":"3"' in text and "RocksDBStateStoreProvider" in text


def test_compacted_versions_read_the_same(spark, scratch):
    from rowforge.streaming.runner import (
        compact_versions, read_latest_versions, run_update_to_versions)
    use_rocksdb_state(spark)
    src, out, ck = scratch("cv_src"), scratch("cv_out"), scratch("cv_ck")
    for i, part in enumerate([CHAT[:6], CHAT[6:12]]):
        write_chat(src, part, f"p{i}.txt")

    def run():
        kept = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src, 1)),
                                     lookup_from_values(spark, STOP))
        counts = sc.stream_keyword_counts(kept)
        run_update_to_versions(counts, out, ck)
        return counts.schema

    schema = run()
    before = sorted(tuple(r) for r in read_latest_versions(spark, out, schema, ["chatkeywords"]).collect())
    assert compact_versions(spark, out, schema, ["chatkeywords"]) == 1
    after = sorted(tuple(r) for r in read_latest_versions(spark, out, schema, ["chatkeywords"]).collect())
    assert after == before
    write_chat(src, CHAT[12:], "p2.txt")     # the stream goes on after compaction
    run()
    cur = {r.chatkeywords: r.occurances
           for r in read_latest_versions(spark, out, schema, ["chatkeywords"]).collect()}
    assert len(cur) == N_WORDS and {k for k, v in cur.items() if v == 2} == TWICE
    assert compact_versions(spark, out, schema, ["chatkeywords"]) == 2
    again = {r.chatkeywords: r.occurances
             for r in read_latest_versions(spark, out, schema, ["chatkeywords"]).collect()}
    assert again == cur


def test_parquet_stream_reads_a_file_and_a_folder(spark, scratch):
    rows = [(i, 0, "user", f"word{i} the") for i in range(20)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    folder, one = scratch("conv_folder") + "/conversations.parquet", scratch("conv_one")
    df.repartition(4).write.parquet(folder)
    df.coalesce(1).write.parquet(one)
    part = next(f for f in os.listdir(one.replace("file:", "")) if f.startswith("part-"))
    got = []
    for i, path in enumerate((folder, f"{one}/{part}")):
        out, ck = scratch(f"conv_out{i}"), scratch(f"conv_ck{i}")
        stream = sc.parquet_stream(spark, path, sc.CONVERSATION_SCHEMA, 1)
        q = run_append_to_files(chat.conversation_tokens(stream), out, ck)
        got.append(sorted(map(tuple, read_result(spark, out, "id long, word string", ran=q).collect())))
    assert got[0] == got[1] and len(got[0]) == 40


def test_several_batches_give_the_same_as_one(spark):
    from conftest import SF_SMALL
    from rowforge.streaming.queries import q_stream_complete, q_stream_update
    one, two, three = (sorted(map(tuple, f(spark, SF_SMALL, n).collect()))
                       for f, n in ((q_stream_complete, None), (q_stream_complete, 2), (q_stream_update, 1)))
    assert one == two == three and one
