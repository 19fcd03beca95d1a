"""One pass, several outputs at one batch; lists that change between batches."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_jobs import write
from test_streaming import CHAT, STOP

from rowforge.operators.aggregate import keyword_count
from rowforge.plans import jobs
from rowforge.session import names_in
from rowforge.sources.lookup import lookup_from_values, read_lookup_list
from rowforge.streaming import chat as sc
from rowforge.streaming import ledger, lists

WORDS, COUNTS = "id string, word string", "chatkeywords string, occurances long"


def outputs(spark, out, upto=None):
    words = Counter(r.word for r in ledger.read_rows(spark, out, "words", WORDS, upto=upto).collect())
    counts = {r.chatkeywords: r.occurances for r in ledger.read_sums(
        spark, out, "keywords", COUNTS, ["chatkeywords"], "json", upto=upto).collect()}
    return words, counts


def run(spark, src, stop, out, ck, make=keyword_count, each=None):
    words = sc.words_without_stop(sc.customer_words(sc.text_stream(spark, src, 1)), stop)
    return ledger.run_to_ledger(words, out, ck, "words", {"keywords": make}, each, formats={"keywords": "json"})


def test_failure_between_two_outputs(spark, scratch):
    """The second batch's words are written and its counts are not: neither is
    seen until both are there."""
    src, out, ck = scratch("in"), scratch("out"), scratch("ck")
    stop = read_lookup_list(spark, write(scratch("stop"), STOP))
    write(src, CHAT[:6], "a.txt")
    run(spark, src, stop, out, ck)
    before = outputs(spark, out)
    assert before[0] and before[0] == before[1] and ledger.committed(spark, out) == 0

    def fails(words):
        raise RuntimeError("lost between two outputs")

    write(src, CHAT[6:], "b.txt")
    with pytest.raises(Exception, match="lost between two outputs"):
        run(spark, src, stop, out, ck, fails)
    assert spark.read.parquet(f"{out}/words").where("batch_id = 1").count() > 0
    assert outputs(spark, out) == before and ledger.committed(spark, out) == 0

    run(spark, src, stop, out, ck)
    after = outputs(spark, out)
    assert after[0] == after[1] != before[0] and ledger.committed(spark, out) == 1
    assert outputs(spark, out, upto=0) == before
    whole = sc.words_without_stop(sc.customer_words(spark.read.text(src)), stop)
    assert after[0] == Counter(r.word for r in whole.collect())


def test_failure_after_the_entry_is_not_written_twice(spark, scratch, monkeypatch):
    src, out, ck = scratch("in"), scratch("out"), scratch("ck")
    stop = lookup_from_values(spark, ["the"])
    write(src, CHAT, "a.txt")
    real = ledger._commit

    def then_fails(*a):
        real(*a)
        raise RuntimeError("lost after the entry")

    monkeypatch.setattr(ledger, "_commit", then_fails)
    with pytest.raises(Exception, match="lost after the entry"):
        run(spark, src, stop, out, ck)
    monkeypatch.setattr(ledger, "_commit", real)
    seen = []
    run(spark, src, stop, out, ck, lambda words: seen.append(1) or keyword_count(words))
    assert not seen and ledger.committed(spark, out) == 0
    words, counts = outputs(spark, out)
    assert words == counts and sum(words.values()) == sc.words_without_stop(
        sc.customer_words(spark.read.text(src)), stop).count()


def test_each_file_is_read_once(spark, scratch):
    """The source's lines are counted by the tasks that read them."""
    src, out = scratch("in"), scratch("out")
    stop = write(scratch("stop"), STOP)
    for k in range(4):
        write(src, CHAT[3 * k:3 * k + 3], f"{k}.txt")
    read = spark.sparkContext.accumulator(0)

    def counted(lines):
        for batch in lines:
            read.add(batch.num_rows)
            yield batch

    lines = sc.text_stream(spark, src, 1).mapInArrow(counted, "value string")
    words = sc.words_without_stop(sc.customer_words(lines), read_lookup_list(spark, stop))
    ledger.run_to_ledger(words, out, scratch("ck"), "words", {"keywords": keyword_count}, formats={"keywords": "json"})
    assert read.value == spark.read.text(src).count() and ledger.committed(spark, out) == 3
    assert outputs(spark, out)[0] == outputs(spark, out)[1]


def test_many_batches_and_snapshots(spark, scratch):
    src, out, ck = scratch("in"), scratch("out"), scratch("ck")
    stop = lookup_from_values(spark, [])
    for k, line in enumerate(CHAT):
        write(src, [line], f"{k}.txt")
    run(spark, src, stop, out, ck)
    n = len(CHAT) - 1
    assert ledger.committed(spark, out) == n
    assert len([x for x in names_in(spark, f"{out}/_ledger") if x.isdigit()]) == ledger.KEPT_ENTRIES
    before = outputs(spark, out)
    assert ledger.compact_sums(spark, out, "keywords", COUNTS, ["chatkeywords"], "json") == n
    assert outputs(spark, out) == before and outputs(spark, out, upto=3) != before
    write(src, CHAT[:2], "more.txt")
    run(spark, src, stop, out, ck)
    words, counts = outputs(spark, out)
    assert words == counts and sum(words.values()) > sum(before[0].values())


def test_empty_folder_and_another_checkpoint(spark, scratch):
    src, out, ck = scratch("in"), scratch("out"), scratch("ck")
    stop = lookup_from_values(spark, ["the"])
    write(src, [], "empty.txt", nl="")
    run(spark, src, stop, out, ck)
    assert outputs(spark, out) == (Counter(), {})
    write(src, CHAT, "a.txt")
    run(spark, src, stop, out, ck)
    with pytest.raises(ValueError, match="another checkpoint"):
        run(spark, src, stop, out, scratch("other_ck"))


def test_chat_job_on_files_that_arrive(spark, scratch):
    src, out = scratch("in"), scratch("out")
    stop = write(scratch("stop"), STOP)
    for k in range(3):
        write(src, CHAT[k::3], f"{k}.txt")
        jobs.chat_job(spark, src, stop, out, max_files_per_trigger=1)
        words, counts = outputs(spark, out)
        assert words == counts and ledger.committed(spark, out) == k


def test_replayed_batch_sees_the_list_it_saw(spark, scratch):
    src, out, ck, path = scratch("in"), scratch("out"), scratch("ck"), scratch("list")
    pins = f"{out}/_pins"
    used = {}

    def without_list(words, batch_id):
        version = lists.pinned_version(words.sparkSession, path, pins, batch_id)
        used.setdefault(batch_id, []).append(version)
        return sc.words_without_stop(words, lists.read_version(words.sparkSession, path, version, "stopword string"))

    def go(make=keyword_count):
        words = sc.customer_words(sc.text_stream(spark, src, 1))
        ledger.run_to_ledger(words, out, ck, "words", {"keywords": make}, without_list, formats={"keywords": "json"})

    def fails(words):
        raise RuntimeError("lost between two outputs")

    lines = ["1~alpha beta gamma~c"]
    with pytest.raises(Exception, match="no version"):
        write(src, lines, "a.txt")
        go()
    lists.publish(spark, path, lookup_from_values(spark, ["alpha"]))
    go()
    lists.publish(spark, path, lookup_from_values(spark, ["beta"]))
    write(src, lines, "b.txt")
    with pytest.raises(Exception, match="lost between"):
        go(fails)
    lists.publish(spark, path, lookup_from_values(spark, ["gamma"]))   # published before the replay
    go()
    write(src, lines, "c.txt")
    go()
    assert used == {0: [0], 1: [1, 1], 2: [2]}
    words, counts = outputs(spark, out)
    assert words == counts == {"alpha": 2, "beta": 2, "gamma": 2}
    assert outputs(spark, out, upto=0)[0] == {"beta": 1, "gamma": 1}
    assert len(names_in(spark, pins)) <= lists.KEPT_PINS + 1


def test_unfinished_version_is_not_used(spark, scratch):
    path = scratch("list")
    assert lists.newest_version(spark, path) == -1
    assert lists.publish(spark, path, spark.range(3).select(F.col("id").cast("string").alias("stopword"))) == 0
    spark.range(9).select(F.col("id").cast("string").alias("stopword")).write.parquet(f"{path}/version=1")
    assert lists.newest_version(spark, path) == 0
    assert lists.publish(spark, path, lookup_from_values(spark, ["x"])) == 1
    assert [r.stopword for r in lists.read_version(spark, path, 1, "stopword string").collect()] == ["x"]
