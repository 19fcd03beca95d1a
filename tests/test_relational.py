from pyspark.sql import functions as F

from rowforge.operators.aggregate import group_avg_count, rank_within
from rowforge.operators.partitioning import balance_summary, fits_broadcast, maybe_broadcast
from rowforge.operators.relational import (
    antijoin_left_anti, antijoin_not_in, antijoin_outer_null, dedup_counts, enrich_inner_join,
    harmonise_key, rows_not_in, union_all,
)


def words(spark, ws):
    return spark.createDataFrame([(i, w) for i, w in enumerate(ws)], "id int, word string")


def stop(spark, ws):
    return spark.createDataFrame([(w,) for w in ws], "stopword string")


def got(df):
    return sorted((r.word for r in df.collect()), key=lambda x: (x is None, x))


def test_anti_join_variants_agree_without_nulls(spark):
    w, s = words(spark, ["a", "b", "the", "c", "the"]), stop(spark, ["the", "of"])
    want = ["a", "b", "c"]
    assert got(antijoin_not_in(w, "word", s, "stopword")) == want
    assert got(antijoin_left_anti(w, "word", s, "stopword")) == want
    assert got(antijoin_outer_null(w, "word", s, "stopword")) == want


def test_not_in_null_semantics(spark):
    w = words(spark, ["a", None, "the"])
    # a null in the list empties the result
    assert got(antijoin_not_in(w, "word", stop(spark, ["the", None]), "stopword")) == []
    # a null word is dropped ...
    assert got(antijoin_not_in(w, "word", stop(spark, ["the"]), "stopword")) == ["a"]
    # ... but kept when the list is empty
    empty = spark.createDataFrame([], "stopword string")
    assert got(antijoin_not_in(w, "word", empty, "stopword")) == ["a", "the", None]


def test_left_anti_and_outer_null_ignore_list_nulls(spark):
    w, s = words(spark, ["a", None, "the"]), stop(spark, ["the", None])
    assert got(antijoin_left_anti(w, "word", s, "stopword")) == ["a"]
    assert got(antijoin_left_anti(w, "word", s, "stopword", keep_null=True)) == ["a", None]
    assert got(antijoin_outer_null(w, "word", s, "stopword")) == ["a", None]


def test_rows_not_in_keeps_all_copies_of_unmatched(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (2, None), (3, "z")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    out = sorted(tuple(r) for r in rows_not_in(a, b).collect())
    assert out == [(3, "z")]
    b2 = spark.createDataFrame([(3, "z")], "k int, v string")
    out = sorted(tuple(r) for r in rows_not_in(a, b2).collect())
    assert out == [(1, "x"), (1, "x"), (2, None), (2, None)]   # duplicates kept


def test_dedup_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,), (None,)], "k int")
    r = dedup_counts(df).first()
    assert (r.total_count, r.distinct_count, r.duplicate_count) == (6, 3, 3)


def test_union_all_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert sorted(tuple(r) for r in union_all(a, b, a).collect()) == [(1, "x"), (1, "x"), (2, "y")]


def test_enrich_join_bad_text_key_does_not_fail(spark):
    fact = spark.createDataFrame([(1, "AL"), (2, "CA"), (3, "AL")], "custnum int, stcd string")
    cust = spark.createDataFrame([("1", "Dr"), ("x", "bad"), ("3", "Eng")], "Id string, prof string")
    cust = harmonise_key(cust, "Id", "int")
    states = spark.createDataFrame([("AL", "Alabama")], "state_cd string, state_desc string")
    j = enrich_inner_join(fact, [(states, fact["stcd"] == states["state_cd"], True),
                                 (cust, fact["custnum"] == cust["Id"], False)])
    assert sorted((r.custnum, r.prof, r.state_desc) for r in j.collect()) == \
        [(1, "Dr", "Alabama"), (3, "Eng", "Alabama")]


def test_group_avg_count_and_rank(spark):
    df = spark.createDataFrame([("p", "a", "10"), ("p", "a", "20"), ("p", "b", "x"),
                                ("q", "c", "1")], "proto string, g string, age string")
    g = group_avg_count(df, ["proto", "g"], "age", avg_name="avg_age")
    r = rank_within(g, ["proto"], "total", ["g"])
    rows = {(x.proto, x.g): (x.avg_age, x.total, x.seq_number) for x in r.collect()}
    assert rows[("p", "a")] == (15.0, 2, 1)
    assert rows[("p", "b")] == (None, 1, 2)      # bad age ignored, not a failure
    assert rows[("q", "c")] == (1.0, 1, 1)


def test_broadcast_size_check(spark):
    small = spark.range(10)
    assert fits_broadcast(small, 10) and not fits_broadcast(small, 9)
    assert maybe_broadcast(spark.range(100), 10) is not None


def test_balance_summary(spark):
    r = balance_summary(spark.range(1000), 8).first()
    assert (r.num_partitions, r.total_rows) == (8, 1000)
    assert r.max_rows - r.min_rows <= 8


def test_not_in_is_one_plan_and_matches_the_sql_form(spark):
    w = words(spark, ["a", None, "the", "b"])
    empty = spark.createDataFrame([], "stopword string")
    for lk in (stop(spark, ["the", "the"]), stop(spark, ["the", None]), empty, stop(spark, [None])):
        want = got(spark.sql("SELECT * FROM {w} WHERE word NOT IN (SELECT stopword FROM {l})", w=w, l=lk))
        for limit in (0, 1000):        # without and with the broadcast hint
            assert got(antijoin_not_in(w, "word", lk, "stopword", limit)) == want


def test_split_by_value_salted_layout(spark, scratch):
    import glob
    import os
    from rowforge.operators.splitting import write_split_by
    df = spark.range(1000).select((F.col("id") % 3).alias("d"), "id")
    p = scratch("split")
    write_split_by(df, "d", p, layout="salted", files_per_value=2)
    back = spark.read.parquet(p)
    assert back.count() == 1000
    for v in range(3):
        files = glob.glob(os.path.join(p.replace("file:", ""), f"d={v}", "part-*"))
        assert 1 <= len(files) <= 2


def test_broadcast_check_bounds_bytes_too(spark):
    wide = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert fits_broadcast(wide, 10, 100_000)
    assert not fits_broadcast(wide, 10, 5_000)


def test_split_by_value_rebalance_splits_a_hot_value(spark, scratch):
    import glob
    import os
    from rowforge.operators.splitting import write_split_by
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = spark.range(200000).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 10).alias("d"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad")).repartition(8)
        p = scratch("rebalance")
        write_split_by(df, "d", p)
    finally:
        spark.conf.set(key, old)
    assert spark.read.parquet(p).count() == 200000
    hot = glob.glob(os.path.join(p.replace("file:", ""), "d=0", "part-*"))
    assert len(hot) > 1          # the value holding a third of the rows is split
