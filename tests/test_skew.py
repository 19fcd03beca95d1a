"""Results stay exact when one key holds a third of all rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rowforge.operators.relational import (
    antijoin_left_anti, antijoin_not_in, antijoin_outer_null, dedup_counts, rows_not_in,
)
from rowforge.plans import insurance
from rowforge.operators.numbering import number_within
from rowforge.operators.prefilter import may_be_in
from rowforge.operators.salted import hot_keys, salted_join
from rowforge.plans.segments import segment_stats
from rowforge.sources.lookup import read_lookup_list


def skewed_orders(spark, n=30000):
    # a third of all orders belong to customer 7
    return spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).alias("o_custkey"),
        F.concat(F.lit("P"), (F.col("id") % 5).cast("string")).alias("o_orderpriority"))


def test_segment_stats_exact_under_skew(spark):
    orders = skewed_orders(spark)
    customer = spark.range(500).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        F.concat(F.lit("S"), (F.col("id") % 4).cast("string")).alias("c_mktsegment"),
        (F.col("id") * 1.25 - 100).alias("c_acctbal"))
    nation = spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"),
                                    F.concat(F.lit("N"), F.col("id").cast("string")).alias("n_name"))
    got = {(r.n_name, r.o_orderpriority, r.c_mktsegment): (r.total, r.avg_acctbal)
           for r in segment_stats(orders, customer, nation).collect()}
    naive = (orders.join(customer, orders.o_custkey == customer.c_custkey)
             .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
             .groupBy("n_name", "o_orderpriority", "c_mktsegment")
             .agg(F.count(F.lit(1)).alias("total"),
                  F.avg("c_acctbal").alias("avg_acctbal")))
    want = {(r.n_name, r.o_orderpriority, r.c_mktsegment): (r.total, r.avg_acctbal)
            for r in naive.collect()}
    assert {k: t for k, (t, _) in got.items()} == {k: t for k, (t, _) in want.items()}
    assert all(abs(a - want[k][1]) < 1e-9 for k, (_, a) in got.items())
    assert sum(t for t, _ in got.values()) == 30000


def test_dedup_counts_with_one_hot_row(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(-1))
                                   .otherwise(F.col("id")).alias("k"))
    r = dedup_counts(df).first()
    assert r.total_count == 30000
    assert r.distinct_count == 20000 + 1
    assert r.duplicate_count == 30000 - 20001


def test_segment_stats_with_null_priority(spark):
    orders = skewed_orders(spark, 3000).withColumn(
        "o_orderpriority", F.when(F.col("o_orderkey") % 7 == 0, F.lit(None))
        .otherwise(F.col("o_orderpriority")))
    customer = spark.range(500).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 25).cast("int").alias("c_nationkey"),
        F.lit("S").alias("c_mktsegment"), (F.col("id") * 0.5).alias("c_acctbal"))
    nation = spark.range(25).select(F.col("id").cast("int").alias("n_nationkey"),
                                    F.col("id").cast("string").alias("n_name"))
    got = {(r.n_name, r.o_orderpriority): r.total
           for r in segment_stats(orders, customer, nation).collect()}
    want = {(r.n_name, r.o_orderpriority): r["count"] for r in
            orders.join(customer, orders.o_custkey == customer.c_custkey)
                  .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                  .groupBy("n_name", "o_orderpriority").count().collect()}
    assert got == want and any(k[1] is None for k in got)


@pytest.fixture
def small_skew_thresholds(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    df.collect()
    return qe.executedPlan().toString()


def hot_words(spark, n=200_000, hot="hot"):
    """A third of all rows hold one word; padded so that partitions have size."""
    word = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.sha2(F.col("id").cast("string"), 256))
    return spark.range(0, n, 1, 8).select("id", word.alias("word"), F.sha2((-F.col("id")).cast("string"), 256).alias("pad"))


@pytest.mark.parametrize("form", [antijoin_left_anti, antijoin_not_in, antijoin_outer_null])
@pytest.mark.parametrize("from_file", [False, True])
def test_hot_word_is_split_on_the_large_list_path(spark, scratch, small_skew_thresholds, monkeypatch, form, from_file):
    """The hot word is on the list, so no filter keeps it from the shuffle."""
    from rowforge.operators import relational
    monkeypatch.setattr(relational, "fits_broadcast", lambda *a: False)
    hot = "6b86b273ff34fce19d6b804eff5a3f5747ada4eaa22f1d49c01e52ddb7875b4b"   # sha256 of "1"
    lookup = spark.range(50_000).select(F.sha2(F.col("id").cast("string"), 256).alias("stopword"))
    if from_file:
        path = scratch("list")
        lookup.union(lookup.limit(10)).write.text(path)
        lookup = read_lookup_list(spark, path)
    out = form(hot_words(spark, hot=hot), "word", lookup, "stopword")
    assert "skew=true" in final_plan(out)
    assert out.count() == sum(1 for i in range(200_000) if i % 3 and i >= 50_000)


@pytest.mark.parametrize("form", [antijoin_left_anti, antijoin_not_in])
def test_only_true_hits_are_shuffled(spark, scratch, monkeypatch, form):
    """Of 200 000 words, 1000 are on a long list that comes from a file."""
    from rowforge.operators import relational
    monkeypatch.setattr(relational, "fits_broadcast", lambda *a: False)
    path = scratch("list")
    spark.range(0, 1_000_000).where("id < 1000 or id >= 900000").select(F.sha2(F.col("id").cast("string"), 256)).write.text(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = spark.range(0, 200_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("word"))
        out = form(words, "word", read_lookup_list(spark, path), "stopword")
        assert out.count() == 199_000
        near = may_be_in(F.col("word"), read_lookup_list(spark, path), "stopword")
        assert 1000 <= words.where(near).count() < 3000
        text = out._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("LeftAnti") == 1 and "Union" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("words", [1, 64, 4096])
def test_filter_never_loses_a_value(spark, words):
    listed = spark.range(500).select(F.concat(F.lit("w"), "id").alias("v")).union(spark.sql("SELECT cast(null AS string)"))
    df = spark.range(2000).select(F.concat(F.lit("w"), "id").alias("w"), "id")
    found = {r["id"] for r in df.where(may_be_in(F.col("w"), listed, "v", words)).collect()}
    assert set(range(500)) <= found
    assert spark.range(3).where(may_be_in(F.col("id"), spark.range(0), "id")).count() == 0


def test_nulls_on_the_large_list_path(spark):
    words = spark.createDataFrame([("a",), ("b",), (None,), ("c",), ("c",)], "word string")
    listed = spark.createDataFrame([("b",), ("b",), ("z",)], "stopword string")
    got = lambda df: sorted((r.word or "-" for r in df.collect()))
    assert got(antijoin_left_anti(words, "word", listed, "stopword", max_broadcast_rows=0)) == ["a", "c", "c"]
    assert got(antijoin_left_anti(words, "word", listed, "stopword", True, 0)) == ["-", "a", "c", "c"]
    assert got(antijoin_not_in(words, "word", listed, "stopword", 0)) == ["a", "c", "c"]
    null = listed.union(spark.sql("SELECT cast(null AS string)"))
    assert got(antijoin_not_in(words, "word", null, "stopword", 0)) == []
    assert got(antijoin_left_anti(words, "word", null, "stopword", max_broadcast_rows=0)) == ["a", "c", "c"]
    assert got(antijoin_not_in(words, "word", listed.limit(0), "stopword", 0)) == ["-", "a", "b", "c", "c"]


def test_hot_row_of_rows_not_in_is_split(spark, small_skew_thresholds):
    # equal rows compress well, so the hot one has to be very frequent here
    for key in ("skewJoin.skewedPartitionThresholdInBytes", "advisoryPartitionSizeInBytes"):
        spark.conf.set(f"spark.sql.adaptive.{key}", "8k")
    k = F.col("id")
    a = spark.range(0, 400_000, 1, 8).select(F.when(k % 100 != 0, F.lit("hot")).otherwise(k.cast("string")).alias("k"))
    b = spark.range(0, 4000, 1, 8).select(k.cast("string").alias("k"))
    out = rows_not_in(a, b)
    assert "skew=true" in final_plan(out)
    assert out.count() == 400_000 - 40


@pytest.fixture
def no_help_from_spark(spark):
    """No broadcast of its own choice and no skew handling at run time."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def largest_share(df):
    """Of the partition with the most rows."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    return max(sizes) / sum(sizes)


def test_hot_keys_are_split_by_the_join(spark, no_help_from_spark):
    """Half of all plans are of one state, a third of one customer."""
    k = F.col("id")
    plans = spark.range(0, 60_000, 1, 8).select(
        k.cast("int").alias("IssuerId"), k.cast("int").alias("IssuerId2"),
        F.when(k % 3 == 0, 7).otherwise(k % 5000).cast("int").alias("custnum"),
        F.when(k % 2 == 0, "3").otherwise((k % 25).cast("string")).alias("stcd"))
    states = spark.range(25).select(k.cast("string").alias("State_cd"), F.concat(F.lit("S"), "id").alias("State_desc"))
    custs = spark.range(5000).select(k.cast("int").alias("cust_id"), (k % 80).alias("Age"))
    of_state = salted_join(plans, states, "stcd", "State_cd", insurance.PLAN_KEY)
    of_both = salted_join(of_state, custs, "custnum", "cust_id", insurance.PLAN_KEY, counted=plans)
    naive = plans.join(states, plans["stcd"] == states["State_cd"])
    assert largest_share(naive) > 0.5 > 0.2 > largest_share(of_state)
    assert largest_share(of_both) < 0.1
    naive = naive.join(custs, naive["custnum"] == custs["cust_id"])
    columns = ["IssuerId", "State_desc", "Age"]
    assert sorted(map(tuple, of_both.select(*columns).collect())) == sorted(map(tuple, naive.select(*columns).collect()))
    assert set(of_both.columns) == set(naive.columns)


def test_salted_join_on_repeated_null_and_missing_keys(spark):
    fact = spark.createDataFrame([(i, "hot" if i % 2 else [None, "b", "c"][i % 3]) for i in range(600)], "i int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("b", 3), (None, 4), ("z", 5)], "key string, v int")
    got = sorted(map(tuple, salted_join(fact, lookup, "k", "key", ["i"], share=0.01).select("i", "v").collect()))
    assert got == sorted(map(tuple, fact.join(lookup, F.col("k") == F.col("key")).select("i", "v").collect()))
    parts = {r["__key"]: r["__parts"] for r in hot_keys(fact, "k", 0.25).collect()}
    assert parts == {"hot": 3}       # 300 of the 500 rows that have a key, in parts of 125
    empty = fact.limit(0)
    assert salted_join(empty, lookup, "k", "key", ["i"]).count() == 0


def test_numbers_of_a_protocol_with_nearly_all_groups(spark, no_help_from_spark):
    k = F.col("id")
    rows = spark.range(0, 40_000, 1, 8).select(
        F.when(k % 50 != 0, "http").when(k % 100 == 0, "ftp").alias("Protocol"), (k % 997).alias("total"),
        F.when(k % 11 != 0, k % 4001).alias("a"), k.alias("b"))
    got = number_within(rows, ["Protocol"], "total", ["a", "b"])
    w = Window.partitionBy("Protocol").orderBy(F.col("total").desc(), F.col("a").asc_nulls_last(), F.col("b").asc_nulls_last())
    want = rows.withColumn("seq_number", F.row_number().over(w))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # the window of the plan is over counts per partition, not over rows
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and plan.index("Window") < plan.index("Aggregate")
    assert number_within(rows.limit(0), ["Protocol"], "total", ["a", "b"]).count() == 0


def test_sorted_rows_of_one_protocol_are_spread(spark, no_help_from_spark, monkeypatch):
    from rowforge.operators import numbering
    paths = []
    real = numbering.scratch_path
    monkeypatch.setattr(numbering, "scratch_path", lambda *a: paths.append(real(*a)) or paths[-1])
    rows = spark.range(0, 40_000, 1, 8).select(F.lit("http").alias("p"), (F.col("id") % 997).alias("total"), "id")
    got = number_within(rows, ["p"], "total", ["id"], partitions=20)
    assert tuple(got.agg(F.max("seq_number"), F.count_distinct("seq_number")).first()) == (40_000, 40_000)
    sizes = [r["count"] for r in spark.read.parquet(paths[0]).groupBy("__part").count().collect()]
    assert len(sizes) == 20 and max(sizes) < 4000


def test_ranking_with_many_nobodies_among_the_states(spark):
    """Customers without a last name lie on the states' side and make it large."""
    plans = spark.range(1000).select(F.col("id").cast("int").alias("custnum"), (F.col("id") % 25).cast("string").alias("stcd"),
                                     F.lit("http://x").alias("NetworkURL"))
    nobody = spark.range(1_100_000).select((F.col("id") + 100_000).cast("string").alias("State_cd"), F.lit("n").alias("State_desc"))
    states = spark.range(25).select(F.col("id").cast("string").alias("State_cd"), F.lit("s").alias("State_desc")).union(nobody)
    custs = spark.range(1000).select(F.col("id").cast("string").alias("Id"), F.lit("30").alias("Age"), F.lit("p").alias("Profession"))
    ranking = insurance.protocol_ranking(plans, states, custs)
    assert [tuple(r) for r in ranking.select("seq_number", "total", "avg_age").collect()] == [(1, 1000, 30.0)]
