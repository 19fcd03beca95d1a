import random

from helpers import replay

from rowforge.llm import packing as pk

SCHEMA = "doc_id long, text string, source string, bin string, cluster string"


def test_tightest_compatible_bin_is_found():
    rng = random.Random(4)
    for _ in range(60):
        items = sorted(((rng.randint(1, 40), rng.choice("abc"), rng.choice([None, *range(6)]))
                        for _ in range(rng.randint(0, 80))), key=lambda x: -x[0])
        per_source = rng.randint(1, 3)
        placed = pk.pack_shard([x[0] for x in items], [x[1] for x in items], [x[2] for x in items], 50, per_source)
        replay(items, placed, 50, per_source)


def check(rows, plan, capacity, per_source):
    text = dict(enumerate(rows))
    covered, bins = {}, {}
    for r in plan:
        covered.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        bins.setdefault(r["bin"], []).append(r)
    for i, row in text.items():
        at = 0
        for start, length in sorted(covered.pop(row[0], [])):
            assert start == at
            at += length
        assert at == len(row[1] or "")
    assert not covered
    for rs in bins.values():
        rs = sorted(rs, key=lambda r: r["position"])
        assert [r["position"] for r in rs] == list(range(len(rs)))
        at = 0
        for r in rs:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    by_id = {row[0]: row for row in rows}
    for rs in bins.values():
        whole = [by_id[r["doc_id"]] for r in rs]
        assert len({w[1] for w in whole}) == len(whole)
        assert all(sum(w[2] == s for w in whole) <= per_source for s in {w[2] for w in whole})


def test_plan_covers_every_text(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("abé ", k=rng.choice([0, 1, 5, 30, 99, 100, 101, 250, 1000]))),
             rng.choice(["hot", "hot", "a", None]), "clash", None) for i in range(300)]
    rows += [(i, "the same text", "hot", "clash", None) for i in range(300, 360)] + [(360, None, "a", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = pk.pack(docs, capacity=100, per_source=2, shard_rows=64).collect()
    check(rows, plan, 100, 2)


def test_texts_of_sequences(spark):
    rows = [(1, "abcdefghij", "s", None, None), (2, "xyz", "t", None, None), (3, "", "t", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = pk.pack(docs, capacity=8)
    got = sorted(["".join(p["text"] for p in r["pieces"]) for r in pk.sequences(docs, plan).collect()])
    assert got == ["abcdefgh", "xyzij"] and plan.count() == 3


def test_given_clusters_repeated_rows_nulls_and_empty(spark):
    rows = [(1, "aa", "s", None, "c"), (2, "bb", "t", None, "c"), (3, "cc", "u", None, None), (4, "dd", "v", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    bins = {r["doc_id"]: r["bin"] for r in pk.pack(docs, capacity=100, cluster_col="cluster").collect()}
    assert bins[1] != bins[2] and bins[3] == bins[4]
    again = spark.createDataFrame([(None, "same", None, None, None)] * 5, SCHEMA)
    assert len({r["bin"] for r in pk.pack(again, capacity=100).collect()}) == 5
    assert pk.pack(docs.limit(0)).count() == 0


def test_repeated_rows_are_spread_over_shards(spark):
    """One row that makes up most of the table, and rows without id."""
    rows = [(7, "same text", "s", None, None)] * 3000 + [(None, "no id", "t", None, None)] * 1000
    plan = pk.pack(spark.createDataFrame(rows, SCHEMA).repartition(4), shard_rows=100, capacity=64).collect()
    assert len(plan) == 4000
    sizes = {}
    for r in plan:
        sizes[r["bin"].split(".")[0]] = sizes.get(r["bin"].split(".")[0], 0) + 1
    assert len(sizes) == 40 and max(sizes.values()) < 200
