import random
import time
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from rowforge.llm import source_mixing as sm

SCHEMA = "doc_id long, source string, mix_slot string, period int"


def made(sizes, seed=1):
    rows = [(i, s, "x", 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("target", [None, {"hot": 1.0, "a": 3.0, "b": 2.0, "c": 0.37}])
def test_every_prefix_deviates_by_less_than_a_block(spark, target):
    sizes = {"hot": 700, "a": 200, "b": 120, "c": 61, "d": 40}
    df = spark.createDataFrame(made(sizes), SCHEMA)
    out = sm.mix(df, target=target, period=60, block_rows=4, bucket_rows=100).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(range(sum(sizes.values())))
    quota = {r["source"]: r["quota"] for r in sm.quotas(
        spark.createDataFrame(list(sizes.items()), "source string, n long"), 60, target, 0.5).collect()}
    assert sum(quota.values()) == 60 and min(quota.values()) >= 1
    blocks = defaultdict(list)
    for r in out:
        blocks[r["source"], r["mix_block"]].append(r)
    taken = {}
    for (source, number), rows in blocks.items():
        full = sizes[source] - number * 4
        assert len(rows) == min(4, full) and len({r["mix_slot"] for r in rows}) == 1
        slot, share = rows[0]["mix_slot"], Fraction(quota[source], 60)
        assert slot not in taken
        taken[slot] = source
        assert rows[0]["mix_release"] == int(number / share) <= slot < rows[0]["mix_deadline"] == -int(-(number + 1) / share // 1)
    # until a source runs out
    done = Counter()
    for slot in range(max(taken) + 1):
        if slot not in taken:
            break
        done[taken[slot]] += 1
        for s, q in quota.items():
            assert abs(done[s] - (slot + 1) * Fraction(q, 60)) < 1
    assert len({r["mix_order"] for r in out}) == len(out)


def test_order_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(made({"a": 300, "b": 100}), SCHEMA)
    one, two = (sorted(map(tuple, sm.mix(d, bucket_rows=50).collect())) for d in (df.repartition(7), df.coalesce(1)))
    assert one == two


def test_edge_rows(spark):
    rows = [(1, None, None, None), (2, "", None, None), (None, "a", None, None), (3, "a", None, None), (3, "a", None, None)]
    out = sm.mix(spark.createDataFrame(rows, SCHEMA), block_rows=1).collect()
    assert len(out) == 5 and len({r["mix_order"] for r in out}) == 5
    assert [r["period"] for r in out] == [None] * 5 and sorted(map(str, (r["doc_id"] for r in out))) == ["1", "2", "3", "3", "None"]
    assert sm.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    absent = sm.mix(spark.createDataFrame(rows, SCHEMA), target={"zzz": 1.0}, block_rows=1)
    assert absent.count() == 5
    assert sm.mix(spark.createDataFrame(rows, SCHEMA), target={}, block_rows=1).count() == 5


def test_many_sources_lengthen_the_period(spark):
    df = spark.createDataFrame(made({f"s{i}": 2 for i in range(30)}), SCHEMA)
    out = sm.mix(df, period=10, block_rows=1).collect()
    assert len({r["mix_slot"] for r in out}) == 60


def test_thousands_of_sources(spark):
    """5000 sources, one of a third of the weight: every prefix of the period is
    less than a block from every share, in well under a minute."""
    sizes = [(f"s{i:05}", 400_000_000 if i == 7 else 1 + (i * i) % 5000) for i in range(5000)]
    began = time.time()
    quota = sm.quotas(spark.createDataFrame(sizes, "source string, n long"), 1000, None, 0.5)
    rows = sm.schedule(quota).collect()
    assert time.time() - began < 60
    q = {r["source"]: r["quota"] for r in quota.collect()}
    period = 20_000
    assert sum(q.values()) == period == len(rows) and max(q.values()) > 300
    at = {r["slot"]: r for r in rows}
    assert sorted(at) == list(range(period))
    done = Counter()
    for slot in range(period):
        s, number = at[slot]["source"], at[slot]["number"]
        assert number == done[s] and number * period // q[s] <= slot < -(-(number + 1) * period // q[s])
        done[s] += 1
    # a block in its window is less than one block from its share at every slot
    assert done == q


def test_rows_without_id_are_dealt(spark):
    rows = [(None, f"s{i % 3}", str(i), None) for i in range(3000)]
    out = sm.mix(spark.createDataFrame(rows, SCHEMA.replace("mix_slot", "other")), block_rows=4, bucket_rows=50)
    assert out.count() == 3000 and out.select("mix_order").distinct().count() == 3000
    draws = spark.createDataFrame(rows, SCHEMA.replace("mix_slot", "other"))
    assert draws.select(sm.F.md5(sm.F.xxhash64(*draws.columns).cast("string").cast("binary"))).distinct().count() == 3000
