"""Plan properties that matter at scale: pruned scans, partial aggregation
before the shuffle, size-checked broadcast of small sides, one split per
line on the cleansing path."""

import pytest

from conftest import SF_SMALL
from rowforge.plans.queries import QUERIES


def plan(spark, name):
    return QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_and_preaggregates(spark):
    p = plan(spark, "rank_within_protocol")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in p
    assert "c_name" not in p                       # customer scan pruned to 4 columns
    assert "partial_count" in p                    # map-side count before the first exchange
    assert "BroadcastHashJoin" in p                # nation (size-checked)


def test_enrich_join_pushes_not_null_filters(spark):
    p = plan(spark, "enrich_inner_join")
    assert "PushedFilters: [IsNotNull(o_custkey)]" in p
    assert "ReadSchema: struct<n_nationkey:int,n_name:string>" in p


def test_stop_words_are_a_broadcast_anti_join(spark):
    for name in ("antijoin_left_anti", "keyword_count"):
        p = plan(spark, name)
        assert "LeftAnti" in p and "BroadcastExchange" in p
        assert "ExistingRDD" not in p              # lookup literals stay JVM-side


def test_cleansing_splits_each_line_once(spark):
    p = plan(spark, "typed_records")
    assert "Generate explode(array(split(" in p
    assert p.count("split(value") == 1


def test_filters_reach_parquet_scan(spark):
    p = plan(spark, "tokenize")
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in p
    assert "ReadSchema: struct<conv_id:bigint,role:string,text:string>" in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rdd_scans(spark, name):
    assert "ExistingRDD" not in plan(spark, name)
