"""Registered queries against their SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if n.startswith("op")]


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    columns = sorted(d[0] for d in cur.description)
    want = sorted(cur.fetchdf()[columns].itertuples(index=False, name=None))
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == columns
    got = sorted(df.toPandas()[columns].itertuples(index=False, name=None))
    if "score" in columns:
        want, got = ([tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in rows] for rows in (want, got))
    assert got == want
