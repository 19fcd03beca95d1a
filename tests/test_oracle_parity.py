"""Every registered job against its DuckDB oracle on the smallest tables
(the same comparison the correctness gate runs on sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
# the training-data queries have tests of their own
NAMES = sorted(n for n in entry.queries() if n != "pipeline" and not n.startswith("op"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if isinstance(x, float):
            return round(x, 9) if not math.isnan(x) else "nan"
        return x

    return sorted((tuple(repr(v(r[i])) for i in order) for r in rows))


def test_every_query_has_an_oracle():
    missing = set(NAMES) - set(entry.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert norm(srows, df.columns) == norm(orows, ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["seq_number", "avg_acctbal", "total", "n_name", "o_orderpriority",
                          "c_mktsegment"]
    assert df.count() > 0
