"""Join, group and rank written in SQL over the registered views give the
same answer as the DataFrame plan."""

from conftest import SF_SMALL
from rowforge.plans import insurance, queries as q
from rowforge.plans.views import register_views

SQL_ENRICHED = """
SELECT i.IssuerId, i.custnum, s.State_desc, c.Profession, c.Age,
       remspecialcharudf(i.NetworkName) AS cleannetworkname,
       url_protocol(i.NetworkURL) AS Protocol
FROM insureview i
JOIN statesview s ON i.stcd = s.State_cd
JOIN custview c ON i.custnum = c.Id
"""

SQL_RANKED = f"""
SELECT row_number() OVER (PARTITION BY Protocol
                          ORDER BY total DESC, State_desc ASC NULLS LAST, Profession ASC NULLS LAST) AS seq_number,
       avg_age, total, State_desc, Protocol, Profession
FROM (SELECT round(sum(Age), 2) / count(Age) AS avg_age, count(1) AS total,
             State_desc, Protocol, Profession
      FROM ({SQL_ENRICHED}) e
      GROUP BY State_desc, Protocol, Profession) g
"""


def test_sql_over_views_matches_dataframe_plan(spark):
    register_views(spark, q._insurance_csv(spark, SF_SMALL), q._ragged(spark, SF_SMALL))
    by_sql = sorted(tuple(r) for r in spark.sql(SQL_RANKED).collect())
    plan = insurance.protocol_ranking(*q._flow_inputs(spark, SF_SMALL))
    by_df = sorted(tuple(r) for r in plan.collect())
    assert by_sql == by_df and len(by_sql) > 0
    n = spark.sql(SQL_ENRICHED).count()
    assert n == q.QUERIES["insurance_enriched"](spark, SF_SMALL).count()
