"""Specs and schema of the insurance-plan layout and the jobs over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from rowforge.functions.keys import composite_key, with_audit_columns
from rowforge.functions.text import clean_special_chars
from rowforge.functions.urls import url_protocol
from rowforge.operators.aggregate import group_avg_count
from rowforge.operators.cleanse import LineSpec
from rowforge.operators.numbering import number_within
from rowforge.operators.relational import harmonise_key
from rowforge.operators.salted import salted_join
from rowforge.operators.splitting import split_by_null
from rowforge.plans.render import INSURANCE_FIELDS

INT_FIELDS = ("IssuerId", "IssuerId2", "custnum")

# File 1: dates yyyy-MM-dd, fields used as they are.
SPEC_FILE1 = LineSpec(names=INSURANCE_FIELDS, required=INSURANCE_FIELDS[:8],
                      int_cols=INT_FIELDS, date_col="BusinessDate",
                      date_format="yyyy-MM-dd")
# File 2: dates dd-MM-yyyy, every field trimmed first.
SPEC_FILE2 = LineSpec(names=INSURANCE_FIELDS, required=INSURANCE_FIELDS[:8],
                      int_cols=INT_FIELDS, date_col="BusinessDate",
                      date_format="dd-MM-yyyy", trim=True)

INSURANCE_SCHEMA = StructType([
    StructField(n, IntegerType() if n in INT_FIELDS else DateType() if n == "BusinessDate"
                else StringType(), True)
    for n in INSURANCE_FIELDS])


#: Columns that tell plans apart, by which those of a hot key are dealt.
PLAN_KEY = ["IssuerId", "IssuerId2", "custnum"]

# Reader options of the plan files.
CSV_ESCAPE, CSV_NAN = ",", "0"


def quality_row(spark: SparkSession, counts: dict[str, int], file: int) -> DataFrame:
    """The counts of one file as a row."""
    return spark.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in counts.items()], F.lit(file).alias("file"))


def insure_view(ds: DataFrame) -> DataFrame:
    """Renamed codes, composite issuer key, no dental column, audit columns."""
    return with_audit_columns(
        ds.withColumnsRenamed({"StateCode": "stcd", "SourceName": "srcnm"})
          .withColumn("issueridcomposite", composite_key("IssuerId", "IssuerId2"))
          .drop("DentalOnlyPlan"))



def customers_and_states(ragged: DataFrame, store_path: str | None = None
                         ) -> tuple[DataFrame, DataFrame]:
    """Split the mixed 5/2-column file (read as strings) by its third
    column: customers where it is set, states where it is null (so a
    customer with an empty last name lands among the states).

    With ``store_path`` the file is parsed once and written partitioned by
    side; each side then reads only its own folder, so the small states side
    can be size-checked (and broadcast) without scanning the customers."""
    if store_path:
        side = F.when(F.col("_c2").isNotNull(), "cust").otherwise("state")
        ragged.withColumn("side", side).write.mode("overwrite").partitionBy("side").parquet(store_path)
        schema = StructType(list(ragged.schema.fields) + [StructField("side", StringType())])
        return customers_and_states_from_store(
            ragged.sparkSession.read.schema(schema).parquet(store_path))
    return _named(*split_by_null(ragged, "_c2"))


def customers_and_states_from_store(stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of a stored split (``side`` partition column)."""
    return _named(stored.where(F.col("side") == "cust").drop("side"),
                  stored.where(F.col("side") == "state").drop("side"))


def _named(custs: DataFrame, states: DataFrame) -> tuple[DataFrame, DataFrame]:
    custs = custs.withColumnsRenamed({"_c0": "Id", "_c1": "FirstName", "_c2": "LastName",
                                      "_c3": "Age", "_c4": "Profession"})
    states = (states.drop("_c2", "_c3", "_c4")
                    .withColumnsRenamed({"_c0": "State_cd", "_c1": "State_desc"}))
    return custs, states


# The joined view's columns, in order.
ENRICHED_COLUMNS = ["IssuerId", "IssuerId2", "BusinessDate", "State_desc", "srcnm", "NetworkName",
                    "NetworkURL", "custnum", "MarketCoverage", "issueridcomposite", "sysdt", "systs",
                    "cleannetworkname", "curdt", "curts", "yr", "mth", "Protocol", "Profession", "Age"]


def _customers(custs: DataFrame) -> DataFrame:
    """Customer lookup keyed by the int form of its text id (bad ids never
    join instead of failing the job)."""
    return harmonise_key(custs.select("Id", "Age", "Profession"), "Id", "int", "cust_id").drop("Id")


def enriched_view(ds22: DataFrame, states: DataFrame, custs: DataFrame) -> DataFrame:
    """Plans joined to their state and customer, with the cleaned name, load
    date/time, year and month of the business date and the URL protocol.
    Duplicate lookup keys multiply rows, as any inner join does.

    The states side also holds every customer without a last name and grows
    with them, so neither side is taken to be small; a state or a customer
    with very many plans is split by the joins."""
    j = salted_join(ds22, states, "stcd", "State_cd", PLAN_KEY)
    j = salted_join(j, _customers(custs), "custnum", "cust_id", PLAN_KEY, counted=ds22)
    derived = {"cleannetworkname": clean_special_chars("NetworkName"),
               "curdt": F.current_date(), "curts": F.current_timestamp(),
               "yr": F.year("BusinessDate"), "mth": F.month("BusinessDate"),
               "Protocol": url_protocol("NetworkURL")}
    return j.select(*[derived[c].alias(c) if c in derived else c for c in ENRICHED_COLUMNS])


def protocol_ranking(ds22: DataFrame, states: DataFrame, custs: DataFrame) -> DataFrame:
    """avg(age) and count per (state, protocol, profession) over the enriched
    rows, numbered per protocol by count.

    Same result as grouping the enriched view, but plans are first counted
    per (customer, state code, protocol) so the customer join sees a few
    rows per customer, whatever share of plans one customer holds, and a state
    with very many customers is split."""
    pre = (ds22.groupBy("custnum", "stcd", url_protocol("NetworkURL").alias("Protocol"))
               .agg(F.count(F.lit(1)).alias("n")))
    c = _customers(custs)
    j = salted_join(pre, states, "stcd", "State_cd", ["custnum", "Protocol"], counted=ds22)
    j = j.join(c, j["custnum"] == c["cust_id"])
    g = group_avg_count(j, ["State_desc", "Protocol", "Profession"], "Age", "avg_age", weight="n")
    numbered = number_within(g, ["Protocol"], "total", ["State_desc", "Profession"])
    return numbered.select(F.col("seq_number").cast("int").alias("seq_number"), "avg_age", "total", "State_desc", "Protocol", "Profession")
