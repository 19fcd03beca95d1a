"""Every registered job: name -> f(spark, sf_dir) -> DataFrame.

Each reads the warehouse tables under ``sf_dir`` (or text that Spark renders
from them into the shared checkpoint folder) in full.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import replace
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.functions.dates import date_parts, normalize_date
from rowforge.functions.keys import composite_key, with_audit_columns
from rowforge.functions.sql import register_sql_functions
from rowforge.functions.text import clean_special_chars, split_keep_trailing, java_trim
from rowforge.functions.urls import url_protocol, url_scheme
from rowforge.operators import cleanse as cl
from rowforge.operators import rowstore
from rowforge.operators.aggregate import top_keywords
from rowforge.operators.numbering import number_within
from rowforge.operators.partitioning import balance_summary
from rowforge.operators.relational import (
    antijoin_left_anti, antijoin_not_in, antijoin_outer_null, dedup_counts, dedup_exact,
    enrich_inner_join, rows_not_in, union_all,
)
from rowforge.operators.salted import salted_join
from rowforge.operators.splitting import rewrite_splits, split_by_width, write_split_by
from rowforge.plans import chat, render, segments
from rowforge.plans import insurance
from rowforge.plans.insurance import INSURANCE_SCHEMA, SPEC_FILE1, SPEC_FILE2
from rowforge.session import fingerprint, read_table, remove_path, scratch_path, table_path
from rowforge.sinks import files as sinks
from rowforge.sources.csv import read_csv_strings, read_csv_typed, read_csv_with_rejects
from rowforge.sources.lookup import lookup_from_values, read_lookup_list
from rowforge.sources.tables import (
    create_database, create_external_csv_table, kept_rows, scan_from_first, select_from_view,
)
from rowforge.sources.text import read_text_lines

Query = Callable[[SparkSession, str], DataFrame]
_written: dict[tuple, str] = {}
_lock = threading.RLock()
#: Tables that stored intermediates are made from.
_SOURCES = ("orders", "customer", "nation", "conversations")


def _once(spark: SparkSession, sf: str, key: str, make) -> str:
    """Path of an intermediate built once per session and state of the tables
    (``make(path)`` writes it); safe when jobs run from several threads."""
    k = (spark.sparkContext.applicationId, sf, key,
         fingerprint(spark, [table_path(sf, t) for t in _SOURCES]))
    with _lock:
        if k not in _written:
            path = scratch_path(spark, "prepared", key)
            make(path)
            _written[k] = path
        return _written[k]


#: Intermediates that hold parsed rows (the others are rendered text).
PARSED = {"insurance1_typed", "cleansed1", "cleansed2", "custs_states_split"}


def remove_intermediates(spark: SparkSession, keys: set[str] | None = None) -> None:
    """Delete what this session has stored for later queries, at its end or
    (``keys``) to have some of it made anew."""
    with _lock:
        for k in [k for k in _written if k[0] == spark.sparkContext.applicationId]:
            if keys is None or k[2] in keys:
                remove_path(spark, _written.pop(k))


def _t(spark, sf, name):
    return read_table(spark, sf, name)


def _rendered(spark: SparkSession, sf: str, key: str, make, **kw) -> str:
    """Render once per session and data set into the shared folder."""
    return _once(spark, sf, key, lambda path: render.write_lines(make(), path, **kw))


def _insurance_text(spark, sf, variant: int) -> DataFrame:
    path = _rendered(spark, sf, f"insurance{variant}",
                     lambda: render.insurance_lines(_t(spark, sf, "orders"), variant))
    return read_text_lines(spark, path)


def _insurance_csv(spark, sf) -> DataFrame:
    """File 1 through the typed CSV reader, ingested once per session into a
    Parquet table (fixed set of dropped malformed rows, see read_csv_typed)."""
    def ingest(store):
        path = _rendered(spark, sf, "insurance1_csv",
                         lambda: render.insurance_lines(_t(spark, sf, "orders"), 1, with_header=False, quoted=True),
                         header_per_file=render.INSURANCE_HEADER)
        read_csv_typed(spark, path, INSURANCE_SCHEMA, date_format="yyyy-MM-dd", store_path=store,
                       escape=insurance.CSV_ESCAPE, nanValue=insurance.CSV_NAN)

    store = _once(spark, sf, "insurance1_typed", ingest)
    return spark.read.schema(INSURANCE_SCHEMA).parquet(store)


def _mixed_text_path(spark, sf) -> str:
    return _rendered(spark, sf, "cust_states",
                     lambda: render.customer_state_lines(_t(spark, sf, "customer"),
                                                         _t(spark, sf, "nation")))


def _body(spark, sf, variant):
    return cl.drop_blank_lines(cl.drop_header(_insurance_text(spark, sf, variant),
                                              render.INSURANCE_HEADER))


def _spec(variant):
    return SPEC_FILE1 if variant == 1 else SPEC_FILE2


def _cleansed(spark, sf, variant) -> tuple[DataFrame, DataFrame]:
    """(kept typed rows, rejected lines) of one file, classified once per
    session into a status-partitioned table under the shared folder; later
    jobs read it with partition pruning instead of re-parsing the text."""
    store = _once(spark, sf, f"cleansed{variant}",
                  lambda path: cl.cleanse(_insurance_text(spark, sf, variant), _spec(variant),
                                          render.INSURANCE_HEADER, store_path=path))
    stored = spark.read.parquet(store)
    kept = stored.where(F.col("status") == "kept").select(*_spec(variant).names)
    rejected = stored.where(F.col("status") == "rejected").select("value", "reject_reason")
    return kept, rejected


def _typed(spark, sf, variant):
    return _cleansed(spark, sf, variant)[0]


def _stop(spark) -> DataFrame:
    return lookup_from_values(spark, chat.DEFAULT_STOP_WORDS)


def _stop_file(spark, sf) -> DataFrame:
    """The stop words loaded from a list of text lines, as a job gets them."""
    path = _rendered(spark, sf, "stopwords", lambda: render.stop_word_lines(_stop(spark)))
    return read_lookup_list(spark, path)


def _chat_tokens(spark, sf) -> DataFrame:
    return chat.conversation_tokens(_t(spark, sf, "conversations"))


def _ragged(spark, sf) -> DataFrame:
    return read_csv_strings(spark, _mixed_text_path(spark, sf), 5)


def _pages_urls(spark, sf) -> DataFrame:
    """Page URLs with some schemes cut off and some upper-cased."""
    p = _t(spark, sf, "pages")
    pid = F.col("page_id")
    url = (F.when(pid % 5 == 0, F.regexp_replace("url", "^https?://", ""))
            .when(pid % 7 == 3, F.upper("url")).otherwise(F.col("url")))
    return p.select(pid, url.alias("url"))


# ---------------------------------------------------------------- sources

def q_read_text_lines(spark, sf):
    return _insurance_text(spark, sf, 1)


def q_csv_schema_dropmalformed(spark, sf):
    return _insurance_csv(spark, sf)


def _csv_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    path = _rendered(spark, sf, "insurance1_csv",
                     lambda: render.insurance_lines(_t(spark, sf, "orders"), 1, with_header=False, quoted=True),
                     header_per_file=render.INSURANCE_HEADER)
    return read_csv_with_rejects(spark, path, INSURANCE_SCHEMA, scratch_path(spark, "out", "csv_sides"),
                                 escape=insurance.CSV_ESCAPE, nanValue=insurance.CSV_NAN)


def q_csv_kept_of_permissive(spark, sf):
    """The rows that ``csv_schema_dropmalformed`` keeps, by the parse that
    keeps the others as well."""
    return _csv_sides(spark, sf)[0]


def q_csv_rejects(spark, sf):
    """Lines of the typed CSV that do not fit its schema, with their cause."""
    return _csv_sides(spark, sf)[1]


def q_csv_strings_ragged(spark, sf):
    return _ragged(spark, sf)


def q_sql_view_select(spark, sf):
    return select_from_view(spark, _t(spark, sf, "customer"), "custview",
                            ["c_custkey", "c_name", "c_mktsegment"])


def q_lookup_list(spark, sf):
    path = _rendered(spark, sf, "segments", lambda: render.segment_list_lines(_t(spark, sf, "customer")))
    return read_lookup_list(spark, path, name="item").distinct()


def _ext_table(spark, sf, appends: int) -> tuple[str, str]:
    """(database, external table) with that many copies of the customers."""
    root = scratch_path(spark, "warehouse")
    db = f"rf_{uuid.uuid4().hex[:12]}"
    create_database(spark, db, root + "/db")
    table, loc = f"{db}.customer_text", root + "/customer_text"
    create_external_csv_table(spark, table, "c_custkey BIGINT, c_name STRING, c_nationkey INT, "
                              "c_acctbal DOUBLE, c_mktsegment STRING", loc)
    cust = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey",
                                            "c_acctbal", "c_mktsegment")
    for _ in range(appends):
        sinks.append_files_to_location(cust, loc, table)
    return db, table


def q_external_table_scan(spark, sf):
    db, table = _ext_table(spark, sf, 1)
    return kept_rows(spark, scan_from_first(spark, table, ["c_custkey", "c_name", "c_mktsegment"]), db)


def q_external_table_append(spark, sf):
    db, table = _ext_table(spark, sf, 2)
    return kept_rows(spark, spark.table(table), db)


def q_append_once(spark, sf):
    """Two jobs append to one folder; the first is tried again after it is
    complete, the second after it died halfway."""
    where = scratch_path(spark, "out", "appended")
    cust = _t(spark, sf, "customer").select(*_CUST_COLS)
    sinks.append_once(cust, where, "first")
    sinks.append_once(cust, where, "first")
    cust.where("c_custkey % 2 = 0").write.csv(f"{where}/second")          # a run that was lost before its end
    sinks.append_once(cust, where, "second")
    return sinks.read_appended(spark, where, _CUST_DDL)


def q_managed_table_overwrite(spark, sf):
    root = scratch_path(spark, "warehouse")
    db = f"rf_{uuid.uuid4().hex[:12]}"
    create_database(spark, db, root)
    table = f"{db}.customer_copy"
    spark.sql(f"CREATE TABLE {table} (c_custkey BIGINT, c_name STRING, c_mktsegment STRING) "
              "USING parquet")
    cust = _t(spark, sf, "customer")
    cols = ["c_custkey", "c_name", "c_mktsegment"]
    sinks.overwrite_table_from_view(spark, table, cust, cols)
    sinks.overwrite_table_from_view(spark, table, cust, cols)  # second run replaces
    return kept_rows(spark, spark.table(table), db)


# ---------------------------------------------------------------- sinks

_CUST_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_CUST_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"


def _cust_with_nulls(spark, sf):
    c = _t(spark, sf, "customer").select(*_CUST_COLS)
    return c.withColumn("c_mktsegment", F.when(F.col("c_custkey") % 13 != 0, F.col("c_mktsegment")))


def q_sink_text(spark, sf):
    path = scratch_path(spark, "out", "text")
    sinks.write_text(_t(spark, sf, "customer").select(*_CUST_COLS), path)
    return spark.read.text(path)


def q_sink_csv_overwrite(spark, sf):
    path = scratch_path(spark, "out", "csv")
    df = _cust_with_nulls(spark, sf)
    sinks.write_csv(df, path)
    sinks.write_csv(df, path)  # overwrite, not append
    return spark.read.schema(_CUST_DDL).csv(path)


def q_sink_json_overwrite(spark, sf):
    path = scratch_path(spark, "out", "json")
    df = _cust_with_nulls(spark, sf)
    sinks.write_json(df, path)
    sinks.write_json(df, path)
    return spark.read.schema(_CUST_DDL).json(path)


def q_sink_csv_tilde_header(spark, sf):
    path = scratch_path(spark, "out", "csv_tilde")
    sinks.write_csv(_cust_with_nulls(spark, sf), path, header=True, sep="~")
    return spark.read.schema(_CUST_DDL).option("header", True).option("sep", "~").csv(path)


def q_sink_parquet_single(spark, sf):
    """A single Parquet file -- used for a result of bounded size (the
    ranking has at most nations x priorities x segments rows at any scale),
    never for a row-level table."""
    path = scratch_path(spark, "out", "parquet_single")
    sinks.write_parquet(q_rank_within_protocol(spark, sf), path, single_file=True)
    return spark.read.parquet(path)


def q_sink_parquet(spark, sf):
    path = scratch_path(spark, "out", "parquet")
    sinks.write_parquet(q_enrich_inner_join(spark, sf), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------- line cleansing

def q_drop_header(spark, sf):
    return cl.drop_header(_insurance_text(spark, sf, 1), render.INSURANCE_HEADER)


def q_drop_blank_lines(spark, sf):
    return _body(spark, sf, 1)


def q_split_fields(spark, sf):
    return cl.split_fields(_body(spark, sf, 1), SPEC_FILE1)


def q_split_fields_trimmed(spark, sf):
    return cl.split_fields(_body(spark, sf, 2), SPEC_FILE2)


def q_filter_complete_rows(spark, sf):
    return cl.filter_complete_rows(cl.split_fields(_body(spark, sf, 1), SPEC_FILE1), SPEC_FILE1)


def q_typed_records(spark, sf):
    """Classification straight from the text (no stored intermediate)."""
    return cl.typed_records(_body(spark, sf, 1), SPEC_FILE1)


def q_cleanse_rejects(spark, sf):
    return union_all(*[_cleansed(spark, sf, v)[1].withColumn("file", F.lit(v)) for v in (1, 2)])


def q_quality_counts(spark, sf):
    out = [cl.quality_counts(_insurance_text(spark, sf, v), _spec(v), render.INSURANCE_HEADER)
           .withColumn("file", F.lit(v)) for v in (1, 2)]
    return union_all(*out)


def q_quality_counts_at_write(spark, sf):
    """The same counts from the jobs that write the classified lines."""
    rows = []
    for v in (1, 2):
        path = scratch_path(spark, "out", f"counted{v}")
        _, _, counts = cl.cleanse_counted(_insurance_text(spark, sf, v), _spec(v), render.INSURANCE_HEADER, path)
        rows.append(insurance.quality_row(spark, counts, v))
    return union_all(*rows)


def _dates(spark, sf, variant, mode):
    spec = _spec(variant)
    arr = split_keep_trailing(F.col("value"))
    raw = F.get(arr, 0), F.get(arr, 2)
    if spec.trim:
        raw = tuple(java_trim(x) for x in raw)
    return _body(spark, sf, variant).select(
        raw[0].alias("IssuerId"), raw[1].alias("raw_date"),
        normalize_date(raw[1], spec.date_format, mode).alias("norm_date"))


def q_normalize_date(spark, sf):
    return _dates(spark, sf, 2, "strict")


def q_normalize_date_lenient(spark, sf):
    return _dates(spark, sf, 1, "lenient")


def q_drop_nulls_any(spark, sf):
    return _insurance_csv(spark, sf).na.drop("any")


def q_rename_columns(spark, sf):
    return _insurance_csv(spark, sf).withColumnsRenamed({"StateCode": "stcd", "SourceName": "srcnm"})


def q_composite_key(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey",
                    composite_key("o_orderkey", "o_custkey").alias("issueridcomposite"))


def q_drop_columns(spark, sf):
    return _t(spark, sf, "lineitem").drop("l_partkey", "l_suppkey", "l_shipdate", "l_tax")


def q_audit_columns(spark, sf):
    c = with_audit_columns(_t(spark, sf, "customer").select("c_custkey", "c_name"))
    return c.select("c_custkey", "c_name",
                    (F.col("sysdt") == F.current_date()).alias("sysdt_ok"),
                    F.col("systs").isNotNull().alias("systs_ok"))


def q_split_by_date(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "value",
                                        F.to_date("ts").alias("event_date"))
    path = scratch_path(spark, "out", "events_by_date")
    write_split_by(ev, "event_date", path)
    return spark.read.parquet(path)


def q_split_by_date_again(spark, sf):
    """Splits by date of all events but those of a few types, then those dates
    of which these types have some written again with all."""
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "value",
                                        F.to_date("ts").alias("event_date"))
    path = scratch_path(spark, "out", "events_again")
    late = (F.col("event_id") % 97 == 5) & (F.day("event_date") % 2 == 0)
    days = [r[0] for r in ev.select("event_date").distinct().collect()]
    rewrite_splits(ev.where(~late), "event_date", path, days)
    rewrite_splits(ev, "event_date", path, [d for d in days if d.day % 2 == 0])
    return spark.read.parquet(path)


def q_split_by_width(spark, sf):
    lines = read_text_lines(spark, _mixed_text_path(spark, sf))
    return split_by_width(lines, {"cust": 5, "state": 2})


def _split_null(spark, sf):
    """Customers and states, split once per session into a side-partitioned
    table (the small states side is then checked and broadcast cheaply)."""
    store = _once(spark, sf, "custs_states_split",
                  lambda path: insurance.customers_and_states(_ragged(spark, sf), path))
    stored = spark.read.schema("_c0 string, _c1 string, _c2 string, _c3 string, _c4 string, "
                               "side string").parquet(store)
    return insurance.customers_and_states_from_store(stored)


def q_split_by_null(spark, sf):
    return insurance.customers_and_states(_ragged(spark, sf))[0]


def q_split_by_null_states(spark, sf):
    return insurance.customers_and_states(_ragged(spark, sf))[1]


# ---------------------------------------------------------------- the insurance flow

def _flow_inputs(spark, sf):
    custs, states = _split_null(spark, sf)
    return insurance.insure_view(_insurance_csv(spark, sf)), states, custs


def q_insure_view(spark, sf):
    v = insurance.insure_view(_insurance_csv(spark, sf))
    return v.withColumn("sysdt_ok", F.col("sysdt") == F.current_date()).drop("sysdt", "systs")


def q_insurance_enriched(spark, sf):
    """The joined view with every derived column; load date/time columns are
    reported as checks against the current date (they differ per run)."""
    v = insurance.enriched_view(*_flow_inputs(spark, sf))
    return v.select(*[c for c in insurance.ENRICHED_COLUMNS
                      if c not in ("sysdt", "systs", "curdt", "curts")],
                    (F.col("curdt") == F.col("sysdt")).alias("dates_ok"))


def q_insurance_protocol_rank(spark, sf):
    return insurance.protocol_ranking(*_flow_inputs(spark, sf))


# ---------------------------------------------------------------- relational

def q_union_all(spark, sf):
    return union_all(_typed(spark, sf, 1), _typed(spark, sf, 2))


def q_dedup_exact(spark, sf):
    return dedup_exact(q_union_all(spark, sf))


def q_dedup_counts(spark, sf):
    return dedup_counts(q_union_all(spark, sf))


def _row_store(spark, sf):
    """(database, the rows of both files in one store)."""
    db = f"rf_{uuid.uuid4().hex[:12]}"
    root = scratch_path(spark, "warehouse")
    create_database(spark, db, root + "/db")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = {str(v): _typed(spark, sf, v) for v in (1, 2)}
    return db, rowstore.write_row_store(parts, f"{db}.merged", f"{root}/merged", buckets)


def q_dedup_exact_stored(spark, sf):
    """``dedup_exact`` over rows stored by a hash of the whole row."""
    db, store = _row_store(spark, sf)
    return kept_rows(spark, rowstore.distinct_rows(store), db)


def q_dedup_counts_stored(spark, sf):
    db, store = _row_store(spark, sf)
    return kept_rows(spark, rowstore.row_counts(store), db)


def q_rows_not_in_stored(spark, sf):
    db, store = _row_store(spark, sf)
    return kept_rows(spark, rowstore.rows_not_in_part(store, "1"), db)


def q_rows_not_in(spark, sf):
    return rows_not_in(q_union_all(spark, sf), _typed(spark, sf, 1))


def q_enrich_inner_join(spark, sf):
    """Orders enriched with customer and nation (small, broadcast after a size
    check).  (Text keys of a lookup file: ``insurance_enriched``.)"""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    j = enrich_inner_join(o, [(c, o["o_custkey"] == c["c_custkey"], False),
                              (n, F.col("c_nationkey") == n["n_nationkey"], True)])
    parts = date_parts("o_orderdate")
    return j.select("o_orderkey", "o_custkey", "o_orderpriority", "n_name", "c_mktsegment",
                    "c_acctbal", parts["yr"].alias("yr"), parts["mth"].alias("mth"))


def q_group_avg_count(spark, sf):
    return segments.segment_stats(_t(spark, sf, "orders"), _t(spark, sf, "customer"),
                                  _t(spark, sf, "nation"))


def q_rank_within_protocol(spark, sf):
    return segments.rank_segments(_t(spark, sf, "orders"), _t(spark, sf, "customer"),
                                  _t(spark, sf, "nation"))


def q_number_rows_within(spark, sf):
    """Every order numbered per priority by its price, rows of a priority
    spread over tasks."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return number_within(o, ["o_orderpriority"], "o_totalprice", ["o_orderkey"])


def q_salted_enrich_join(spark, sf):
    """The rows of ``enrich_inner_join``, with hot customers and hot nations
    split by the join itself."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    c = _t(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    j = salted_join(o, c, "o_custkey", "c_custkey", ["o_orderkey"])
    j = salted_join(j, n, "c_nationkey", "n_nationkey", ["o_orderkey"], counted=c)
    parts = date_parts("o_orderdate")
    return j.select("o_orderkey", "o_custkey", "o_orderpriority", "n_name", "c_mktsegment",
                    "c_acctbal", parts["yr"].alias("yr"), parts["mth"].alias("mth"))


def q_repartition_balance(spark, sf, n: int = 8):
    """Rows dealt to ``n`` partitions, and whether these differ by no more
    than one row per task that dealt them."""
    lines = _t(spark, sf, "lineitem")
    sources = lines.select(F.spark_partition_id().alias("p")).distinct().count()
    s = balance_summary(lines, n)
    return s.select("num_partitions", "total_rows",
                    (F.col("max_rows") - F.col("min_rows") <= sources).alias("balanced"))


# ---------------------------------------------------------------- scalar functions

def q_clean_special_chars(spark, sf):
    p = _pages_urls(spark, sf)
    return p.select("page_id", "url", clean_special_chars("url").alias("cleanurl"))


def q_url_protocol(spark, sf):
    p = _pages_urls(spark, sf)
    return p.select("page_id", "url", url_protocol("url").alias("Protocol"))


def q_url_scheme(spark, sf):
    p = _pages_urls(spark, sf)
    return p.select("page_id", "url", url_scheme("url").alias("Protocol"))


def q_sql_registered_udf(spark, sf):
    register_sql_functions(spark)
    return spark.sql("SELECT page_id, remspecialcharudf(url) AS cleanurl, "
                     "url_protocol(url) AS Protocol FROM {p}", p=_pages_urls(spark, sf))


def q_date_parts(spark, sf):
    o = _t(spark, sf, "orders")
    parts = date_parts("o_orderdate")
    return o.select("o_orderkey", parts["yr"].alias("yr"), parts["mth"].alias("mth"))


# ---------------------------------------------------------------- chat (batch)

def _chat_messages(spark, sf):
    return chat.parse_messages(render.chat_lines(_t(spark, sf, "conversations")))


def q_parse_delimited_message(spark, sf):
    return _chat_messages(spark, sf)


def q_filter_by_role(spark, sf):
    return chat.filter_by_role(_chat_messages(spark, sf), "c")


def q_tokenize(spark, sf):
    return _chat_tokens(spark, sf)


def q_antijoin_not_in(spark, sf):
    return antijoin_not_in(_chat_tokens(spark, sf), "word", _stop_file(spark, sf), "stopword")


def q_antijoin_left_anti(spark, sf):
    return antijoin_left_anti(_chat_tokens(spark, sf), "word", _stop(spark), "stopword")


def q_antijoin_outer_null(spark, sf):
    return antijoin_outer_null(_chat_tokens(spark, sf), "word", _stop(spark), "stopword")


def _said_words(spark, sf) -> DataFrame:
    """A list that grows with the data, loaded from a file: the plain words of
    the assistants' turns."""
    def lines():
        said = chat.conversation_tokens(_t(spark, sf, "conversations"), "assistant")
        return said.where(F.col("word").rlike("^[A-Za-z]+$")).select(F.col("word").alias("value"))
    return read_lookup_list(spark, _rendered(spark, sf, "said_words", lines))


def q_antijoin_long_list(spark, sf):
    """Customer words that no assistant says: the list is taken as too long to be
    broadcast, so a filter of it decides which words are shuffled at all."""
    return antijoin_left_anti(_chat_tokens(spark, sf), "word", _said_words(spark, sf), "stopword",
                              max_broadcast_rows=0)


def q_keyword_count(spark, sf):
    return chat.keywords(_chat_tokens(spark, sf), _stop(spark))


def q_keyword_top(spark, sf, k: int = 20):
    """The ``k`` most recurring customer keywords (a top-k report)."""
    return top_keywords(q_keyword_count(spark, sf), k)


# ---------------------------------------------------------------- forms that differ on nulls and on lenient dates

def _nullable_words(spark, sf) -> DataFrame:
    """Customer tokens in which every empty one is null."""
    return _chat_tokens(spark, sf).withColumn("word", F.nullif("word", F.lit("")))


def _nullable_stop(spark, sf) -> DataFrame:
    return _stop_file(spark, sf).union(spark.range(1).select(F.lit(None).cast("string")))


def q_antijoin_not_in_nulls(spark, sf):
    """A null word is dropped; the list has no null."""
    return antijoin_not_in(_nullable_words(spark, sf), "word", _stop_file(spark, sf), "stopword")


def q_antijoin_not_in_null_list(spark, sf):
    """A null in the list leaves nothing: the number of rows, which is 0."""
    kept = antijoin_not_in(_nullable_words(spark, sf), "word", _nullable_stop(spark, sf), "stopword")
    return kept.agg(F.count(F.lit(1)).alias("rows_left"))


def q_antijoin_left_anti_nulls(spark, sf):
    """A null in the list is ignored, a null word is dropped."""
    return antijoin_left_anti(_nullable_words(spark, sf), "word", _nullable_stop(spark, sf), "stopword")


def q_antijoin_outer_null_nulls(spark, sf):
    """A null in the list is ignored, a null word is kept."""
    return antijoin_outer_null(_nullable_words(spark, sf), "word", _nullable_stop(spark, sf), "stopword")


def q_typed_records_lenient(spark, sf):
    """File 1 with dates that roll over instead of being rejected."""
    return cl.typed_records(_body(spark, sf, 1), replace(SPEC_FILE1, date_mode="lenient"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}
