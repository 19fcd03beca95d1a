"""DuckDB SQL stating, independently of the Spark code, what each registered
job must return (tables are views named like the parquet files).

The raw text layouts are restated here from their rules (see
``rowforge.plans.render``); parsing results are stated from what each line
kind must yield.
"""

from __future__ import annotations

from rowforge.plans.chat import DEFAULT_STOP_WORDS
from rowforge.plans.render import INSURANCE_FIELDS, INSURANCE_HEADER

H = INSURANCE_HEADER
JT = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def jt(x: str) -> str:
    return JT.format(x=x)


def _ins(v: int) -> str:
    """CTEs ins{v}_f (one row per order with its fields) and ins{v} (lines)."""
    y = "CAST(year(d) AS VARCHAR)"
    m = "lpad(CAST(month(d) AS VARCHAR), 2, '0')"
    dd = "lpad(CAST(day(d) AS VARCHAR), 2, '0')"
    good, bad = ((f"{y} || '-' || {m} || '-' || {dd}", f"{y} || '-13-' || {dd}") if v == 1
                 else (f"{dd} || '-' || {m} || '-' || {y}", f"{dd} || '-13-' || {y}"))
    pad = (lambda f: f) if v == 1 else (lambda f: f"CASE WHEN k % 7 = 1 THEN ' ' || {f} || chr(9) ELSE {f} END")
    fl = ", ".join(f"{pad('f' + str(i))} AS f{i}" for i in range(1, 11))
    return f"""
ins{v}_k AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus AS st, o_orderpriority AS pr,
         CAST(o_orderdate AS DATE) AS d,
         CASE WHEN o_orderkey % 101 = {7 * v} THEN 'header'
              WHEN o_orderkey % 53 = {5 * v} THEN 'blank'
              WHEN o_orderkey % 47 = {3 * v} THEN 'short'
              WHEN o_orderkey % 23 = {4 * v} THEN 'missing'
              WHEN o_orderkey % 29 = {6 * v} THEN 'badint'
              WHEN o_orderkey % 31 = {8 * v} THEN 'baddate'
              ELSE 'ok' END AS kind
  FROM orders),
ins{v}_raw AS (
  SELECT k, ck, d, kind,
    CAST(k AS VARCHAR) AS f1,
    CASE WHEN kind = 'badint' THEN 'N' || CAST(ck AS VARCHAR) ELSE CAST(ck AS VARCHAR) END AS f2,
    CASE WHEN kind = 'baddate' THEN {bad} ELSE {good} END AS f3,
    CASE WHEN kind = 'missing' THEN '  ' ELSE CAST(ck % 25 AS VARCHAR) END AS f4,
    pr AS f5,
    'Plan-' || st || '/' || CAST(ck % 10 AS VARCHAR) || '_(' || pr || ')' AS f6,
    CASE WHEN k % 3 = 0 THEN 'http://www' || CAST(ck AS VARCHAR) || '.example.com/'
         WHEN k % 3 = 1 THEN 'https://net' || CAST(ck AS VARCHAR) || '.example.org/'
         ELSE 'www.net' || CAST(ck AS VARCHAR) || '.example.net' END AS f7,
    CAST(ck AS VARCHAR) AS f8,
    CASE WHEN k % 5 = 0 THEN '' WHEN k % 2 = 0 THEN 'Individual' ELSE 'SHOP (Small Group)' END AS f9,
    CASE WHEN k % 4 = 0 THEN '' WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS f10
  FROM ins{v}_k),
ins{v}_f AS (SELECT k, ck, d, kind, {fl} FROM ins{v}_raw),
ins{v} AS (
  SELECT CAST(-1 AS BIGINT) AS line_no, '{H}' AS value
  UNION ALL
  SELECT k, CASE kind WHEN 'header' THEN '{H}'
                      WHEN 'blank' THEN ' ' || chr(9) || ' '
                      WHEN 'short' THEN concat_ws(',', f1, f2, f3, f4, f5, f6)
                      ELSE concat_ws(',', f1, f2, f3, f4, f5, f6, f7, f8, f9, f10) END
  FROM ins{v}_f)"""


NAMES = INSURANCE_FIELDS


def _parsed(v: int) -> str:
    """CTEs split{v} (all lines, string fields) and cls{v} (typed + reason)."""
    t = (lambda x: x) if v == 1 else jt
    fmt = "%Y-%m-%d" if v == 1 else "%d-%m-%Y"
    fields = ", ".join(f"{t(f'arr[{i + 1}]')} AS {n}" for i, n in enumerate(NAMES))
    blank_any = " OR ".join(f"{jt(f'coalesce({n}, {chr(39)}{chr(39)})')} = ''" for n in NAMES[:8])

    def sint(c):
        return f"CASE WHEN regexp_full_match({c}, '[+-]?[0-9]+') THEN TRY_CAST({c} AS INTEGER) END"

    return f"""{_ins(v)},
split{v} AS (
  SELECT value, CAST(len(arr) AS INTEGER) AS n_fields, {fields}
  FROM (SELECT value, string_split(value, ',') AS arr FROM ins{v})),
typ{v} AS (
  SELECT *, {sint('IssuerId')} AS i1, {sint('IssuerId2')} AS i2, {sint('custnum')} AS i8,
         strftime(try_strptime(BusinessDate, '{fmt}'), '%Y-%m-%d') AS dnorm,
         ({blank_any}) AS has_blank
  FROM split{v}),
cls{v} AS (
  SELECT *, CASE WHEN n_fields < 10 THEN 'too_few_fields'
                 WHEN has_blank THEN 'missing_required'
                 WHEN i1 IS NULL OR i2 IS NULL OR i8 IS NULL THEN 'bad_int'
                 WHEN dnorm IS NULL THEN 'bad_date' END AS reject_reason,
            value = '{H}' AS is_header,
            value <> '{H}' AND {jt('value')} = '' AS is_blank
  FROM typ{v}),
body{v} AS (SELECT * FROM cls{v} WHERE NOT is_header AND NOT is_blank),
kept{v} AS (
  SELECT i1 AS IssuerId, i2 AS IssuerId2, dnorm AS BusinessDate, StateCode, SourceName,
         NetworkName, NetworkURL, i8 AS custnum, MarketCoverage, DentalOnlyPlan
  FROM body{v} WHERE reject_reason IS NULL)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip().rstrip(",") for p in parts)


FIELD_COLS = ", ".join(NAMES)
O: dict[str, str] = {}

# ------------------------------------------------------------------ line cleansing
O["read_text_lines"] = _with(_ins(1)) + "\nSELECT value FROM ins1"
O["drop_header"] = _with(_ins(1)) + f"\nSELECT value FROM ins1 WHERE value <> '{H}'"
O["drop_blank_lines"] = _with(_parsed(1)) + "\nSELECT value FROM body1"
O["split_fields"] = _with(_parsed(1)) + f"\nSELECT {FIELD_COLS}, n_fields FROM body1"
O["split_fields_trimmed"] = _with(_parsed(2)) + f"\nSELECT {FIELD_COLS}, n_fields FROM body2"
O["filter_complete_rows"] = (_with(_parsed(1)) +
                             f"\nSELECT {FIELD_COLS}, n_fields FROM body1 WHERE n_fields >= 10 AND NOT has_blank")
O["typed_records"] = _with(_parsed(1)) + "\nSELECT * FROM kept1"
O["typed_records_lenient"] = _with(_parsed(1)) + r"""
SELECT i1 AS IssuerId, i2 AS IssuerId2,
       strftime(CAST(make_date(y, 1, 1) + to_months(m - 1) + to_days(d - 1) AS DATE), '%Y-%m-%d') AS BusinessDate,
       StateCode, SourceName, NetworkName, NetworkURL, i8 AS custnum, MarketCoverage, DentalOnlyPlan
FROM (SELECT *, CAST(regexp_extract(BusinessDate, '^([0-9]+)-([0-9]+)-([0-9]+)', 1) AS INTEGER) AS y,
             CAST(regexp_extract(BusinessDate, '^([0-9]+)-([0-9]+)-([0-9]+)', 2) AS INTEGER) AS m,
             CAST(regexp_extract(BusinessDate, '^([0-9]+)-([0-9]+)-([0-9]+)', 3) AS INTEGER) AS d
      FROM body1 WHERE reject_reason IS NULL OR reject_reason = 'bad_date')"""
O["cleanse_rejects"] = _with(_parsed(1), _parsed(2)) + """
SELECT value, reject_reason, 1 AS file FROM body1 WHERE reject_reason IS NOT NULL
UNION ALL
SELECT value, reject_reason, 2 AS file FROM body2 WHERE reject_reason IS NOT NULL"""


def _qc(v):
    return f"""SELECT count(*) AS raw_lines, count_if(is_header) AS header_lines,
       count_if(is_blank) AS blank_lines,
       count_if(NOT is_header AND NOT is_blank AND reject_reason = 'too_few_fields') AS too_few_fields,
       count_if(NOT is_header AND NOT is_blank AND reject_reason = 'missing_required') AS missing_required,
       count_if(NOT is_header AND NOT is_blank AND reject_reason = 'bad_int') AS bad_int,
       count_if(NOT is_header AND NOT is_blank AND reject_reason = 'bad_date') AS bad_date,
       count_if(NOT is_header AND NOT is_blank AND reject_reason IS NULL) AS kept,
       {v} AS file
FROM cls{v}"""


O["quality_counts"] = _with(_parsed(1), _parsed(2)) + f"\n{_qc(1)}\nUNION ALL\n{_qc(2)}"

O["quality_counts_at_write"] = O["quality_counts"]

O["normalize_date"] = _with(_parsed(2)) + """
SELECT IssuerId, BusinessDate AS raw_date, dnorm AS norm_date FROM body2"""

O["normalize_date_lenient"] = _with(_parsed(1)) + r"""
SELECT IssuerId, raw_date,
       strftime(CAST(make_date(y, 1, 1) + to_months(m - 1) + to_days(d - 1) AS DATE), '%Y-%m-%d') AS norm_date
FROM (SELECT IssuerId, BusinessDate AS raw_date,
             TRY_CAST(nullif(regexp_extract(BusinessDate, '^([0-9]+)-([0-9]+)-([0-9]+)', 1), '') AS INTEGER) AS y,
             TRY_CAST(nullif(regexp_extract(BusinessDate, '^([0-9]+)-([0-9]+)-([0-9]+)', 2), '') AS INTEGER) AS m,
             TRY_CAST(nullif(regexp_extract(BusinessDate, '^([0-9]+)-([0-9]+)-([0-9]+)', 3), '') AS INTEGER) AS d
      FROM body1)"""

O["union_all"] = _with(_parsed(1), _parsed(2)) + "\nSELECT * FROM kept1 UNION ALL SELECT * FROM kept2"
O["dedup_exact"] = _with(_parsed(1), _parsed(2)) + "\nSELECT DISTINCT * FROM (SELECT * FROM kept1 UNION ALL SELECT * FROM kept2)"
O["dedup_counts"] = _with(_parsed(1), _parsed(2), "u AS (SELECT * FROM kept1 UNION ALL SELECT * FROM kept2)") + """
SELECT (SELECT count(*) FROM u) AS total_count,
       (SELECT count(*) FROM (SELECT DISTINCT * FROM u)) AS distinct_count,
       (SELECT count(*) FROM u) - (SELECT count(*) FROM (SELECT DISTINCT * FROM u)) AS duplicate_count"""
O["rows_not_in"] = _with(_parsed(1), _parsed(2), "u AS (SELECT * FROM kept1 UNION ALL SELECT * FROM kept2)") + "\n" + \
    "SELECT * FROM u WHERE NOT EXISTS (SELECT 1 FROM kept1 b WHERE " + \
    " AND ".join(f"u.{n} IS NOT DISTINCT FROM b.{n}" for n in NAMES) + ")"

O |= {f"{k}_stored": O[k] for k in ("dedup_exact", "dedup_counts", "rows_not_in")}

# ------------------------------------------------------------------ CSV path
_CSV = _with(_ins(1)) + """
SELECT CAST(k AS INTEGER) AS IssuerId, CAST(ck AS INTEGER) AS IssuerId2, d AS BusinessDate,
       f4 AS StateCode, f5 AS SourceName,
       CASE WHEN k % 13 = 0 THEN f6 || ', east' ELSE f6 END AS NetworkName, f7 AS NetworkURL,
       CAST(ck AS INTEGER) AS custnum, nullif(f9, '') AS MarketCoverage, nullif(f10, '') AS DentalOnlyPlan
FROM ins1_f WHERE kind IN ('ok', 'missing') AND k % 37 <> 1"""
O["csv_schema_dropmalformed"] = _CSV
O["csv_kept_of_permissive"] = _CSV
O["csv_rejects"] = _with(_ins(1)) + f"""
SELECT CASE kind WHEN 'header' THEN '{H}' WHEN 'short' THEN concat_ws(',', f1, f2, f3, f4, f5, q6)
         ELSE concat_ws(',', f1, f2, f3, f4, f5, q6, f7, f8, f9, f10) END AS line,
       CASE WHEN kind = 'header' THEN 'bad_IssuerId,bad_IssuerId2,bad_BusinessDate,bad_custnum'
            WHEN kind = 'short' OR k % 37 = 1 THEN 'too_few_columns'
            WHEN kind = 'badint' THEN 'bad_IssuerId2' ELSE 'bad_BusinessDate' END AS cause
FROM (SELECT *, CASE WHEN k % 37 = 1 THEN '"' || f6 || ',"' WHEN k % 13 = 0 THEN '"' || f6 || ', east"' ELSE f6 END AS q6
      FROM ins1_f)
WHERE kind IN ('header', 'short', 'badint', 'baddate') OR kind IN ('ok', 'missing') AND k % 37 = 1"""
O["drop_nulls_any"] = f"SELECT * FROM ({_CSV}) WHERE MarketCoverage IS NOT NULL AND DentalOnlyPlan IS NOT NULL"
O["rename_columns"] = f"""SELECT IssuerId, IssuerId2, BusinessDate, StateCode AS stcd, SourceName AS srcnm,
       NetworkName, NetworkURL, custnum, MarketCoverage, DentalOnlyPlan FROM ({_CSV})"""

# ------------------------------------------------------------------ mixed customer/state layout
_CS = """cs AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c0, c_name AS c1,
         CASE WHEN c_custkey % 17 = 3 THEN '' ELSE 'L' || CAST(c_nationkey AS VARCHAR) END AS c2,
         CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 80 + 18 AS VARCHAR) AS c3,
         CASE WHEN c_custkey % 19 = 5 THEN '' ELSE c_mktsegment END AS c4
  FROM customer),
st AS (SELECT CAST(n_nationkey AS VARCHAR) AS c0, n_name AS c1 FROM nation)"""
O["csv_strings_ragged"] = _with(_CS) + """
SELECT c0 AS _c0, c1 AS _c1, nullif(c2, '') AS _c2, c3 AS _c3, nullif(c4, '') AS _c4 FROM cs
UNION ALL SELECT c0, c1, NULL, NULL, NULL FROM st"""
O["split_by_width"] = _with(_CS) + """
SELECT 'cust' AS side, concat_ws(',', c0, c1, c2, c3, c4) AS value FROM cs WHERE c4 <> ''
UNION ALL SELECT 'state', c0 || ',' || c1 FROM st"""
O["split_by_null"] = _with(_CS) + """
SELECT c0 AS Id, c1 AS FirstName, c2 AS LastName, c3 AS Age, nullif(c4, '') AS Profession
FROM cs WHERE c2 <> ''"""
O["split_by_null_states"] = _with(_CS) + """
SELECT c0 AS State_cd, c1 AS State_desc FROM cs WHERE c2 = ''
UNION ALL SELECT c0, c1 FROM st"""
O["lookup_list"] = "SELECT DISTINCT c_mktsegment AS item FROM customer WHERE c_custkey % 11 <> 0"

# ------------------------------------------------------------------ tables and sinks
_CUST = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
_CUST_NULLS = """SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer"""
O["sql_view_select"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
O["external_table_scan"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
O["external_table_append"] = f"{_CUST} UNION ALL {_CUST}"
O["append_once"] = f"{_CUST} UNION ALL {_CUST}"
O["managed_table_overwrite"] = "SELECT c_custkey, c_name, c_mktsegment FROM customer"
O["sink_text"] = """SELECT concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR),
                 CAST(c_acctbal AS VARCHAR), c_mktsegment) AS value FROM customer"""
O["sink_csv_overwrite"] = _CUST_NULLS
O["sink_json_overwrite"] = _CUST_NULLS
O["sink_csv_tilde_header"] = _CUST_NULLS

# ------------------------------------------------------------------ projections
O["composite_key"] = """SELECT o_orderkey, o_custkey,
       CAST(o_orderkey AS VARCHAR) || CAST(o_custkey AS VARCHAR) AS issueridcomposite FROM orders"""
O["drop_columns"] = """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
       l_returnflag, l_linestatus FROM lineitem"""
O["audit_columns"] = "SELECT c_custkey, c_name, true AS sysdt_ok, true AS systs_ok FROM customer"
O["split_by_date"] = "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_date FROM events"
O["split_by_date_again"] = O["split_by_date"]
O["date_parts"] = """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr,
       CAST(month(o_orderdate) AS INTEGER) AS mth FROM orders"""
O["repartition_balance"] = ("SELECT CAST(8 AS BIGINT) AS num_partitions, count(*) AS total_rows, "
                            "true AS balanced FROM lineitem")

# ------------------------------------------------------------------ joins, groups, ranks
O["enrich_inner_join"] = """
SELECT o_orderkey, o_custkey, o_orderpriority, n_name, c_mktsegment, c_acctbal,
       CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mth
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
O["sink_parquet"] = O["enrich_inner_join"]
O["group_avg_count"] = """
SELECT n_name, o_orderpriority, c_mktsegment,
       CAST(sum(CAST(c_acctbal AS DECIMAL(26,8))) AS DOUBLE) / count(c_acctbal) AS avg_acctbal,
       count(*) AS total
FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name, o_orderpriority, c_mktsegment"""
O["rank_within_protocol"] = f"""
SELECT CAST(row_number() OVER (PARTITION BY o_orderpriority
                               ORDER BY total DESC, n_name NULLS LAST, c_mktsegment NULLS LAST) AS INTEGER) AS seq_number,
       avg_acctbal, total, n_name, o_orderpriority, c_mktsegment
FROM ({O["group_avg_count"]}) g"""

O["sink_parquet_single"] = O["rank_within_protocol"]
O["number_rows_within"] = """
SELECT o_orderkey, o_orderpriority, o_totalprice,
       row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey NULLS LAST) AS seq_number
FROM orders"""
O["salted_enrich_join"] = O["enrich_inner_join"]

# ------------------------------------------------------------------ URL and text functions
_URLS = """u AS (SELECT page_id, CASE WHEN page_id % 5 = 0 THEN regexp_replace(url, '^https?://', '')
                               WHEN page_id % 7 = 3 THEN upper(url) ELSE url END AS url FROM pages)"""
_CLEAN = "regexp_replace(" + jt("url") + r", '[0-9\-?,/_()\[\]]', ' ', 'g')"
_PROTO = "CASE WHEN instr(url, 'http') > 0 THEN 'http' ELSE 'noprotocol' END"
O["clean_special_chars"] = _with(_URLS) + f"\nSELECT page_id, url, {_CLEAN} AS cleanurl FROM u"
O["url_protocol"] = _with(_URLS) + f"\nSELECT page_id, url, {_PROTO} AS Protocol FROM u"
O["url_scheme"] = _with(_URLS) + """
SELECT page_id, url, coalesce(nullif(regexp_extract(lower(url), '^(https?)://', 1), ''), 'noprotocol') AS Protocol FROM u"""
O["sql_registered_udf"] = _with(_URLS) + f"\nSELECT page_id, {_CLEAN} AS cleanurl, {_PROTO} AS Protocol FROM u"

# ------------------------------------------------------------------ chat
STOP = "(VALUES " + ", ".join("('" + w.replace("'", "''") + "')" for w in DEFAULT_STOP_WORDS) + ") AS s(stopword)"
_MSG = r"""msg AS (
  SELECT CAST(conv_id AS VARCHAR) AS id, regexp_replace(text, '[\r\n~]', ' ', 'g') AS chat,
         CASE WHEN role = 'user' THEN 'c' ELSE 'a' END AS type
  FROM conversations)"""
_TOK = "tok AS (SELECT conv_id AS id, unnest(string_split(text, ' ')) AS word FROM conversations WHERE role = 'user')"
_MTOK = "mtok AS (SELECT id, unnest(string_split(chat, ' ')) AS word FROM msg WHERE type = 'c')"
O["parse_delimited_message"] = _with(_MSG) + "\nSELECT id, chat, type FROM msg"
O["filter_by_role"] = _with(_MSG) + "\nSELECT id, chat FROM msg WHERE type = 'c'"
O["tokenize"] = _with(_TOK) + "\nSELECT id, word FROM tok"
_NOSTOP = _with(_TOK) + f"\nSELECT id, word FROM tok WHERE word NOT IN (SELECT stopword FROM {STOP})"
O["antijoin_not_in"] = _NOSTOP
O["antijoin_left_anti"] = _NOSTOP
O["antijoin_outer_null"] = _NOSTOP
O["antijoin_long_list"] = _with(_TOK) + """
SELECT id, word FROM tok WHERE word NOT IN (
  SELECT said FROM (SELECT unnest(string_split(text, ' ')) AS said FROM conversations WHERE role = 'assistant')
  WHERE regexp_full_match(said, '[A-Za-z]+'))"""
_NULLABLE = f"""SELECT id, nullif(word, '') AS word FROM tok
WHERE nullif(word, '') IS NULL OR word NOT IN (SELECT stopword FROM {STOP})"""
O["antijoin_not_in_nulls"] = _with(_TOK) + f"\nSELECT * FROM ({_NULLABLE}) WHERE word IS NOT NULL"
O["antijoin_not_in_null_list"] = _with(_TOK) + f"""
SELECT count(*) AS rows_left FROM tok
WHERE nullif(word, '') NOT IN (SELECT stopword FROM {STOP} UNION ALL SELECT NULL)"""
O["antijoin_left_anti_nulls"] = O["antijoin_not_in_nulls"]
O["antijoin_outer_null_nulls"] = _with(_TOK) + "\n" + _NULLABLE
O["keyword_count"] = _with(_TOK) + f"""
SELECT word AS chatkeywords, count(*) AS occurances FROM tok
WHERE word NOT IN (SELECT stopword FROM {STOP}) GROUP BY word"""

O["keyword_top"] = f"""SELECT * FROM ({O["keyword_count"]}) k
ORDER BY occurances DESC, chatkeywords ASC NULLS LAST LIMIT 20"""

# ------------------------------------------------------------------ streaming (same answers as batch)
O["stream_file_source"] = O["parse_delimited_message"]
O["stream_tokens"] = _with(_MSG, _MTOK) + "\nSELECT id, word FROM mtok"
O["stream_append"] = _with(_MSG, _MTOK) + f"\nSELECT id, word FROM mtok WHERE word NOT IN (SELECT stopword FROM {STOP})"
O["stream_result_read"] = O["stream_append"]
O["stream_complete"] = _with(_MSG, _MTOK) + f"""
SELECT word AS chatkeywords, count(*) AS occurances FROM mtok
WHERE word NOT IN (SELECT stopword FROM {STOP}) GROUP BY word"""
O["stream_update"] = O["stream_complete"]
O["stream_one_pass"] = f"SELECT *, occurances AS words_written FROM ({O['stream_complete']}) k"
_HALF = "(VALUES " + ", ".join("('" + w.replace("'", "''") + "')" for w in DEFAULT_STOP_WORDS[::2]) + ") AS s(stopword)"
O["stream_changing_list"] = _with(_MSG, _MTOK) + f"""
SELECT id, word FROM mtok WHERE CASE WHEN CAST(id AS BIGINT) % 2 = 0
  THEN word NOT IN (SELECT stopword FROM {_HALF}) ELSE word NOT IN (SELECT stopword FROM {STOP}) END"""
O["stream_to_parquet"] = _NOSTOP
O["stream_agg_to_json"] = O["keyword_count"]

# ------------------------------------------------------------------ the insurance flow
_CSVROWS = "csvrows AS (" + _CSV[_CSV.index("\nSELECT") + 1:] + ")"
_STATES = "states AS (SELECT c0 AS State_cd, c1 AS State_desc FROM cs WHERE c2 = '' UNION ALL SELECT c0, c1 FROM st)"
_CUSTS = "custs AS (SELECT TRY_CAST(c0 AS INTEGER) AS cust_id, c3 AS Age, nullif(c4, '') AS Profession FROM cs WHERE c2 <> '')"
_COMB = "comb AS (SELECT r.*, s.State_desc, k.Age, k.Profession FROM csvrows r " \
        "JOIN states s ON r.StateCode = s.State_cd JOIN custs k ON r.custnum = k.cust_id)"
O["insure_view"] = f"""SELECT IssuerId, IssuerId2, BusinessDate, StateCode AS stcd, SourceName AS srcnm,
       NetworkName, NetworkURL, custnum, MarketCoverage,
       CAST(IssuerId AS VARCHAR) || CAST(IssuerId2 AS VARCHAR) AS issueridcomposite,
       true AS sysdt_ok FROM ({_CSV})"""
O["insurance_enriched"] = _with(_ins(1), _CS, _CSVROWS, _STATES, _CUSTS, _COMB) + f"""
SELECT IssuerId, IssuerId2, BusinessDate, State_desc, SourceName AS srcnm, NetworkName, NetworkURL,
       custnum, MarketCoverage, CAST(IssuerId AS VARCHAR) || CAST(IssuerId2 AS VARCHAR) AS issueridcomposite,
       regexp_replace({jt("NetworkName")}, '[0-9\\-?,/_()\\[\\]]', ' ', 'g') AS cleannetworkname,
       CAST(year(BusinessDate) AS INTEGER) AS yr, CAST(month(BusinessDate) AS INTEGER) AS mth,
       CASE WHEN instr(NetworkURL, 'http') > 0 THEN 'http' ELSE 'noprotocol' END AS Protocol,
       Profession, Age, true AS dates_ok
FROM comb"""
O["insurance_protocol_rank"] = _with(_ins(1), _CS, _CSVROWS, _STATES, _CUSTS, _COMB) + """
SELECT CAST(row_number() OVER (PARTITION BY Protocol ORDER BY total DESC, State_desc NULLS LAST, Profession NULLS LAST) AS INTEGER) AS seq_number,
       avg_age, total, State_desc, Protocol, Profession
FROM (SELECT State_desc, CASE WHEN instr(NetworkURL, 'http') > 0 THEN 'http' ELSE 'noprotocol' END AS Protocol,
             Profession, CAST(sum(TRY_CAST(Age AS DECIMAL(26,8))) AS DOUBLE) / count(TRY_CAST(Age AS DOUBLE)) AS avg_age,
             count(*) AS total
      FROM comb GROUP BY 1, 2, 3)"""

ORACLE_SQL = O
