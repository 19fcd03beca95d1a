"""Raw layouts derived from the warehouse tables.

The cleansing operators work on dirty delimited text.  These functions let
Spark render such text from the given tables -- one line per source row, with
dirt injected by fixed rules on the row key -- so every job's work grows with
the tables.  The SQL in ``rowforge.plans.oracle`` states the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The header line of the insurance layout.
INSURANCE_HEADER = ("IssuerId,IssuerId2,BusinessDate,StateCode,SourceName,"
                    "NetworkName,NetworkURL,custnum,MarketCoverage,DentalOnlyPlan")
INSURANCE_FIELDS = tuple(INSURANCE_HEADER.split(","))

# Dirt rules in precedence order; a line of file v gets the
# kind when  o_orderkey % modulus == residue * v.
DIRT_RULES = (
    ("header", 101, 7),
    ("blank", 53, 5),
    ("short", 47, 3),
    ("missing", 23, 4),
    ("badint", 29, 6),
    ("baddate", 31, 8),
)
BLANK_LINE = " \t "


def _s(c):
    return c.cast("string")


def line_kind(k, variant: int):
    expr = None
    for name, m, r in DIRT_RULES:
        cond = (k % m) == r * variant
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("ok"))


def insurance_lines(orders: DataFrame, variant: int, with_header: bool = True,
                    quoted: bool = False) -> DataFrame:
    """Orders as insurance-plan lines (columns ``line_no``, ``value``).

    quoted (for CSV readers): every 13th key's network name is a quoted one
    with a comma inside; every 37th's (after key 1) ends in a comma, which a
    reader with the escape character ``,`` takes as an unclosed quote.

    variant 1: dates ``yyyy-MM-dd``; variant 2: ``dd-MM-yyyy`` and every 7th
    key's fields padded with blank/tab (the trimmed path).
    """
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    d = F.to_date("o_orderdate")
    yyyy, mm, dd = _s(F.year(d)), F.lpad(_s(F.month(d)), 2, "0"), F.lpad(_s(F.dayofmonth(d)), 2, "0")
    if variant == 1:
        good, bad = F.concat_ws("-", yyyy, mm, dd), F.concat_ws("-", yyyy, F.lit("13"), dd)
    else:
        good, bad = F.concat_ws("-", dd, mm, yyyy), F.concat_ws("-", dd, F.lit("13"), yyyy)
    kind = F.col("kind")
    f = [
        _s(k),
        F.when(kind == "badint", F.concat(F.lit("N"), _s(ck))).otherwise(_s(ck)),
        F.when(kind == "baddate", bad).otherwise(good),
        F.when(kind == "missing", F.lit("  ")).otherwise(_s(ck % 25)),
        pr,
        F.concat(F.lit("Plan-"), st, F.lit("/"), _s(ck % 10), F.lit("_("), pr, F.lit(")")),
        F.when(k % 3 == 0, F.concat(F.lit("http://www"), _s(ck), F.lit(".example.com/")))
         .when(k % 3 == 1, F.concat(F.lit("https://net"), _s(ck), F.lit(".example.org/")))
         .otherwise(F.concat(F.lit("www.net"), _s(ck), F.lit(".example.net"))),
        _s(ck),
        F.when(k % 5 == 0, F.lit("")).when(k % 2 == 0, F.lit("Individual"))
         .otherwise(F.lit("SHOP (Small Group)")),
        F.when(k % 4 == 0, F.lit("")).when(k % 3 == 0, F.lit("Yes")).otherwise(F.lit("No")),
    ]
    if quoted:
        f[5] = (F.when(k % 37 == 1, F.concat(F.lit('"'), f[5], F.lit(',"')))
                 .when(k % 13 == 0, F.concat(F.lit('"'), f[5], F.lit(', east"'))).otherwise(f[5]))
    if variant == 2:
        f = [F.when(k % 7 == 1, F.concat(F.lit(" "), x, F.lit("\t"))).otherwise(x) for x in f]
    line = (F.when(kind == "header", F.lit(INSURANCE_HEADER))
             .when(kind == "blank", F.lit(BLANK_LINE))
             .when(kind == "short", F.concat_ws(",", *f[:6]))
             .otherwise(F.concat_ws(",", *f)))
    body = (orders.select(k, ck, st, pr, "o_orderdate")
                  .withColumn("kind", line_kind(k, variant))
                  .select(k.alias("line_no"), line.alias("value")))
    if not with_header:
        return body
    top = orders.sparkSession.range(1).select(F.lit(-1).cast("bigint").alias("line_no"),
                                             F.lit(INSURANCE_HEADER).alias("value"))
    return top.unionByName(body)


def chat_lines(conversations: DataFrame) -> DataFrame:
    """Conversation turns as ``id~text~type`` lines; type ``c`` for the
    customer (role user) and ``a`` otherwise; CR, LF and ``~`` in the text
    become blanks."""
    text = F.regexp_replace(F.col("text"), "[\r\n~]", " ")
    typ = F.when(F.col("role") == "user", F.lit("c")).otherwise(F.lit("a"))
    return conversations.select(F.concat_ws("~", _s(F.col("conv_id")), text, typ).alias("value"))


def customer_state_lines(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """One mixed layout: customers as 5 fields, states (nations) as 2.

    Some customers have an empty last name (3rd field) or an empty
    profession (5th, a trailing empty field)."""
    ck = F.col("c_custkey")
    last = F.when(ck % 17 == 3, F.lit("")).otherwise(F.concat(F.lit("L"), _s(F.col("c_nationkey"))))
    age = _s(F.floor(F.abs(F.col("c_acctbal"))).cast("bigint") % 80 + 18)
    prof = F.when(ck % 19 == 5, F.lit("")).otherwise(F.col("c_mktsegment"))
    cust = customer.select(F.concat_ws(",", _s(ck), F.col("c_name"), last, age, prof).alias("value"))
    states = nation.select(F.concat_ws(",", _s(F.col("n_nationkey")), F.col("n_name")).alias("value"))
    return cust.unionByName(states)


def segment_list_lines(customer: DataFrame) -> DataFrame:
    """A one-column list (market segments, one per customer) with padding,
    blank lines and CRLF endings."""
    ck = F.col("c_custkey")
    v = (F.when(ck % 11 == 0, F.lit(""))
          .when(ck % 7 == 0, F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
          .otherwise(F.col("c_mktsegment")))
    return customer.select(F.concat(v, F.lit("\r")).alias("value"))


def stop_word_lines(words: DataFrame) -> DataFrame:
    """A one-column list with padding and CRLF endings."""
    w = F.col(words.columns[0])
    return words.select(F.concat(F.when(F.length(w) == 2, F.concat(F.lit(" "), w, F.lit(" "))).otherwise(w),
                                 F.lit("\r")).alias("value"))


def write_lines(lines: DataFrame, path: str, header_per_file: str | None = None) -> str:
    """Write the ``value`` column as text files.

    ``header_per_file`` puts that line first in every output file, the
    layout a header-aware CSV reader expects (it skips each file's first
    line).  The lines go through the CSV writer as one unquoted column of that
    name, with a separator that no line holds, so each file the writer opens
    gets its header."""
    df = lines.select("value")
    if header_per_file is None:
        df.write.mode("overwrite").text(path)
    else:
        (df.withColumnRenamed("value", header_per_file).write.mode("overwrite")
         .option("header", True).option("sep", "\u0001").option("quote", "\u0000").option("escape", "\u0000")
         .option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
