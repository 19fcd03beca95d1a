from pyspark.sql import functions as F

from rowforge.functions import (
    clean_special_chars, composite_key, java_split_width, java_trim, normalize_date,
    strict_int, url_protocol, url_scheme,
)
from rowforge.functions.sql import register_sql_functions


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("r")).first()[0]


def test_java_trim_strips_control_chars(spark):
    assert one(spark, java_trim, "\t a b \t\n") == "a b"
    assert one(spark, java_trim, None) is None


def test_cleaner_golden_case(spark):
    # 3 blanks, 2 blanks, 1 trailing blank; then a leading run that is trimmed
    assert one(spark, clean_special_chars, "Harbour-/7B_(for eyes)") == "Harbour   B  for eyes "
    assert one(spark, clean_special_chars, "  North EAST_ZONE [4]?") == "North EAST ZONE     "
    assert one(spark, clean_special_chars, None) is None


def test_url_protocol_contains_semantics(spark):
    cases = {"http://plans.example.com/": "http", "www.example.net": "noprotocol",
             "https://a.org": "http", "HTTP://z": "noprotocol",
             "www.a.com/?r=http://b": "http", None: "noprotocol"}
    for u, want in cases.items():
        assert one(spark, url_protocol, u) == want, u


def test_url_scheme(spark):
    cases = {"https://a.org": "https", "HTTP://z": "http", "www.a.com/?r=http://b": "noprotocol",
             None: "noprotocol", "ftp://x": "noprotocol"}
    for u, want in cases.items():
        assert one(spark, url_scheme, u) == want, u


def test_normalize_date_strict_and_lenient(spark):
    strict = lambda c: normalize_date(c, "yyyy-MM-dd")
    lenient = lambda c: normalize_date(c, "yyyy-MM-dd", "lenient")
    assert one(spark, strict, "2019-10-01") == "2019-10-01"
    assert one(spark, strict, "2019-13-01") is None
    assert one(spark, strict, "garbage") is None
    assert one(spark, lenient, "2019-13-01") == "2020-01-01"
    assert one(spark, lenient, "2019-02-30") == "2019-03-02"
    assert one(spark, lenient, "garbage") is None
    dmy = lambda c: normalize_date(c, "dd-MM-yyyy")
    assert one(spark, dmy, "02-10-2019") == "2019-10-02"


def test_strict_int(spark):
    assert one(spark, strict_int, "123") == 123
    assert one(spark, strict_int, "+5") == 5
    assert one(spark, strict_int, " 12") is None        # Spark's cast would accept it
    assert one(spark, strict_int, "99999999999") is None
    assert one(spark, strict_int, "N12") is None


def test_java_split_width_drops_trailing_empties(spark):
    assert one(spark, java_split_width, "3,Cy,Ray,50,") == 4
    assert one(spark, java_split_width, "3,,Ray,50,x") == 5
    assert one(spark, java_split_width, "AL,Alabama") == 2


def test_composite_key(spark):
    df = spark.createDataFrame([(1, 23), (12, 3), (None, 4)], "a int, b int")
    got = [r[0] for r in df.select(composite_key("a", "b")).collect()]
    assert got == ["123", "123", None]
    got = [r[0] for r in df.select(composite_key("a", "b", "|")).collect()]
    assert got == ["1|23", "12|3", None]


def test_sql_function_matches_column_function(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([("Harbour-/7B_(for eyes)",), (None,), ("\ta[b]\t",), ("a \u0085",)], "v string")
    a = df.select(clean_special_chars("v").alias("r")).collect()
    b = spark.sql("SELECT remspecialcharudf(v) AS r FROM {d}", d=df).collect()
    assert a == b
    assert spark.catalog.functionExists("remspecialcharudf")


def test_lenient_date_garbage_is_null_not_error(spark):
    lenient = lambda c: normalize_date(c, "yyyy-MM-dd", "lenient")
    assert one(spark, lenient, "0000-01-01") is None
    assert one(spark, lenient, "2019-99999999-01") is None
    assert one(spark, lenient, "1-10-2019") == "0007-04-11"           # taken as year 1, month 10, day 2019
    assert one(spark, lenient, "2019-20000-01") == "3685-08-01"       # any month that stays in four-digit years
    assert one(spark, lenient, "0002-01-3660000") is None             # rolls out of them
    assert one(spark, lenient, "2019-01-99999999999") is None
    assert one(spark, lenient, "2019-00-00") == "2018-11-30"


def test_separators_are_literal(spark):
    from rowforge.functions.text import split_keep_trailing, split_trimmed
    df = spark.createDataFrame([("a|b||",), (" x . y\t.z ",)], "v string")
    r = df.select(split_keep_trailing("v", "|").alias("p"), split_trimmed("v", ".").alias("t")).collect()
    assert r[0].p == ["a", "b", "", ""]
    assert r[1].t == ["x", "y", "z"]
    assert one(spark, lambda c: java_split_width(c, "|"), "a|b||") == 2


def test_trimmed_split_with_dollar_separator(spark):
    from rowforge.functions.text import split_trimmed
    df = spark.createDataFrame([(" a $ b$c ",)], "v string")
    assert df.select(split_trimmed("v", "$").alias("t")).first().t == ["a", "b", "c"]


def test_trim_and_blank_at_the_edges(spark):
    from rowforge.functions.text import is_blank, split_trimmed
    assert one(spark, java_trim, "a \u0085") == "a \u0085"             # beyond U+0020: no blank
    assert one(spark, java_trim, "\x00\x1f a\n") == "a"
    assert one(spark, is_blank, "\u0085") is False and one(spark, is_blank, " \x00\t") is True
    assert one(spark, is_blank, None) is None and one(spark, strict_int, "5\n") is None
    assert one(spark, lambda c: split_trimmed(c), " a , \x01b,, c d ") == ["a", "b", "", "c d"]


def test_long_inner_runs_are_linear(spark):
    import time
    from rowforge.functions.text import split_trimmed

    def seconds(n):
        df = spark.range(20).select(F.concat(F.lit("a"), F.repeat(F.lit(" "), n), F.lit("b"),
                                             F.repeat(F.lit(","), n), F.lit("c")).alias("v"))
        t = time.time()
        df.select(F.sum(F.length(java_trim("v"))), F.sum(F.size(split_trimmed("v", ";"))),
                  F.sum(java_split_width("v"))).collect()
        return time.time() - t

    seconds(100)
    assert seconds(200_000) < 20       # quadratic: minutes


def test_averages_are_not_rounded(spark):
    from rowforge.operators.aggregate import group_avg_count
    df = spark.createDataFrame([("a", 0.001, 1), ("a", 0.002, 1), ("a", 0.001, 1), ("b", 1e-12, 2), ("b", None, 5),
                                ("b", 3e-12, 2), ("c", 1e25, 1), ("c", 2e25, 3), ("d", None, 1)],
                               "k string, v double, n int")
    got = {r.k: r for r in group_avg_count(df, ["k"], "v").collect()}
    assert got["a"].avg_value == 0.004 / 3 and got["d"].avg_value is None
    assert abs(got["b"].avg_value - 2e-12) < 1e-24 and got["b"].total == 3
    weighted = {r.k: r for r in group_avg_count(df, ["k"], "v", weight="n").collect()}
    assert abs(weighted["c"].avg_value - 1.75e25) < 1e11 and weighted["b"].total == 9
    assert abs(weighted["b"].avg_value - 2e-12) < 1e-24
