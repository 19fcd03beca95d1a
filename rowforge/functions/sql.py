"""SQL-callable functions, registered as SQL UDFs so the optimizer inlines
them into plain expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rowforge.functions.text import JAVA_BLANKS, SPECIAL_CHARS_PATTERN


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Fixed value: the name under which the cleaner is known to SQL.
CLEANER_NAME = "remspecialcharudf"


def register_sql_functions(spark: SparkSession, cleaner_name: str = CLEANER_NAME) -> None:
    blanks = "'" + "".join(f"\\u{ord(c):04x}" for c in JAVA_BLANKS) + "'"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {cleaner_name}(s STRING) "
        f"RETURNS STRING RETURN regexp_replace(btrim(s, {blanks}), "
        f"{_sql_str(SPECIAL_CHARS_PATTERN)}, ' ')"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION url_protocol(u STRING) RETURNS STRING "
        "RETURN CASE WHEN instr(u, 'http') > 0 THEN 'http' ELSE 'noprotocol' END"
    )
