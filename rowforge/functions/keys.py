"""Derived key and audit columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowforge.functions.text import _c


def composite_key(a, b, sep: str | None = None) -> Column:
    """Text concatenation of two values; null if either is null.

    Without a separator ``(1, 23)`` and ``(12, 3)`` collide; pass ``sep`` to
    keep them apart.
    """
    parts = [_c(a).cast("string"), _c(b).cast("string")]
    if sep is not None:
        parts.insert(1, F.lit(sep))
    return F.concat(*parts)


def with_audit_columns(df: DataFrame, date_col: str = "sysdt",
                       ts_col: str = "systs") -> DataFrame:
    """Load date and time; Spark evaluates both once per query."""
    return df.withColumns({date_col: F.current_date(), ts_col: F.current_timestamp()})
