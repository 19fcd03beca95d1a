"""Column -> Column building blocks (all JVM-side built-in expressions)."""

from rowforge.functions.text import (  # noqa: F401
    java_trim, is_blank, clean_special_chars, split_keep_trailing,
    java_split_width, field, tokenize, strict_int,
)
from rowforge.functions.dates import normalize_date, date_parts  # noqa: F401
from rowforge.functions.urls import url_protocol, url_scheme  # noqa: F401
from rowforge.functions.keys import composite_key, with_audit_columns  # noqa: F401
