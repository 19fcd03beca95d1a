"""URL protocol labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowforge.functions.text import _c


def url_protocol(c) -> Column:
    """``http`` when the text contains ``http`` anywhere (case-sensitive),
    else ``noprotocol``; a null URL is ``noprotocol``."""
    c = _c(c)
    return F.when(F.instr(c, "http") > 0, F.lit("http")).otherwise(F.lit("noprotocol"))


def url_scheme(c) -> Column:
    """``http`` or ``https`` from a leading scheme (any case), else ``noprotocol``."""
    s = F.regexp_extract(F.lower(_c(c)), r"^(https?)://", 1)
    return F.when(s != "", s).otherwise(F.lit("noprotocol"))
