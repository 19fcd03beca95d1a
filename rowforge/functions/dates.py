"""Date normalisation: strict (bad text -> null) or lenient (out-of-range
month/day roll over into the next month/year, as a lenient calendar does)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowforge.functions.text import _c

_TOKENS = {"yyyy": "y", "MM": "m", "dd": "d"}


def _lenient_regex(fmt: str) -> tuple[str, list[str]]:
    """Turn e.g. ``dd-MM-yyyy`` into ``^([0-9]+)-([0-9]+)-([0-9]+)`` and the
    order of the captured parts (``['d', 'm', 'y']``)."""
    order, out, i = [], "^", 0
    while i < len(fmt):
        for tok, part in _TOKENS.items():
            if fmt.startswith(tok, i):
                out += "([0-9]+)"
                order.append(part)
                i += len(tok)
                break
        else:
            out += re.escape(fmt[i])
            i += 1
    if sorted(order) != ["d", "m", "y"]:
        raise ValueError(f"lenient mode needs yyyy, MM and dd in {fmt!r}")
    return out, order


def normalize_date(c, fmt: str, mode: str = "strict",
                   out_fmt: str = "yyyy-MM-dd", years: tuple[int, int] = (1, 9999)) -> Column:
    """Parse text in ``fmt`` and print it as ``out_fmt``.

    strict: anything that is not a real date in ``fmt`` becomes null.
    lenient: numbers are taken as they are and rolled over
    (``2019-13-01`` -> ``2020-01-01``, ``2019-02-30`` -> ``2019-03-02``);
    null only where a number exceeds an int, or the date (or the month that
    days are counted from) lies outside ``years``, by default the years that
    print as four digits.
    """
    c = _c(c)
    if mode == "strict":
        return F.date_format(F.try_to_date(c, fmt), out_fmt)
    if mode != "lenient":
        raise ValueError(f"unknown mode {mode!r}")
    rx, order = _lenient_regex(fmt)
    part = {p: F.regexp_extract(c, rx, i + 1) for i, p in enumerate(order)}
    num = {p: F.when(v != "", v.try_cast("int")) for p, v in part.items()}
    months = num["y"].cast("bigint") * 12 + num["m"] - 1
    year = F.floor(months / 12).cast("int")
    first = F.when(year.between(*years), F.make_date(year, (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1)))
    # days from 1970-01-01 as a long, checked before they become a date
    day = F.unix_date(first).cast("bigint") + num["d"] - 1
    least, most = (F.unix_date(F.make_date(F.lit(y), F.lit(m), F.lit(d)))
                   for y, m, d in ((years[0], 1, 1), (years[1], 12, 31)))
    return F.when(day.between(least, most), F.date_format(F.date_from_unix_date(day.cast("int")), out_fmt))


def date_parts(c) -> dict[str, Column]:
    c = _c(c)
    return {"yr": F.year(c), "mth": F.month(c)}
