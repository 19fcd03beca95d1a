"""Inner join that spreads hot keys itself, whatever broadcast and AQE may do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more than this share of all rows, so there are fewer than 1 / HOT_SHARE.
HOT_SHARE = 1 / 256


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """(__key, __parts) of the keys with more than ``share`` of the rows that
    have one, and the number of parts of that size in each: fewer than
    1 / ``share`` rows.  A count per key with a partial count in each task; the
    total is a scalar subquery over the same counts."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    part = counts.agg(F.sum("__n")).scalar() * F.lit(share)
    return counts.where(F.col("__n") > part).select("__key", F.ceil(F.col("__n") / part).cast("int").alias("__parts"))


def salted_join(fact: DataFrame, lookup: DataFrame, key: str, lookup_key: str, salt_by: list[str],
                counted: DataFrame | None = None, share: float = HOT_SHARE) -> DataFrame:
    """``fact`` inner-joined with ``lookup`` on ``key`` = ``lookup_key``.

    Rows of a hot key are dealt to its parts by a hash of ``salt_by`` (columns
    that differ between its rows; a hash, so a task that runs again deals alike),
    and only the lookup rows of hot keys are repeated, once per part.  Every other row
    is joined as usual.  Repeated lookup keys multiply rows, as in any join.

    ``counted`` is where keys are counted, if not in ``fact`` itself: the table that
    ``fact`` was made from, if that is cheaper.  Any counts give the right rows."""
    # fewer than 1 / share rows, so this broadcast is bounded
    hot = F.broadcast(hot_keys(fact if counted is None else counted, key, share))
    parts = F.coalesce("__parts", F.lit(1))
    dealt = fact.join(hot, fact[key] == hot["__key"], "left").withColumn(
        "__salt", F.pmod(F.xxhash64(*salt_by), parts).cast("int")).drop("__key", "__parts")
    of_part = lookup.join(hot, lookup[lookup_key] == hot["__key"], "left").withColumn(
        "__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__key", "__parts")
    return dealt.join(of_part, (dealt[key] == of_part[lookup_key]) & (dealt["__salt"] == of_part["__part"])
                      ).drop("__salt", "__part")
