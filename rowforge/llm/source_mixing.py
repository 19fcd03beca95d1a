"""Mixing sources to target weights by Pfair scheduling, in DataFrame
functions only.

Method: each source's documents, in an order given by a hash of their id, are
cut into blocks of ``block_rows``.  Target weights are whole quotas that add
up to a period of P slots, one block per slot.  Block i (from 0) of a source
with quota q is released at slot floor(i * P / q) and due by
ceil((i + 1) * P / q).  Earliest deadline first among the released blocks
(ties: the smaller quota, then the smaller source name) meets every window, so
after any number of slots each source is less than one block from its share, for as
long as no source has run out.  The windows repeat every P slots, so one period is
scheduled, and every block finds its slot from its number alone.

Sources of one quota have the same windows, so the schedule is made for the
distinct quotas, whose sources take turns.  Quotas add up to P, so there are fewer
than sqrt(2 P) distinct ones, and a period takes P steps over as many: with P four
times the number of sources, some thousand sources take seconds, and a hundred
thousand some minutes of one task.

The order covers every document.  Where a source runs out, its slots stay
empty and the others keep theirs.

A source that holds most rows is no bottleneck: rows are numbered in small
hash buckets per source, and buckets are added up afterwards.

Edge cases: a null source counts as the source named by the empty string; rows
without id are dealt and ordered by a hash of their other columns; sources without a
weight get a quota of one; weights of absent sources are ignored; repeated
rows are numbered one by one (those of one id in one bucket).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PERIOD = 1000            # slots, at least four for every source
BLOCK_ROWS = 8
BUCKET_ROWS = 2048       # rows numbered together, on average
STRIDE = 256             # slots whose results are gathered before they join the others


def quotas(sizes: DataFrame, period: int, target: dict[str, float] | None, power: float) -> DataFrame:
    """(source, quota, period): whole quotas by largest remainder, one at
    least, that add up to the period.  One row per source.  Without targets
    a source's weight is its size to the given power."""
    weight = F.pow(F.col("n").cast("double"), F.lit(power))
    if target is not None:
        named = F.create_map(*[F.lit(x) for kv in target.items() for x in kv]) if target else None
        weight = F.coalesce(named[F.col("source")], F.lit(0.0)) if target else F.lit(0.0)
    every = Window.partitionBy(F.lit(1))
    rows = sizes.select("source", F.greatest(weight, F.lit(0.0)).alias("w"))
    slots = F.greatest(F.lit(period), 4 * F.count("*").over(every))
    rows = rows.select("source", slots.alias("period"), F.count("*").over(every).alias("k"),
                       (F.col("w") / F.greatest(F.sum("w").over(every), F.lit(1e-300))).alias("w"))
    exact = F.col("w") * (F.col("period") - F.col("k"))
    rows = rows.select("source", "period", F.floor(exact).alias("whole"), (exact - F.floor(exact)).alias("part"), "k")
    order = every.orderBy(F.desc("part"), "source")
    rows = rows.select("source", "period", "whole", F.row_number().over(order).alias("place"),
                       (F.col("period") - F.col("k") - F.sum("whole").over(every)).alias("left"), "k")
    # what rounding left over goes round from the largest remainder on
    extra = F.floor(F.col("left") / F.col("k")) + F.when(F.col("place") <= F.col("left") % F.col("k"), 1).otherwise(0)
    return rows.select("source", (1 + F.col("whole") + extra).cast("long").alias("quota"),
                       F.col("period").cast("long").alias("period"))


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def schedule(quota: DataFrame) -> DataFrame:
    """(source, number, slot) of one period, from 0, of (source, quota,
    period): earliest deadline first."""
    classes = quota.groupBy("period", "quota").agg(F.count("*").alias("n"))
    listed = classes.groupBy("period").agg(F.sort_array(F.collect_list(F.struct("quota", "n"))).alias("all"))
    period, zero = F.col("period"), F.lit(0).cast("long")
    none = F.array().cast("array<struct<quota: bigint, n: bigint, turn: bigint, slot: bigint>>")

    def first(state: Column, slot: Column) -> Column:
        """Of the released blocks the one that is due first."""
        ready = F.filter(state, lambda c: (c["done"] < c["quota"] * c["n"]) & (
            F.floor(F.floor(c["done"] / c["n"]) * period / c["quota"]) <= slot))
        return F.array_min(F.transform(ready, lambda c: F.struct(
            F.ceil((F.floor(c["done"] / c["n"]) + 1) * period / c["quota"]).alias("due"),
            c["quota"].alias("quota"), c["n"].alias("n"), c["done"].alias("turn"))))

    def step(acc: Column, slot: Column) -> Column:
        return _let(first(acc["state"], slot), lambda d: F.struct(
            F.transform(acc["state"], lambda c: F.struct(
                c["quota"], c["n"], (c["done"] + F.when(c["quota"] == d["quota"], 1).otherwise(0)).alias("done"))).alias("state"),
            F.array_append(acc["out"], F.struct(d["quota"].alias("quota"), d["n"].alias("n"), d["turn"].alias("turn"),
                                                slot.alias("slot"))).alias("out")))

    def stride(acc: Column, start: Column) -> Column:
        slots = F.sequence(start, F.least(start + STRIDE, period) - 1)
        run = F.aggregate(slots, F.struct(acc["state"].alias("state"), none.alias("out")), step)
        return _let(run, lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], r["out"]).alias("out")))

    state = F.transform("all", lambda c: F.struct(c["quota"].alias("quota"), c["n"].alias("n"), zero.alias("done")))
    run = F.aggregate(F.sequence(zero, period - 1, F.lit(STRIDE).cast("long")),
                      F.struct(state.alias("state"), none.alias("out")), stride)
    turns = listed.select(F.explode(run["out"]).alias("s")).select(
        "s.quota", (F.col("s.turn") % F.col("s.n")).alias("place"), F.floor(F.col("s.turn") / F.col("s.n")).alias("number"),
        "s.slot")
    placed = quota.select("source", "quota", (F.row_number().over(
        Window.partitionBy("quota").orderBy("source")) - 1).cast("long").alias("place"))
    return placed.join(turns, ["quota", "place"]).select("source", "number", "slot")


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source",
        target: dict[str, float] | None = None, power: float = 0.5, period: int = PERIOD,
        block_rows: int = BLOCK_ROWS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``docs`` with mix_block (number in its source), mix_slot, mix_release,
    mix_deadline and mix_order, by which the rows are to be read (equal only
    for rows of one block, which stand in order of their id)."""
    own = ["mix_block", "mix_slot", "mix_release", "mix_deadline", "mix_order"]
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    source = F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(""))
    buckets = max(1, -(-docs.count() // bucket_rows))
    ident = F.col(f"`{id_col}`").cast("string")
    draw = F.md5(F.coalesce(F.concat(F.lit("mix:"), ident), F.xxhash64(*keep).cast("string")).cast("binary"))
    rows = docs.select(*keep, source.alias("__source"), draw.alias("__draw"))
    bucket = F.floor(F.conv(F.substring("__draw", 1, 8), 16, 10).cast("long") * buckets / float(1 << 32)).cast("int")
    rows = rows.withColumn("__bucket", bucket)
    key = ["__source", "__bucket"]
    sizes = rows.groupBy(*key).agg(F.count("*").alias("n"))
    before = sizes.select(*key, (F.sum("n").over(Window.partitionBy("__source").orderBy("__bucket")) - F.col("n"))
                          .alias("__before"))
    quota = quotas(sizes.groupBy(F.col("__source").alias("source")).agg(F.sum("n").alias("n")), period, target, power)
    before = before.join(quota.select(F.col("source").alias("__source"), F.col("quota").alias("__quota"),
                                      F.col("period").alias("__period")), "__source")
    local = Window.partitionBy(*key).orderBy("__draw", F.col(f"`{id_col}`"))
    numbered = rows.withColumn("__local", F.row_number().over(local)).join(before, key)
    number = F.col("__before") + F.col("__local") - 1
    placed = numbered.withColumn("__number", number).withColumn(
        "mix_block", F.floor(F.col("__number") / block_rows).cast("long")).withColumn(
        "__turn", F.col("mix_block") % F.col("__quota"))
    # one row per slot of a period, found by source and number: a source of most rows has most of them
    turns = schedule(quota).select(F.col("source").alias("__source"), F.col("number").alias("__turn"),
                                   F.col("slot").alias("__slot"))
    slot = F.floor(F.col("mix_block") / F.col("__quota")) * F.col("__period") + F.col("__slot")
    placed = placed.join(turns, ["__source", "__turn"]).withColumn("mix_slot", slot.cast("long"))
    return placed.select(
        *keep, "mix_block", "mix_slot",
        F.floor(F.col("mix_block") * F.col("__period") / F.col("__quota")).cast("long").alias("mix_release"),
        F.ceil((F.col("mix_block") + 1) * F.col("__period") / F.col("__quota")).cast("long").alias("mix_deadline"),
        (F.col("mix_slot") * block_rows + F.col("__number") % block_rows).cast("long").alias("mix_order"))
