"""Best-fit packing of documents into sequences, with conflicts.

Method: documents are placed in order of falling length.  Open bins are kept
in order of their residual capacity; a document looks up the smallest residual
that holds it and goes on to the next larger one (successor search) until it
finds the tightest bin that is compatible.  A bin carries bitmaps of what it
holds: one bit per duplicate cluster, so copies never share a sequence, and
``per_source`` layers of one bit per source, so no sequence holds more than
that many documents of one source.  Bins of equal residual and equal bitmaps
are interchangeable and are tested once.

A document longer than the capacity is cut: its leading pieces of exactly the
capacity are sequences of their own, and its rest is packed.  Nothing is
dropped or shortened.

Documents are dealt to shards of about ``shard_rows`` rows by a hash of id, length,
cluster and the number of the row, so a shard is a bounded group at any size,
however frequent one source, cluster or repeated row is; bins never span shards.  Only ids, lengths, sources and clusters move.
Given the place of each row in a reading order, shards are ranges of that
order instead, and bins are numbered by their first row in it, so the names of
the bins sort in the order in which they are to be read.

Edge cases: null and empty texts take no room and are not packed; null source
and null cluster are values like any other for sources, while a row without a
cluster conflicts with nothing; rows that repeat a doc_id are packed one by one;
equal lengths are placed in order of doc_id, then source and cluster.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 16384         # code points
SHARD_ROWS = 4096
PER_SOURCE = 2

PLAN = ("doc_id long, piece int, start long, length long, bin string, position int, "
        "offset long")


class Bins:
    """Open bins by residual; each class of equal bins is a list of numbers."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.residuals: list[int] = []                       # sorted, without repeats
        self.classes: dict[int, dict[tuple, list[int]]] = {}  # residual -> bitmaps -> bins
        self.count = 0

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset in it) of a document; ``source`` and ``cluster`` are
        one-bit masks (0: no conflicts)."""
        for at in range(bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[at]
            for held, bins in self.classes[residual].items():
                if not (held[0] & cluster or held[-1] & source):
                    number = bins.pop(0)
                    if not bins:
                        self._forget(residual, held)
                    self._keep(number, residual - size, held, source, cluster)
                    return number, self.capacity - residual
        number, self.count = self.count, self.count + 1
        self._keep(number, self.capacity - size, (0,) * (1 + self.per_source), source, cluster)
        return number, 0

    def _forget(self, residual: int, held: tuple) -> None:
        del self.classes[residual][held]
        if not self.classes[residual]:
            del self.classes[residual]
            self.residuals.pop(bisect_left(self.residuals, residual))

    def _keep(self, number: int, residual: int, held: tuple, source: int, cluster: int) -> None:
        if not residual:
            return
        layers, carry = [held[0] | cluster], source
        for layer in held[1:]:  # the first layer that lacks the source takes it
            layers.append(layer | carry)
            carry &= layer
        if residual not in self.classes:
            insort(self.residuals, residual)
        self.classes.setdefault(residual, {}).setdefault(tuple(layers), []).append(number)


def _bits(values: list, only_repeated: bool) -> list[int]:
    """A one-bit mask per distinct value, in order of appearance; 0 for null
    (and, if asked, for values that occur once)."""
    count: dict = {}
    for v in values:
        count[v] = count.get(v, 0) + 1
    bit: dict = {}
    for v in values:
        if v is not None and (count[v] > 1 or not only_repeated):
            bit.setdefault(v, 1 << len(bit))
    return [bit.get(v, 0) for v in values]


def pack_shard(sizes: list[int], sources: list, clusters: list, capacity: int,
               per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each document, placed in the given order."""
    bins = Bins(capacity, per_source)
    return [bins.place(*x) for x in zip(sizes, _bits(sources, False), _bits(clusters, True))]


def _pack(capacity: int, per_source: int):
    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("rest", "descending"), ("doc_id", "ascending"), ("source", "ascending"),
                             ("cluster", "ascending"), ("length", "ascending"), ("place", "ascending")])
        shard = rows.column("shard")[0].as_py()
        doc, length = rows.column("doc_id").to_pylist(), rows.column("length").to_pylist()
        rest = rows.column("rest").to_pylist()
        some = [i for i, r in enumerate(rest) if r]
        column = lambda c: [x for x, r in zip(rows.column(c).to_pylist(), rest) if r]
        placed = pack_shard([rest[i] for i in some], column("source"), column("cluster"), capacity, per_source)
        out, filled = [], {}
        for i, (number, offset) in zip(some, placed):
            position = filled[number] = filled.get(number, -1) + 1
            out.append((doc[i], length[i] // capacity, length[i] - rest[i], rest[i], f"{shard}.{number}",
                        position, offset))
        for i, n in enumerate(length):
            out += [(doc[i], p, p * capacity, capacity, f"{shard}.f{i}.{p}", 0, 0) for p in range(n // capacity)]
        place = rows.column("place").to_pylist()
        if place[0] is not None:
            at = [place[i] for i in some] + [place[i] for i, n in enumerate(length) for _ in range(n // capacity)]
            first: dict = {}     # bin -> its first place; the whole pieces of a text come before its rest
            for x, here in zip(out, at):
                mine = (here, x[3] < capacity, x[1])
                first[x[4]] = min(first.get(x[4], mine), mine)
            name = {b: f"{shard:09}.{k:09}" for k, b in enumerate(sorted(first, key=first.__getitem__))}
            out = [(*x[:4], name[x[4]], *x[5:]) for x in out]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
        return pa.table([pa.array([x[c] for x in out], k) for c, k in enumerate(kinds)],
                        ["doc_id", "piece", "start", "length", "bin", "position", "offset"])
    return packed


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster_col: str | None = None, place_col: str | None = None, capacity: int = CAPACITY,
         per_source: int = PER_SOURCE, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The packing plan: one row per piece of a document with its bin, its
    place in it, and the code points ``start``, ``length`` that it takes from
    the text.  Without a cluster column, equal texts are a cluster.
    ``place_col`` numbers the rows of ``docs`` from 0 in their reading order."""
    text = F.col(text_col).cast("string")
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.md5(text.cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(text).cast("long").alias("length"),
                       F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
                       cluster.alias("cluster"), (F.col(place_col) if place_col else F.lit(None)).cast("long")
                       .alias("place")).where("length > 0")
    n_rows = docs.count()
    shards = max(1, -(-n_rows // shard_rows))
    shard = (F.floor(F.col("place") * shards / max(1, n_rows)) if place_col
             else F.pmod(F.xxhash64("doc_id", "length", "cluster", F.monotonically_increasing_id()), F.lit(shards)))
    dealt = rows.withColumn("rest", F.col("length") % capacity).withColumn("shard", shard.cast("int"))
    return dealt.groupBy("shard").applyInArrow(_pack(capacity, per_source), PLAN)


def sequences(docs: DataFrame, plan: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed texts of a plan over documents with unique ids: bin and its
    pieces in order, each (doc_id, text)."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    part = F.substring(F.col("text"), (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    return (plan.join(text, "doc_id").groupBy("bin")
            .agg(F.sort_array(F.collect_list(F.struct("position", "doc_id", part.alias("text")))).alias("pieces"))
            .select("bin", F.transform("pieces", lambda p: F.struct(p["doc_id"], p["text"])).alias("pieces")))
