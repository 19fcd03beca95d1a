"""Near-duplicate documents by an inverted join over MinHash signatures.

Method: every distinct shingle set gets a signature of ``coordinates``
min-hashes and is posted under each (coordinate, value) pair.  Two sets of
Jaccard similarity >= t agree in at least ``matches_needed`` coordinates (but
for a chance of ``miss`` per pair at exactly t, and far less above it), so

* a set with fewer than that many values that any other set has is alone;
* ordering a set's values from rare to common, two similar sets share one of
  their first ``shared - matches_needed + 1`` values (prefix filter); the
  common values, such as those of a passage that many documents carry, are
  skipped;
* collisions are counted on the whole signatures, and pairs above the match
  threshold are confirmed on the full shingle sets of their texts.

Large groups never become all their pairs.  Equal sets are one class from the
start.  Then every posting list offers only the pairs with its hub, the member
whose values are the most common ones; pairs inside one component need no test
any more.  Of the pairs between different components, those of lists of up to
``SHORT_LIST`` members are joined.  Longer lists that have members in common
form a family, whose members are dealt into chunks of about ``CHUNK``; pairs of
chunks are compared as tiles, by the same counts; the texts of members that have
a pair above the match threshold follow, and their sets are compared.  A tile
returns no more links than it has members.

Links that must not be missed at all, whatever their number: the exact join of
``group_join`` gives the same components without a chance.

Edge cases: null, empty and blank texts have no shingles and link with
nothing; what is linked are the sets of texts, so rows of one ``doc_id`` with
different texts are judged each by its own.  In ``near_duplicates`` a row
without ``doc_id`` is never linked (null component, kept) and rows that repeat
the smallest id of a component are all kept; ``one_of_each`` keeps one row of
every component, whatever its id.  Other columns play no part here.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowforge.llm.shingles import _weights, mix, shingle_sets
from rowforge.session import names_in, remove_path, scratch_path

COORDINATES = 64
MISS = 1e-7
SHORT_LIST = 16
CHUNK = 256
SIGNED = "n_shingles long, set_a long, set_b long, signature binary"


def matches_needed(threshold: float, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """The largest m such that a pair at ``threshold`` agrees in fewer than m
    coordinates with a chance of at most ``miss``."""
    below, m = 0.0, 0
    while m < coordinates:
        below += comb(coordinates, m) * threshold ** m * (1 - threshold) ** (coordinates - m)
        if below > miss:
            return max(m, 1)
        m += 1
    return m


def sign(n: int, coordinates: int = COORDINATES):
    """Column function: text -> (set size, two set fingerprints, signature)."""
    def signed(texts: pa.Array) -> pa.Array:
        salt = mix(np.arange(1, coordinates + 1, dtype=np.uint64))[:, None]
        factor = _weights(coordinates)[:, None]
        size, a, b, sig = [], [], [], []
        for s in shingle_sets(texts, n):
            size.append(len(s))
            a.append(int(s.sum(dtype=np.uint64).view(np.int64)))
            b.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
            least = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
            for i in range(0, len(s), 512):
                np.minimum(least, ((s[None, i:i + 512] ^ salt) * factor).min(axis=1), out=least)
            sig.append((least >> np.uint64(32)).astype("<u4").tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(size, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
             pa.array(sig, pa.binary())], ["n_shingles", "set_a", "set_b", "signature"])
    return F.arrow_udf(signed, SIGNED)


def _values(signature: pa.Array) -> pa.Array:
    raw = np.frombuffer(b"".join(signature.to_pylist()), "<i4")
    width = len(raw) // max(1, len(signature))
    ends = np.arange(len(signature) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(raw))


def _agreeing(left: pa.Array, right: pa.Array) -> pa.Array:
    a = np.frombuffer(b"".join(left.to_pylist()), "<i4").reshape(len(left), -1)
    b = np.frombuffer(b"".join(right.to_pylist()), "<i4").reshape(len(right), -1)
    return pa.array((a == b).sum(axis=1), pa.int32())


def _linked(n: int, threshold_pct: int):
    """Column function: do the full shingle sets of two texts reach the
    threshold (100 * |A n B| >= pct * |A u B|)?"""
    def linked(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(shingle_sets(left, n), shingle_sets(right, n)):
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(bool(both) and 100 * both >= threshold_pct * (len(a) + len(b) - both))
        return pa.array(out, pa.bool_())
    return F.arrow_udf(linked, "boolean")


class _Store:
    """Tables that cut the lineage, below one folder of the shared one."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, scratch_path(spark, "near_dedup")

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, f"{self.root}/{name}")

    def remove_all_but(self, *kept: str) -> None:
        self.remove(*set(names_in(self.spark, self.root)).difference(kept))


def connected(spark: SparkSession, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b).
    Least labels travel along links and then jump to the label's own label,
    until nothing changes; every step is a join and a min, so a node with
    very many links is pre-aggregated like any other key."""
    store, k = _Store(spark), 0
    both = store(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    label = store(both.groupBy(F.col("a").alias("node"))
                  .agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels0")
    while True:
        seen = (both.join(label, both["b"] == label["node"]).groupBy("a")
                .agg(F.min("component").alias("near")))
        step = (label.join(seen, label["node"] == seen["a"])
                .select("node", F.least("component", "near").alias("to"), F.col("component").alias("was")))
        jump = label.select(F.col("node").alias("to"), F.col("component").alias("beyond"))
        k += 1
        new = store(step.join(jump, "to", "left").select(
            "node", F.least("to", F.coalesce("beyond", "to")).alias("component"), "was"), f"labels{k}")
        moved = new.where("component <> was").limit(1).count()
        label = new.select("node", "component")
        store.remove(f"labels{k - 1}")
        if not moved:
            break
    store.remove("links")
    return (nodes.select("node").join(label, "node", "left")
            .select("node", F.coalesce("component", "node").alias("component")))


def _confirmed(pairs: DataFrame, sets: DataFrame, texts: DataFrame, n: int,
               threshold_pct: int, needed: int) -> DataFrame:
    """Of pairs (a, b): those above the match threshold whose full sets link."""
    agreeing = F.arrow_udf(_agreeing, "int")
    sig = sets.select("rep", "signature")
    counted = (pairs.join(sig.select(F.col("rep").alias("a"), F.col("signature").alias("sig_a")), "a")
               .join(sig.select(F.col("rep").alias("b"), F.col("signature").alias("sig_b")), "b")
               .where(agreeing("sig_a", "sig_b") >= needed).select("a", "b"))
    return (counted.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b")), "b")
            .where(_linked(n, threshold_pct)("text_a", "text_b")).select("a", "b"))


def _families(store: _Store, posted: DataFrame, long_lists: DataFrame, labels: DataFrame) -> DataFrame:
    """(family, rep, component) of the members of long lists, if a family has
    more than one component."""
    spark = posted.sparkSession
    near = posted.join(long_lists, ["coordinate", "value"]).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    near = store(near.distinct(), "near")
    nodes = near.select(F.col("a").alias("node")).distinct()
    family = connected(spark, nodes, near.where("a <> b")).select(
        F.col("node").alias("rep"), F.col("component").alias("family"))
    members = store(family.join(labels, "rep"), "families")
    mixed = members.groupBy("family").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    return members.join(store(mixed.select("family"), "mixed_families"), "family", "left_semi")


def _tiled(store: _Store, members: DataFrame, sets: DataFrame, chunk_rows: int) -> DataFrame:
    """Each member once for every tile (family, low, high) that its chunk is
    part of.  Large components have chunks of their own, and two chunks of one
    component make no tile.  Counts per family are stored before they are joined, so
    that a large family's members are not shuffled by its name for them."""
    size = store(members.groupBy("family", "component").agg(F.count("*").alias("n")), "sizes")
    large = F.col("n") >= chunk_rows
    sized = members.join(size, ["family", "component"]).select(
        "family", "rep", "component", large.alias("large"),
        F.when(large, F.col("component")).otherwise(0).alias("home"))
    kind = ["family", "large", "home"]
    count = store(sized.groupBy(*kind).agg(F.ceil(F.count("*") / chunk_rows).alias("chunks")), "chunks")
    part = F.pmod(F.xxhash64(F.lit("chunk"), "rep"), F.col("chunks"))
    sized = sized.join(count, kind).withColumn("chunk", F.xxhash64("large", "home", part))
    others = sized.select("family", F.col("large").alias("other_large"), F.col("home").alias("other_home"),
                          F.col("chunk").alias("other")).distinct()
    others = store(others, "others")
    dealt = sized.join(others, "family").where(~(F.col("large") & F.col("other_large")
                                                 & (F.col("home") == F.col("other_home"))))
    return (dealt.select("family", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"),
                         "chunk", "rep", "component")
            .join(sets, "rep"))


def _overlaps(left: list[np.ndarray], right: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of the intersections of all pairs of two lists of sets, by
    products of 0/1 matrices over the shingles that both lists have."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)))
    held = [[np.searchsorted(both, s[np.isin(s, both, assume_unique=True)]) for s in side] for side in (left, right)]
    for a in range(0, len(both), columns):
        m = []
        for side in held:
            x = np.zeros((len(side), min(columns, len(both) - a)), np.float32)
            for i, at in enumerate(side):
                x[i, at[np.searchsorted(at, a):np.searchsorted(at, a + columns)] - a] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out


TILE = "family long, low long, high long, chunk long, rep long, component long, n_shingles long"


def _sides(rows: pa.Table, threshold_pct: int) -> tuple:
    """Of a tile: positions of either chunk, and which pairs are of different
    components and near enough in size."""
    chunk = rows.column("chunk").to_numpy()
    low, high = rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
    component, size = rows.column("component").to_numpy(), rows.column("n_shingles").to_numpy()
    left, right = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    a, b = size[left][:, None], size[right]
    able = ((component[left][:, None] != component[right])
            & (100 * np.minimum(a, b) >= threshold_pct * np.maximum(a, b)))
    return left, right, able & (left[:, None] < right) if low == high else able


def _matching(threshold_pct: int, needed: int):
    def matching(rows: pa.Table) -> pa.Table:
        """The members of one tile that have a pair above the match threshold."""
        left, right, able = _sides(rows, threshold_pct)
        sig = np.frombuffer(b"".join(rows.column("signature").to_pylist()), "<i4").reshape(len(rows), -1)
        agree = np.zeros(able.shape, np.int16)
        for k in range(sig.shape[1]):
            agree += sig[left, None, k] == sig[None, right, k]
        able &= agree >= needed
        found = np.union1d(left[able.any(axis=1)], right[able.any(axis=0)])
        return rows.take(pa.array(found)).select([x.split()[0] for x in TILE.split(", ")])
    return matching


def _compare(n: int, threshold_pct: int):
    def compare(rows: pa.Table) -> pa.Table:
        """Links of one tile that join components: no more than a forest."""
        left, right, able = _sides(rows, threshold_pct)
        rep, component = rows.column("rep").to_numpy(), rows.column("component").to_numpy()
        size = rows.column("n_shingles").to_numpy()
        links = []
        if able.any():
            sets = list(shingle_sets(rows.column("text").combine_chunks(), n))
            both = _overlaps([sets[i] for i in left], [sets[j] for j in right])
            linked = able & (100 * both >= threshold_pct * (size[left][:, None] + size[right] - both))
            joined: dict = {}

            def root(c):
                while c in joined:
                    c = joined[c]
                return c

            for a, b in np.argwhere(linked):
                a, b = left[a], right[b]
                p, q = root(int(component[a])), root(int(component[b]))
                if p != q:
                    joined[max(p, q)] = min(p, q)
                    links.append((int(rep[a]), int(rep[b])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})
    return compare


def _grouped(rows: DataFrame, n: int, threshold_pct: int, coordinates: int, short_list: int,
             chunk_rows: int, miss: float, linkable: str) -> tuple[DataFrame, DataFrame]:
    """The stored rows (``rows`` with doc_id and text, and row, n_shingles,
    set_a, set_b), and one row per distinct set of those that are ``linkable``:
    the set, its first row (no_id, doc_id, row), and its component."""
    spark = rows.sparkSession
    store = _Store(spark)
    needed = matches_needed(threshold_pct / 100, coordinates, miss)
    base = store(rows.withColumn("row", F.monotonically_increasing_id())
                   .withColumn("s", sign(n, coordinates)("text")).select(*rows.columns, "row", "s.*"), "signed")
    filled = base.where("n_shingles > 0").where(linkable)
    # the rows of a set have one representative, whose text stands for them
    classes = store(filled.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first"),
        F.first("signature").alias("signature")).withColumn("rep", F.col("first.row")), "classes")

    posts = classes.select("rep", F.posexplode(F.arrow_udf(_values, "array<int>")("signature"))
                           .alias("coordinate", "value"))
    # stored, so that nothing stands between an exchange and the join, and a hot value is split
    common = store(posts.groupBy("coordinate", "value").agg(F.count("*").alias("df")).where("df > 1"), "common")
    shared = (posts.join(common, ["coordinate", "value"]).groupBy("rep")
              .agg(F.sort_array(F.collect_list(F.struct("df", "coordinate", "value"))).alias("values"))
              .where(F.size("values") >= needed))
    shared = store(shared, "shared")
    prefix = F.slice("values", 1, F.size("values") - needed + 1)
    weight = F.aggregate("values", F.lit(0).cast("long"), lambda s, v: s + v["df"])
    posted = shared.join(classes.select("rep", "n_shingles"), "rep").select(
        "rep", "n_shingles", weight.alias("weight"), F.explode(prefix).alias("v"))
    posted = store(posted.select("rep", "n_shingles", "weight", "v.coordinate", "v.value"),
                     "posted")
    sets = store(classes.join(shared.select("rep"), "rep", "left_semi")
                   .select("rep", "n_shingles", "signature"), "sets")
    texts = base.select(F.col("row").alias("rep"), "text").join(shared.select("rep"), "rep", "left_semi")
    texts = store(texts, "texts")

    key = ["coordinate", "value"]
    in_reach = 100 * F.least("n_a", "n_b") >= threshold_pct * F.greatest("n_a", "n_b")
    confirmed = lambda pairs, name: store(_confirmed(
        pairs.where(in_reach).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        sets, texts, n, threshold_pct, needed), name)

    # every member with its list's hub
    hub = F.max(F.struct("weight", (-F.col("rep")).alias("minus_rep"), "n_shingles"))
    lists = store(posted.groupBy(*key).agg(F.count("*").alias("members"), hub.alias("hub"))
                    .where("members > 1"), "lists")
    side = posted.select(*key, F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"))
    hubs = lists.select(*key, (-F.col("hub.minus_rep")).alias("b"), F.col("hub.n_shingles").alias("n_b"))
    links = confirmed(side.join(hubs, key).where("a <> b"), "hub_links")
    reps = sets.select(F.col("rep").alias("node"))
    labels = store(connected(spark, reps, links).withColumnRenamed("node", "rep"), "first_components")

    # pairs of different components in short lists
    labelled = posted.join(labels, "rep")
    mixed = labelled.groupBy(*key).agg(F.count("*").alias("members"), F.min("component").alias("x"),
                                       F.max("component").alias("y")).where("x <> y")
    mixed = store(mixed.select(*key, "members"), "mixed")
    short = labelled.join(mixed.where(F.col("members") <= short_list).select(*key), key).select(
        *key, F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("component").alias("c_a"))
    short = store(short, "short")
    other = short.select(*key, F.col("a").alias("b"), F.col("n_a").alias("n_b"), F.col("c_a").alias("c_b"))
    links = links.union(confirmed(short.join(other, key).where("a < b and c_a <> c_b"), "short_links"))

    # families of long lists, in tiles
    long_lists = mixed.where(F.col("members") > short_list).select(*key).join(
        lists.select(*key, (-F.col("hub.minus_rep")).alias("hub")), key)
    tiles = _tiled(store, _families(store, posted, long_lists, labels), sets, chunk_rows)
    tile = ["family", "low", "high"]
    opened = store(tiles.groupBy(*tile).applyInArrow(_matching(threshold_pct, needed), TILE), "opened")
    found = opened.join(texts, "rep").groupBy(*tile).applyInArrow(_compare(n, threshold_pct), "a long, b long")
    links = links.union(store(found, "tile_links"))
    labels = store(connected(spark, reps, links), "components")

    grouped = classes.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "set_a", "set_b", "n_shingles", "first", F.coalesce("component", "rep").alias("component"))
    grouped = store(grouped, "grouped")
    store.remove_all_but("signed", "grouped")
    return base, grouped


def near_duplicates(docs: DataFrame, n: int = 5, threshold_pct: int = 80, *,
                    id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES,
                    short_list: int = SHORT_LIST, chunk_rows: int = CHUNK, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    doc_id reachable over links, itself included), kept (doc_id is that one)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base, grouped = _grouped(rows, n, threshold_pct, coordinates, short_list, chunk_rows, miss, "doc_id is not null")
    least = grouped.groupBy("component").agg(F.min("first.doc_id").alias("component_id"))
    of_class = grouped.join(least, "component").select("set_a", "set_b", "n_shingles", "component_id")
    return (base.join(of_class, ["set_a", "set_b", "n_shingles"], "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
                    .alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def one_of_each(docs: DataFrame, n: int = 5, threshold_pct: int = 80, *, coordinates: int = COORDINATES,
                short_list: int = SHORT_LIST, chunk_rows: int = CHUNK, miss: float = MISS) -> DataFrame:
    """``docs`` (with doc_id and text) without near-duplicates: exactly one row
    of every component, of the smallest doc_id, or of none if none has one.
    Rows without shingles stay."""
    base, grouped = _grouped(docs, n, threshold_pct, coordinates, short_list, chunk_rows, miss, "true")
    first = grouped.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.row").alias("row"))
    alone = base.where("n_shingles = 0").select("row")
    return base.join(first.union(alone), "row", "left_semi").select(*docs.columns)
