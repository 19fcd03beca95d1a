"""Jaccard join of documents by word n-grams over a token-group matrix.

Method: similar documents are partitioned into groups; the matrix holds, for
every group, the union of its members' tokens (shingles).  A set links with a
member of a group only if it shares enough tokens with the group's union, so
groups below that bound stay closed and only the members of qualifying groups
are compared.  All of it is exact; a partition of any kind gives the same links.

Which tokens are needed: of a set of ``x`` tokens, a set that reaches the
threshold has at least ``r = required(x)``.  In a fixed order of all tokens (by
hash) the first ``x - r + f(r)`` of both sets, their windows, then have at least
``f(r)`` tokens in common (``f`` rises by at most one with ``r``).  Of the
window, ordered again from rare to common tokens, the first ``x - r + 1`` hold
one that both have.  Only these are joined, so tokens of a passage that very many
documents carry are met only where nothing rarer is left.

1. equal sets are one class; tokens of the windows are counted over classes, and
   a class whose first tokens no other class has is alone;
2. every list of classes with a common token has a hub (the member of the most
   common tokens); a class belongs to the group of the hub of its longest list,
   in chunks of about ``GROUP_ROWS``;
3. classes that link with their hub are a component, inside which nothing is
   left to compare;
4. the matrix (token, group) is joined with itself for pairs of groups that share
   a token and are not of one component; such a pair is a tile;
5. a tile bounds each class's overlap with the other group's union, opens it if the
   bound reaches ``f(r)``, counts common window tokens of the opened classes
   as a product of 0/1 matrices, and names the classes that still may link;
6. the texts of these alone are fetched, and full sets decide.

Copies never become pairs (1), large groups of near copies become one link each
(3), and a tile returns no more links than it has classes (6).

Edge cases: null, empty and blank texts have no tokens and link with nothing; a
text of fewer words than ``n`` has its whole sequence as one token; a row without
``doc_id`` is never linked (null component); rows of one ``doc_id`` with
different texts are judged each by its own; repeated rows are one class; an empty
table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm.bloom import among
from rowforge.llm.near_dedup import _linked, _overlaps, _Store, connected
from rowforge.llm.shingles import mix, shingle_sets

GROUP_ROWS = 256
#: f(r): all of r up to the first number, and one of every so many beyond it.
WINDOW_ALL, WINDOW_STEP = 32, 32
SIGNED = "n_shingles long, set_a long, set_b long, window array<long>"


def required(size, threshold_pct: int):
    """The least overlap of a set of ``size`` with one that links with it."""
    return (threshold_pct * size + 99) // 100


def window_overlap(r):
    """f: the least overlap of windows."""
    return np.where(r <= WINDOW_ALL, r, WINDOW_ALL + (r - WINDOW_ALL) // WINDOW_STEP)


def _sql_required(threshold_pct: int) -> str:
    return f"(({threshold_pct} * n_shingles + 99) div 100)"


def sign(n: int, threshold_pct: int):
    """Column function: text -> (set size, two set fingerprints, window)."""
    def signed(texts: pa.Array) -> pa.Array:
        size, a, b, windows = [], [], [], []
        for s in shingle_sets(texts, n):
            r = required(len(s), threshold_pct)
            size.append(len(s))
            a.append(int(s.sum(dtype=np.uint64).view(np.int64)))
            b.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)))
            windows.append(s[:len(s) - r + int(window_overlap(r))].view(np.int64))
        ends = np.cumsum([0, *map(len, windows)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int64), *windows])
        return pa.StructArray.from_arrays(
            [pa.array(size, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], SIGNED.replace(",", "").split()[::2])
    return F.arrow_udf(signed, SIGNED)


def _rows_of(table: pa.Table) -> tuple:
    """(positions of the low group, of the high group, the columns as arrays)."""
    group = table.column("group").to_numpy()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    cols = {c: table.column(c).to_numpy() for c in ("rep", "component", "n_shingles")}
    return np.flatnonzero(group == low), np.flatnonzero(group == high), cols


def _in_reach(left: np.ndarray, right: np.ndarray, cols: dict, threshold_pct: int) -> np.ndarray:
    size, component = cols["n_shingles"], cols["component"]
    a, b = size[left][:, None], size[right][None, :]
    return ((component[left][:, None] != component[right]) & (cols["rep"][left][:, None] != cols["rep"][right])
            & (100 * np.minimum(a, b) >= threshold_pct * np.maximum(a, b)))


def _qualifying(threshold_pct: int):
    def qualifying(rows: pa.Table) -> pa.Table:
        """The classes of a tile that may link with one of the other group."""
        left, right, cols = _rows_of(rows)
        window = rows.column("window").combine_chunks()
        ends, flat = window.offsets.to_numpy(), window.values.to_numpy()
        tokens = [np.sort(flat[a:b]) for a, b in zip(ends[:-1], ends[1:])]
        size = cols["n_shingles"]
        r = required(size, threshold_pct)
        need = window_overlap(r)
        union = np.unique(np.concatenate([tokens[i] for i in right]))
        left = np.array([i for i in left if np.isin(tokens[i], union).sum() >= need[i]], np.int64)
        if len(left):
            union = np.unique(np.concatenate([tokens[i] for i in left]))
            right = np.array([i for i in right if np.isin(tokens[i], union).sum() >= need[i]], np.int64)
        found = np.zeros(0, np.int64)
        if len(left) and len(right):
            both = _overlaps([tokens[i] for i in left], [tokens[i] for i in right])
            able = (_in_reach(left, right, cols, threshold_pct)
                    & (both >= np.maximum(need[left][:, None], need[right])))
            whole = size - r + need == size           # the window is the set: decided here
            known = whole[left][:, None] & whole[right]
            links = 100 * both >= threshold_pct * (size[left][:, None] + size[right] - both)
            able &= ~known | links
            found = np.union1d(left[able.any(axis=1)], right[able.any(axis=0)])
        return rows.take(pa.array(found)).select(["low", "high", "group", "rep", "component", "n_shingles"])
    return qualifying


def _compared(n: int, threshold_pct: int):
    def compared(rows: pa.Table) -> pa.Table:
        """Links of one tile that join components: no more than a forest."""
        left, right, cols = _rows_of(rows)
        links, joined = [], {}
        if len(left) and len(right):
            sets = list(shingle_sets(rows.column("text").combine_chunks(), n))
            both = _overlaps([sets[i] for i in left], [sets[i] for i in right])
            size = cols["n_shingles"]
            linked = (_in_reach(left, right, cols, threshold_pct)
                      & (100 * both >= threshold_pct * (size[left][:, None] + size[right] - both)))

            def root(c):
                while c in joined:
                    c = joined[c]
                return c

            for a, b in np.argwhere(linked):
                a, b = left[a], right[b]
                p, q = root(int(cols["component"][a])), root(int(cols["component"][b]))
                if p != q:
                    joined[max(p, q)] = min(p, q)
                    links.append((int(cols["rep"][a]), int(cols["rep"][b])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})
    return compared


def _sql_overlap(r: str) -> str:
    return f"IF({r} <= {WINDOW_ALL}, {r}, {WINDOW_ALL} + ({r} - {WINDOW_ALL}) div {WINDOW_STEP})"


def _shared_tokens(store: _Store, classes: DataFrame, threshold_pct: int) -> DataFrame:
    """(rep, n_shingles, least, weight, window, prefix) of the classes that are
    not alone: the least overlap of its window, the window's tokens that another
    class has, rare ones first, and those of them by which it is found."""
    posts = classes.select("rep", F.explode("window").alias("token"))
    common = store(posts.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "common")
    found = posts.join(common, "token").groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("v"))
    sizes = classes.select("rep", "n_shingles", F.expr(_sql_overlap(_sql_required(threshold_pct))).alias("least"))
    # of the n - r + 1 rarest tokens, those of this class alone come first
    first = F.size("v") - F.col("least") + 1
    weight = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x["df"])
    return store(found.join(sizes, "rep").where(first > 0).select(
        "rep", "n_shingles", "least", weight.alias("weight"), F.col("v.token").alias("window"),
        F.slice("v.token", F.lit(1), first.cast("int")).alias("prefix")), "shared")


def _texts(store: _Store, name: str, reps: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, text) of some classes.  A filter of their keys leaves all other
    texts where they are."""
    keys = store(classes.select("rep", "first.doc_id", "first.text_hash").join(reps, "rep", "left_semi"), f"{name}_keys")
    held = docs.where(among(keys, "text_hash")).groupBy("doc_id", "text_hash").agg(F.first("text").alias("text"))
    return store(held.join(keys, ["doc_id", "text_hash"]).select("rep", "text"), name)


def _links(store: _Store, classes: DataFrame, docs: DataFrame, n: int, threshold_pct: int,
           group_rows: int) -> DataFrame:
    """Links (a, b) between classes that make the components of all links."""
    spark = docs.sparkSession
    shared = _shared_tokens(store, classes, threshold_pct)
    posted = shared.select("rep", "weight", F.explode("prefix").alias("token"))
    hub = F.max(F.struct("weight", (-F.col("rep")).alias("minus_rep")))["minus_rep"]
    lists = store(posted.groupBy("token").agg(F.count("*").alias("members"), (-hub).alias("hub"))
                  .where("members > 1"), "lists")
    near = posted.join(lists, "token").groupBy("rep").agg(F.max(F.struct("members", "token", "hub"))["hub"].alias("hub"))
    near = store(near, "near")

    # a class and its hub: first the bound on their windows, then the sets
    own = shared.select("rep", "n_shingles", "least", "window")
    of_hub = own.select(*[F.col(c).alias(f"hub_{c}" if c != "rep" else "hub") for c in own.columns])
    pairs = near.where("rep <> hub").join(own, "rep").join(of_hub, "hub").where(
        100 * F.least("n_shingles", "hub_n_shingles") >= threshold_pct * F.greatest("n_shingles", "hub_n_shingles"))
    pairs = pairs.where(F.size(F.array_intersect("window", "hub_window")) >= F.greatest("least", "hub_least"))
    pairs = store(pairs.select("rep", "hub"), "hub_pairs")
    texts = _texts(store, "hub_texts", pairs.select(F.explode(F.array("rep", "hub")).alias("rep")), classes, docs)
    links = (pairs.join(texts, "rep").join(texts.select(F.col("rep").alias("hub"), F.col("text").alias("hub_text")), "hub")
             .where(_linked(n, threshold_pct)("text", "hub_text")).select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    links = store(links, "hub_links")
    labels = store(connected(spark, near.select(F.col("rep").alias("node")), links), "components")

    counts = store(near.groupBy("hub").agg(F.ceil(F.count("*") / group_rows).alias("chunks")), "chunks")
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "rep"), F.col("chunks"))
    sizes = shared.select("rep", "n_shingles")
    members = near.join(counts, "hub").join(labels, near["rep"] == labels["node"]).join(sizes, "rep").select(
        F.xxhash64("hub", chunk).alias("group"), "rep", "n_shingles", "component", (F.col("rep") == F.col("hub")).alias("is_hub"))
    members = store(members, "members")
    spans = store(members.groupBy("group").agg(
        F.min("component").alias("c_min"), F.max("component").alias("c_max"),
        ((F.count("*") == 2) & F.bool_or("is_hub")).alias("done")), "spans")
    members = members.drop("is_hub")

    of_group = members.select("rep", "group")
    matrix = store(posted.select("rep", "token").join(of_group, "rep").select("token", "group").distinct()
                   .join(spans.drop("done"), "group"), "matrix")
    other = matrix.select("token", *[F.col(c).alias(f"{c}_2") for c in ("group", "c_min", "c_max")])
    one = "c_min = c_max and c_min_2 = c_max_2 and c_min = c_min_2"
    pairs = matrix.join(other, "token").where(f"group < group_2 and not ({one})").select(
        F.col("group").alias("low"), F.col("group_2").alias("high")).distinct()
    # of a hub and one more member, the only pair has been decided
    inner = spans.where("c_min <> c_max and not done").select(F.col("group").alias("low"), F.col("group").alias("high"))
    pairs = store(pairs.union(inner), "pairs")

    sides = pairs.withColumn("group", F.col("low")).union(
        pairs.where("low <> high").withColumn("group", F.col("high")))
    tiles = sides.join(members, "group").join(shared.select("rep", "window"), "rep")
    tile = "low long, high long, group long, rep long, component long, n_shingles long"
    opened = store(tiles.groupBy("low", "high").applyInArrow(_qualifying(threshold_pct), tile), "opened")
    texts = _texts(store, "tile_texts", opened.select("rep"), classes, docs)
    found = opened.join(texts, "rep").groupBy("low", "high").applyInArrow(
        _compared(n, threshold_pct), "a long, b long")
    return store(links.union(found), "links")


def jaccard_components(docs: DataFrame, n: int = 5, threshold_pct: int = 80, *, id_col: str = "doc_id",
                       text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (size of its set) and
    component_id, the smallest doc_id reachable over links (100 * |A n B| >=
    ``threshold_pct`` * |A u B|), itself included."""
    store = _Store(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    signed = docs.withColumn("s", sign(n, threshold_pct)("text")).select("doc_id", "text_hash", "s.*")
    base = store(signed, "signed")
    filled = base.where("n_shingles > 0 and doc_id is not null")
    classes = filled.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("window").alias("window"))
    classes = store(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    links = _links(store, classes, docs, n, threshold_pct, group_rows)
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = store(connected(docs.sparkSession, ends, links), "labels")
    grouped = classes.select("rep", "set_a", "set_b", "n_shingles", F.col("first.doc_id").alias("least")).join(
        labels, F.col("rep") == labels["node"])
    grouped = store(grouped.drop("node"), "grouped")
    least = store(grouped.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    linked = grouped.join(least, "component").select("set_a", "set_b", "n_shingles", "component_id")
    # classes without a link are one component each
    lone = classes.join(grouped.select("rep"), "rep", "left_anti").select(
        "set_a", "set_b", "n_shingles", F.col("first.doc_id").alias("component_id"))
    of_class = store(linked.union(lone), "of_class")
    rows = base.select("doc_id", "set_a", "set_b", "n_shingles")
    out = store(rows.join(of_class, ["set_a", "set_b", "n_shingles"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")), "result")
    store.remove_all_but("result")
    return out
