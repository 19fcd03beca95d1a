"""Exact nearest neighbours by a blocked int8 matrix join.

Method: vectors are dealt into blocks by a hash of their id, and each block of
queries meets each block of candidates.  There, vectors are quantised to int8
(one scale per vector), and for each tile of the product matrix an int8
product gives every inner product with a bound on its error, since

    |<q, c> - <q', c'>| <= |q - q'| * |c| + |q'| * |c - c'|

and only pairs whose upper bound reaches the k-th best lower bound of their
query (or what the query's heap already holds) are recomputed in double
precision.  All tiles of a pair of blocks share the queries' heaps, and the
heaps of different candidate blocks are merged by a ranked window.

The answer is exact: bounds only ever rule out pairs that cannot be among
the k best.  Ties go to the smaller id.  Queries are a stated set that meets
all rows in blocks; work grows as queries times rows.

Edge cases: vectors that are null, zero, empty or hold null or non-finite
components take no part, nor do rows without an id; vectors of different
lengths meet only their own length; repeated ids are separate rows (a query's
own id is never its neighbour).  Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

QUERY_ROWS, CANDIDATE_ROWS = 4096, 8192     # rows per block
TILE = (256, 4096)                          # of a product
SURVIVORS = 1 << 18      # pairs recomputed at a time
#: Relative slack of the bounds for rounding in their own arithmetic.
SLACK = 1e-9

_NEAR = "query_id long, vec_id long, score double"


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector, dims) of the rows that take part."""
    v = F.col(vector_col)
    if rows.schema[vector_col].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (rows.where(sound & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"), F.size(v).alias("dims")))


def _quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale per vector, length of the quantisation error)."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = 1.0  # of subnormal vectors; the error holds all of it
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(vectors - codes * scale[:, None], axis=1)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added component by component."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * c[:, d]
    return total


def _tile(heaps: list[list], q_ids, q, q_quant, c_ids, c, c_quant, k: int) -> None:
    q_codes, q_scale, q_error = q_quant
    c_codes, c_scale, c_error = c_quant
    # whole numbers below 2 ** 24 up to 1040 dimensions: exact in float32
    kind = np.float32 if q.shape[1] <= 1040 else np.float64
    rough = (q_codes.astype(kind) @ c_codes.T.astype(kind)).astype(np.float64)
    rough *= q_scale[:, None] * c_scale
    q_len, c_len = np.linalg.norm(q, axis=1), np.linalg.norm(c, axis=1)
    error = q_error[:, None] * c_len + (q_len + q_error)[:, None] * c_error
    error += SLACK * (1 + q_len[:, None] * c_len)
    other = q_ids[:, None] != c_ids
    low = np.nan_to_num(np.where(other, rough - error, -np.inf), nan=-np.inf)
    floor = np.partition(low, len(c) - k, axis=1)[:, len(c) - k] if len(c) > k else np.full(len(q), -np.inf)
    held = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    rows, cols = np.nonzero(other & ~(rough + error < np.maximum(floor, held)[:, None]))
    for a in range(0, len(rows), SURVIVORS):
        i, j = rows[a:a + SURVIVORS], cols[a:a + SURVIVORS]
        score = _exact(q[i], c[j])
        # of each query's survivors the k best enter its heap
        order = np.lexsort((c_ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, i, side="left")
        best = np.arange(len(i)) - first < k
        for r, s, v in zip(i[best].tolist(), score[best].tolist(), c_ids[j[best]].tolist()):
            if len(heaps[r]) < k:
                heapq.heappush(heaps[r], (s, -v))
            elif (s, -v) > heaps[r][0]:
                heapq.heapreplace(heaps[r], (s, -v))


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vectors = rows.column("vector").combine_chunks().flatten().to_numpy().astype(np.float64)
    return rows.column("vec_id").to_numpy(), vectors.reshape(rows.num_rows, -1)


def _search(k: int):
    def search(asked: pa.Table, candidates: pa.Table) -> pa.Table:
        """A query block against a candidate block, in tiles that share the
        queries' heaps."""
        heaps: list[list] = [[] for _ in range(asked.num_rows)]
        q_ids = np.zeros(0, np.int64)
        if asked.num_rows and candidates.num_rows:
            q_ids, q = _matrix(asked)
            ids, vectors = _matrix(candidates)
            q_quant, c_quant = _quantised(q), _quantised(vectors)
            for a in range(0, len(ids), TILE[1]):
                there = slice(a, a + TILE[1])
                for b in range(0, len(q_ids), TILE[0]):
                    here = slice(b, b + TILE[0])
                    _tile(heaps[here], q_ids[here], q[here], tuple(x[here] for x in q_quant),
                          ids[there], vectors[there], tuple(x[there] for x in c_quant), k)
        n = [len(h) for h in heaps]
        flat = [x for h in heaps for x in h]
        return pa.table({"query_id": pa.array(np.repeat(q_ids, n) if len(q_ids) else [], pa.int64()),
                         "vec_id": pa.array([-v for _, v in flat], pa.int64()),
                         "score": pa.array([s for s, _ in flat], pa.float64())})
    return search


def _dealt(rows: DataFrame, block: str, count: int, size: int) -> DataFrame:
    """Rows with their block number, by a hash of the id."""
    return rows.withColumn(block, F.pmod(F.xxhash64("vec_id"), F.lit(_blocks(count, size))).cast("int"))


def _blocks(count: int, size: int) -> int:
    return max(1, -(-count // size))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, *, id_col: str = "vec_id",
            vector_col: str = "embedding", query_rows: int = QUERY_ROWS,
            candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """The k candidates of largest inner product for every query: query_id,
    rank (from 1), vec_id, score."""
    asked, held = usable(queries, id_col, vector_col), usable(vectors, id_col, vector_col)
    n_asked, n_held = asked.count(), held.count()
    # every query goes to each candidate block, every candidate to each query block
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = _dealt(asked, "q_block", n_asked, query_rows).withColumn("c_block", each(_blocks(n_held, candidate_rows)))
    held = _dealt(held, "c_block", n_held, candidate_rows).withColumn("q_block", each(_blocks(n_asked, query_rows)))
    meet = ["dims", "q_block", "c_block"]
    found = (asked.groupBy(*meet).cogroup(held.groupBy(*meet))
             .applyInArrow(_search(k), _NEAR))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
