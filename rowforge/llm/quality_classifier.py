"""Document quality from random-indexing word vectors.

Method: every word of the vocabulary has a sparse random index vector; a
word's own vector is the sum of the index vectors of its neighbours in all texts
(two to either side), centred and scaled to length one.  The
vectors of a document's words are averaged, and a network of two layers gives
the probability of label 1, divided in the logit by a temperature that is
fitted on rows the network has not seen.

Words are runs of letters, of digits, or of other non-blank characters.  All
runs of digits are one word, as are all words in capitals (two letters or more)
and all that repeat the word before; a word outside the vocabulary falls into
one of ``SPARE`` classes by its hash.

Vocabulary (the ``VOCABULARY`` most frequent words) and word vectors are counted
over all texts; no label is read for them.  The network and its temperature are
fitted on a bounded sample of about ``TRAIN_ROWS`` labelled ids, chosen by a hash.
The driver gets the vocabulary, its summed vectors and one vector per training row.

Edge cases: a null or empty text is the zero vector and gets the network's
score for that; without a labelled row every score is 0.5; an id with several
labels counts once, with the more frequent one (ties: 1), and an id with several
texts with the smallest.  Existing columns called score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm.characters import code_slices, letter_table
from rowforge.llm.shingles import _weights, mix
from rowforge.session import remove_path, scratch_path

TRAIN_ROWS = 6000
VOCABULARY = 20000
SPARE = 256
DIMS = 64
REACH = 2                # neighbours to either side
HIDDEN = 32
SLICE_BYTES = 1 << 20
STRETCH = 50_000
HELD_WORDS = 1 << 20

COMPONENTS = [f"d{i}" for i in range(DIMS)]

NUMBER, CAPITALS, AGAIN = (np.uint64(x) for x in (1, 2, 3))


def word_codes(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit code per word in order, first word index per row + total)."""
    table = letter_table()
    low = table[codes]
    kind = np.where(low > 0, 1, 3).astype(np.int8)
    small = codes < 0x3001
    blank = np.zeros(0x3001, bool)
    blank[[i for i in range(0x3001) if chr(i).isspace()]] = True
    digit = np.zeros(0x3001, bool)
    digit[[i for i in range(0x3001) if chr(i).isnumeric()]] = True
    near = np.where(small, codes, 0)
    kind[small & blank[near]] = 0
    kind[small & digit[near] & (low == 0)] = 2
    opens = np.ones(len(codes), bool)
    opens[1:] = kind[1:] != kind[:-1]
    opens[rows[:-1][rows[:-1] < len(codes)]] = True
    opens &= kind > 0
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(rows), np.int64)
    solid = np.flatnonzero(kind)
    owner = np.cumsum(opens)[solid] - 1
    inside = solid - starts[owner]
    heads = np.searchsorted(solid, starts)
    value = np.where(low > 0, low, codes)[solid].astype(np.uint64)
    weight = _weights(1 << max(8, int(inside.max()).bit_length()))
    words = mix(np.add.reduceat((value + np.uint64(1)) * weight[inside], heads)) | np.uint64(4)
    letters = kind[starts] == 1
    capital = np.add.reduceat((codes[solid] != low[solid]).astype(np.int32), heads)
    length = np.diff(np.append(heads, len(solid)))
    words[kind[starts] == 2] = NUMBER
    first = np.searchsorted(starts, rows)
    again = np.zeros(len(words), bool)
    again[1:] = letters[1:] & (words[1:] == words[:-1])
    again[first[:-1][first[:-1] < len(words)]] = False
    words[letters & (capital == length) & (length > 1)] = CAPITALS
    words[again] = AGAIN
    return words, first


def _tokens(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for codes, rows in code_slices(texts, SLICE_BYTES):
        yield word_codes(codes, rows)


def _numbered(words: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Row of the vector table for each word."""
    if not len(vocabulary):
        return (words % np.uint64(SPARE)).astype(np.int64)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    spare = len(vocabulary) + (words % np.uint64(SPARE)).astype(np.int64)
    return np.where(vocabulary[at] == words, at, spare)


def _index_vectors(n: int) -> np.ndarray:
    """Sparse random vectors: each component is -1 or 1 with 1/16 chance each."""
    draw = np.random.default_rng(20240229).integers(0, 16, (n, DIMS), dtype=np.int8)
    return (draw == 0).astype(np.int8) - (draw == 1).astype(np.int8)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of one task's rows with counts; a word comes again after ``HELD_WORDS`` others."""
    held, n_held = [], 0

    def added() -> pa.RecordBatch:
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        n = np.bincount(at, np.concatenate([c for _, c in held]), len(keys)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["word", "n"])

    for batch in batches:
        for words, _ in _tokens(batch.column("text")):
            held.append(np.unique(words, return_counts=True))
            n_held += len(held[-1][0])
            if n_held > HELD_WORDS:
                yield added()
                held, n_held = [], 0
    if held:
        yield added()


def _neighbour_sums(ids: np.ndarray, first: np.ndarray, index: np.ndarray, total: np.ndarray) -> None:
    """Adds the index vectors of each word's neighbours in its own row to the word's total."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for a in range(0, len(ids), STRETCH):
        b = min(a + STRETCH, len(ids))
        lo, hi = max(0, a - REACH), min(len(ids), b + REACH)
        own, vectors = row[lo:hi], index[ids[lo:hi]]
        near = np.zeros_like(vectors)
        for step in range(1, REACH + 1):
            same = (own[step:] == own[:-step])[:, None]
            near[:-step] += vectors[step:] * same
            near[step:] += vectors[:-step] * same
        order = np.argsort(ids[a:b], kind="stable")
        word = ids[a:b][order]
        heads = np.flatnonzero(np.diff(word, prepend=-1))
        total[word[heads]] += np.add.reduceat(near[a - lo:b - lo][order], heads, axis=0, dtype=np.int64)


def _contexts(batches: Iterator[pa.RecordBatch], vocabulary: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The summed neighbour vectors of one task's rows, a row per word and a column per component."""
    index = _index_vectors(len(vocabulary) + SPARE)
    total = np.zeros(index.shape, np.int64)
    for batch in batches:
        for words, first in _tokens(batch.column("text")):
            _neighbour_sums(_numbered(words, vocabulary), first, index, total)
    found = np.flatnonzero(total.any(axis=1))
    yield pa.RecordBatch.from_arrays([pa.array(found), *[pa.array(c) for c in total[found].T.copy()]],
                                     ["word", *COMPONENTS])


def pooled(texts: pa.Array, vocabulary: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The mean word vector of each row; zero for a row without words."""
    out = []
    for words, first in _tokens(texts):
        ids = _numbered(words, vocabulary)
        sums = np.zeros((len(first) - 1, vectors.shape[1]))
        # a slice of words at a time; a row over a border adds up its parts
        for a in range(0, len(ids), 100_000):
            part = vectors[ids[a:a + 100_000]]
            row = np.searchsorted(first, np.arange(a, a + len(part)), side="right") - 1
            heads = np.flatnonzero(np.diff(row, prepend=-1))
            sums[row[heads]] += np.add.reduceat(part, heads, axis=0)
        out.append(sums / np.maximum(np.diff(first), 1)[:, None])
    return np.concatenate(out) if out else np.zeros((0, vectors.shape[1]))


@dataclass(frozen=True)
class QualityModel:
    vocabulary: np.ndarray
    vectors: np.ndarray
    layers: tuple[np.ndarray, ...]      # input shift, input scale, W1, b1, W2, b2
    temperature: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(_logit(self.layers, x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _logit(layers: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    shift, scale, w1, b1, w2, b2 = layers
    return np.tanh((x - shift) * scale @ w1 + b1) @ w2 + b2


def fit_network(x: np.ndarray, y: np.ndarray, *, epochs: int = 60, batch: int = 128, rate: float = 0.01,
                decay: float = 1e-4, seed: int = 11) -> tuple[np.ndarray, ...]:
    """Two layers by Adam on the log-loss."""
    rng = np.random.default_rng(seed)
    shift, scale = x.mean(axis=0), 1 / (x.std(axis=0) + 1e-6)
    z = (x - shift) * scale
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
         rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    mean, square, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
    for epoch in range(epochs):
        order = rng.permutation(len(z))
        for a in range(0, len(z), batch):
            i = order[a:a + batch]
            h = np.tanh(z[i] @ p[0] + p[1])
            g = (_sigmoid(h @ p[2] + p[3]) - y[i]) / len(i)
            back = np.outer(g, p[2]) * (1 - h * h)
            grads = [z[i].T @ back + decay * p[0], back.sum(axis=0), h.T @ g + decay * p[2], np.array([g.sum()])]
            step += 1
            for w, d, m, s in zip(p, grads, mean, square):
                m += 0.1 * (d - m)
                s += 0.001 * (d * d - s)
                w -= rate * (1 - epoch / epochs) * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return (shift, scale, *p)


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log-loss on a grid from 0.25 to 16."""
    grid = np.geomspace(0.25, 16, 97)
    loss = [np.logaddexp(0, np.where(y > 0, -logits, logits) / t).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS) -> QualityModel:
    """Fit on documents that have a 0 or 1 label (see the module's bound)."""
    spark = docs.sparkSession
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(
        "id is not null and y in (0, 1)").groupBy("id").agg(F.round(F.avg("y")).cast("int").alias("y"))
    share = min(1.0, rows / max(1, marked.count()))
    drawn = F.pmod(F.xxhash64(F.lit("quality sample"), "id"), F.lit(1 << 20)) / float(1 << 20)
    sample = marked.where(drawn < share)  # about ``rows`` rows at any size
    path = scratch_path(spark, "quality", "sample")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    texts.join(F.broadcast(sample), "id").groupBy("id", "y").agg(F.min("text").alias("text")).write.parquet(path)
    sample, text = spark.read.schema("id long, y int, text string").parquet(path), texts.select("text")

    top = (text.mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .where("n > 2").orderBy(F.desc("n"), "word").limit(VOCABULARY))
    vocabulary = np.sort(np.array([r["word"] for r in top.collect()], np.int64).view(np.uint64))
    held = spark.sparkContext.broadcast(vocabulary)
    sums = (text.mapInArrow(lambda b: _contexts(b, held.value), ", ".join(f"{c} long" for c in ["word", *COMPONENTS]))
            .groupBy("word").agg(*[F.sum(c).alias(c) for c in COMPONENTS]).toArrow())
    vectors = np.zeros((len(vocabulary) + SPARE, DIMS))
    vectors[sums.column("word").to_numpy()] = np.stack([sums.column(c).to_numpy() for c in COMPONENTS], axis=1)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    vectors -= vectors.mean(axis=0)
    vectors = (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)
    table = spark.sparkContext.broadcast((vocabulary, vectors))
    pool = F.arrow_udf(lambda texts: pa.array([v.tobytes() for v in pooled(texts, *table.value)], pa.binary()), "binary")
    seen = sample.select("id", "y", pool("text").alias("x")).orderBy("id", "y").collect()
    remove_path(spark, path)
    if not seen:
        zero = np.zeros(DIMS)
        return QualityModel(vocabulary, vectors, (zero, zero, np.zeros((DIMS, HIDDEN)), np.zeros(HIDDEN),
                                                  np.zeros(HIDDEN), np.zeros(1)), 1.0)
    x = np.array([np.frombuffer(r["x"]) for r in seen])
    y = np.array([r["y"] for r in seen], float)
    apart = np.arange(len(y)) % 5 == 4
    layers = fit_network(x[~apart], y[~apart]) if (~apart).any() else fit_network(x, y)
    temperature = fit_temperature(_logit(layers, x[apart]), y[apart]) if apart.any() else 1.0
    return QualityModel(vocabulary, vectors, layers, temperature)


def score(docs: DataFrame, model: QualityModel, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of label 1."""
    # vocabulary x DIMS floats; plain arrays, so that workers need no import
    held = docs.sparkSession.sparkContext.broadcast(
        (model.vocabulary, model.vectors, model.layers, model.temperature))

    def scored(texts: pa.Array) -> pa.Array:
        m = QualityModel(*held.value)
        return pa.array(m.probability(pooled(texts, m.vocabulary, m.vectors)), pa.float64())

    return docs.withColumn("score", F.arrow_udf(scored, "double")(F.col(text_col).cast("string")))


def is_held_out(id_col: str = "doc_id"):
    """The fold whose labels are never read."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
