"""Spelling variants: words one edit apart, each variant with its usual form.

Words are maximal runs of the letters ``A-Z a-z \\u00C0-\\u00FF`` of whole texts with
A-Z lower-cased, of at least ``MIN_LENGTH`` code points and ``MIN_COUNT``
occurrences.  Two are near if they differ by exactly one inserted, deleted or
replaced code point.  A word's form is its near word of the most occurrences
(ties: smallest in code-point order), if these are at least ``RATIO`` times its own;
its root is the last word that following forms leads to.

Method (Bloom-guided neighbourhoods): the vocabulary is counted with a partial
count inside each task, and hashed into blocked Bloom filters, one per word length,
which are or-ed together in Spark and broadcast.  Their size is bounded by
``bloom.FILTER_BYTES``, whatever the vocabulary: beyond it there are more
false positives, never a lost word.  Every word generates its neighbourhood: all its
deletions, and all replacements by a greater letter (insertions and replacements by
a smaller letter are the same pairs seen from the other word).  Candidates are
hashed from the word's prefix and suffix sums, without making the strings, and
probed against the filter of their length; only positives become strings and are
shuffled to an exact join with the vocabulary, which removes false positives.

Edge cases: null and empty texts have no words; words longer than
``LONGEST`` share one filter and are probed in slices of positions; repeated rows
count as often as they occur; a table without such words gives an empty result;
other columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm import bloom
from rowforge.llm.shingles import mix
from rowforge.session import remove_path, scratch_path

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
#: The letters of words after lower-casing A-Z.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: Words of a task counted in memory before they are handed on.
HELD_WORDS = 200_000
LONGEST = 64
#: Candidates hashed at a time.
PROBES = 1 << 20

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _counted(min_length: int, change: Callable | None):
    run = re.compile("[a-zÀ-ÿ]{%d,}" % max(1, min_length))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def batch():
            out = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                             ["word", "n"])
            total.clear()
            return out

        for b in batches:
            for doc, text in zip(b.column(0), b.column(1)):
                text = text.as_py()
                if not text:
                    continue
                lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                found = Counter(run.findall(lower))
                if change:
                    found = change(doc.as_py(), found)
                for word, n in found.items():
                    if len(word) >= min_length:
                        total[word] += n
                if len(total) >= HELD_WORDS:
                    yield batch()
        if total:
            yield batch()
    return counted


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               change: Callable | None = None) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text).  ``change``, if given,
    maps (doc_id, Counter of a text's runs of at least ``min_length``) to the
    Counter that is to be used."""
    counts = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _counted(min_length, change), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _code_points(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions in the batch, matrix of code points) per word length."""
    words = words.to_pylist()
    length = np.array([len(w) for w in words], np.int64)
    for n in np.unique(length):
        at = np.flatnonzero(length == n)
        flat = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), np.uint32)
        yield at, flat.reshape(len(at), n)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(0, n - 1), base)]), dtype=np.uint64)


def _terms(codes: np.ndarray) -> np.ndarray:
    """What each letter adds to its word's hash."""
    return mix(codes.astype(np.uint64) + np.uint64(1)) * _powers(_P, codes.shape[1])


def _shard(length: int) -> int:
    return min(int(length), LONGEST)


def _masks(blocks: dict[int, int]):
    def masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, codes in _code_points(b.column(0)):
                shard = _shard(codes.shape[1])
                yield bloom.bits(shard, _terms(codes).sum(axis=1, dtype=np.uint64), blocks[shard])
    return masks


def filters_of(words: DataFrame, filter_bytes: int = bloom.FILTER_BYTES) -> dict[int, np.ndarray]:
    """The Bloom filter of every word length."""
    shard = F.least(F.length("word"), F.lit(LONGEST))
    sizes = {r["shard"]: r["n"] for r in words.groupBy(shard.alias("shard")).agg(F.count("*").alias("n")).collect()}
    blocks = bloom.blocks_of(sizes, filter_bytes)
    return bloom.merged(words.select("word").mapInArrow(_masks(blocks), bloom.BITS), blocks)


def neighbourhood(codes: np.ndarray, filters: dict[int, np.ndarray]) -> Iterator[tuple[int, str]]:
    """(row, candidate) of the deletions and greater replacements of words of
    one length that the filters may hold.  Candidates of a row are distinct."""
    rows, n = codes.shape
    letters = np.array(LETTERS, np.uint32)
    values = mix(letters.astype(np.uint64) + np.uint64(1))
    power = _powers(_P, n)
    step = max(1, PROBES // (n * len(letters)))
    for first in range(0, rows, step):
        part = codes[first:first + step]
        terms = _terms(part)
        total = terms.sum(axis=1, dtype=np.uint64)
        if _shard(n - 1) in filters:
            before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
            gone = before + (total[:, None] - before - terms) * _P_INVERSE
            # of equal letters side by side only the first: the result is the same
            able = np.concatenate([np.ones((len(part), 1), bool), part[:, 1:] != part[:, :-1]], axis=1)
            i, j = np.nonzero(able)
            hit = bloom.positive(gone[i, j], filters[_shard(n - 1)])
            for r, k in zip(i[hit].tolist(), j[hit].tolist()):
                yield first + r, _text(np.delete(part[r], k))
        if _shard(n) in filters:
            width = max(1, PROBES // (len(part) * len(letters)))
            for a in range(0, n, width):
                cut = part[:, a:a + width]
                i, j, c = np.nonzero(letters > cut[:, :, None])
                changed = (total[:, None] - terms[:, a:a + width])[i, j] + values[c] * power[a + j]
                hit = bloom.positive(changed, filters[_shard(n)])
                for r, k, x in zip(i[hit].tolist(), j[hit].tolist(), c[hit].tolist()):
                    word = part[r].copy()
                    word[a + k] = letters[x]
                    yield first + r, _text(word)


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le")


def _probed(filters):
    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, codes in _code_points(b.column(0)):
                row, found = [], []
                for r, candidate in neighbourhood(codes, filters.value):
                    row.append(r)
                    found.append(candidate)
                own = pa.array(at[np.array(row, np.int64)])
                yield pa.RecordBatch.from_arrays([b.column(0).take(own), b.column(1).take(own),
                                                  pa.array(found, pa.string())], ["word", "n", "near"])
    return probed


def variants(words: DataFrame, ratio: int = RATIO, filter_bytes: int = bloom.FILTER_BYTES) -> DataFrame:
    """A vocabulary (word, n) -> word, form, root, n, n_near, form_n."""
    spark = words.sparkSession
    base = scratch_path(spark, "spelling")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    words = stored(words.select("word", "n"), "words")
    filters = spark.sparkContext.broadcast(filters_of(words, filter_bytes))
    positives = words.mapInArrow(_probed(filters), "word string, n long, near string")
    pairs = positives.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    pairs = stored(pairs, "pairs")
    both = pairs.select("word", "n", "near", "near_n").union(pairs.select("near", "near_n", "word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near"))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    usual = -F.col("best.minus_n") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(usual, F.col("best.near")).alias("form"), F.when(usual, -F.col("best.minus_n")).alias("form_n"))
    formed = stored(formed, "formed")
    # of the words that have a form: the last word so far, which doubles its way each time
    last, k = formed.where("form is not null").select("word", F.col("form").alias("root")), 0
    while True:
        further = last.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = stored(last.join(further, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), f"roots{k}")
        last, k = step.select("word", "root"), k + 1
        if not step.where("moved").limit(1).count():
            break
    out = stored(formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "result")
    for name in ("words", "pairs", "formed", *[f"roots{i}" for i in range(k)]):
        remove_path(spark, f"{base}/{name}")
    return out
