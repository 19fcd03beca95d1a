import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from rowforge.llm import bloom, queries
from rowforge.llm.spelling_variants import LETTERS, filters_of, neighbourhood, variants, vocabulary

SCHEMA = "doc_id long, text string, word string, n string, form int"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words_of(rows):
    out = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(words):
    """word -> (form, root, n, n_near, form_n), by comparing all pairs."""
    out = {}
    for w, n in words.items():
        about = [v for v in words if v != w and near(v, w)]
        best = min(about, key=lambda v: (-words[v], v), default=None)
        out[w] = (best if best and words[best] >= 5 * n else None, len(about))
    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w
    return {w: (form, root(w), words[w], k, words[form] if form else None) for w, (form, k) in out.items()}


def made(seed):
    rng = random.Random(seed)
    letters = [chr(c) for c in LETTERS]
    base = ["".join(rng.choices(letters[:6] + ["é", "ß", "ÿ", "À"], k=rng.randint(6, 9))) for _ in range(40)]
    base += ["aaaaaaa", "aaaaaa", "abababab", "bababa", "x" * 80, "x" * 81, "y" * 70 + "z", "y" * 71]
    counts = Counter()
    for w in base:
        counts[w] += rng.choice([5, 30, 200])
        for _ in range(rng.randint(0, 6)):
            k, x = rng.randrange(len(w)), rng.choice(letters)
            v = rng.choice([w[:k] + w[k + 1:], w[:k] + x + w[k + 1:], w[:k] + x + w[k:]])
            counts[v] += rng.choice([1, 5, 6, 40])
    return counts


@pytest.mark.parametrize("seed, filter_bytes", [(1, bloom.FILTER_BYTES), (2, 64)])
def test_against_all_pairs(spark, seed, filter_bytes):
    """With filters that hold the words, and with ones that say yes to almost anything."""
    words = {w: n for w, n in made(seed).items() if n >= 5 and len(w) >= 6}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in variants(table, filter_bytes=filter_bytes).collect()}
    assert got == grouped(words)
    assert any(r[0] for r in got.values())


def test_chains_of_forms(spark):
    words = {"aaaaaa" + "b" * k: 5 ** (k + 1) for k in range(9)}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: (r["form"], r["root"]) for r in variants(table).collect()}
    last = "aaaaaa" + "b" * 8
    assert got == {w: (w + "b" if w != last else None, last) for w in words}


def test_neighbourhood_is_whole(spark):
    """A filter without a zero bit lets every candidate through, each once."""
    word = "aabcéÿ"
    codes = np.array([[ord(c) for c in word]], np.uint32)
    full = {n: np.full((1, bloom.LANES), 0xFFFFFFFF, np.uint32) for n in (5, 6)}
    got = [w for _, w in neighbourhood(codes, full)]
    want = {word[:i] + word[i + 1:] for i in range(6)} | {
        word[:i] + chr(x) + word[i + 1:] for i in range(6) for x in LETTERS if chr(x) > word[i]}
    assert len(got) == len(set(got)) and set(got) == want


def test_filters_lose_no_word_and_are_bounded(spark):
    words = spark.range(20_000).selectExpr("concat('word', translate(cast(id as string), '0123456789', 'abcdefghij')) AS word")
    for size in (bloom.FILTER_BYTES, 4096):
        filters = filters_of(words, size)
        assert sum(x.nbytes for x in filters.values()) <= size + 32 * len(filters)
    keys = spark.range(5000).selectExpr("xxhash64(id) AS k")
    rows = spark.range(50_000).selectExpr("id", "xxhash64(id) AS k").union(spark.sql("SELECT -1L, CAST(NULL AS BIGINT)"))
    got = [r["id"] for r in rows.where(bloom.among(keys, "k")).collect()]
    assert set(range(5000)) <= set(got) and -1 not in got and len(got) < 5500


def texts(seed=7):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(5, 8))) for _ in range(60)] + ["Éléphant", "STRASSE", "Straße"]
    rows = [(i, rng.choice([" ", "-", "\n", "7"]).join(rng.choices(words, k=rng.randint(0, 90)))) for i in range(150)]
    rows += [(None, "unknown " * 9)] * 2 + [(5, None), (6, ""), (7, "repeated repeaten ") , (7, "Repeated ")] + [(7, "repeated")] * 30
    return rows + [(8, "lengthy" * 20_000), (8, "verylong " * 50_000)]


def test_vocabulary(spark):
    rows = texts()
    docs = spark.createDataFrame([(*r, None, "x", 1) for r in rows], SCHEMA)
    got = {r["word"]: r["n"] for r in vocabulary(docs, change=queries.misspelt).collect()}
    assert got == words_of(rows)


def test_query_against_all_pairs(spark, scratch):
    rows = texts(9)
    path = scratch("documents")
    spark.createDataFrame([(*r, None, "x", 1) for r in rows], SCHEMA).write.parquet(f"{path}/documents.parquet")
    got = {r["word"]: tuple(r)[1:] for r in queries.op13_spelling_variants(spark, path).collect()}
    assert got == grouped(words_of(rows))


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    out = variants(vocabulary(docs))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
