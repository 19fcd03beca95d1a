import random

import numpy as np
import pytest
from helpers import components, shingles

from rowforge.llm.group_join import jaccard_components, required, window_overlap
from test_near_dedup import SCHEMA, made


def families(seed=11):
    """Near copies around the threshold, and many texts that share a passage
    without being alike."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.choices(words, k=40)
    texts = []
    for size in (12, 30, 60, 140):
        base = rng.choices(words, k=size)
        for k in range(24):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + size // 40)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy if k % 5 else copy + ["more"]))
    texts += [" ".join(passage + rng.choices(words, k=rng.randint(0, 60))) for _ in range(40)]
    texts += ["the same text of eight words here now"] * 6 + [None, "", " \t", "a", "A", "a b", "Ä b", "ä b"]
    rng.shuffle(texts)
    return dict(enumerate(texts, 1))


def test_windows_keep_every_link():
    """f never rises faster than the required overlap; windows of linked sets
    share at least f of either."""
    for pct in (60, 80, 90):
        r = required(np.arange(1, 4000), pct)
        assert (np.diff(window_overlap(r)) <= np.diff(r)).all() and (np.diff(window_overlap(r)) >= 0).all()
    rng = random.Random(2)
    for _ in range(300):
        base = rng.sample(range(10 ** 6), rng.randint(1, 400))
        a = sorted(base)
        b = sorted(set(rng.sample(base, max(1, int(len(base) * rng.uniform(.85, 1))))) | {
            rng.randrange(10 ** 6) for _ in range(rng.randint(0, 1 + len(base) // 20))})
        both = len(set(a) & set(b))
        if 100 * both >= 90 * (len(a) + len(b) - both):
            cut = [set(s[:len(s) - required(len(s), 90) + int(window_overlap(required(len(s), 90)))]) for s in (a, b)]
            assert len(cut[0] & cut[1]) >= max(window_overlap(required(len(s), 90)) for s in (a, b))


@pytest.mark.parametrize("texts, n, pct, rows", [(made(), 3, 90, 256), (families(), 3, 90, 4), (families(5), 5, 80, 16)])
def test_against_all_pairs(spark, texts, n, pct, rows):
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in texts.items()], SCHEMA)
    got = jaccard_components(docs, n, pct, group_rows=rows).collect()
    parent, size = components(texts, n, pct)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == size
    assert {r["doc_id"]: r["component_id"] for r in got} == parent


def test_near_misses_in_one_large_family(spark):
    """Every two of these share most tokens and no two link: nothing is
    decided by a hub, all tiles are opened."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(100)]
    texts = {}
    for i in range(1, 61):
        copy = list(base)
        for at in rng.sample(range(5, 95), 2):
            copy[at] = f"own{i}x{at}"
        texts[i] = " ".join(copy)
    texts[61] = texts[7].replace("w99", "end")
    parent, _ = components(texts, 3, 90)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs, 3, 90, group_rows=8).collect()}
    assert got == parent and 1 < len(set(got.values())) < 61


def test_null_and_repeated_rows(spark):
    a, b = "a b c d e f", "q r s t u v w"
    rows = [(None, a), (None, a), (5, a), (5, a), (3, a.upper()), (5, b), (4, None), (9, b), (9, b)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)
    got = sorted(map(tuple, jaccard_components(docs, 3, 90).collect()), key=str)
    want = [(None, 4, None)] * 2 + [(5, 4, 3)] * 2 + [(3, 4, 3), (5, 5, 5), (4, 0, 4)] + [(9, 5, 5)] * 2
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    out = jaccard_components(spark.createDataFrame([], SCHEMA), 3, 90)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_very_long_text(spark):
    rng = random.Random(1)
    words = [str(rng.random()) for _ in range(60_000)]
    near = list(words)
    near[100:200] = ["other"] * 100
    texts = {1: " ".join(words), 2: " ".join(near), 3: "x" * 300_000, 4: " ".join(words[:50_000])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(docs, 3, 90).collect()}
    assert got == {i: (len(shingles(t, 3)), min(i, {2: 1}.get(i, i))) for i, t in texts.items()}
