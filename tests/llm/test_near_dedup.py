import random

import pytest
from helpers import components

from rowforge.llm.near_dedup import connected, matches_needed, near_duplicates, one_of_each

SCHEMA = "doc_id long, text string, component_id string, kept string, other int"


def made(seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choices(words, k=60))
    texts = []
    for _ in range(12):  # families of near copies, some of them large
        base = rng.choices(words, k=rng.randint(8, 120))
        for _ in range(rng.choice([1, 1, 2, 5, 14])):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
        texts.append(" ".join(base[: len(base) // 2]) + " " + passage)
    texts += [" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(10)]
    texts += ["", None, " \n\t ", "one", "ONE", "One  two", "one two", "Éa b c", "éa b c", "a b c", "a b c"]
    texts += [texts[0]] * 30 + [passage] * 3
    rng.shuffle(texts)
    return dict(enumerate(texts, 1))


@pytest.mark.parametrize("n, pct, short", [(3, 85, 2), (5, 80, 16)])
def test_against_all_pairs(spark, n, pct, short):
    texts = made()
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in texts.items()], SCHEMA)
    got = near_duplicates(docs, n, pct, short_list=short, chunk_rows=4).collect()
    parent, size = components(texts, n, pct)
    assert {r["doc_id"]: r["component_id"] for r in got} == parent
    assert {r["doc_id"]: r["n_shingles"] for r in got} == size
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "a b c d e f", None, None, None)] * 2 + [(5, "a b c d e f", None, None, None)] * 2 + [
        (3, "A b c D e f", None, None, None), (4, None, None, None, None)]
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).collect()), key=str)
    assert got == sorted([(None, 4, None, True)] * 2 + [(5, 4, 3, False)] * 2 + [(3, 4, 3, True), (4, 0, 4, True)],
                         key=str)


def test_empty_table(spark):
    out = near_duplicates(spark.createDataFrame([], SCHEMA), 3, 85)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101)], "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in [*range(1, 41), 100, 101, 200]], "node long")
    got = {r["node"]: r["component"] for r in connected(spark, nodes, links).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 200: 200}


def test_threshold_of_matches():
    assert matches_needed(0.85) == 37 and matches_needed(0.8) == 33
    assert matches_needed(0.0) == 1 and matches_needed(1.0) == 64


def test_very_long_text(spark):
    rng = random.Random(1)
    words = [str(rng.random()) for _ in range(60_000)]
    near = list(words)
    near[100:200] = ["other"] * 100
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, "x" * 300_000)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, 3, 85).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_reused_repeated_and_null_ids(spark):
    rng = random.Random(8)
    text = lambda: " ".join(f"v{rng.randrange(10_000)}" for _ in range(60))
    near = lambda t: " ".join(t.split()[:-1] + ["end"])
    a, b, c, d, e, lone = (text() for _ in range(6))
    rows = [(1, a), (7, a), (7, b),                       # an id with a copy and with a text of its own
            (5, c), (5, d), (9, near(c)), (9, near(d)),   # two groups of the same ids
            (4, e), (4, e), (4, e),                       # exact repeats
            (None, lone), (None, lone), (None, near(lone)), (None, e), (8, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "x", "y", k) for k, (i, t) in enumerate(rows)], SCHEMA)
    out = one_of_each(docs, 5, 80)
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert out.columns == docs.columns
    known = [r for r in got if r[0] is not None]
    assert sorted(known, key=str) == sorted([(1, a), (7, b), (5, c), (5, d), (4, e), (8, None), (8, "")], key=str)
    assert len(got) == len(known) + 1 and [t for i, t in got if i is None][0] in (lone, near(lone))
    judged = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs, 5, 80).collect()}
    assert {(1, 1, True), (7, 1, False), (7, 7, True), (5, 5, True), (9, 5, False)} <= judged
    assert (9, 9, True) not in judged and (5, 9, False) not in judged


def test_chance_of_a_missed_link_is_an_argument(spark):
    """A smaller chance asks for fewer matches; the links stay those of all pairs."""
    assert matches_needed(0.8, miss=1e-12) < matches_needed(0.8) < matches_needed(0.8, miss=1e-3)
    assert matches_needed(0.8, miss=0.0) == 1
    texts = dict(list(made(5).items())[:60])
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in texts.items()], SCHEMA)
    parent, _ = components(texts, 5, 80)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, 5, 80, miss=0.0, short_list=2).collect()}
    assert got == parent


def test_inner_tables_are_removed(spark, monkeypatch):
    from rowforge.llm import near_dedup
    from rowforge.session import names_in
    roots = []
    real = near_dedup.scratch_path
    monkeypatch.setattr(near_dedup, "scratch_path", lambda *a: roots.append(real(*a)) or roots[-1])
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e g"), (3, "a b c d e f")], "doc_id long, text string")
    assert near_duplicates(docs, 3, 85).count() == 3
    assert set(names_in(spark, roots[0])) == {"signed", "grouped"}
    assert all(len([n for n in names_in(spark, r) if n.startswith("labels")]) <= 1 for r in roots[1:])
