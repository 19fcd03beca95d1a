import os
import subprocess
import sys

import numpy as np
import pytest

from rowforge.llm import language_id as li

SF = "/root/testdata/sf0.001"
HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return li.train(docs.where(~li.is_held_out()))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(li.is_held_out())
    rows = li.identify(docs, model).select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_spans_of_mixed_text(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pick = {r["lang"]: r["text"][:600] for r in docs.where("length(text) > 700").collect()}
    text = pick["de"] + "\n" + pick["es"]
    out = li.identify(spark.createDataFrame([(text,)], "text string"), model).first()
    assert [s["lang"] for s in out["spans"]] == ["de", "es"]
    border = out["spans"][1]["start"]
    assert abs(border - 601) < 40 and 0.3 < out["score"] < 0.7
    for s in out["spans"]:
        assert text[s["start"]].isalpha() and text[s["end"] - 1].isalpha()


def test_edge_rows(spark, model):
    rows = [(None, "a", 1), ("", "b", 2), ("12 34 --", "c", 3), ("x", "d", 4), ("x", "d", 4), ("the " * 50_000, "e", 5)]
    docs = spark.createDataFrame(rows, "text string, lang_pred string, score int")
    got = li.identify(docs, model).collect()
    assert [r["lang_pred"] for r in got[:3]] == ["und"] * 3 and [r["score"] for r in got[:3]] == [0.0] * 3
    assert all(r["spans"] == [] for r in got[:3]) and got[3] == got[4]
    assert got[5]["lang_pred"] == "en" and len(got[5]["spans"]) == 1


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert li.identify(none, model).count() == 0
    untrained = li.train(none)
    assert untrained.languages == ()
    assert li.identify(spark.createDataFrame([("hello",)], "text string"), untrained).first()["lang_pred"] == "und"
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert li.train(unlabelled).languages == ()


def test_script_narrows_candidates(spark):
    rows = [(i, t, l) for i, (t, l) in enumerate([("привет как дела сегодня", "ru"), ("hello how are you", "en")] * 5)]
    m = li.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    out = li.identify(spark.createDataFrame([("неизвестное слово and unknown words",)], "text string"), m).first()
    assert [s["lang"] for s in out["spans"]] == ["ru", "en"]


def test_viterbi_is_the_best_path():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(0, 6, 4)
        first = np.concatenate([[0], np.cumsum(sizes)])
        s = rng.normal(0, 3, (first[-1], 3)).astype(np.float32)
        got = li._viterbi(s, first, 2.0)
        for a, b in zip(first[:-1], first[1:]):
            value = lambda p: sum(s[a + i, x] for i, x in enumerate(p)) - 2 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: E731,B023
            best = max(map(value, itertools.product(range(3), repeat=b - a)), default=0)
            assert abs(value(got[a:b]) - best) < 1e-3


def test_segments_give_the_best_path():
    rng = np.random.default_rng(6)
    for n_words, n_lang, words in [(1, 3, 4), (7, 1, 4), (64, 4, 8), (1000, 5, 16), (777, 12, 64), (5000, 4, 512)]:
        scores = rng.normal(size=(n_words, n_lang)).astype(np.float32) * rng.choice([.5, 3])
        scores[rng.random(n_words) < .3] = 0
        rows = np.array([0, n_words])
        want = li._together(scores, rows, 2.0)
        got = li._in_segments(scores, 2.0, words)
        worth = lambda x: scores[np.arange(n_words), x].sum(dtype=np.float64) - 2.0 * (x[1:] != x[:-1]).sum()  # noqa: E731, B023
        assert abs(worth(got) - worth(want)) < 1e-3 and (got == want).mean() > .99
    scores = rng.normal(size=(900, 4)).astype(np.float32)
    first = np.array([0, 10, 300, 300, 320, 880, 900])
    assert (li._viterbi(scores, first, 1.0, 100) == li._together(scores, first, 1.0)).mean() > .99


def plain(text, model, penalty=li.SWITCH_PENALTY):
    """(language, score, spans) of a text, word by word."""
    low = li.letter_table()
    words, k = [], 0
    while k < len(text):
        if low[ord(text[k])]:
            e = k
            while e < len(text) and low[ord(text[e])]:
                e += 1
            words.append((k, e))
            k = e
        k += 1
    if not words:
        return "und", 0.0, []
    scores = []
    for a, b in words:
        letters = [32, *(int(low[ord(c)]) for c in text[a:b]), 32]
        total = np.zeros(len(model.languages))
        for p, h, n in zip(letters, letters[1:], letters[2:]):
            x = (h * 0x9E3779B1 + p * 0x85EBCA6B + n * 0xC2B2AE35) & 0xFFFFFFFF
            total += model.log_p[((x ^ (x >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 16]
        able = model.uses[li.scripts_of(np.array([ord(text[a])]))[0]]
        scores.append(np.where(able | ~able.any(), total, total - 1e4))
    paths = [(s, [i]) for i, s in enumerate(scores[0])]
    for s in scores[1:]:
        top = max(paths, key=lambda x: x[0])
        paths = [(x + s[i], p + [i]) if x >= top[0] - penalty else (top[0] - penalty + s[i], top[1] + [i])
                 for i, (x, p) in enumerate(paths)]
    labels = max(paths, key=lambda x: x[0])[1]
    spans, owned, weighed = [], {}, {}
    for i, (a, b) in enumerate(words):
        if not i or labels[i] != labels[i - 1]:
            spans.append([a, b, labels[i], 0, np.zeros(len(model.languages))])
        spans[-1][1] = b
        spans[-1][3] += b - a
        spans[-1][4] = spans[-1][4] + scores[i]
    for a, b, label, n, total in spans:
        sure = 1 / np.exp((total - total[label]).clip(max=700)).sum()
        owned[label] = owned.get(label, 0) + n
        weighed[label] = weighed.get(label, 0) + n * sure
    best = min(owned, key=lambda x: (-owned[x], x))
    return (model.languages[best], weighed[best] / sum(owned.values()),
            [(a, b, model.languages[x]) for a, b, x, *_ in spans])


def test_rows_against_plain_python(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 3000 and doc_id % 2 = 0").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    two = [t for t in texts.values() if len(t) > 300][:12]
    odd = [(-1, "12 34"), (-2, "a" * 40), (-3, "\n".join(t[:150] for t in two)), (-4, "привет hello שלום 漢字 ok")]
    texts |= dict(odd)
    got = li.identify(docs.union(spark.createDataFrame(odd, "doc_id long, text string")), model).collect()
    assert len(got) == len(texts) > 50
    for r in got:
        lang, score, spans = plain(texts[r["doc_id"]], model)
        assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-3, r["doc_id"]
        assert [tuple(s) for s in r["spans"]] == spans


def test_blocks_of_letters_score_as_one(model):
    text = "the words of this text, " * 40 + "x" * 700 + " und die anderen"
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    low, starts, ends = li._words(codes, np.array([0, len(codes)]))
    whole = [b for *_, b in li._trigrams(low, starts, ends)]
    parts = list(li._trigrams(low, starts, ends, 97))
    assert len(whole) == 1 < len(parts) and (np.concatenate([b for *_, b in parts]) == whole[0]).all()
    scores = np.zeros((len(starts), len(model.languages)))
    for a, b, heads, buckets in parts:
        scores[a:b] += np.add.reduceat(model.log_p[buckets], heads, axis=0)
    (a, b, heads, buckets), = li._trigrams(low, starts, ends)
    assert np.allclose(scores, np.add.reduceat(model.log_p[buckets], heads, axis=0), atol=1e-2)


LONG = """
import resource, sys, time
import numpy as np
from rowforge.llm import language_id as li
rng = np.random.default_rng(1)
model = li.LanguageModel(tuple(f"l{i:02}" for i in range(12)), rng.normal(-9, 1, (li.BUCKETS, 12)).astype(np.float32),
                         np.ones((len(li.SCRIPT_NAMES), 12), bool))
words = ["".join(chr(c) for c in rng.integers(97, 123, n)) for n in rng.integers(2, 9, 4000)]
li.letter_table()
base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
took = []
for mb in (5, 20):
    text = " ".join(rng.choice(words, mb * 160_000))[:mb << 20]
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    began = time.time()
    names, score, *_ = li._label(model, 12.0, codes, np.array([0, len(codes)]))
    took.append(time.time() - began)
print("LONG", (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) / 1024, *took)
"""


def test_a_text_of_20_mb():
    done = subprocess.run([sys.executable, "-c", LONG], cwd=HERE, capture_output=True, text=True, timeout=300,
                          env={**os.environ, "PYTHONPATH": HERE, "OMP_NUM_THREADS": "1"})
    assert done.returncode == 0, done.stderr[-2000:]
    mb, small, large = map(float, done.stdout.split("LONG")[1].split())
    assert mb < 1000 and large < 8 * small and large < 100
