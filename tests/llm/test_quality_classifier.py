import numpy as np
import pytest

from rowforge.llm import quality_classifier as qc

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return qc.train(docs, labels.where(~qc.is_held_out()))


def test_held_out_accuracy_and_calibration(spark, model):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = qc.score(docs.where(qc.is_held_out()), model).join(labels, "doc_id").select("score", "quality").collect()
    p, y = np.array([r["score"] for r in rows]), np.array([r["quality"] for r in rows])
    assert ((p >= 0.7) == y).mean() >= 0.93 and ((p >= 0) & (p <= 1)).all()
    low, high = p[y == 0], p[y == 1]
    assert (low[:, None] < high[None]).mean() >= 0.95
    assert abs(p.mean() - y.mean()) < 0.1


def test_edge_texts(spark, model):
    rows = [(None, 5), ("", 5), ("   \n", 5), ("one", 5), ("one", 5), ("word " * 100_000, 5), ("漢字 かな", 5), ("\u0000", 5)]
    got = [r["score"] for r in qc.score(spark.createDataFrame(rows, "text string, score int"), model).collect()]
    assert all(0 <= s <= 1 for s in got) and got[0] == got[1] == got[2] and got[3] == got[4]


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    m = qc.train(docs, none)
    assert [r["score"] for r in qc.score(docs, m).collect()] == [0.5, 0.5]
    assert qc.score(docs.limit(0), m).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (1, 7), (1, 1), (1, 1), (2, 0)], "doc_id long, quality int")
    assert qc.score(docs, qc.train(docs, odd)).count() == 2


def test_words_against_plain_python():
    import pyarrow as pa
    texts = ["The the THE cat!! 12 34 --a", "", "A AB ab", "aa aa aa"]
    got = [[w.tolist()[a:b] for a, b in zip(f[:-1], f[1:])] for w, f in qc._tokens(pa.array(texts))][0]
    the, again, capital, cat, bang, number = got[0][0], 3, 2, got[0][3], got[0][4], 1
    assert got[0][:7] == [the, again, again, cat, bang, number, number]
    assert got[1] == [] and got[2][1] == capital and got[3][1:] == [again, again]


def test_pooled_vectors_against_plain_means():
    import pyarrow as pa
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b", "cc", "!", "7"], rng.integers(0, 9))) for _ in range(50)]
    words = [w for ws, f in qc._tokens(pa.array(texts)) for w in ws]
    vocabulary = np.unique(np.array(words, np.uint64))[:3]
    vectors = rng.normal(size=(len(vocabulary) + qc.SPARE, 4)).astype(np.float32)
    want = []
    for t in texts:
        ws = [w for x, f in qc._tokens(pa.array([t])) for w in x]
        ids = qc._numbered(np.array(ws, np.uint64), vocabulary)
        want.append(vectors[ids].mean(axis=0) if len(ids) else np.zeros(4))
    assert np.allclose(qc.pooled(pa.array(texts), vocabulary, vectors), want, atol=1e-5)


def test_neighbour_sums_against_plain_python(monkeypatch):
    monkeypatch.setattr(qc, "STRETCH", 7)     # words at the borders of stretches
    rng = np.random.default_rng(5)
    sizes = [0, 1, 2, 40, 0, 5, 1]
    first = np.concatenate([[0], np.cumsum(sizes)])
    ids, index = rng.integers(0, 6, first[-1]), qc._index_vectors(6)
    got, want = np.zeros(index.shape, np.int64), np.zeros(index.shape, np.int64)
    qc._neighbour_sums(ids, first, index, got)
    for a, b in zip(first[:-1], first[1:]):
        for i in range(a, b):
            for j in range(max(a, i - qc.REACH), min(b, i + qc.REACH + 1)):
                if i != j:
                    want[ids[i]] += index[ids[j]]
    assert (got == want).all()


def test_word_counts_cover_all_texts(monkeypatch):
    import pyarrow as pa
    from collections import Counter
    monkeypatch.setattr(qc, "HELD_WORDS", 3)
    texts = ["a b a", None, "c d e f", "a", "", "f f g"]
    words = Counter(int(w) for ws, _ in qc._tokens(pa.array(texts)) for w in ws.view(np.int64))
    got = Counter()
    for t in texts:
        for batch in qc._counted(iter([pa.RecordBatch.from_arrays([pa.array([t], pa.string())], ["text"])])):
            for r in batch.to_pylist():
                got[r["word"]] += r["n"]
    assert got == words


def test_vocabulary_reaches_beyond_the_labelled_rows(spark):
    rows = [(i, "plain words here" if i < 4 else "unlabelled corpus text") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (2, 1), (3, 0)], "doc_id long, quality int")
    m = qc.train(docs, labels)
    found = set(m.vocabulary.tolist())
    import pyarrow as pa
    for word in ("plain", "unlabelled", "corpus"):
        (ws, _), = qc._tokens(pa.array([word]))
        assert int(ws[0]) in found
    assert np.allclose(np.linalg.norm(m.vectors[:len(found)], axis=1), 1, atol=1e-4)


def test_one_id_with_many_rows_is_one_training_row(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(50)] + [(2, "other")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 40 + [(1, 0)] * 3 + [(2, 0)], "doc_id long, quality int")
    assert qc.score(docs, qc.train(docs, labels)).count() == 51
