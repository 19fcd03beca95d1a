import random

import pytest

from rowforge.llm import token_counts as tc

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def tokenizer():
    return tc.load_tokenizer(RANKS)


def hostile(rng, n):
    bits = ["word", " ", "  ", "\n", "\n\n", "\t", "\x0b", "\x1c", " ", " ", "é", "漢字", "'s", "'ll", "123",
            "!!!", ". ", " the", "The", "\U0001f600", "_", "​"]
    return "".join(rng.choices(bits, k=n))


def test_leaves_encode_as_the_whole(tokenizer):
    rng = random.Random(1)
    for n in (0, 1, 10, 300, 3000):
        for _ in range(15):
            text = hostile(rng, n)
            assert "".join(tc.cut(text, 16)) == text
            assert sum(map(tokenizer.count, tc.cut(text, 16))) == tokenizer.count(text)


def test_edits_against_a_full_recount(tokenizer, monkeypatch):
    monkeypatch.setattr(tc, "LEAF", 24)
    monkeypatch.setattr(tc.cut, "__defaults__", (24,))
    rng = random.Random(2)
    for _ in range(60):
        text = hostile(rng, rng.choice([0, 3, 200]))
        tree = tc.plant(text, tokenizer)
        for _ in range(25):
            at, remove = rng.randint(0, len(text) + 3), rng.choice([0, 0, 1, 2, 30, 500])
            text, tree, done = tc.edit(text, tree, at, remove, hostile(rng, rng.choice([0, 1, 2, 80])), tokenizer)
            assert int(tree.tokens[1]) == tokenizer.count(text) and int(tree.chars[1]) == len(text)
            assert all(tree.chars[i] == tree.chars[2 * i] + tree.chars[2 * i + 1] for i in range(1, tree.width))


def test_a_small_edit_encodes_little(tokenizer):
    text = "some words of a long text " * 20_000
    tree = tc.plant(text, tokenizer)
    _, _, done = tc.edit(text, tree, 250_000, 3, "other", tokenizer)
    assert done < 4 * tc.LEAF


def test_columns(spark, tokenizer):
    rows = [(1, "a b 12345 c", [(4, 5, "*****"), (11, 0, "\n")]), (2, None, [(0, 0, "new")]), (3, "", None),
            (4, "x", [(None, None, None), (99, 5, "y"), None]), (4, "x", [(0, 1, ""), (0, 0, "q")]), (5, "z" * 200_000, [])]
    df = spark.createDataFrame(rows, f"doc_id long, text string, edits {tc.EDITS}")
    df = df.selectExpr("*", "'clash' as tree", "1 as encoded_chars")
    counted = tc.count_tokens(df, tokenizer)
    before = [r["tree"]["n_tokens"] for r in counted.collect()]
    assert before == [tokenizer.count(t or "") for _, t, _ in rows]
    out = tc.apply_edits(counted, tokenizer).collect()
    assert [r["text"] for r in out][:5] == ["a b ***** c\n", "new", "", "xy", "x"]
    assert [r["tree"]["n_tokens"] for r in out] == [tokenizer.count(r["text"]) for r in out]
    assert tc.apply_edits(tc.count_tokens(df.limit(0), tokenizer), tokenizer).count() == 0


def test_query_against_a_full_recount(spark, tokenizer):
    import re

    from rowforge.llm.queries import op10_token_counts
    sf = "/root/testdata/sf0.001"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op10_token_counts(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        t = text[r["doc_id"]]
        changed = re.sub("[0-9]{5,}", lambda m: "*" * len(m[0]), t, count=1) + "\n"
        assert (r["n_tokens"], r["edited_tokens"]) == (tokenizer.count(t), tokenizer.count(changed))
