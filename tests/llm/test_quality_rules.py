import random

from helpers import quality_measures

from rowforge.llm import quality_rules as qr

SCHEMA = "doc_id long, text string, n_words string, kept int"


def made():
    rng = random.Random(6)
    words = ["alpha", "beta", "gam#ma", "$$", "ÉTÉ", "x|y", "one", "two", "three"]
    texts = []
    for _ in range(120):
        body = [rng.choice(words) for _ in range(rng.randint(0, 40))]
        if rng.random() < 0.5:
            body += body[: rng.randint(0, 20)]
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\x0b", "\xa0"]) for w in body))
    return [*texts, None, "", " \n\n ", "\n a \n a \n", "same line\nsame line\n same line", "a b c d e a b c d e",
            "a a a a a a a", "\xa0", " lead trail ", "x" * 100_000, "lorem ipsum dolor sit amet " * 5_000]


def test_measures_against_plain_python(spark):
    texts = made()
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r["doc_id"]: r for r in qr.ledger(df).collect()}
    for i, t in enumerate(texts):
        want = quality_measures(t)
        assert {k: got[i][k] for k in want} == want, repr(t)[:80]
        base = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert bool(got[i]["fail_bits"] & qr.mask_of(qr.POLICIES["base", 1])) == base
        assert got[i]["kept"] == 1


def test_policies_and_ablation(spark):
    df = spark.createDataFrame([(i, t, None, None) for i, t in enumerate(made())], SCHEMA)
    rows = qr.ledger(df)
    bits = [r["fail_bits"] for r in rows.collect()]
    for policy in qr.POLICIES:
        mask = qr.mask_of(qr.POLICIES[policy])
        kept = [r["kept"] for r in qr.apply_policy(rows, *policy).collect()]
        assert kept == [not b & mask for b in bits]
        for r in qr.ablation(rows, *policy).collect():
            one = qr.mask_of([r["rule"]])
            assert r["failed"] == sum(bool(b & one) for b in bits)
            assert r["kept_without"] == sum(b & mask == one for b in bits)


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b", None, None)] * 2, SCHEMA)
    a, b = qr.ledger(df).collect()
    assert a == b
    assert qr.ledger(df.limit(0)).count() == 0 and qr.ablation(qr.ledger(df.limit(0)), "base", 1).count() == 0


def test_only_rule_agrees_with_the_ablation(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = spark.createDataFrame(qr.ledger(docs).toArrow())
    kept = {r["rule"]: r["kept_without"] for r in qr.ablation(rows, "web", 2).collect()}
    only = {r["rule"]: r["count"] for r in rows.groupBy(qr.only_rule("web", 2).alias("rule")).count().collect()}
    assert {k: n for k, n in kept.items() if n} == {k: n for k, n in only.items() if k is not None}
    judged = qr.apply_policy(rows, "web", 2).withColumn("rule", qr.only_rule("web", 2))
    assert judged.where("kept and rule is not null").count() == 0
