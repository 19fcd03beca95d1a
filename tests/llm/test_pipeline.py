import re
from collections import Counter

import pytest
from helpers import components

import corpus_pipeline as cp

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PERSONAL = [r"[\w.+-]+@[\w-]+\.[\w.]+", r"\+\d \(\d{3}\) \d{3}-\d{4}", r"\b\d{1,3}(?:\.\d{1,3}){3}\b",
            r"AKIA[0-9A-Z]{16}", r"password=\w+"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, from the tables and some odd rows."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(10_001, None, "en", "src1", 0), (10_002, "", None, None, 0), (10_003, "12 34", "en", "src1", 5),
           (10_004, "the words of this text and that one are in the language of the other texts", None, None, None),
           (None, "another text that is in the language of these texts, by someone at x.y@example.com", "en", "src1", 1)]
    docs = docs.union(spark.createDataFrame(odd, SCHEMA))
    out, now = [docs], docs
    for _, stage in cp.STAGES:
        now = spark.createDataFrame(stage(spark, now, SF).toArrow())
        out.append(now)
    return [x.collect() for x in out]


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert all(list(rows[0].asDict()) == COLUMNS for rows in stages[:-1])


def test_language_stage_keeps_clean_documents(stages):
    before, after = {r["doc_id"]: r for r in stages[0]}, {r["doc_id"]: r for r in stages[1]}
    assert set(before) - set(after) == {10_001, 10_002, 10_003}
    assert after[10_004]["lang"] == "en" and all(after[i]["text"] == before[i]["text"] for i in after)


def test_one_document_of_each_group_stays(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[1] if r["doc_id"] is not None}
    parent, _ = components(texts, 5, 80)
    assert {r["doc_id"] for r in stages[2]} == {i for i in parent if parent[i] == i} | {None}


def test_personal_data_is_replaced(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2]}
    for r in stages[3]:
        assert r["n_chars"] == len(r["text"])
        for pattern in PERSONAL:
            for value in re.findall(pattern, before[r["doc_id"]]):
                assert value not in r["text"]
        if not any(re.search(p, before[r["doc_id"]]) for p in [*PERSONAL, r"\d{13}", r"TOKEN|secret|token"]):
            assert r["text"] == before[r["doc_id"]]


def test_mixing_keeps_all_rows_and_interleaves(stages):
    assert Counter(map(tuple, stages[4])) == Counter(map(tuple, stages[3]))
    first = [r["source"] for r in stages[4][:160]]
    assert len(set(first)) >= 15          # blocks of 8 rows of about twenty sources


def test_packing_covers_every_text(stages):
    length = Counter()
    for r in stages[5]:
        length[r["doc_id"]] += r["length"]
    assert length == Counter({r["doc_id"]: len(r["text"]) for r in stages[4]})


def test_run_writes_and_rereads_each_stage(spark):
    from __spark_entry__ import oracle_sql, queries
    assert queries()["pipeline"] is cp.run and "pipeline" not in oracle_sql()
    plan = cp.run(spark, SF).collect()
    again = cp.run(spark, SF).collect()
    assert sorted(map(tuple, plan)) == sorted(map(tuple, again)) and plan


def test_empty_table(spark):
    now = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        now = spark.createDataFrame(stage(spark, now, SF).toArrow())
        assert now.count() == 0


def test_packing_follows_the_mix(spark, scratch, monkeypatch):
    import functools
    docs = spark.createDataFrame([(i, f"text number {i} " * (1 + i % 7), "en", "abc"[i % 3], 0) for i in range(900)], SCHEMA)
    mix, pack = cp.source_mixing.mix, cp.packing.pack
    monkeypatch.setattr(cp.packing, "pack", functools.partial(pack, shard_rows=64))

    def plan(stage):
        path = scratch("mix")
        stage(spark, docs, SF).write.option("maxRecordsPerFile", 50).parquet(path)
        return cp.pack_sequences(spark, spark.read.parquet(path), SF).collect()

    def early(rows):
        """The sources of the texts of the first fifth of the sequences."""
        names = sorted({r["bin"] for r in rows})
        first = set(names[:len(names) // 5])
        return Counter("abc"[r["doc_id"] % 3] for r in rows if r["bin"] in first)

    plans = {"none": plan(lambda spark, docs, sf: docs)}
    for hot in "ab":
        target = {s: 8.0 if s == hot else 1.0 for s in "abc"}
        monkeypatch.setattr(cp.source_mixing, "mix", functools.partial(mix, target=target))
        order = {r["doc_id"]: i for i, r in enumerate(cp.mix_sources(spark, docs, SF).collect())}
        plans[hot] = plan(cp.mix_sources)
        ranges = {}
        for r in plans[hot]:
            ranges.setdefault(r["bin"].split(".")[0], []).append(order[r["doc_id"]])
        seen = [x for k in sorted(ranges) for x in (min(ranges[k]), max(ranges[k]))]
        assert len(ranges) == 15 and seen == sorted(seen)
        assert early(plans[hot])[hot] > 0.6 * sum(early(plans[hot]).values())
    assert len({tuple(sorted(map(tuple, p))) for p in plans.values()}) == 3


def test_sequences_are_numbered_in_the_read_order(spark):
    rows = [(i, "x" * n, "s", None, 0) for i, n in enumerate([3, 25, 8, 10, 2, 1])]
    docs = cp.in_read_order(spark, spark.createDataFrame(rows, SCHEMA))
    got = sorted(cp.packing.pack(docs, capacity=10, place_col="place").collect(), key=lambda r: (r["bin"], r["position"]))
    firsts = {}
    for r in got:
        firsts[r["bin"]] = min(firsts.get(r["bin"], 99), r["doc_id"])
    assert list(firsts.values()) == sorted(firsts.values())
    assert {r["doc_id"] for r in got} == set(range(6))


def test_language_stage_keeps_evenly_mixed_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    pick = {r["lang"]: r["text"] for r in docs.where("length(text) > 700").collect()}
    langs = sorted(x for x in pick if x is not None)
    mixed = [(20_001, 3), (20_002, 4)]
    rows = [(i, "\n".join(pick[x][:500] for x in langs[:k]), None, "src1", 0) for i, k in mixed]
    rows += [(20_003, "12 -- 34", None, "src1", 0)]
    model = cp.language_id.train(docs)
    found = {r["doc_id"]: r for r in cp.language_id.identify(spark.createDataFrame(rows, SCHEMA), model).collect()}
    for i, k in mixed:
        assert len({s["lang"] for s in found[i]["spans"]}) == k
        assert found[i]["score"] < 0.4 < 0.9 < found[i]["confidence"] <= 1
    both = docs.select(COLUMNS).union(spark.createDataFrame(rows, SCHEMA))
    kept = {r["doc_id"] for r in cp.keep_known_language(spark, both, SF).collect()}
    assert {20_001, 20_002} <= kept and 20_003 not in kept


def test_files_are_in_the_order_of_their_numbers(spark, scratch, monkeypatch):
    names = spark.range(100_003).selectExpr("concat('file:/x/part-', lpad(cast(id as string), greatest(5, length(cast(id as string))), '0'), "
                                            "'-c000.snappy.parquet') AS path", "id")
    order = cp.Window.orderBy(cp.file_number(cp.F.col("path")), "path")
    rows = names.select("id", cp.F.row_number().over(order).alias("n")).where("id <> n - 1")
    assert rows.count() == 0
    assert names.where("path < 'file:/x/part-100000' and id > 100000").count() == 0
    by_text = names.orderBy("path").limit(10_010).collect()
    assert [r["id"] for r in by_text] != list(range(10_010))          # the text order is another one
    path = scratch("files")
    spark.range(0, 300, 1, 6).selectExpr("id AS doc_id").write.parquet(path)
    back = cp.in_read_order(spark, spark.read.parquet(path))
    got = sorted((r["place"], r["doc_id"]) for r in back.collect())
    assert got == [(i, i) for i in range(300)]
    assert "strategy=broadcast" in back._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(cp, "maybe_broadcast", lambda df: df)             # as if there were too many files
    back = cp.in_read_order(spark, spark.read.parquet(path))
    assert "strategy=broadcast" not in back._jdf.queryExecution().analyzed().toString()
    assert sorted((r["place"], r["doc_id"]) for r in back.collect()) == got
