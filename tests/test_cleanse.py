
from rowforge.operators import cleanse as cl
from rowforge.operators.cleanse import LineSpec

HEADER = "a,b,d,s"
SPEC = LineSpec(names=("a", "b", "d", "s"), required=("a", "b", "d"), int_cols=("a", "b"),
                date_col="d", date_format="yyyy-MM-dd")

LINES = [
    HEADER,
    "1,2,2019-10-01,x",
    "",
    " \t ",
    "3,4,2019-10-02,",       # last field may be blank
    HEADER,                  # repeated header inside the body
    "5,6,2019-13-01,y",      # bad date
    "7,x8,2019-10-01,y",     # bad int
    "9, ,2019-10-01,y",      # blank required field
    "10,11",                 # too few fields
    " 12,13,2019-10-01,y",   # padded int is not an int on the untrimmed path
]


def lines(spark, rows=LINES):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_drop_header_and_blank(spark):
    df = cl.drop_blank_lines(cl.drop_header(lines(spark), HEADER))
    got = [r.value for r in df.collect()]
    assert HEADER not in got and "" not in got and " \t " not in got
    assert len(got) == 7


def test_drop_header_defaults_to_first_line(spark):
    df = cl.drop_header(spark.createDataFrame([(HEADER,), ("1,2",)], "value string"))
    assert [r.value for r in df.collect()] == ["1,2"]


def test_split_fields_pads_short_rows(spark):
    df = cl.split_fields(lines(spark, ["10,11", "1,2,3,4,5"]), SPEC)
    rows = {r.a: r for r in df.collect()}
    assert rows["10"].d is None and rows["10"].n_fields == 2
    assert rows["1"].s == "4" and rows["1"].n_fields == 5


def test_trimmed_split(spark):
    spec = LineSpec(names=("a", "b"), trim=True)
    r = cl.split_fields(lines(spark, [" 1 ,\t2\t"]), spec).first()
    assert (r.a, r.b) == ("1", "2")


def test_classify_reasons(spark):
    body = cl.drop_blank_lines(cl.drop_header(lines(spark), HEADER))
    got = {r.value: r.reject_reason for r in cl.classify(body, SPEC).collect()}
    assert got["1,2,2019-10-01,x"] is None
    assert got["3,4,2019-10-02,"] is None
    assert got["5,6,2019-13-01,y"] == cl.BAD_DATE
    assert got["7,x8,2019-10-01,y"] == cl.BAD_INT
    assert got["9, ,2019-10-01,y"] == cl.MISSING_REQUIRED
    assert got["10,11"] == cl.TOO_FEW_FIELDS
    assert got[" 12,13,2019-10-01,y"] == cl.BAD_INT


def test_typed_records_types(spark):
    df = cl.typed_records(cl.drop_header(lines(spark), HEADER), SPEC)
    assert dict(df.dtypes) == {"a": "int", "b": "int", "d": "string", "s": "string"}
    assert sorted(r.a for r in df.collect()) == [1, 3]


def test_quality_counts_reconcile(spark):
    r = cl.quality_counts(lines(spark), SPEC, HEADER).first().asDict()
    assert r["raw_lines"] == len(LINES)
    parts = ["header_lines", "blank_lines", "too_few_fields", "missing_required",
             "bad_int", "bad_date", "kept"]
    assert sum(r[p] for p in parts) == r["raw_lines"]
    assert (r["header_lines"], r["blank_lines"], r["kept"]) == (2, 2, 2)


def test_cleanse_stored_once(spark, scratch):
    kept, rej = cl.cleanse(lines(spark), SPEC, HEADER, store_path=scratch("cleanse"))
    assert kept.count() == 2 and rej.count() == 5
    assert set(rej.columns) == {"value", "reject_reason"}
    # kept + rejected are disjoint and together are every body line
    assert kept.count() + rej.count() == 7


def test_first_line_is_from_first_file_by_name(spark, scratch):
    import os
    p = scratch("hdr").replace("file:", "")
    os.makedirs(p)
    with open(os.path.join(p, "b.txt"), "w") as f:
        f.write("9,9,2019-10-01,x\n" * 50)          # larger file, listed second by name
    with open(os.path.join(p, "a.txt"), "w") as f:
        f.write(HEADER + "\n1,2,2019-10-01,x\n")
    lines = spark.read.text(p)
    assert cl.first_line(lines) == HEADER
    assert cl.drop_header(lines).count() == 51
