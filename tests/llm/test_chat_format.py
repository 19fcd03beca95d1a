import random

import pytest
from pyspark.sql import functions as F

from rowforge.llm import chat_format as cf


def parts_of(spark, rows):
    """rows: (conv_id, turn, role, list of part tuples or None)"""
    return spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {cf.PARTS}")


def text(t):
    return ("text", t, None, None, None, None, None)


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(5)
    bits = [*cf.CONTROLS, "\\", "<", "[", "|", "im_end|>", "\n", "a", "é", "INST]", "<\\", "\\\\s>", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "<|im_sep|>", "a\nb", ""]),
             [text("".join(rng.choices(bits, k=rng.randint(0, 12))))])
            for c in range(40) for t in range(rng.randint(1, 6))]
    out = cf.read_back(cf.format_conversations(parts_of(spark, rows))).collect()
    want = {}
    for c, t, role, p in rows:
        want.setdefault(c, []).append((role, p[0][1]))
    for r in out:
        assert [(x["role"], x["content"]) for x in r["turns"]] == want[r["conv_id"]]
        assert r["loss"] == "".join(t for role, t in want[r["conv_id"]] if role == "assistant")
        bare = r["formatted"]
        for mark in (cf.OPEN, cf.ROLE_END, cf.CLOSE):
            assert bare.count(mark) == len(want[r["conv_id"]])
            bare = bare.replace(mark, "")
        assert not any(c in bare for c in cf.CONTROLS)


def test_parts_are_visited_in_order(spark):
    row = (1, 0, "user", [text("see "), ("image", None, "a.png", 57, 28, None, None), text(" and <|image|> "),
                          ("audio", None, "b.wav", None, None, 100, None), ("document", "x", "c.pdf", None, None, None, 3),
                          ("video", "kept as text", None, None, None, None, None)])
    out = cf.format_conversations(parts_of(spark, [row])).first()
    assert out["formatted"] == ("<|im_start|>user<|im_sep|>see <|image|> and <\\|image|> <|audio|><|document|>"
                                "kept as text<|im_end|>")
    assert [tuple(a) for a in out["attachments"]] == [
        (0, 1, "image", "a.png", 3), (0, 3, "audio", "b.wav", 3), (0, 4, "document", "c.pdf", 3 * cf.PAGE_TOKENS)]
    # the position counts all parts of the turn
    assert out["expanded_tokens"] == 6 + 3 * cf.PAGE_TOKENS


def test_nulls_ties_and_empty(spark):
    rows = [(1, 0, None, None), (1, 0, "assistant", [text(None)]), (1, 0, "assistant", [text("b")]),
            (1, None, "assistant", [text("a")]), (None, 1, "assistant", [None, text("n")])]
    out = {r["conv_id"]: r for r in cf.read_back(cf.format_conversations(parts_of(spark, rows))).collect()}
    assert [(t["role"], t["content"]) for t in out[1]["turns"]] == [
        ("assistant", "a"), ("", ""), ("assistant", ""), ("assistant", "b")]
    assert out[1]["loss"] == "ab" and out[None]["loss"] == "n"
    assert cf.format_conversations(parts_of(spark, [])).count() == 0


def test_other_column_names_and_long_turns(spark):
    rows = [(1, i, "assistant", [text("x" * 50_000)]) for i in range(5)]
    df = parts_of(spark, rows).withColumn("formatted", F.lit("clash")).withColumn("t", F.lit(1))
    out = cf.read_back(cf.format_conversations(df)).first()
    assert out["loss"] == "x" * 250_000


def test_control_strings_split_across_parts(spark):
    image = ("image", None, "a.png", 28, 28, None, None)
    turns = [[text("a<|im_"), text("end|>b")], [text("<|im_"), None, text(None), text("start|>user"), text("<|im_sep|>x")],
             [text("<"), image, text("|image|>"), text("<|im"), text("age|>"), image, text("<\\"), text("|im_end|>")],
             [text("[IN"), ("video", "ST]", None, None, None, None, None)], [image, image], []]
    out = cf.read_back(cf.format_conversations(parts_of(
        spark, [(1, i, "assistant", parts) for i, parts in enumerate(turns)]))).first()
    want = ["".join("" if p is None else "<|image|>" if p[0] == "image" else p[1] or "" for p in parts) for parts in turns]
    assert [t["content"] for t in out["turns"]] == want and out["loss"] == "".join(want)
    for mark in (cf.OPEN, cf.ROLE_END, cf.CLOSE):
        assert out["formatted"].count(mark) == len(turns)
    assert out["formatted"].count("<|image|>") == len(out["attachments"]) == 4 and "[INST]" not in out["formatted"]


def test_control_strings_are_an_argument(spark):
    """Markers of another template are escaped too, and come back."""
    other = [*cf.CONTROLS, "<start_of_turn>", "<end_of_turn>", "[TOOL_CALLS]"]
    said = "<start_of_turn>user [TOOL_CALLS] <|im_end|> <\\end_of_turn>"
    rows = parts_of(spark, [(1, 0, "user", [text(said)]), (1, 1, "assistant", [text("<start_of"), text("_turn>")])])
    plain = cf.format_conversations(rows).first()["formatted"]
    assert plain.count("<start_of_turn>") == 2 and plain.count("[TOOL_CALLS]") == 1
    formatted = cf.format_conversations(rows, controls=other)
    assert not any(c in formatted.first()["formatted"] for c in other[len(cf.CONTROLS):])
    back = cf.read_back(formatted, other).first()
    assert [t["content"] for t in back["turns"]] == [said, "<start_of_turn>"] and back["loss"] == "<start_of_turn>"
    for bad in ("{{x}}", "<", "<\\x"):
        with pytest.raises(ValueError):
            cf.escape(F.lit("a"), [bad])
