import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from rowforge.llm import queries
from rowforge.llm.conversation_repair import Search, repair, summaries

GRAMMAR = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, place string, edit int"
SPACE = " \t\n\x0b\f\r"


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        solid = text.rstrip(SPACE)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "truncated" if solid[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired lines) by trying every sequence of edits."""
    roles = {"u": "user", "a": "assistant"}
    found = []
    kinds = [["D"] if f in ("blank", "duplicate") else ["K", "Ru", "Ra", "D"] for f in faults(rows)]
    for gaps in product(["", "u", "a", "ua", "au"], repeat=len(rows) + 1):
        if sum(map(len, gaps)) > len(rows) + 1:
            continue
        for edits in product(*kinds):
            cost, audit, lines = 0, "", []
            for k, (edit, gap) in enumerate(zip([*edits, ""], gaps)):
                for x in gap:
                    cost, audit = cost + 3, audit + "I"
                    lines.append((roles[x], ""))
                if edit:
                    _, role, text = rows[k]
                    audit += edit[0]
                    cost += {"K": 0, "R": 3, "D": 4}[edit[0]] + 3 * (edit != "D" and faults(rows)[k] == "truncated")
                    if edit != "D":
                        lines.append((roles[edit[1]] if edit[0] == "R" else role, text))
            if GRAMMAR.fullmatch("".join(r[:1] or "?" for r, _ in lines)):
                found.append((cost, audit, [f"{r}:{t}" for r, t in lines]))
    return min(found)


def searched(rows):
    search, out = Search(), []
    for (turn, role, text), fault in zip(rows, faults(rows)):
        out += search.step((turn, role, text, fault))
    out += search.close()
    return "".join(x.edit for x in out), [f"{x.role}:{x.row[2] if x.row else ''}" for x in out if x.edit != "D"]


def test_search_against_every_sequence():
    rng = random.Random(3)
    for _ in range(150):
        rows = [(k, rng.choice(["user", "assistant", "system", "user", "tool", " "]),
                 rng.choice(["", " ", "Yes.", "No", "One!", f"t{k}.", f"t{k}"])) for k in range(rng.choice([0, 1, 2, 2, 3, 3]))]
        _, audit, lines = cheapest(rows)
        assert searched(rows) == (audit, lines), rows


def test_memory_is_bounded_by_what_is_unresolved():
    rng = random.Random(5)
    search, most, edits = Search(), 0, 0
    for k in range(20_000):
        role = rng.choice(["user", "assistant", "assistant", "user", "system"])
        edits += len(search.step((k, role, f"t{k}.", rng.choice([None, None, "truncated", "blank"]))))
        most = max(most, search.held())
    assert edits > 19_000 and most < 200
    assert edits + len(search.close()) >= 20_000


def expected(rows):
    """The contract's columns for one conversation's rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    fault = faults(rows)
    initials = [r[1][:1] for r in rows]
    turns = {r[0] for r in rows if r[0] is not None}
    cost, audit, lines = cheapest(rows)
    return ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, fault.count("blank"), fault.count("duplicate"),
            fault.count("truncated"), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def made(seed):
    rng = random.Random(seed)
    texts = ["Ja.", "Nein", "Ok!", "", " \n", None, "Ünï?", "Was?  \n", "a\n"]
    rows = []
    for conv in [*range(1, 60), None]:
        rows += [(conv, rng.choice([None, 0, 1, 2, 3, 7]), rng.choice(["user", "assistant", "system", "user", None, ""]),
                  rng.choice(texts)) for _ in range(rng.choice([1, 2, 2, 3]))]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_against_every_sequence(spark, seed):
    rows = made(seed)
    got = {r["conv_id"]: tuple(r)[1:] for r in
           summaries(repair(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA))).collect()}
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {conv: expected(of) for conv, of in by.items()}


def test_edits_are_the_repaired_conversation(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "user", "Hi."), (1, 2, "user", "Hi."), (1, 4, "user", "Still?"),
            (1, 5, "assistant", "cut of")]
    out = repair(spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA))
    got = [tuple(r)[1:] for r in sorted(out.collect(), key=lambda r: r["place"])]
    assert got == [(0, "K", None, 0, "system", "system", "Be brief."), (1, "K", None, 1, "user", "user", "Hi."),
                   (2, "D", "duplicate", 2, "user", None, "Hi."), (3, "I", None, None, None, "assistant", ""),
                   (4, "K", None, 4, "user", "user", "Still?"),
                   (5, "K", "truncated", 5, "assistant", "assistant", "cut of")]
    assert summaries(out).select("cost", "audit").first() == (3 + 4 + 3, "KKDIKK")


def test_long_conversation_and_hot_rows(spark):
    """One conversation of many turns, one row that it repeats very often, one very long text."""
    turns = spark.range(60_000).selectExpr("0L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
                                           "concat(id, '.') AS text")
    again = spark.range(30_000).selectExpr("0L AS conv_id", "5L AS turn", "'user' AS role", "'same.' AS text")
    long = spark.range(1).selectExpr("1L AS conv_id", "0L AS turn", "'user' AS role", "repeat('word ', 1000000) AS text")
    out = {r["conv_id"]: r for r in summaries(repair(turns.union(again).union(long))).collect()}
    hot = out[0]
    assert (hot["duplicate"], hot["blank"], hot["truncated"], hot["gaps"]) == (29_999, 0, 0, 0)
    # the row is after the assistant's of its turn, and one insertion mends the order
    assert hot["cost"] == 4 * 29_999 + 3 and len(hot["audit"]) == 90_001
    assert out[1]["audit"] == "D" and out[1]["cost"] == 4 and out[1]["truncated"] == 1


def test_empty_table(spark):
    out = summaries(repair(spark.createDataFrame([], SCHEMA)))
    assert out.count() == 0 and "repaired_sha256" in out.columns


def test_query_on_nulls_and_dropped_rows(spark, scratch):
    rows = made(4) + [(conv, 0, "user", "Hm.") for conv in range(100, 160)]
    path = scratch("conversations")
    spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA).coalesce(2).write.parquet(f"{path}/conversations.parquet")
    by = {}
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (turn, "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text)
        by.setdefault(conv, []).extend([row] * {0: 0, 3: 2}.get(h, 1))
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert any(not of for of in by.values())
    by = {conv: of for conv, of in by.items() if len(of) <= 3}
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, path).collect()}
    assert {c: got[c] for c in by} == {conv: expected(of) if of else empty for conv, of in by.items()}
    assert set(got) == {r[0] for r in rows}
