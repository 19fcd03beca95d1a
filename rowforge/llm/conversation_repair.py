"""Repair of the role structure of conversations at least cost.

A repaired conversation has the role initials ``(s?(ua)+)?``: nothing, or an
optional system turn and then pairs of user and assistant.  Rows are taken by turn
(nulls first; rows of one turn by role, then text).  A row's first fault is
``blank`` (no character but white space), ``duplicate`` (role and text seen
earlier in the conversation) or ``truncated`` (its last character that is no white
space ends no sentence).  Edits and their costs:

* K keeps a row: 0;
* R gives it the role user or assistant: 3;
* D deletes it: 4, the only edit of blank and duplicate rows;
* I inserts an empty user or assistant turn: 3;
* a truncated row that is kept or gets a role costs 3 more.

The cheapest edits are chosen; of equally cheap ones those whose initials in order
are least in ASCII order.

Method (survivor coalescence): a Viterbi search over the role that was written
last keeps one survivor per state.  Survivors are leaves of a tree of
backpointers with reference counts.  Where a path loses, its nodes go as far as no
other survivor needs them; once all survivors descend from one node, the edits
up to it are final and are emitted.  Ties are broken on the whole of both unresolved
suffixes.  A survivor goes early when another one can follow it in every
continuation at less cost (``_FOLLOWS``), so the state "nothing written yet",
whose path shares nothing with the others, does not keep the tree open.

A conversation streams through one task in order, a batch at a time.  Held of it are
its unresolved rows only, whatever its length; copies of a row are counted before
the shuffle, and earlier equal rows are found by an aggregate, not a set in
memory.  A conversation is not split over tasks: its edits are one sequence.

Edge cases: a null role or text is one space; a null turn comes first; rows
without ``conv_id`` are one conversation; a conversation of which nothing can
be kept is deleted whole; an empty table gives an empty result; a role that
starts with another letter cannot be kept; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
ENDS = ".!?"
EDITED = ("conv_id long, place long, edit string, fault string, turn long, old_role string, "
          "role string, text string")
DIGEST = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
FLUSH_ROWS, FLUSH_CHARS = 4096, 4 << 20

# Costs of edits, and pairs of role initials that may be neighbours.
RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
LEGAL = {"su", "ua", "au"}

#: States are the initial written last ("" is none yet) -> initials that may follow.
_NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
_ROLE = {"u": "user", "a": "assistant"}
_FINAL = ("", "a")
#: (state, another, extra): whatever follows the state, the other can do at so much more at most.
_FOLLOWS = [("", "a", 4), ("s", "a", 0)]


class _Node:
    """An edit; ``uses`` counts the survivors that end here."""

    __slots__ = ("parent", "edit", "row", "role", "kids", "uses")

    def __init__(self, parent, edit="", row=None, role=None):
        self.parent, self.edit, self.row, self.role = parent, edit, row, role
        self.kids, self.uses = set(), 0
        if parent is not None:
            parent.kids.add(self)


class Search:
    """Cheapest edits of one conversation; ``step`` and ``close`` return those
    that have become final, as nodes."""

    def __init__(self):
        self.root = _Node(None)
        self.best: dict[str, tuple[int, _Node]] = {}
        self._offer(self.best, "", 0, None, "")
        self._insert(self.best)

    def _path(self, node: _Node) -> str:
        edits = []
        while node is not self.root:
            edits.append(node.edit)
            node = node.parent
        return "".join(reversed(edits))

    def _release(self, node: _Node) -> None:
        node.uses -= 1
        while node is not self.root and not node.uses and not node.kids:
            node.parent.kids.discard(node)
            node = node.parent

    def _offer(self, best: dict, state: str, cost: int, parent: _Node | None, edit: str, row=None, role=None) -> bool:
        held = best.get(state)
        if held and (held[0] < cost or held[0] == cost and self._path(held[1]) <= self._path(parent) + edit):
            return False
        node = _Node(parent, edit, row, role) if parent is not None else self.root
        node.uses += 1
        best[state] = (cost, node)
        if held:
            self._release(held[1])
        return True

    def _insert(self, best: dict) -> None:
        again = True
        while again:
            again = False
            for state in [s for s in _NEXT if s in best]:
                for to in set(_NEXT[state]) - {"s"}:
                    cost, node = best[state]
                    again |= self._offer(best, to, cost + INSERT, node, "I", None, _ROLE[to])

    def _settled(self) -> list[_Node]:
        out = []
        while not self.root.uses and len(self.root.kids) == 1:
            self.root = self.root.kids.pop()
            self.root.parent = None
            out.append(self.root)
        return out

    def step(self, row: tuple) -> list[_Node]:
        """``row``: (turn, role, text, fault)."""
        role, fault = row[1], row[3]
        more = TRUNCATED if fault == "truncated" else 0
        new: dict = {}
        for state, (cost, node) in self.best.items():
            self._offer(new, state, cost + DELETE, node, "D", row)
            if fault in ("blank", "duplicate"):
                continue
            for to in _NEXT[state]:
                if role[:1] == to:
                    self._offer(new, to, cost + more, node, "K", row, role)
                if to != "s":
                    self._offer(new, to, cost + more + RETYPE, node, "R", row, _ROLE[to])
        old, self.best = self.best, new
        for _, node in old.values():
            self._release(node)
        self._insert(new)
        for state, other, extra in _FOLLOWS:
            if state in new and other in new:
                (cost, node), (less, rival) = new[state], new[other]
                if cost > less + extra or not extra and cost == less and self._path(node) > self._path(rival):
                    del new[state]
                    self._release(node)
        return self._settled()

    def close(self) -> list[_Node]:
        cost, path, state = min((self.best[s][0], self._path(self.best[s][1]), s) for s in _FINAL if s in self.best)
        for s in [s for s in self.best if s != state]:
            self._release(self.best.pop(s)[1])
        node, out = self.best[state][1], []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]

    def held(self) -> int:
        """Nodes of the tree."""
        todo, n = [self.root], 0
        while todo:
            todo += todo.pop().kids
            n += 1
        return n


def with_faults(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) -> one per distinct row with ``copies``,
    the ``fault`` of its first copy and that of the others."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("copies"))
    rows = rows.withColumn("mark", F.sha2("text", 256))
    said = ["conv_id", "role", "mark"]
    # nulls come first in a struct, as they do among turns
    first = rows.groupBy(*said).agg(F.min(F.struct("turn"))["turn"].alias("first_turn")).select(
        *[F.col(c).alias(f"{c}_1") for c in said], "first_turn")
    same = F.lit(True)
    for c in said:
        same &= F.col(c).eqNullSafe(F.col(f"{c}_1"))
    solid = F.rtrim("text", F.lit(SPACE))
    again = F.when(solid == "", "blank").otherwise("duplicate")
    fault = (F.when((solid == "") | ~F.col("turn").eqNullSafe(F.col("first_turn")), again)
             .when(~F.right(solid, F.lit(1)).isin(*ENDS), "truncated"))
    return rows.join(first, same).select("conv_id", "turn", "role", "text", "copies",
                                         fault.alias("fault"), again.alias("later_fault"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("fault", pa.string()),
                        ("turn", pa.int64()), ("old_role", pa.string()), ("role", pa.string()), ("text", pa.string())])
    out: list[tuple] = []
    chars = place = 0
    search = conv = None

    def batch():
        nonlocal out, chars
        done = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), schema)], schema=schema)
        out, chars = [], 0
        return done

    def add(nodes):
        nonlocal chars, place
        for x in nodes:
            turn, old, text, fault = x.row or (None, None, "", None)
            out.append((conv, place, x.edit, fault, turn, old, x.role, text))
            chars += len(text)
            place += 1

    for b in batches:
        for c, turn, role, text, copies, fault, later in zip(*[x.to_pylist() for x in b.columns]):
            if search is None or c != conv:
                if search:
                    add(search.close())
                search, conv, place = Search(), c, 0
            for k in range(copies):
                add(search.step((turn, role, text, later if k else fault)))
                if len(out) >= FLUSH_ROWS or chars >= FLUSH_CHARS:
                    yield batch()
    if search:
        add(search.close())
    if out:
        yield batch()


def repair(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) -> every edit in order: conv_id, place
    (from 0), edit (K, R, D, I), fault, turn and old_role of the row it is about
    (null for I), role (null for D) and text after it.  The repaired conversation
    is its rows other than D by place.  Rows of a conversation are neighbours
    in one partition, by place."""
    rows = with_faults(turns).repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    return rows.mapInArrow(_edited, EDITED)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in DIGEST.split(", ")]
    rows: list[tuple] = []
    conv = now = None

    def row():
        turns = now["turns"]
        gaps = now["last"] - now["low"] + 1 - turns if turns else 0
        return (conv, gaps, now["blank"], now["duplicate"], now["truncated"], now["illegal"], now["cost"],
                now["audit"].decode(), now["sha"].hexdigest())

    def table():
        kinds = [pa.string() if n in ("audit", "repaired_sha256") else pa.int64() for n in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    for b in batches:
        for c, place, edit, fault, turn, old, role, text in zip(*[x.to_pylist() for x in b.columns]):
            if not place:
                if now:
                    rows.append(row())
                conv, now = c, {"turns": 0, "low": None, "last": None, "before": None, "blank": 0, "duplicate": 0,
                                "truncated": 0, "illegal": 0, "cost": 0, "audit": bytearray(), "sha": hashlib.sha256(),
                                "said": False}
            now["audit"] += edit.encode()
            now["cost"] += {"K": 0, "R": RETYPE, "D": DELETE, "I": INSERT}[edit]
            if edit != "D":
                now["cost"] += TRUNCATED * (fault == "truncated")
                now["sha"].update(("\n" * now["said"] + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                now["said"] = True
            if edit != "I":
                if fault:
                    now[fault] += 1
                now["illegal"] += now["before"] is not None and now["before"] + old[:1] not in LEGAL
                now["before"] = old[:1]
                if turn is not None and turn != now["last"]:
                    now["turns"] += 1
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["last"] = turn
        if len(rows) >= FLUSH_ROWS:
            yield table()
            rows = []
    if now:
        rows.append(row())
    if rows:
        yield table()


def summaries(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result as it stands: counts of gaps
    in the turns, of faults and of illegal neighbours before, cost and initials
    of the edits, and the digest of the repaired ``role:text`` lines."""
    return edits.mapInArrow(_digested, DIGEST)
