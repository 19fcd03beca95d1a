"""Token counts that follow edits.

Method: a text is cut into leaves of about ``LEAF`` code points, each of whole
pre-tokens.  A byte-level BPE pre-token never holds a blank after another
character, so a place where a non-blank is followed by a space or a line end
can always be a border: both sides encode there as they do in the whole text.
A binary segment tree per document holds the characters and tokens under each
node.  An edit looks up its leaves from the top, re-encodes their text plus one
character of context on either side (which takes in the neighbour leaf if the
edit touches a border), puts the new counts into the leaves and updates the
sums above them; all other leaves keep their counts.

The tokenizer's vocabulary file is read on the driver and broadcast; its size
is the vocabulary's, whatever the data.

Edge cases: null and empty texts have no leaves and no tokens, and can be
edited like any other (null counts as empty then).  The positions of edits are
code points of the text before any of them; they are applied from the last to
the first (ties: the later one in the list first), clipped to the text.  Null
edits, or null fields, count as none, 0 and the empty string.  A text without
blanks is one leaf.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 512
#: A leaf that an edit makes longer than this many times LEAF is cut anew.
GROWTH = 4

# Fixed value: the pre-token pattern of the 50k byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

EDITS = "array<struct<at: int, remove: int, insert: string>>"
TREE = "struct<n_tokens: bigint, chars: array<int>, tokens: array<int>>"


class Tokenizer:
    """A byte-level BPE vocabulary in base64 rank lines; the encoder is made
    on first use, once per task."""

    def __init__(self, rank_lines: bytes, pattern: str):
        self.rank_lines, self.pattern = rank_lines, pattern
        self.encoder = None

    def sent(self, spark):
        """Broadcast what a worker makes its own tokenizer from."""
        return spark.sparkContext.broadcast((self.rank_lines, self.pattern))

    def count(self, text: str) -> int:
        if self.encoder is None:
            import tiktoken
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.rank_lines.splitlines())}
            self.encoder = tiktoken.Encoding("ranks", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        return len(self.encoder.encode_ordinary(text))


def load_tokenizer(path: str, pattern: str = PATTERN) -> Tokenizer:
    with open(path, "rb") as f:
        return Tokenizer(f.read(), pattern)


def cut(text: str, leaf: int = LEAF) -> list[str]:
    """Leaves of about ``leaf`` code points that encode separately."""
    border, out, start = re.compile(r"(?<=\S)[ \n]"), [], 0
    while start < len(text):
        found = border.search(text, start + leaf)
        end = found.start() if found else len(text)
        out.append(text[start:end])
        start = end
    return out


class Tree:
    """Sums of characters and tokens over leaves, as two flat binary trees:
    node i has children 2i and 2i+1, the leaves begin at ``width``."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens

    @classmethod
    def over(cls, chars: list[int], tokens: list[int]) -> Tree:
        width = 1 << max(0, (len(chars) - 1).bit_length())
        trees = np.zeros((2, 2 * width), np.int64)
        trees[0, width:width + len(chars)] = chars
        trees[1, width:width + len(chars)] = tokens
        level = width
        while level > 1:
            trees[:, level // 2:level] = trees[:, level:2 * level:2] + trees[:, level + 1:2 * level:2]
            level //= 2
        return cls(trees[0], trees[1])

    @property
    def width(self) -> int:
        return len(self.chars) // 2

    def leaf_at(self, position: int) -> tuple[int, int]:
        """(leaf that holds the character, first character of that leaf); the
        last leaf with text for positions behind the end."""
        position = max(0, min(position, int(self.chars[1]) - 1))
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if position - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node - self.width, start

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.width
        more = chars - int(self.chars[node]), tokens - int(self.tokens[node])
        while node:
            self.chars[node] += more[0]
            self.tokens[node] += more[1]
            node //= 2


def plant(text: str, tokenizer: Tokenizer) -> Tree:
    leaves = cut(text)
    return Tree.over([len(x) for x in leaves], [tokenizer.count(x) for x in leaves])


def edit(text: str, tree: Tree, at: int, remove: int, insert: str, tokenizer: Tokenizer) -> tuple[str, Tree, int]:
    """(new text, its tree, code points encoded).  ``tree`` is used up."""
    at = max(0, min(at, len(text)))
    end = max(at, min(at + remove, len(text)))
    new = text[:at] + insert + text[end:]
    if not text:
        return new, plant(new, tokenizer), len(new)
    first, start = tree.leaf_at(at - 1)
    last, begin = tree.leaf_at(end)
    stop = begin + int(tree.chars[last + tree.width])
    region = new[start:stop + len(new) - len(text)]
    parts = cut(region)
    counts = [(len(p), tokenizer.count(p)) for p in parts]
    room = last - first + 1
    if len(counts) <= room or len(region) <= GROWTH * LEAF * room:
        if len(counts) > room:  # the last leaf takes the rest
            rest = counts[room - 1:]
            counts[room - 1:] = [(sum(c for c, _ in rest), sum(t for _, t in rest))]
        for i in range(room):
            tree.put(first + i, *(counts[i] if i < len(counts) else (0, 0)))
    else:
        old = [(int(c), int(t)) for c, t in zip(tree.chars[tree.width:], tree.tokens[tree.width:])]
        old[first:last + 1] = counts
        kept = [x for x in old if x[0]]
        tree = Tree.over([c for c, _ in kept], [t for _, t in kept])
    return new, tree, len(region)


def _trees(trees: list[Tree]) -> list[pa.Array]:
    ends = pa.array(np.cumsum([0, *[len(t.chars) for t in trees]]), pa.int32())
    flat = lambda parts: pa.ListArray.from_arrays(ends, pa.array(
        np.concatenate(parts) if parts else np.zeros(0), pa.int32()))
    return [pa.array([int(t.tokens[1]) for t in trees], pa.int64()),
            flat([t.chars for t in trees]), flat([t.tokens for t in trees])]


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``tree``: n_tokens and the two segment trees."""
    held = tokenizer.sent(docs.sparkSession)
    made: list[Tokenizer] = []

    def planted(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(Tokenizer(*held.value))
        trees = [plant(t or "", made[0]) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays(_trees(trees), ["n_tokens", "chars", "tokens"])

    return docs.withColumn("tree", F.arrow_udf(planted, TREE)(F.col(text_col).cast("string")))


def apply_edits(docs: DataFrame, tokenizer: Tokenizer, *, text_col: str = "text", tree_col: str = "tree",
                edits_col: str = "edits") -> DataFrame:
    """``docs`` with text and tree after the edits, and ``encoded_chars``, the
    code points that had to be encoded for it."""
    held = tokenizer.sent(docs.sparkSession)
    made: list[Tokenizer] = []

    def edited(texts: pa.Array, trees: pa.Array, edits: pa.Array) -> pa.Array:
        if not made:
            made.append(Tokenizer(*held.value))
        out_text, out_tree, encoded = [], [], []
        for text, kept, changes in zip(texts.to_pylist(), trees.to_pylist(), edits.to_pylist()):
            text, done = text or "", 0
            tree = Tree(np.array(kept["chars"], np.int64), np.array(kept["tokens"], np.int64))
            changes = [(c["at"] or 0, c["remove"] or 0, c["insert"] or "") for c in changes or [] if c]
            for _, (at, remove, insert) in sorted(enumerate(changes), key=lambda c: (c[1][0], c[0]), reverse=True):
                text, tree, n = edit(text, tree, at, remove, insert, made[0])
                done += n
            out_text.append(text)
            out_tree.append(tree)
            encoded.append(done)
        return pa.StructArray.from_arrays(
            [pa.array(out_text, pa.string()),
             pa.StructArray.from_arrays(_trees(out_tree), ["n_tokens", "chars", "tokens"]),
             pa.array(encoded, pa.int64())], ["text", "tree", "encoded_chars"])

    changed = F.arrow_udf(edited, f"struct<text: string, tree: {TREE}, encoded_chars: bigint>")
    return (docs.withColumn("__edited", changed(F.col(text_col).cast("string"), F.col(tree_col),
                                                F.col(edits_col).cast(EDITS)))
            .withColumns({text_col: F.col("__edited.text"), tree_col: F.col("__edited.tree"),
                          "encoded_chars": F.col("__edited.encoded_chars")}).drop("__edited"))
