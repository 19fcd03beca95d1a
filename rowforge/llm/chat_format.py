"""Chat formatting of typed content parts, in DataFrame functions only.

Method: a turn's content is an ordered array of typed parts.  ``visit``
flattens it: consecutive text parts are joined and become their escaped text
(so no control string comes together across parts), an image, audio or
document part becomes one placeholder, and for each placeholder an attachment
reference is recorded (turn, position among the parts, kind, source and the number of tokens
the placeholder expands to).  ``format_conversations`` joins a conversation's
turns in order, marks each one, and records the spans of assistant content as
the loss mask (code points of the formatted string, markers excluded).

Escaping is reversible: between the first character of a control string and
its rest goes one more backslash than there were, so ``<|im_end|>`` becomes
``<\\|im_end|>`` and that becomes ``<\\\\|im_end|>``; no control string is left
inside content, and ``unescape`` takes exactly one backslash out again.  The
control strings are an argument: give those of every template whose markers a
model may take for its own (each starting with ``<`` or ``[``); the template's own
markers and placeholders are always among them.

Edge cases: null parts, part types or texts count as empty text, a null role
as an empty one; an unknown part type is kept as text; equal turn numbers are
ordered by role and content; conversations without any row do not appear.
A conversation's result is one string, so it has to fit into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's markers and placeholders, and the control strings
# of common chat templates that content must not be able to imitate.
OPEN, ROLE_END, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
OWN = [OPEN, ROLE_END, CLOSE, *PLACEHOLDERS.values()]
CONTROLS = [*OWN, "<s>", "</s>", "[INST]", "[/INST]", "<|endoftext|>", "<|startoftext|>", "<unk>"]

PART = ("struct<type: string, text: string, source: string, width: int, height: int, "
        "milliseconds: int, pages: int>")
PARTS = f"array<{PART}>"

PATCH = 28            # pixels of an image along one side of a token
AUDIO_STEP = 40       # milliseconds of sound per token
PAGE_TOKENS = 512     # tokens per document page

_FIRST = r"([<\[])"


def rests(controls: list[str]) -> str:
    """A pattern of what follows the first character of a control string."""
    if bad := [s for s in controls if s[:1] not in ("<", "[") or len(s) < 2 or s[1] == "\\"]:
        raise ValueError(f"control strings start with < or [ and go on: {bad}")
    every = dict.fromkeys([*OWN, *controls])
    return "|".join("".join(c if c.isalnum() else "\\" + c for c in s[1:]) for s in every)


_RESTS = rests(CONTROLS)


def escape(text: Column, controls: list[str] = CONTROLS) -> Column:
    return F.regexp_replace(text, _FIRST + r"(\\*)(" + rests(controls) + ")", r"$1\\$2$3")


def unescape(text: Column, controls: list[str] = CONTROLS) -> Column:
    return F.regexp_replace(text, _FIRST + r"\\(\\*)(" + rests(controls) + ")", "$1$2$3")


def text_part(text: Column) -> Column:
    """A one-part content array of plain text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                            F.lit(None).cast("string").alias("source"),
                            *[F.lit(None).cast("int").alias(c)
                              for c in ("width", "height", "milliseconds", "pages")])).cast(PARTS)


def expanded_tokens(part: Column) -> Column:
    """Tokens that a placeholder stands for, from the part's measurements
    (missing or non-positive ones count as the smallest unit)."""
    steps = lambda c, unit: F.ceil(F.greatest(F.coalesce(part[c], F.lit(1)), F.lit(1)) / unit)
    return (F.when(part["type"] == "image", steps("width", PATCH) * steps("height", PATCH))
            .when(part["type"] == "audio", steps("milliseconds", AUDIO_STEP))
            .when(part["type"] == "document", steps("pages", 1) * PAGE_TOKENS))


def _placeholder(part: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, mark in PLACEHOLDERS.items():
        out = F.when(part["type"] == kind, F.lit(mark)).otherwise(out)
    return out


def visit(parts: Column, controls: list[str] = CONTROLS) -> tuple[Column, Column]:
    """(flattened content, attachments in order) of a content array."""
    some = F.coalesce(parts, F.array().cast(PARTS))
    # a run of text parts is escaped as one text, once a placeholder or the end closes it
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("run"))
    closed = lambda acc: F.array_append(acc["done"], escape(F.array_join(acc["run"], ""), controls))
    content = F.aggregate(some, start, lambda acc, p: F.when(_placeholder(p).isNull(), F.struct(
        acc["done"].alias("done"), F.array_append(acc["run"], F.coalesce(p["text"], F.lit(""))).alias("run")))
        .otherwise(F.struct(F.array_append(closed(acc), _placeholder(p)).alias("done"),
                            F.array().cast("array<string>").alias("run"))),
        lambda acc: F.array_join(closed(acc), ""))
    attached = F.transform(some, lambda p, i: F.struct(
        i.alias("position"), p["type"].alias("kind"), p["source"].alias("source"),
        expanded_tokens(p).cast("long").alias("tokens")))
    return content, F.filter(attached, lambda a: F.coalesce(a["kind"].isin(list(PLACEHOLDERS)), F.lit(False)))


def format_conversations(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", parts_col: str = "parts",
                         controls: list[str] = CONTROLS) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start and
    length of each assistant content), attachments, expanded_tokens."""
    content, attached = visit(F.col(parts_col), controls)
    rows = turns.select(F.col(id_col).alias("conv_id"), F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        content.alias("content"), attached.alias("attached")).alias("t"))
    grouped = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"], controls), F.lit(ROLE_END))
    grouped = grouped.select("conv_id", "turns", F.transform("turns", lambda t: F.struct(
        F.length(head(t)).alias("before"), F.length(t["content"]).alias("length"),
        F.concat(head(t), t["content"], F.lit(CLOSE)).alias("piece"))).alias("pieces"))
    at = F.aggregate(
        F.arrays_zip("turns", "pieces"),
        F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start: int, length: int>>").alias("spans")),
        lambda acc, x: F.struct(
            (acc["end"] + x["pieces"]["before"] + x["pieces"]["length"] + len(CLOSE)).alias("end"),
            F.when(x["turns"]["role"] == "assistant", F.array_append(acc["spans"], F.struct(
                (acc["end"] + x["pieces"]["before"]).alias("start"), x["pieces"]["length"].alias("length"))))
            .otherwise(acc["spans"]).alias("spans")))
    attachments = F.flatten(F.transform("turns", lambda t: F.transform(t["attached"], lambda a: F.struct(
        t["turn"].alias("turn"), a["position"].alias("position"), a["kind"].alias("kind"),
        a["source"].alias("source"), a["tokens"].alias("tokens")))))
    out = grouped.select("conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
                         at["spans"].alias("loss_spans"), attachments.alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda s, a: s + a["tokens"]))


def read_back(formatted: DataFrame, controls: list[str] = CONTROLS) -> DataFrame:
    """conv_id, turns (role and unescaped content) and loss (all text under
    the mask, unescaped), taken from the formatted string and its spans."""
    cut = F.split("formatted", "\\Q" + OPEN + "\\E", -1)
    pieces = F.slice(cut, F.lit(2), F.size(cut))
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(p, ROLE_END, 1), controls).alias("role"),
        unescape(F.substring_index(F.substring_index(p, ROLE_END, -1), CLOSE, 1), controls).alias("content")))
    masked = F.transform("loss_spans", lambda s: unescape(
        F.substring(F.col("formatted"), s["start"] + 1, s["length"]), controls))
    return formatted.withColumn("turns", turns).withColumn("loss", F.array_join(masked, ""))
