"""Quality rules as a bitmask ledger, in DataFrame functions only.

Method: every rule is evaluated once per document; its failure sets one bit of
``fail_bits`` and what it measured is stored beside it.  A policy is a named,
versioned set of rules (a mask), so applying another policy, or asking what a
rule changes, reads the ledger's bits and never the texts again: ablations
count documents per distinct bit pattern first and then look at bits.

Words are runs of ``[^\\x20\\x09-\\x0D]``; all thresholds are whole numbers in
percent, so a measurement on the border compares exactly.

Edge cases: a null or blank text has no words and no characters, fails
``few_words`` and no rule that divides by words; columns of the input named
like the ledger's are replaced, others are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WINDOW = 5

#: Measurements, in the order of the ledger's columns.
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_letters", "n_capitals"]

#: Rule -> SQL condition under which a document fails; bit i is the i-th rule.
#: Rules are only ever added at the end, so that stored bits keep their sense.
RULES = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 25 * n_words",
    "letters": "100 * n_letters < 50 * word_chars",
    "capitals": "100 * n_capitals > 50 * n_letters",
}

#: (policy, version) -> rules that reject.
POLICIES = {
    ("base", 1): ["few_words", "repeated_windows"],
    ("web", 1): ["few_words", "repeated_windows", "symbols", "duplicate_lines"],
    ("web", 2): list(RULES),
}


def mask_of(rules: list[str]) -> int:
    return sum(1 << list(RULES).index(r) for r in rules)


def ledger(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with every measurement and ``fail_bits``."""
    own = [*MEASURES, "fail_bits"]
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in own]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    body = F.btrim(text, F.lit(BLANKS))
    cut = docs.select(*keep, text.alias("__text"), F.when(body == "", F.array().cast("array<string>"))
                      .otherwise(F.split(body, BLANK_RUN)).alias("__words"))
    n = F.size("__words")
    window = F.transform(F.slice("__words", 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
                         lambda w, i: F.xxhash64(w, *[F.get("__words", i + k) for k in range(1, WINDOW)]))
    lines = F.filter(F.split("__text", "\n", -1), lambda s: F.btrim(s, F.lit(BLANKS)) != "")
    count = lambda pattern: F.length(F.regexp_replace("__text", pattern, "")).cast("long")
    cut = cut.select(
        *keep, window.alias("__windows"), lines.alias("__lines"), n.cast("long").alias("n_words"),
        count(BLANK_RUN).alias("word_chars"), count(r"[^#*$%&|<>]+").alias("n_symbols"),
        count(r"\P{L}+").alias("n_letters"), count(r"\P{Lu}+").alias("n_capitals"))
    # sort the windows of those documents in which one occurs again
    again = F.size(F.array_distinct("__windows")) < F.size("__windows")
    marked = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    n_lines = F.size("__lines").cast("long")
    cut = cut.select(*keep, *[m for m in MEASURES if m in cut.columns], n_lines.alias("n_lines"),
                     (n_lines - F.size(F.array_distinct("__lines"))).alias("n_dup_lines"),
                     F.when(again, F.sort_array(marked)).alias("__sorted"))
    twin = lambda x, j: (x["h"] == F.get("__sorted", j)["h"])
    starts = F.transform("__sorted", lambda x, j: F.when(
        F.coalesce(twin(x, j - 1), F.lit(False)) | F.coalesce(twin(x, j + 1), F.lit(False)), x["i"]))
    cut = cut.select(*[c for c in cut.columns if c != "__sorted"],
                     F.sort_array(F.array_compact(starts)).alias("__starts"))
    covered = F.transform("__starts", lambda p, j: F.least(
        F.coalesce(F.get("__starts", j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
    repeated = F.aggregate(covered, F.lit(0).cast("long"), lambda s, x: s + x)
    measured = cut.withColumn("n_repeat_words", F.coalesce(repeated, F.lit(0).cast("long")))
    bits: Column = F.lit(0).cast("long")
    for i, failed in enumerate(RULES.values()):
        bits = bits + F.when(F.expr(failed), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long"))
    return measured.select(*keep, *MEASURES).withColumn("fail_bits", bits)


def failed(policy: str, version: int) -> Column:
    """Does the policy reject the ledger's row?"""
    return F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy, version])).cast("long")) != 0


def apply_policy(rows: DataFrame, policy: str, version: int) -> DataFrame:
    return rows.withColumn("kept", ~failed(policy, version))


def only_rule(policy: str, version: int) -> Column:
    """The one rule of the policy that the ledger's row fails: without it the
    row would be kept.  Null if it fails none or several."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[policy, version])).cast("long"))
    alone = F.create_map(*[x for rule in POLICIES[policy, version]
                           for x in (F.lit(mask_of([rule])).cast("long"), F.lit(rule))])
    return F.try_element_at(alone, bits)


def ablation(rows: DataFrame, policy: str, version: int) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that would be
    kept without it.  Documents are counted per bit pattern first (at most
    2 ** rules patterns), then patterns are compared bitwise."""
    mask = mask_of(POLICIES[policy, version])
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).count()
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask_of([r])).cast("long").alias("bit"))
                      for r in POLICIES[policy, version]])
    each = patterns.select("bits", "count", F.explode(rules).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("count")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("kept_without"))
