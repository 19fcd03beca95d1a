"""Language identification of mixed-language text.

Method: a word's script narrows the candidate languages; each word gets a
score per candidate (log-probabilities of its letter trigrams, word edges
included); a Viterbi pass over the words, with a penalty for every switch of
language, labels each word, and runs of equally labelled words are the spans.

A document's language is the one that labels most letters (ties: the smaller
name); its score is the letters of those spans, each span weighted by the
probability of its label among the learned languages, over all letters.  Its
confidence is the same over the spans of all languages, so a text that is
evenly mixed has a low score and a high confidence.

A text of more than ``LONG_WORDS`` words is cut into segments that go through
Viterbi side by side: first from every possible label before a segment, then, when
these are joined, from the scores that really come before it.  Trigrams are scored
``LETTERS`` letters at a time.  So time and memory follow the length of the text.

Training reads text and language only, of a bounded sample: about
``rows_per_language`` rows of each language, chosen by a hash of the id.

Edge cases: a null text, or one without letters, is ``und`` with score 0 and
no spans, as is every text if no training row has a language.  Existing
columns called lang_pred, score, confidence or spans are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.llm.characters import code_slices, letter_table, runs

BUCKETS = 1 << 16
ROWS_PER_LANGUAGE = 2000
SWITCH_PENALTY = 12.0
#: A script belongs to a language that writes this share of its letters in it.
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"
LETTERS = 1 << 20
LONG_WORDS, SEGMENT_WORDS = 1 << 15, 512

# First and last code point of the letter blocks of scripts.
SCRIPTS = [
    ("Latin", 0x0041, 0x02AF), ("Greek", 0x0370, 0x03FF), ("Cyrillic", 0x0400, 0x052F),
    ("Armenian", 0x0530, 0x058F), ("Hebrew", 0x0590, 0x05FF), ("Arabic", 0x0600, 0x077F),
    ("Devanagari", 0x0900, 0x097F), ("Bengali", 0x0980, 0x09FF), ("Gurmukhi", 0x0A00, 0x0A7F),
    ("Gujarati", 0x0A80, 0x0AFF), ("Tamil", 0x0B80, 0x0BFF), ("Telugu", 0x0C00, 0x0C7F),
    ("Kannada", 0x0C80, 0x0CFF), ("Malayalam", 0x0D00, 0x0D7F), ("Thai", 0x0E00, 0x0E7F),
    ("Georgian", 0x10A0, 0x10FF), ("Hangul", 0x1100, 0x11FF), ("Ethiopic", 0x1200, 0x137F),
    ("Khmer", 0x1780, 0x17FF), ("Latin", 0x1E00, 0x1EFF), ("Greek", 0x1F00, 0x1FFF),
    ("Kana", 0x3040, 0x30FF), ("Han", 0x3400, 0x4DBF), ("Han", 0x4E00, 0x9FFF),
    ("Hangul", 0xAC00, 0xD7AF), ("Han", 0x20000, 0x323AF),
]
SCRIPT_NAMES = sorted({s[0] for s in SCRIPTS}) + ["other"]


def scripts_of(codes: np.ndarray) -> np.ndarray:
    """Index into SCRIPT_NAMES for each code point."""
    first = np.array([s[1] for s in SCRIPTS])
    last = np.array([s[2] for s in SCRIPTS])
    index = np.array([SCRIPT_NAMES.index(s[0]) for s in SCRIPTS])
    at = np.maximum(np.searchsorted(first, codes, side="right") - 1, 0)
    inside = (codes >= first[at]) & (codes <= last[at])
    return np.where(inside, index[at], len(SCRIPT_NAMES) - 1)


@dataclass(frozen=True)
class LanguageModel:
    """languages; log-probability per trigram bucket and language; scripts
    that each language uses (script x language)."""
    languages: tuple[str, ...]
    log_p: np.ndarray
    uses: np.ndarray


def _words(codes: np.ndarray, rows: np.ndarray):
    """(lower-case letters and zeros, word starts, word ends)."""
    low = letter_table()[codes]
    starts, ends = runs(low > 0, rows)
    return low, starts, ends


def _trigrams(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, at_once: int = LETTERS
              ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first word, word behind the last, where each word's letters begin,
    bucket per letter), some words at a time; a very long word in parts."""
    before = np.concatenate([[0], np.cumsum(ends - starts)])
    i = 0
    while i < before[-1]:
        a = int(np.searchsorted(before, i, side="right")) - 1
        b = max(a + 1, int(np.searchsorted(before, i + at_once, side="right")) - 1)
        j = min(int(before[b]), i + at_once)
        first = np.maximum(before[a:b], i)
        sizes = np.minimum(before[a + 1:b + 1], j) - first
        heads = first - i
        letters = np.arange(j - i) + np.repeat(starts[a:b] + first - before[a:b] - heads, sizes)
        here = low[letters]
        prev, after = low[letters - 1], low[np.minimum(letters + 1, len(low) - 1)]
        prev[heads[before[a:b] >= i]] = 32
        whole = before[a + 1:b + 1] <= j
        after[(heads + sizes - 1)[whole]] = 32
        h = here * np.uint32(0x9E3779B1) + prev * np.uint32(0x85EBCA6B) + after * np.uint32(0xC2B2AE35)
        yield a, b, heads, (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16)
        i = j


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram and script counts per language of one task's rows; scripts are
    the negative keys -1, -2, ..."""
    found: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        for lang in sorted(set(langs)):
            texts = batch.column("text").filter(pa.array(langs == lang))
            counts = found.setdefault(lang, np.zeros(BUCKETS + len(SCRIPT_NAMES), np.int64))
            for codes, rows in code_slices(texts):
                low, starts, ends = _words(codes, rows)
                for *_, buckets in _trigrams(low, starts, ends):
                    counts[:BUCKETS] += np.bincount(buckets, minlength=BUCKETS)
                letters = codes[low > 0]
                counts[BUCKETS:] += np.bincount(scripts_of(letters), minlength=len(SCRIPT_NAMES))
    for lang, counts in found.items():
        at = np.flatnonzero(counts)
        key = np.where(at < BUCKETS, at, BUCKETS - 1 - at)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(key, pa.int32()),
                                          pa.array(counts[at], pa.int64())], ["lang", "key", "n"])


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_language: int = ROWS_PER_LANGUAGE) -> LanguageModel:
    """Fit on the given rows that have a language (see the module's bound).
    What reaches the driver is at most BUCKETS counts per language."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return LanguageModel((), np.zeros((BUCKETS, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items()
                           for x in (lang, min(1.0, rows_per_language / n))])
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), "id"), F.lit(1 << 20)) / float(1 << 20)
    counts = (rows.where(drawn < share[F.col("lang")]).select("lang", "text")
              .mapInArrow(_count, "lang string, key int, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow())
    languages = tuple(sorted(set(counts.column("lang").to_pylist())))
    at = np.array([languages.index(x) for x in counts.column("lang").to_pylist()], np.int64)
    key, n = counts.column("key").to_numpy(), counts.column("n").to_numpy()
    grams = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(languages)))
    is_gram = key >= 0
    grams[key[is_gram], at[is_gram]] = n[is_gram]
    scripts[-1 - key[~is_gram], at[~is_gram]] = n[~is_gram]
    smooth = 0.5
    log_p = np.log((grams + smooth) / (grams.sum(axis=0) + smooth * BUCKETS)).astype(np.float32)
    return LanguageModel(languages, log_p, scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1))


def _viterbi(scores: np.ndarray, first: np.ndarray, penalty: float, long_words: int = LONG_WORDS) -> np.ndarray:
    """Best label of each word; ``first``: first word per row + total."""
    long = np.flatnonzero(np.diff(first) > long_words)
    if not len(long):
        return _together(scores, first, penalty)
    labels, done = np.zeros(len(scores), np.int64), 0
    for row in [*long, len(first) - 1]:
        a = first[row]
        if done < row:
            labels[first[done]:a] = _together(scores[first[done]:a], first[done:row + 1] - first[done], penalty)
        if row < len(first) - 1:
            labels[a:first[row + 1]] = _in_segments(scores[a:first[row + 1]], penalty)
        done = row + 1
    return labels


def _in_segments(scores: np.ndarray, penalty: float, words: int = SEGMENT_WORDS) -> np.ndarray:
    """Best label of each word of one long row."""
    n_words, n_lang = scores.shape
    n = -(-n_words // words)
    x = np.zeros((n * words, n_lang), scores.dtype)     # words without scores change no label
    x[:n_words] = scores
    x = x.reshape(n, words, n_lang)
    # from each label before a segment to each label at its end
    table = np.where(np.eye(n_lang, dtype=bool), 0.0, -np.inf) + np.zeros((n, 1, 1))
    for t in range(words):
        table = np.maximum(table, table.max(axis=2, keepdims=True) - penalty) + x[:, None, t]
    best = np.zeros((n + 1, n_lang))
    for k in range(n):
        end = (best[k][:, None] + table[k]).max(axis=0)
        best[k + 1] = end - end.max()
    last, best = int(best[n].argmax()), best[:n].copy()
    own, each = np.arange(n_lang), np.arange(n)
    came = np.zeros((words, n, n_lang), np.int8 if n_lang < 128 else np.int32)
    for t in range(words):
        top = best.argmax(axis=1)
        leave = best[each, top] - penalty
        stay = best >= leave[:, None]
        came[t] = np.where(stay, own, top[:, None])
        best = np.where(stay, best, leave[:, None])
        best += x[:, t] - best.max(axis=1, keepdims=True)
    # back from every label at a segment's end; then along the ends that are taken
    state = np.broadcast_to(own, (n, n_lang)).astype(came.dtype)
    found = np.empty_like(came)
    for t in range(words - 1, -1, -1):
        found[t] = state
        state = np.take_along_axis(came[t], state.astype(np.int64), axis=1)
    taken = np.zeros(n, np.int64)
    for k in range(n - 1, -1, -1):
        taken[k] = last
        last = int(state[k, last])
    return found[:, each, taken].T.reshape(-1)[:n_words].astype(np.int64)


def _together(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of each word of some rows, which advance together, longest
    first, so each step is one array operation."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    begin, sizes = first[:-1][order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(1, (sizes[0] if len(sizes) else 0) + 1), side="right")
    came = np.zeros(scores.shape, np.int8 if scores.shape[1] < 128 else np.int32)
    labels = np.zeros(len(scores), np.int64)
    own = np.arange(scores.shape[1])
    best = np.zeros((len(order), scores.shape[1]), np.float32)
    for t, n in enumerate(active):
        at = begin[:n] + t
        if t:
            top = best[:n].argmax(axis=1)
            leave = best[np.arange(n), top] - penalty
            stay = best[:n] >= leave[:, None]
            came[at] = np.where(stay, own, top[:, None])
            best[:n] = np.where(stay, best[:n], leave[:, None])
            best[:n] -= best[:n].max(axis=1, keepdims=True)
        best[:n] += scores[at]
    state = best.argmax(axis=1)
    for t in range(len(active) - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        labels[at] = state[:n]
        state[:n] = came[at, state[:n]]
    return labels


def _label(model: LanguageModel, penalty: float, codes: np.ndarray, rows: np.ndarray):
    """Per row: language, score, confidence, and its spans (start, end, language)."""
    low, starts, ends = _words(codes, rows)
    n_rows, n_lang = len(rows) - 1, len(model.languages)
    if not len(starts) or not n_lang:
        none = np.zeros(0, np.int64)
        return ([UNDETERMINED] * n_rows, np.zeros(n_rows), np.zeros(n_rows), np.zeros(n_rows + 1, np.int64),
                none, none, none)
    scores = np.zeros((len(starts), n_lang), np.float32)
    for a, b, heads, buckets in _trigrams(low, starts, ends):
        scores[a:b] += np.add.reduceat(model.log_p[buckets], heads, axis=0)
    before = np.concatenate([[0], np.cumsum(ends - starts)])
    del low
    allowed = model.uses[scripts_of(codes[starts])]
    allowed[~allowed.any(axis=1)] = True
    scores[~allowed] -= 1e4
    first = np.searchsorted(starts, rows)
    labels = _viterbi(scores, first, penalty)
    row = np.searchsorted(rows, starts, side="right") - 1
    opens = np.ones(len(starts), bool)
    opens[1:] = (labels[1:] != labels[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(opens)
    tail = np.append(head[1:], len(starts)) - 1
    letters = before[tail + 1] - before[head]
    total = np.add.reduceat(scores, head, axis=0, dtype=np.float64)
    sure = 1 / np.exp(total - total[np.arange(len(head)), labels[head]][:, None]).clip(max=1e300).sum(axis=1)
    owned, weighed = np.zeros((n_rows, n_lang)), np.zeros((n_rows, n_lang))
    np.add.at(owned, (row[head], labels[head]), letters)
    np.add.at(weighed, (row[head], labels[head]), letters * sure)
    pick = owned.argmax(axis=1)
    size = owned.sum(axis=1)
    score = np.where(size > 0, weighed[np.arange(n_rows), pick] / np.maximum(size, 1), 0.0)
    confidence = weighed.sum(axis=1) / np.maximum(size, 1)
    names = [model.languages[p] if s else UNDETERMINED for p, s in zip(pick, size)]
    return (names, score.clip(0, 1), confidence.clip(0, 1), np.searchsorted(row[head], np.arange(n_rows + 1)),
            starts[head] - rows[row[head]], ends[tail] - rows[row[head]], labels[head])


def identify(docs: DataFrame, model: LanguageModel, *, text_col: str = "text",
             penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` with lang_pred, score and confidence (0 to 1) and spans (start
    and end in code points, language), see the module."""
    # BUCKETS x languages floats; plain arrays, so that workers need no import
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_p, model.uses))

    def labelled(texts: pa.Array) -> pa.Array:
        model, out = LanguageModel(*held.value), []
        for codes, rows in code_slices(texts):
            names, score, confidence, offsets, start, end, lang = _label(model, penalty, codes, rows)
            span = pa.StructArray.from_arrays(
                [pa.array(start, pa.int32()), pa.array(end, pa.int32()),
                 pa.array([model.languages[x] for x in lang], pa.string())], ["start", "end", "lang"])
            out.append(pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(confidence, pa.float64()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), span)],
                ["lang_pred", "score", "confidence", "spans"]))
        return pa.concat_arrays(out) if out else pa.array([], type=pa.struct(
            [("lang_pred", pa.string()), ("score", pa.float64()), ("confidence", pa.float64()),
             ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])))]))

    # marked so that no filter on its columns is pushed below it, which would run it twice
    label = F.arrow_udf(labelled, "lang_pred string, score double, confidence double, "
                                  "spans array<struct<start: int, end: int, lang: string>>").asNondeterministic()
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "confidence", "spans")]
    marked = docs.select(*keep, label(F.col(text_col).cast("string")).alias("__lid"))
    return marked.select(*keep, "__lid.lang_pred", "__lid.score", "__lid.confidence", "__lid.spans")


def is_held_out(id_col: str = "doc_id"):
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
