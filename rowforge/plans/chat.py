"""Chat keyword extraction (batch form; the same operators run on a stream
in ``rowforge.streaming.chat``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.functions.text import field, split_keep_trailing, tokenize
from rowforge.operators.aggregate import keyword_count
from rowforge.operators.relational import antijoin_left_anti

# Default stop words -- common function words of the English,
# French, German and Spanish text in the chat data (case-sensitive, as the
# matching is).
DEFAULT_STOP_WORDS = (
    "a", "an", "the", "and", "or", "of", "to", "in", "is", "was", "are", "be",
    "it", "that", "this", "for", "on", "by", "as", "at", "with", "from", "he",
    "i", "my", "me", "you", "your", "we",
    "le", "la", "les", "de", "des", "du", "un", "une", "et", "en", "que", "qui",
    "dans", "pour", "par", "sur", "avec", "au", "aux", "ou", "est",
    "der", "die", "das", "den", "dem", "und", "zu", "von", "mit", "ist", "ein",
    "eine", "sich", "nicht", "auf", "im",
    "el", "los", "las", "y", "con", "para", "es", "por", "una",
)


def parse_messages(lines: DataFrame, sep: str = "~", col: str = "value") -> DataFrame:
    """``id~chat~type`` lines -> (id, chat, type); missing parts are null."""
    parts = split_keep_trailing(F.col(col).cast("string"), sep)
    return lines.select(field(parts, 0).alias("id"), field(parts, 1).alias("chat"),
                        field(parts, 2).alias("type"))


def filter_by_role(messages: DataFrame, role: str = "c") -> DataFrame:
    return messages.where(F.col("type") == role).select("id", "chat")


def tokens(messages: DataFrame, text_col: str = "chat", id_col: str = "id") -> DataFrame:
    """(id, word) per blank-separated token; runs of blanks give empty
    tokens, which are kept and counted like any other word."""
    return messages.select(F.col(id_col).alias("id"),
                           F.explode(tokenize(F.col(text_col), " ")).alias("word"))


def conversation_tokens(conversations: DataFrame, role: str = "user") -> DataFrame:
    """Customer tokens straight from the conversations table."""
    msgs = conversations.where(F.col("role") == role).select(
        F.col("conv_id").alias("id"), F.col("text").alias("chat"))
    return tokens(msgs)


def keywords(words: DataFrame, stop: DataFrame, stop_col: str = "stopword") -> DataFrame:
    """Keyword counts without stop words.

    Words are counted first (partial aggregation combines a hot word inside
    each task), and only the distinct words meet the stop list, so the anti
    join sees the vocabulary, not every token."""
    counts = keyword_count(words.where(F.col("word").isNotNull()))
    return antijoin_left_anti(counts, "chatkeywords", stop, stop_col)
