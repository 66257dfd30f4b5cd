"""Text expressions; all but the stemming hook run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from featloom.functions.columns import bind

# White space that separates words, and the 32 ASCII punctuation marks.
SPACE = r"[ \t\r\n]+"
PUNCTUATION = r"""[!"#$%&'()*+,\-./:;<=>?@\[\\\]^_`{|}~]"""
# Symbols blanked before the sequence models, and removed from names.
TOKEN_FILTER = r"""[!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\r\n]"""
NAME_SYMBOLS = "[!@#$_“”¨«»®´·º½¾¿¡§£₤‘’]"
NOT_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Non-empty pieces between runs of white space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def word_stats(col: str) -> list[Column]:
    """Words, unique words and unique percentage (NULL for a text without words)."""
    tokens = words(F.col(col))
    total, unique = F.size(tokens), F.size(F.array_distinct(tokens))
    return [
        total.alias(f"{col}_words"),
        unique.alias(f"{col}_unique_words"),
        F.try_divide(unique * 100.0, total).alias(f"{col}_unique_pct"),
    ]


def occurrences(col: Column, pattern: str) -> Column:
    """How many characters match a one-character pattern."""
    return F.length(col) - F.length(F.regexp_replace(col, pattern, ""))


def punctuation_count(col: Column) -> Column:
    return occurrences(col, PUNCTUATION)


def mark_stats(col: str, marks: dict[str, str]) -> list[Column]:
    """Characters, blanks, the given marks, and unique words per blank plus one."""
    text = F.col(col)
    blanks = occurrences(text, " ")
    unique = F.size(F.array_distinct(F.split(text, " ")))
    return [
        F.length(text).alias(f"{col}_chars"),
        blanks.alias(f"{col}_blanks"),
        *[occurrences(text, p).alias(f"{col}_{name}") for name, p in marks.items()],
        (unique * 100.0 / (blanks + 1)).alias(f"{col}_unique_by_blanks_pct"),
    ]


def contained_tokens(a: Column, b: Column) -> Column:
    """How many tokens of ``a`` (repeats counted) are tokens of ``b``."""
    tokens = F.split(a, " ")
    return bind(F.split(b, " "), lambda other: F.size(F.filter(tokens, lambda t: F.array_contains(other, t))))


def strip_symbols(col: Column, symbols: str = NAME_SYMBOLS, filler: str = "") -> Column:
    """Lower case, symbols replaced by ``filler``, white space squeezed."""
    cleaned = F.regexp_replace(F.lower(col), symbols, filler)
    return F.trim(F.regexp_replace(cleaned, SPACE, " "))


def normalize_tokens(col: Column, stopwords: list[str] = (), min_len: int = 2) -> Column:
    """Lower case, ASCII punctuation to blanks, words without stop words and short ones."""
    tokens = words(F.regexp_replace(F.lower(col), PUNCTUATION, " "))
    return drop_words(F.filter(tokens, lambda t: F.length(t) >= min_len), stopwords)


def drop_words(tokens: Column, stopwords: list[str]) -> Column:
    if not stopwords:
        return tokens
    stop = F.array(*[F.lit(w) for w in stopwords])
    return F.filter(tokens, lambda t: ~F.array_contains(stop, t))


def clean_tokens(
    col: Column, stopwords: list[str] = (), min_len: int = 2, drop_numbers: bool = False
) -> Column:
    """Lower-cased letter/digit runs without stop words and short tokens."""
    text = F.lower(col)
    if drop_numbers:
        text = strip_numbers(text)
    tokens = F.filter(F.split(text, NOT_WORD), lambda t: F.length(t) >= min_len)
    return drop_words(tokens, stopwords)


def strip_numbers(col: Column) -> Column:
    """Remove digit runs that stand alone between ASCII non-word characters."""
    return F.regexp_replace(col, r"(^|[^0-9A-Za-z_])[0-9]+(?![0-9A-Za-z_])", "$1")


def truncate_middle(tokens: Column, head: int = 20, tail: int = 30) -> Column:
    """First ``head`` and last ``tail`` tokens when there are more than both."""
    cut = F.concat(F.slice(tokens, 1, head), F.slice(tokens, -tail, tail))
    return F.when(F.size(tokens) > head + tail, cut).otherwise(tokens)


def concat_text(cols: list[str], default: str = "") -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit(default)) for c in cols])


def sequence_tokens(col: Column) -> Column:
    """Lower case, filter symbols to blanks, split on blanks."""
    return F.filter(F.split(F.regexp_replace(F.lower(col), TOKEN_FILTER, " "), " "), lambda t: t != "")


def stem(tokens: Column, fn: Callable[[str], str] | None = None) -> Column:
    """Apply a stemmer to every token (Arrow batches); identity without one."""
    if fn is None:
        return tokens

    @F.pandas_udf("array<string>")
    def apply(batch: pd.Series) -> pd.Series:
        return batch.map(lambda ts: None if ts is None else [fn(t) for t in ts])

    return apply(tokens)
