"""Quality rules, line first: failing lines go, then documents that lost too much text.

Every feature is an array expression over one document's own words or lines,
so there is no shuffle, no Python and no limit on the text; the cost of a
document is O(n log n) in its words.

Cases: NULL text has no word and fails; an empty text likewise; repeated rows
are judged each by itself; an empty table gives an empty result; further
columns of the input pass through ``clean`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import words

SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
BOILERPLATE = (
    "all rights reserved|cookie policy|privacy policy|terms of use|terms of service|lorem ipsum|javascript|"
    "click here|sign up|log in|subscribe to|share this"
)


@dataclass(frozen=True)
class Rules:
    """Bounds of the base rules and of the line rules."""

    min_words: int = 20
    max_repeat_pct: int = 30
    symbols_per_word: float = 0.2  # punctuation: more symbols a word than this
    separators: int = 3  # navigation: as many words that are only a separator
    short_menu: int = 8  # boilerplate phrases count in lines of at most so many words
    repeat_words: int = 12  # repetition: in lines of at least so many words
    distinct_share: float = 0.2  # fewer distinct words than this share
    max_lost: float = 0.3  # share of word characters that may go


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def line_fails(line: Column, rules: Rules) -> Column:
    """A line with words that reads as symbols, a menu, boilerplate or one word over and over; never NULL."""

    def judge(w: Column) -> Column:
        n = F.size(w)
        symbols = F.regexp_count(line, F.lit(SYMBOLS)) > n * rules.symbols_per_word
        menu = F.size(F.filter(w, lambda x: x.isin("|", ">", "»", "·", "/"))) >= rules.separators
        phrase = (n <= rules.short_menu) & F.lower(line).rlike(BOILERPLATE)
        again = (n >= rules.repeat_words) & (F.size(F.array_distinct(w)) < n * rules.distinct_share)
        return (n > 0) & (symbols | menu | phrase | again)

    return F.exists(F.array(words(line)), judge)  # binds the words, which are then split once


def repeat_words(hashes: Column) -> tuple[Column, Column]:
    """(whether any window repeats, (hash, position) pairs in order of hash)."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.size(F.array_distinct(hashes)) < F.size(hashes), pairs


def features(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and cleaned text.

    Added columns start with ``q_``, so they cannot clash with those of ``docs``.
    """
    text = F.col("text")
    df = docs.withColumn("q_words", words(text)).withColumn("q_lines", F.coalesce(F.split(text, "\n"), F.array().cast("array<string>")))
    df = df.withColumns(
        {
            "q_hash": F.transform(F.col("q_words"), lambda w: F.xxhash64(w)),
            "q_full": F.filter(F.col("q_lines"), has_word),
            "q_n_words": F.size("q_words").cast("long"),
            "q_word_chars": F.length(F.array_join("q_words", "")).cast("long"),
            "q_n_symbols": F.coalesce(F.regexp_count(text, F.lit(SYMBOLS)), F.lit(0)).cast("long"),
        }
    ).drop("q_words")
    at = F.sequence(F.lit(0), F.greatest(F.col("q_n_words").cast("int") - WINDOW, F.lit(0)))
    df = df.withColumn(
        "q_window",
        F.when(
            F.col("q_n_words") >= WINDOW,
            F.transform(at, lambda i: F.xxhash64(*[F.get(F.col("q_hash"), i + j) for j in range(WINDOW)])),
        ),
    ).drop("q_hash")
    some, pairs = repeat_words(F.col("q_window"))
    df = df.withColumn("q_pairs", F.when(some, pairs)).drop("q_window")

    def twin(x: Column, i: Column) -> Column:
        s = F.col("q_pairs")
        before = F.when(i > 0, F.get(s, i - 1)["h"])
        return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

    df = df.withColumn("q_at", F.sort_array(F.transform(F.filter(F.col("q_pairs"), twin), lambda x: x["i"]))).drop("q_pairs")
    step = F.transform("q_at", lambda x, i: F.least(F.coalesce(F.get(F.col("q_at"), i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
    df = df.withColumns(
        {
            "q_n_repeat_words": F.coalesce(F.aggregate(step, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
            "q_n_dup_lines": (F.size("q_full") - F.size(F.array_distinct("q_full"))).cast("long"),
            "q_good": F.filter(F.col("q_lines"), lambda x: ~line_fails(x, rules)),
        }
    ).drop("q_at", "q_full")
    left = F.length(F.array_join(words(F.array_join("q_good", " ")), ""))
    left = F.when(F.size("q_good") == F.size("q_lines"), F.col("q_word_chars")).otherwise(left)
    failed = (F.col("q_n_words") < rules.min_words) | (100 * F.col("q_n_repeat_words") > rules.max_repeat_pct * F.col("q_n_words"))
    df = df.withColumns(
        {
            "q_base_failed": failed,
            "q_lost_chars": (F.col("q_word_chars") - left).cast("long"),
            "q_text": F.when(F.size("q_good") == F.size("q_lines"), text).otherwise(F.array_join("q_good", "\n")),
        }
    ).drop("q_good", "q_lines")
    return df.withColumn("q_kept", ~F.col("q_base_failed") & (F.col("q_lost_chars") <= rules.max_lost * F.col("q_word_chars")))


def report(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs`` with its counts and verdict."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"]
    rows = features(docs.select("doc_id", "text"), rules)
    return rows.select("doc_id", *[F.col(f"q_{n}").alias(n) for n in names])


def clean(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The kept rows of ``docs`` without their failing lines; ``n_chars``, if there, follows the text."""
    # a column whose value is not known in advance keeps the filter above the features; below, it would repeat them
    rows = features(docs, rules).withColumn("q_row", F.monotonically_increasing_id())
    rows = rows.filter(F.col("q_kept") & (F.col("q_row") >= 0))
    out = {c: F.col(c) for c in docs.columns} | {"text": F.col("q_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.length("q_text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(c) for c, v in out.items()])


# the same rules in DuckDB; @docs stands for a relation with doc_id and text
SQL = r"""
w AS (SELECT rid, doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
             string_split(text, chr(10)) AS ls FROM (SELECT row_number() OVER () AS rid, * FROM @docs)),
win AS (SELECT rid, i, ws[i:i+7] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, sum(least(8, coalesce(nxt - i, 8))) AS n FROM
        (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM again) GROUP BY rid),
l AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM w),
lw AS (SELECT rid, k, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
bad AS (SELECT *, len(ws) > 0 AND (
          len(regexp_extract_all(line, '[#*$%&|<>]')) > len(ws) * 0.2
          OR len(list_filter(ws, lambda x: x IN ('|', '>', '»', '·', '/'))) >= 3
          OR (len(ws) <= 8 AND regexp_matches(lower(line), '@boilerplate'))
          OR (len(ws) >= 12 AND len(list_distinct(ws)) < len(ws) * 0.2)) AS fails FROM lw),
lines AS (SELECT rid, count(*) FILTER (WHERE len(ws) > 0) - count(DISTINCT line) FILTER (WHERE len(ws) > 0) AS n_dup,
          coalesce(sum(length(array_to_string(ws, ''))) FILTER (WHERE NOT fails), 0) AS left_chars,
          string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT fails) AS good FROM bad GROUP BY rid),
f AS (SELECT w.rid, w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(coalesce(w.text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(n_dup, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
        (length(array_to_string(ws, '')) - coalesce(left_chars, 0))::BIGINT AS lost_chars, good
      FROM w LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND lost_chars <= 0.3 * word_chars AS kept FROM f)
""".replace("@boilerplate", BOILERPLATE)

REPORT_SQL = (
    "WITH " + SQL.replace("@docs", "documents")
    + " SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, lost_chars FROM judged"
)
