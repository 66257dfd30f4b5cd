"""Text expressions and vectorisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from featloom.checks.registry import R, check, rounded
from featloom.functions import text as tx
from featloom.operators import vectorize as vec

STOP = ["the", "and", "der", "die", "und", "les", "des", "los", "que"]
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
WORDS = r"list_filter(regexp_split_to_array({c}, '[ \t\r\n]+'), lambda w: w <> '')"
PUNCT_SQL = tx.PUNCTUATION.replace("'", "''")
FILTER_SQL = tx.TOKEN_FILTER.replace("'", "''")


@check(
    "word_counts_x1",
    f"""SELECT doc_id, n AS text_words, u AS text_unique_words, {R('u * 100.0 / NULLIF(n, 0)', 'text_unique_pct')} FROM
    (SELECT doc_id, len({WORDS.format(c='text')}) AS n, len(list_distinct({WORDS.format(c='text')})) AS u FROM documents)""",
)
def _(t):
    return rounded(t.documents.select("doc_id", *tx.word_stats("text")), "text_unique_pct")


@check(
    "punctuation_count_x2",
    f"SELECT doc_id, length(text) - length(regexp_replace(text, '{PUNCT_SQL}', '', 'g')) AS punct FROM documents",
)
def _(t):
    return t.documents.select("doc_id", tx.punctuation_count(F.col("text")).alias("punct"))


@check(
    "character_counts_x3",
    f"""SELECT doc_id, length(text) AS text_chars, length(text) - length(replace(text, ' ', '')) AS text_blanks,
    length(text) - length(replace(text, '!', '')) AS text_surprise, length(text) - length(replace(text, '?', '')) AS text_question,
    length(text) - length(replace(text, '"', '')) AS text_quote, length(text) - length(replace(text, '''', '')) AS text_quote2,
    {R("len(list_distinct(string_split(text, ' '))) * 100.0 / (length(text) - length(replace(text, ' ', '')) + 1)", 'text_unique_by_blanks_pct')} FROM documents""",
)
def _(t):
    marks = {"surprise": "!", "question": r"\?", "quote": '"', "quote2": "'"}
    return rounded(t.documents.select("doc_id", *tx.mark_stats("text", marks)), "text_unique_by_blanks_pct")


@check(
    "contained_tokens_x4",
    """SELECT conv_id, turn, len(list_filter(string_split(a, ' '), lambda w: list_contains(string_split(b, ' '), w))) AS n,
    CAST(len(list_filter(string_split(a, ' '), lambda w: list_contains(string_split(b, ' '), w))) > 0 AS INT) AS flag FROM
    (SELECT u.conv_id, u.turn, u.text AS a, v.text AS b FROM conversations u JOIN conversations v ON u.conv_id = v.conv_id AND v.turn = u.turn + 1)""",
)
def _(t):
    a = t.conversations.select("conv_id", "turn", F.col("text").alias("a"))
    b = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    n = tx.contained_tokens(F.col("a"), F.col("b"))
    return a.join(b, ["conv_id", "turn"]).select("conv_id", "turn", n.alias("n"), (n > 0).cast("int").alias("flag"))


@check(
    "clean_name_x5",
    rf"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(text), '{tx.NAME_SYMBOLS}', '', 'g'), '[ \t\r\n]+', ' ', 'g'))) AS clean FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", F.md5(tx.strip_symbols(F.col("text"))).alias("clean"))


@check(
    "normalized_tokens_x6",
    rf"""SELECT doc_id, md5(array_to_string(list_filter(list_filter(regexp_split_to_array(regexp_replace(lower(text), '{PUNCT_SQL}', ' ', 'g'), '[ \t\r\n]+'),
    lambda w: length(w) >= 2), lambda w: NOT list_contains({STOP_SQL}, w)), ' ')) AS tokens FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", F.md5(F.array_join(tx.normalize_tokens(F.col("text"), STOP), " ")).alias("tokens"))


CLEAN = rf"list_filter(list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: length(w) >= 2), lambda w: NOT list_contains({STOP_SQL}, w))"


@check("cleaned_tokens_x7", f"SELECT doc_id, md5(array_to_string({CLEAN}, ' ')) AS tokens, len({CLEAN}) AS n FROM documents")
def _(t):
    tokens = tx.clean_tokens(F.col("text"), STOP)
    return t.documents.select("doc_id", F.md5(F.array_join(tokens, " ")).alias("tokens"), F.size(tokens).alias("n"))


@check(
    "strip_numbers_x8",
    r"""SELECT doc_id, md5(array_to_string(list_filter(regexp_extract_all(text, '[0-9A-Za-z_]+|[^0-9A-Za-z_]+'), lambda w: NOT regexp_full_match(w, '[0-9]+')), '')) AS clean FROM documents""",
)
def _(t):
    return t.documents.select("doc_id", F.md5(tx.strip_numbers(F.col("text"))).alias("clean"))


@check(
    "middle_truncation_x9",
    f"""SELECT doc_id, md5(array_to_string(CASE WHEN len(w) > 50 THEN list_concat(w[1:20], w[-30:]) ELSE w END, ' ')) AS cut FROM
    (SELECT doc_id, {WORDS.format(c='text')} AS w FROM documents)""",
)
def _(t):
    df = t.documents.select("doc_id", tx.words(F.col("text")).alias("w"))
    return df.select("doc_id", F.md5(F.array_join(tx.truncate_middle(F.col("w")), " ")).alias("cut"))


@check("concatenated_text_x10", "SELECT item_id, COALESCE(param_1, 'none') || ' ' || COALESCE(param_2, 'none') || ' ' || city AS text FROM items", ("items",))
def _(t):
    return t.items.select("item_id", tx.concat_text(["param_1", "param_2", "city"], "none").alias("text"))


def _cut_plural(word: str) -> str:
    return word[:-1] if word.endswith("s") and len(word) > 3 else word


@check(
    "stemming_hook_x11",
    f"""SELECT doc_id, md5(array_to_string(list_transform({CLEAN}, lambda w: CASE WHEN w LIKE '%s' AND length(w) > 3 THEN left(w, length(w) - 1) ELSE w END), ' ')) AS stems FROM documents""",
)
def _(t):
    stems = tx.stem(tx.clean_tokens(F.col("text"), STOP), _cut_plural)
    return t.documents.select("doc_id", F.md5(F.array_join(stems, " ")).alias("stems"))


SEQ = f"list_filter(string_split(regexp_replace(lower(text), '{FILTER_SQL}', ' ', 'g'), ' '), lambda w: w <> '')"


@check("sequence_tokens_x12", f"SELECT doc_id, md5(array_to_string({SEQ}, ' ')) AS tokens FROM documents")
def _(t):
    return t.documents.select("doc_id", F.md5(F.array_join(tx.sequence_tokens(F.col("text")), " ")).alias("tokens"))


@check(
    "padded_token_ids_x13",
    f"""WITH tok AS (SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS term FROM (SELECT doc_id, {SEQ} AS w FROM documents)),
    idx AS (SELECT term, code FROM (SELECT term, row_number() OVER (ORDER BY COUNT(*) DESC, term) AS code FROM tok GROUP BY term) WHERE code < 500),
    seq AS (SELECT doc_id, list(code ORDER BY p) AS s FROM tok JOIN idx USING (term) GROUP BY 1)
    SELECT doc_id, array_to_string(list_concat([0 FOR i IN range(100 - LEAST(len(COALESCE(s, [])), 100))], COALESCE(s, [])[-100:]), ' ') AS ids
    FROM documents LEFT JOIN seq USING (doc_id)""".replace("[0 FOR i IN range(100 - LEAST(len(COALESCE(s, [])), 100))]", "list_transform(range(100 - LEAST(len(COALESCE(s, [])), 100)), lambda i: CAST(0 AS BIGINT))"),
)
def _(t):
    ids = vec.token_ids(t.documents, "doc_id", "text", 500, 100)
    return ids.select("doc_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), " ").alias("ids"))


# ---- vectorisers ----------------------------------------------------------------

TOK = f"SELECT doc_id, generate_subscripts(w, 1) AS p, unnest(w) AS term FROM (SELECT doc_id, {CLEAN} AS w FROM documents)"
UNI = f"WITH tc AS (SELECT doc_id, term, COUNT(*) AS n FROM ({TOK}) GROUP BY 1, 2), voc AS (SELECT term, COUNT(*) AS df, CAST(SUM(n) AS BIGINT) AS cf FROM tc GROUP BY 1)"


def _tc(t, ngrams=(1, 1)):
    return vec.term_counts(t.documents, "doc_id", "text", "word", ngrams, STOP)


@check(
    "term_counts_v1",
    f"""{UNI}, kept AS (SELECT term FROM voc WHERE df >= 3 AND df <= 0.5 * (SELECT COUNT(*) FROM documents) ORDER BY cf DESC, term LIMIT 800)
    SELECT doc_id, term, n FROM tc JOIN kept USING (term)""",
)
def _(t):
    tc = _tc(t)
    n_docs = t.documents.agg(F.count(F.lit(1))).scalar()
    kept = vec.prune_vocab(vec.vocabulary(tc), min_df=3, max_df=0.5, max_features=800, n_docs=n_docs)
    return vec.restrict(tc, kept).select("doc_id", "term", "n")


@check(
    "word_bigrams_v1",
    f"""WITH tok AS ({TOK}) SELECT doc_id, term, COUNT(*) AS n FROM (SELECT doc_id, term FROM tok
    UNION ALL SELECT a.doc_id, a.term || ' ' || b.term FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.p = a.p + 1) GROUP BY 1, 2""",
)
def _(t):
    return _tc(t, (1, 2))


def _tfidf_sql(tf, idf):
    return f"""{UNI}, w AS (SELECT doc_id, term, {tf} * ({idf}) AS w FROM tc JOIN voc USING (term), (SELECT COUNT(*) AS nd FROM documents))
    SELECT doc_id, term, {R('w / sqrt(SUM(w * w) OVER (PARTITION BY doc_id))', 'w')} FROM w"""


@check("tfidf_smooth_v2", _tfidf_sql("n", "ln((1 + nd) / CAST(1 + df AS DOUBLE)) + 1"))
def _(t):
    n_docs = t.documents.agg(F.count(F.lit(1))).scalar()
    return rounded(vec.tfidf(_tc(t), "doc_id", n_docs), "w")


@check("tfidf_sublinear_v2", _tfidf_sql("(1 + ln(n))", "ln(nd / CAST(df AS DOUBLE)) + 1"))
def _(t):
    n_docs = t.documents.agg(F.count(F.lit(1))).scalar()
    return rounded(vec.tfidf(_tc(t), "doc_id", n_docs, smooth=False, sublinear=True), "w")


@check(
    "char_wb_ngrams_v3",
    rf"""WITH pieces AS (SELECT ' ' || w || ' ' AS w, COUNT(*) AS c FROM (SELECT unnest({WORDS.format(c="lower(text)")}) AS w FROM documents) GROUP BY 1),
    grams AS (SELECT substring(w, i, g) AS term, c FROM (SELECT w, c, g, unnest(range(1, length(w) - g + 2)) AS i FROM pieces, (SELECT unnest([2, 3]) AS g)) )
    SELECT term, CAST(SUM(c) AS BIGINT) AS cf FROM grams GROUP BY 1""",
)
def _(t):
    # padded words have three characters or more, so none is shorter than an n-gram
    tc = vec.term_counts(t.documents, "doc_id", "text", "char_wb", (2, 3))
    return vec.vocabulary(tc).select("term", "cf")


@check(
    "char_bigrams_v3",
    r"""WITH d AS (SELECT doc_id, regexp_replace(lower(text), '[ \t\r\n]{2,}', ' ', 'g') AS s FROM documents)
    SELECT doc_id, a || b AS term, COUNT(*) AS n FROM (SELECT doc_id, unnest(c) AS a, unnest(list_concat(c[2:], [NULL])) AS b FROM (SELECT doc_id, string_split(s, '') AS c FROM d))
    WHERE b IS NOT NULL GROUP BY 1, 2""",
)
def _(t):
    return vec.term_counts(t.documents, "doc_id", "text", "char", (2, 2))


@check("feature_hashing_v4")
def _(t):
    return vec.hash_terms(_tc(t), "doc_id", 2**18, signed=True)


@check("weighted_hash_bag_v5")
def _(t):
    return vec.hash_terms(_tc(t, (1, 2)), "doc_id", 2**24, ngram_weights=[1.5, 1.0], binary=True, min_support=3)


@check(
    "support_pruning_v6",
    f"""{UNI}, bound AS (SELECT MIN(t) AS t FROM (SELECT t, (SELECT COUNT(*) FROM voc WHERE df > t) AS k FROM (SELECT DISTINCT df AS t FROM voc UNION SELECT 0)) WHERE k <= 400)
    SELECT term, df, cf FROM voc WHERE df > (SELECT t FROM bound)""",
)
def _(t):
    return vec.prune_support(vec.vocabulary(_tc(t)), 400)


@check("binary_weights_v7", f"{UNI} SELECT doc_id, term, 1 AS n FROM tc")
def _(t):
    return vec.binarize_weights(_tc(t))


@check(
    "l2_rows_and_columns_v8",
    f"""{UNI} SELECT doc_id, term, {R('n / sqrt(SUM(n * n) OVER (PARTITION BY doc_id))', 'by_doc')}, {R('n / sqrt(SUM(n * n) OVER (PARTITION BY term))', 'by_term')} FROM tc""",
)
def _(t):
    tc = _tc(t).withColumns({"by_doc": F.col("n").cast("double"), "by_term": F.col("n").cast("double")}).drop("n")
    out = vec.l2_normalize(vec.l2_normalize(tc, "doc_id", "by_doc"), "term", "by_term")
    return rounded(out, "by_doc", "by_term")


@check(
    "stacked_blocks_v9",
    f"""{UNI} SELECT doc_id, 'text:' || term AS term, n FROM tc UNION ALL SELECT doc_id, 'lang:' || lang, 1 FROM documents""",
)
def _(t):
    lang = t.documents.select("doc_id", F.col("lang").alias("term"), F.lit(1).cast("long").alias("n"))
    return vec.stack_blocks({"text": _tc(t), "lang": lang})
