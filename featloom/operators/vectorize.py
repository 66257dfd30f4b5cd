"""Documents as long-form (id, term, weight) rows."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.functions.text import SPACE, clean_tokens, sequence_tokens
from featloom.operators.joins import attach
from featloom.plans.prefix import running_sums
from featloom.plans.sizing import cut_lineage, is_small, spread
from featloom.plans.skew import keyed_left_join

# (document, term) rows that a task sends on together
ROWS = 100_000
# a vocabulary of files up to this size is broadcast whole
BROADCAST_BYTES = 4 * 1024 * 1024
# buckets up to this number are marked by a bit each (16 MB)
MARKED = 2**27


def word_ngrams(tokens: list[str], sizes: tuple[int, int]) -> list[str]:
    """All n-grams of a token list, n from sizes[0] to sizes[1]."""
    every = range(sizes[0], sizes[1] + 1)
    return [g for n in every for g in (tokens if n == 1 else map(" ".join, zip(*[tokens[i:] for i in range(n)])))]


def char_ngrams(text: str, sizes: tuple[int, int]) -> list[str]:
    """Character n-grams of a (long) text; an empty text is one empty character."""
    if not text:
        return [""] if sizes[0] <= 1 <= sizes[1] else []
    return [text[i : i + n] for n in range(sizes[0], sizes[1] + 1) for i in range(len(text) - n + 1)]


def piece_ngrams(piece: str, sizes: tuple[int, int]) -> list[str]:
    """Character n-grams of a short string; a string shorter than the smallest size counts once as a whole."""
    return [piece] if len(piece) < sizes[0] else char_ngrams(piece, sizes)


def _word_counts(text: str, sizes: tuple[int, int]) -> Counter:
    return Counter(word_ngrams(text.split(" ") if text else [], sizes))


def _char_counts(text: str, sizes: tuple[int, int]) -> Counter:
    return Counter(char_ngrams(text, sizes))


def _char_wb_counts(text: str, sizes: tuple[int, int]) -> Counter:
    # repeated words of a document are cut once and counted by their number
    out: Counter = Counter()
    for word, n in Counter(w for w in re.split(SPACE, text) if w).items():
        for gram in piece_ngrams(f" {word} ", sizes):
            out[gram] += n
    return out


def _counted(df: DataFrame, id_col: str, text: str, count, sizes: tuple[int, int]) -> DataFrame:
    """(id, term, n) of each row by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            at, terms, numbers = [], [], []

            def send() -> pa.RecordBatch:
                arrays = [ids.take(pa.array(at, pa.int64())), pa.array(terms, pa.string()), pa.array(numbers, pa.int64())]
                return pa.RecordBatch.from_arrays(arrays, names=[id_col, "term", "n"])

            for i, value in enumerate(texts):
                found = count(value.as_py(), sizes) if value.is_valid else {}
                at += [i] * len(found)
                terms += found.keys()
                numbers += found.values()
                if len(at) > ROWS:
                    yield send()
                    at, terms, numbers = [], [], []
            yield send()

    schema = T.StructType([df.schema[id_col], T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])
    return df.select(id_col, text).mapInArrow(run, schema)


def term_counts(
    df: DataFrame,
    id_col: str,
    text: str,
    analyzer: str = "word",
    ngrams: tuple[int, int] = (1, 1),
    stopwords: list[str] = (),
) -> DataFrame:
    """(id, term, n).  'word': letter/digit runs of two or more characters;
    'char': n-grams of the squeezed text; 'char_wb': n-grams inside blank-padded words.

    A row is counted where it is read.  Only the terms of ids that several rows
    share (NULL is such an id) are shuffled and added up.
    """
    lowered = F.regexp_replace(F.lower(text), r"[ \t\r\n]{2,}", " ")
    kinds = {
        "word": (F.array_join(clean_tokens(F.col(text), list(stopwords)), " "), _word_counts),
        "char": (lowered, _char_counts), "char_wb": (lowered, _char_wb_counts),
    }
    if analyzer not in kinds:
        raise ValueError(analyzer)
    form, count = kinds[analyzer]
    ids = df.groupBy(F.col(id_col).alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    several = cut_lineage(ids.filter("__n > 1").select("__id"))
    df = spread(df.select(id_col, text)).select(id_col, form.alias("__t"))
    if not several.head(1):
        return _counted(df, id_col, "__t", count, ngrams)
    same = F.col(id_col).eqNullSafe(F.col("__id"))
    alone = _counted(df.join(several, same, "left_anti"), id_col, "__t", count, ngrams)
    rows = _counted(df.join(several, same, "left_semi"), id_col, "__t", count, ngrams)
    return alone.unionByName(rows.groupBy(id_col, "term").agg(F.sum("n").alias("n")))


def vocabulary(tc: DataFrame) -> DataFrame:
    """(term, df, cf): documents with the term, and occurrences."""
    return tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("cf"))


def prune_vocab(
    vocab: DataFrame, min_df: int = 1, max_df: float | int | None = None, max_features: int | None = None,
    n_docs: int | Column | None = None,
) -> DataFrame:
    """Document-frequency bounds, then the most frequent ``max_features`` terms
    (ties by term).  A float ``max_df`` is a share of ``n_docs``."""
    kept = vocab.filter(F.col("df") >= min_df)
    if max_df is not None:
        bound = F.lit(max_df) * n_docs if isinstance(max_df, float) else F.lit(max_df)
        kept = kept.filter(F.col("df") <= bound)
    if max_features is None:
        return kept
    ordered = kept.withColumn("__neg", -F.col("cf"))
    ranked = running_sums(ordered, [], ["__neg", "term"], {"__rank": F.lit(1)})
    return ranked.filter(F.col("__rank") <= max_features).select(*vocab.columns)


def support_threshold(vocab: DataFrame, max_features: int) -> DataFrame:
    """One row: the smallest bound t for which at most ``max_features`` terms have df > t."""
    sizes = vocab.groupBy("df").agg(F.count(F.lit(1)).alias("terms"))
    above = running_sums(sizes.withColumn("__neg", -F.col("df")), [], ["__neg"], {"kept": F.col("terms")})
    # the largest df whose suffix is too long must be dropped
    return above.agg(F.coalesce(F.max(F.when(F.col("kept") > max_features, F.col("df"))), F.lit(0)).alias("min_df"))


def prune_support(vocab: DataFrame, max_features: int, min_df: int = 0) -> DataFrame:
    """Raise the document-frequency bound until the vocabulary fits."""
    bound = F.greatest(support_threshold(vocab, max_features).scalar(), F.lit(min_df))
    return vocab.filter(F.col("df") > bound)


def restrict(tc: DataFrame, vocab: DataFrame) -> DataFrame:
    """Rows whose term is in the vocabulary, with its document frequency."""
    vocab = cut_lineage(vocab.select("term", "df"))
    if is_small(vocab, BROADCAST_BYTES):
        return tc.join(F.broadcast(vocab), "term").select(*tc.columns, "df")
    joined = keyed_left_join(tc, vocab.withColumn("__n", F.col("df")), ["term"], weight="__n")
    return joined.filter(F.col("df").isNotNull())


def tfidf(
    tc: DataFrame, id_col: str, n_docs: int | Column, smooth: bool = True, sublinear: bool = False,
    norm: str | None = "l2",
) -> DataFrame:
    """(id, term, w) with idf ln((1+n)/(1+df))+1 (smooth) or ln(n/df)+1."""
    if "df" not in tc.columns:
        dfs = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.count(F.lit(1)).alias("__n"))
        tc = keyed_left_join(tc, dfs, ["term"], weight="__n")
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1 if smooth else F.log(n / F.col("df")) + 1
    tf = 1 + F.log(F.col("n").cast("double")) if sublinear else F.col("n").cast("double")
    weighted = tc.select(id_col, "term", (tf * idf).alias("w"))
    return l2_normalize(weighted, id_col) if norm == "l2" else weighted


def l2_normalize(tc: DataFrame, by: str, w: str = "w") -> DataFrame:
    """Divide by the root of the sum of squares per document or per term."""
    if by == "term":
        sums = tc.groupBy(by).agg(F.sum(F.col(w) * F.col(w)).alias("__ss"), F.count(F.lit(1)).alias("__n"))
        rows = keyed_left_join(tc, sums, [by], weight="__n")
    else:
        # the terms of one document fit in a task
        rows = tc.withColumn("__ss", F.sum(F.col(w) * F.col(w)).over(Window.partitionBy(by)))
    return rows.withColumn(w, F.coalesce(F.try_divide(F.col(w), F.sqrt("__ss")), F.lit(0.0))).drop("__ss")


def binarize_weights(tc: DataFrame, w: str = "n") -> DataFrame:
    return tc.withColumn(w, F.when(F.col(w) > 0, 1).otherwise(0))


def stack_blocks(blocks: dict[str, DataFrame]) -> DataFrame:
    """Side-by-side blocks: a union in which terms carry the block name."""
    parts = [tc.withColumn("term", F.concat(F.lit(f"{name}:"), F.col("term"))) for name, tc in blocks.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def category_block(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """(id, term, w): one-hot codes in long form; a missing category is no term."""
    pairs = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in cols]
    return df.select(id_col, F.explode(F.array_compact(F.array(*pairs))).alias("term")).withColumn("w", F.lit(1.0))


def number_block(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    """(id, term, w): numeric columns (predictions, counts) in long form; missing numbers are no term."""
    cells = [F.struct(F.lit(c).alias("term"), F.col(c).cast("double").alias("w")) for c in cols]
    return df.select(id_col, F.explode(F.array(*cells)).alias("c")).select(id_col, "c.*").filter("w IS NOT NULL")


def block_features(rows: DataFrame, id_col: str, blocks: dict[str, DataFrame], name: str = "features") -> DataFrame:
    """``rows`` with all blocks (id, term, w) side by side as one sparse vector; a row without a term gets zeros.

    Terms of different blocks are different columns; columns follow the order of block and term.
    """
    from featloom.operators.topics import to_sparse

    vectors, _ = to_sparse(stack_blocks({n: b.select(id_col, "term", "w") for n, b in blocks.items()}), id_col, "w", ids=rows)
    return rows.join(vectors.withColumnRenamed("vec", name), id_col)


def hash_terms(
    tc: DataFrame, id_col: str, n_features: int = 2**18, signed: bool = False,
    ngram_weights: list[float] | None = None, binary: bool = False, min_support: int | None = None,
) -> DataFrame:
    """(id, bucket, w): terms hashed to buckets.  ``ngram_weights[i]`` weighs (i+1)-grams;
    ``binary`` uses presence; buckets with at most ``min_support`` documents are dropped."""
    h = F.xxhash64("term")
    value = F.lit(1.0) if binary else F.col("n").cast("double")
    if ngram_weights:
        size = F.size(F.split("term", " "))
        value = value * F.element_at(F.array(*[F.lit(float(w)) for w in ngram_weights]), size)
    if signed:
        value = F.when(F.shiftright(h, 62).bitwiseAND(F.lit(1)) == 0, value).otherwise(-value)
    rows = tc.select(id_col, F.pmod(h, F.lit(n_features)).cast("int").alias("bucket"), value.alias("w"))
    # with signs, terms of one bucket may cancel; presence is then the sign of what is left
    combine = F.sum("w") if not binary else F.signum(F.sum("w")) if signed else F.max("w")
    out = rows.groupBy(id_col, "bucket").agg(combine.alias("w"))
    if min_support is None:
        return out
    out = cut_lineage(out)
    support = out.groupBy("bucket").agg(F.count(F.lit(1)).alias("__s"))
    if n_features <= MARKED:
        return _marked(out, support.filter(F.col("__s") > min_support), n_features)
    joined = keyed_left_join(out, support.withColumn("__n", F.col("__s")), ["bucket"], weight="__n")
    return joined.filter(F.col("__s") > min_support).drop("__s")


def _marked(rows: DataFrame, kept: DataFrame, n_features: int) -> DataFrame:
    """The ``rows`` whose bucket is among ``kept``, by a broadcast of one bit for each bucket; no row is shuffled."""
    one = F.expr("shiftleft(1L, bucket & 63)")
    table = kept.groupBy(F.shiftright("bucket", 6).alias("at")).agg(F.bit_or(one).alias("bits")).toPandas()
    marks = np.zeros(-(-n_features // 64), np.uint64)
    marks[table["at"].to_numpy(np.int64)] = table["bits"].to_numpy(np.int64).view(np.uint64)
    known = rows.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = batch.column(batch.schema.get_field_index("bucket")).to_numpy(zero_copy_only=False).astype(np.uint64)
            found = known.value[bucket >> np.uint64(6)] >> (bucket & np.uint64(63)) & np.uint64(1)
            yield batch.filter(pa.array(found.astype(bool)))

    return rows.mapInArrow(run, rows.schema)


def word_index(df: DataFrame, text: str, num_words: int) -> DataFrame:
    """(term, code, n): codes 1 .. num_words - 1 by frequency n, ties by term."""
    tokens = df.select(F.explode(sequence_tokens(F.col(text))).alias("term"))
    counts = tokens.groupBy("term").agg((-F.count(F.lit(1))).alias("__neg"))
    ranked = running_sums(counts, [], ["__neg", "term"], {"code": F.lit(1)})
    return ranked.filter(F.col("code") < num_words).select("term", F.col("code").cast("int"), (-F.col("__neg")).alias("n"))


def token_ids(df: DataFrame, id_col: str, text: str, num_words: int, maxlen: int, fit_on: DataFrame | None = None) -> DataFrame:
    """Codes of the known tokens, cut in front and padded in front to ``maxlen``."""
    index = word_index(df if fit_on is None else fit_on, text, num_words)
    tokens = df.select(id_col, F.posexplode(sequence_tokens(F.col(text))).alias("__p", "term"))
    known = attach(tokens, index, "term", weight="n").filter(F.col("code").isNotNull())
    seqs = known.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("__p", "code"))).alias("__s"))
    codes = F.coalesce(F.transform("__s", lambda s: s["code"]), F.array().cast("array<int>"))
    last = F.when(F.size(codes) > maxlen, F.slice(codes, -maxlen, maxlen)).otherwise(codes)
    out = df.select(id_col).join(seqs, id_col, "left").select(id_col, last.alias("__l"))
    padding = F.array_repeat(F.lit(0), F.lit(maxlen) - F.size("__l"))
    return out.select(id_col, F.concat(padding, "__l").alias("ids"))
