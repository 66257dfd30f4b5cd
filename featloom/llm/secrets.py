"""Secret scan: candidate strings, and a random forest that removes the false ones.

Candidates are all runs of ``MIN_CHARS`` or more letters, digits and signs of keys;
a word between white space may hold many (minified JSON, CSV, URLs).  Features
of a candidate are its length, the shares of kinds of characters, changes between kinds, how usual its letter transitions are, the
share of it that dictionary words cover, its path (the source, and slashes), and
the words before and after it, hashed.  Dictionary and transitions are counted
over all texts.

Labelled findings come from the format alone: what has the form of a known key
or of a long hexadecimal digest is true, what is only letters is false, the rest
is unlabelled.  The forest is fitted on at most ``TRAIN_ROWS`` findings of each
kind, those of smallest hash, and judges every candidate.

All of it is DataFrame expressions and Spark's own learner.  Cases: NULL and
empty texts have no candidates; without findings of both kinds nothing can be
learned and the format decides alone; repeated rows give repeated findings; an
empty table gives an empty result; further columns are ignored, a missing or NULL
source is a source.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import stored, words

MIN_CHARS = 16
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 20, 6, 4
NEIGHBOURS, PATHS = 32, 8  # hashed values of a neighbouring word and of a source
DICTIONARY = 5  # texts must use a word as often
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
VALUE = rf"[A-Za-z0-9+/_=\-]{{{MIN_CHARS},}}"
# fixed values: the forms of known keys
KNOWN = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[baprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}.*|sk_live_[A-Za-z0-9]{16,}|AIza[0-9A-Za-z_-]{35})$"
DIGEST = r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{32,}$"


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, path, at, part, value, slashes, chars, before, last, next): each candidate, the ``part``-th of word ``at``.

    Slashes and characters are the word's; of its neighbours only hashes go along, as words may be long.
    """
    path = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.coalesce(path, F.lit("")).alias("path"), words(F.col("text")).alias("w"))
    w = F.col("w")
    none = F.array().cast("array<string>")
    values = F.transform(
        w, lambda x, i: F.struct(i.alias("at"), F.when(F.length(x) >= MIN_CHARS, F.regexp_extract_all(x, F.lit(VALUE), F.lit(0))).otherwise(none).alias("values"))
    )

    def near(i: Column) -> Column:
        return slot(F.lower(F.coalesce(F.when(i >= 0, F.get(w, i)), F.lit(""))), NEIGHBOURS)

    def word_of(c: Column) -> Column:
        at, x = c["at"], F.get(w, c["at"])
        return F.struct(
            at.alias("at"), c["values"].alias("values"), F.regexp_count(x, F.lit(r"[/\\]")).alias("slashes"), F.length(x).alias("chars"),
            near(at - 2).alias("before"), near(at - 1).alias("last"), near(at + 1).alias("next"),
        )

    found = F.transform(F.filter(values, lambda c: F.size(c["values"]) > 0), word_of)
    each = F.transform(
        found,
        lambda c: F.transform(
            c["values"],
            lambda v, j: F.struct(c["at"].alias("at"), j.alias("part"), v.alias("value"), *[c[k].alias(k) for k in ("slashes", "chars", "before", "last", "next")]),
        ),
    )
    return rows.select("doc_id", "path", F.inline(F.flatten(each)))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n) of the letter words of all texts, lower-cased, without what is longer than a candidate may be."""
    plain = F.filter(F.transform(words(F.lower("text")), lambda x: F.regexp_replace(x, r"[^\p{L}]", "")), lambda x: (F.length(x) >= 3) & (F.length(x) < MIN_CHARS))
    return docs.select(F.explode(plain).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def transitions(vocab: DataFrame) -> list[float]:
    """log probability of each pair of neighbours in ALPHABET, over all words; some 1,300 numbers, whatever the corpus."""
    size = len(ALPHABET)
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), i, F.lit(2)))
    seen = vocab.select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    seen = seen.where(F.col("pair").rlike("^[a-z0-9]{2}$"))
    table = {r.pair: r.n for r in seen.collect()}
    out = []
    for a in ALPHABET:
        row = [table.get(a + b, 0) + 1.0 for b in ALPHABET]
        total = sum(row)
        out += [row[j] / total for j in range(size)]
    return out


def slot(value: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(size)).cast("int")


def one_hot(at: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == at).cast("double"))


def with_features(rows: DataFrame, vocab: DataFrame, usual: list[float]) -> DataFrame:
    """``rows`` (from ``candidates``) with ``features`` as a vector."""
    v, low, n = F.col("value"), F.lower("value"), F.length("value").cast("double")

    def share(pattern: str) -> Column:
        return F.regexp_count(v, F.lit(pattern)) / n

    table, size = F.array(*[F.lit(float(x)) for x in usual]), len(ALPHABET)
    place = F.transform(
        F.filter(F.split(low, ""), lambda c: c != ""),
        lambda c: F.when(c.between("a", "z"), F.ascii(c) - 97).when(c.between("0", "9"), F.ascii(c) - 22),
    )
    rows = rows.withColumn("place", place)
    steps = F.transform(
        F.sequence(F.lit(0), F.size("place") - 2),
        lambda i: F.coalesce(F.log(F.get(table, F.get(F.col("place"), i) * size + F.get(F.col("place"), i + 1))), F.lit(-8.0)),
    )
    transition = F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / F.greatest(n - 1, F.lit(1.0))
    rows = rows.withColumn("transition", transition).drop("place")
    # the share of the value that dictionary words make up
    runs = rows.select("value").distinct().select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    known = vocab.where(F.col("n") >= DICTIONARY).select("word")
    cover = runs.join(known, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    rows = rows.join(cover, "value", "left").withColumn("coverage", F.coalesce("covered", F.lit(0)) / F.length("value")).drop("covered")
    kinds = r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"
    plain = [
        n, share("[0-9]"), share("[A-Z]"), share("[a-z]"), share(r"[^A-Za-z0-9]"), share(kinds), share("[aeiou]"), F.col("transition"), F.col("coverage"),
        F.size(F.array_distinct(F.split(v, ""))) / n, F.col("slashes"), F.col("chars") - F.length("value"),
    ]
    everything = F.concat(
        F.array(*[x.cast("double") for x in plain]), one_hot(slot(F.col("path"), PATHS), PATHS),
        *[one_hot(F.col(c), NEIGHBOURS) for c in ("before", "last", "next")],
    )
    return rows.withColumn("features", array_to_vector(everything))


def labelled(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label``: 1 by a known form, 0 for letters only, NULL else."""
    v = F.col("value")
    return rows.withColumn("label", F.when(v.rlike(KNOWN) | v.rlike(DIGEST), 1.0).when(v.rlike("^[A-Za-z]+$"), 0.0))


def training_rows(rows: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """At most ``limit`` findings of each label, those of smallest hash."""
    order = [F.xxhash64("value", "doc_id", "at", "part"), F.col("value")]
    return rows.where("label = 1").orderBy(*order).limit(limit).unionByName(rows.where("label = 0").orderBy(*order).limit(limit))


def fit(train: DataFrame):
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8)
    return forest.fit(train.select("features", "label"))


def scan(docs: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, at, part, value, label, probability) of every candidate; ``at`` counts words and ``part`` the candidates of a word from 0."""
    vocab = stored(vocabulary(docs), "dictionary")
    rows = stored(labelled(with_features(candidates(docs), vocab, transitions(vocab))), "candidates")
    train = stored(training_rows(rows, limit).select("features", "label"), "findings")
    if train.select("label").distinct().count() < 2:
        return rows.select("doc_id", "at", "part", "value", "label", F.coalesce("label", F.lit(0.0)).alias("probability"))
    judged = fit(train).transform(rows)
    return judged.select("doc_id", "at", "part", "value", "label", vector_to_array("probability")[1].alias("probability"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, at, part, n_chars, masked, value_sha256, probability, kept) of every candidate; kept is what the forest takes for a secret."""
    masked = F.concat(F.substring("value", 1, 4), F.lit("..."))
    return scan(docs).select(
        "doc_id", "at", "part", F.length("value").alias("n_chars"), masked.alias("masked"), F.sha2("value", 256).alias("value_sha256"),
        "probability", (F.col("probability") > 0.5).alias("kept"),
    )
