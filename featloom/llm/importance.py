"""Quality classifier by importance resampling.

Words and word pairs of the lower-cased text are hashed into ``BUCKETS``.  Two
bag-of-n-grams models, one of the target text (documents labelled good) and one
of all raw text, give each document the log of its probability under the target
model over that under the raw model; a pseudo-count draws the ratio of rare
buckets to one.  A document's own n-grams are left out of both models, so that
labelled documents have no advantage.  Gumbel noise on the log weights and the k
largest sums are a sample without replacement in proportion to the weights.

``k`` defaults to the share of good documents among the labelled ones, of all
rows.  Ranks come from ranges of the order, so no task sees all rows.

Cases: NULL and empty texts have weight 1 but rank last; an id labelled twice is
good if any of its labels is; labels without a document are ignored; without
good labels the weights are 1; repeated rows share weight and noise; an empty
table gives an empty result; further columns are kept by ``select``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import mix, near_keys, prefix_sums_by, rows_of, stored

BUCKETS = 2**18
PSEUDO = 4.0
SEED = 6
PER_ID = 64  # bits of the bitmap for each labelled id
GROUP = 500_000


def grams(text: bytes | None) -> np.ndarray:
    """Bucket of each word and of each pair of neighbours."""
    words = (text or b"").lower().split()
    digest = xxhash.xxh64_intdigest
    one = np.fromiter((digest(w) for w in words), np.uint64, len(words))
    two = mix(one[:-1] * np.uint64(3) + one[1:] * np.uint64(0x9E3779B97F4A7C15))
    return (np.concatenate((one, two)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    waiting, size = [], 0
    for (text,) in rows_of(batches, "text"):
        waiting.append(grams(text))
        size += len(waiting[-1])
        if size > GROUP:
            total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
            waiting, size = [], 0
    if waiting:
        total += np.bincount(np.concatenate(waiting), minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def counts(docs: DataFrame) -> np.ndarray:
    """N-grams in each bucket over all rows; BUCKETS numbers, whatever the corpus."""
    rows = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(_count, "bucket long, n long")
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(BUCKETS)
    out[table["bucket"].to_numpy(np.int64)] = table["n"].to_numpy(np.float64)
    return out


def _score(models):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = models.value
        all_raw, all_target = raw.sum(), target.sum()
        for batch in batches:
            out = []
            for doc, mark, text in rows_of([batch], "doc_id", "mark", "text"):
                own, n = np.unique(grams(text), return_counts=True)
                size = n.sum()
                rest, t = raw[own] - n, target[own]
                pair = []
                for mine, kept in ((0, 0), (n, size)):
                    share = (all_target - kept) / max(all_raw - size, 1.0)
                    pair.append(float((n * np.log(np.maximum(t - mine, 0) + PSEUDO)).sum() - (n * np.log(np.maximum(rest, 0) * share + PSEUDO)).sum()))
                out.append((doc, mark, int(size), *pair))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "mark", "n_grams", "other", "inside"])

    return run


def weights(docs: DataFrame, good_ids: DataFrame) -> DataFrame:
    """(doc_id, mark, n_grams, log_weight) of each row; ``good_ids`` (doc_id) names the target documents."""
    good = good_ids.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("g_id")).distinct()
    good = stored(good.withColumn("key", F.xxhash64("g_id")), "good")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    keyed = rows.select("doc_id", "text").withColumn("key", F.xxhash64("doc_id"))
    # counts of the target: those of all rows that the bitmap lets pass, less those it lets pass by chance, whose texts are few
    some = near_keys(keyed, good, "key", PER_ID)
    others = some.select("doc_id", "key").join(good, F.col("doc_id") == F.col("g_id"), "left_anti").distinct()
    others = stored(others.select(F.col("doc_id").alias("o_id"), "key"), "others")
    extra = near_keys(some, others, "key", PER_ID).join(others.select("o_id"), F.col("doc_id").eqNullSafe(F.col("o_id")), "left_semi")
    target = counts(some) - counts(extra)
    models = docs.sparkSession.sparkContext.broadcast((counts(rows), target))
    scored = rows.mapInArrow(_score(models), "doc_id long, mark long, n_grams long, other double, inside double")
    scored = scored.join(good.select("g_id"), F.col("doc_id") == F.col("g_id"), "left")
    return scored.select("doc_id", "mark", "n_grams", F.when(F.col("g_id").isNull(), F.col("other")).otherwise(F.col("inside")).alias("log_weight"))


def resample(weighted: DataFrame, k: int) -> DataFrame:
    """``weighted`` with ``kept``: a sample of ``k`` rows without replacement in proportion to exp(log_weight)."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), "doc_id", "mark"), 11) + 0.5) / 2.0**53
    noisy = F.when(F.col("n_grams") > 0, F.col("log_weight") - F.log(-F.log(u))).otherwise(F.lit(float("-inf")))
    order = [-noisy, F.col("doc_id"), F.col("mark")]
    ranked = prefix_sums_by(weighted, order, {"w_rank": F.lit(1)})
    return ranked.withColumn("kept", F.col("w_rank") <= k).drop("w_rank")


def classify(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """(doc_id, mark, n_grams, log_weight, kept) of each row of ``docs``; labels have doc_id, quality and toxic."""
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    by_id = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.coalesce(good, F.lit(False)).cast("int")).alias("good"))
    by_id = stored(by_id, "labels")
    if share is None:
        share = by_id.agg(F.avg("good")).first()[0]
    weighted = stored(weights(docs, by_id.where("good = 1")), "weights")
    return resample(weighted, round(weighted.count() * (1.0 if share is None else share)))


def select(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """The rows of ``docs`` that the sample takes."""
    kept = classify(docs, labels, share).where("kept").select(F.col("doc_id").alias("k_id"), F.col("mark").alias("k_mark"))
    same = docs["doc_id"].eqNullSafe(kept["k_id"]) & F.xxhash64(docs["text"]).eqNullSafe(kept["k_mark"])
    return docs.join(kept, same, "left_semi")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_grams, log_weight, kept) of each row of ``docs``."""
    return classify(docs, labels).drop("mark")
