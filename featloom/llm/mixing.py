"""Mixing sources to target weights by pivotal dependent rounding.

A source's target over its size says how many copies of each of its documents
the mix takes; the whole part is certain, the fraction is a probability.  Two
documents with open probabilities play against each other: words move from one
to the other, at random and without changing either expectation, until one of
them is certain.  One open document is left of each block, the blocks' open
documents meet in the next level of the tree, and one coin decides the last of
a source.  So each source takes its target up to the size of one document.

Blocks come from hashes of the documents, and so do the random numbers: reruns
agree, whatever the partitions, and a large source is many blocks.

Cases: NULL text has size 0; documents of size 0 are decided by a coin each and
take nothing; a NULL source is a source, the last; rows that agree in doc_id,
source and size are one unit with one decision; an empty table gives an empty
result; ``mix`` keeps all columns and adds (or replaces) ``mix_copy``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import prefix_sums_by, stored, words

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # of all sizes
MOST = 2.0  # times a source's size
BLOCK, FAN_IN = 1024, 64
SEED = 20


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n, target) from rows (source, size, n): shares by weight, none above MOST times its source.

    Sorted by limit over weight, the sources at their limit come first; the level
    of the others follows from running sums.
    """
    total = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"), F.sum("n").alias("n"))
    ranked = prefix_sums_by(total, [F.col("source").isNull(), F.col("source")], {"rank": F.lit(1)})
    pick = F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.pmod(F.col("rank") - 1, F.lit(len(WEIGHTS))).cast("int"))
    rows = ranked.withColumn("weight", pick).withColumn("most", MOST * F.col("source_size"))
    level = F.col("most") / F.col("weight")
    rows = prefix_sums_by(rows, [level, F.col("rank")], {"sum_most": F.col("most"), "sum_weight": F.col("weight")})
    rows = stored(rows, "levels")
    whole = rows.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    here = (SHARE * F.col("all_size") - F.col("sum_most") + F.col("most")) / (F.col("all_weight") - F.col("sum_weight") + F.col("weight"))
    water = rows.join(F.broadcast(whole)).where(here < level).agg(F.max(here).alias("water"))  # one row each
    rows = rows.join(F.broadcast(water))
    return rows.select("source", "source_size", "n", F.least("most", F.coalesce(F.col("water") * F.col("weight"), F.col("most"))).alias("target"))


def uniform(a: int, b: int, level: int) -> float:
    """A number in [0, 1) that depends on two hashes and the level only."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + level * 0x165667B19E3779F9) % 2**64
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) % 2**64
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) % 2**64
    return (x ^ x >> 31) / 2**64


def round_block(prob: np.ndarray, size: np.ndarray, key: np.ndarray, level: int, last: bool) -> np.ndarray:
    """Probabilities after the block's pairs have played: 0 or 1, one at most between unless ``last``."""
    out = prob.astype(float).copy()
    open_at = -1
    for i in range(len(out)):
        if open_at < 0:
            open_at = i
            continue
        j = open_at
        p, q, a, b = out[j], out[i], float(size[j]), float(size[i])
        up = min(1 - p, q * b / a)  # what p may gain
        down = min(p, (1 - q) * b / a)  # what p may lose
        if uniform(int(key[j]), int(key[i]), level) * (up + down) < down:
            full = up == 1 - p
            p, q = (1.0, q - up * a / b) if full else (p + up, 0.0)
        else:
            full = down == p
            p, q = (0.0, q + down * a / b) if full else (p - down, 1.0)
        out[j], out[i] = (round(x) if abs(x - round(x)) < 1e-9 else x for x in (p, q))
        left = [x for x in (j, i) if 0 < out[x] < 1]
        open_at = left[0] if left else -1
    if last and open_at >= 0:
        out[open_at] = float(uniform(int(key[open_at]), 0, level + 100) < out[open_at])
    return out


def _level(rows: DataFrame, level: int) -> DataFrame:
    """Plays one level: blocks of rows with a probability between 0 and 1."""
    schema = rows.schema

    def play(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "size"], kind="stable").reset_index(drop=True)
        last = bool(pdf["blocks"].iloc[0] == 1)
        pdf["prob"] = round_block(pdf["prob"].to_numpy(), pdf["size"].to_numpy(), pdf["key"].to_numpy(), level, last)
        pdf["blocks"] = -(-pdf["blocks"] // FAN_IN)
        pdf["block"] = pdf["block"] % pdf["blocks"]
        return pdf

    return rows.groupBy("s_key", "block").applyInPandas(play, schema)


def decide(sizes: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each distinct (doc_id, source, size)."""
    units = stored(sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "units")
    units = units.withColumn("words", F.col("size") * F.col("rows"))
    goal = targets(units.select("source", F.col("words").alias("size"), F.lit(1).alias("n")))
    goal = goal.withColumnRenamed("source", "g_source")
    rows = units.join(goal, units["source"].eqNullSafe(goal["g_source"])).drop("g_source")
    many = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = rows.withColumn("many", many).withColumn("base", F.floor("many").cast("int"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    key = F.xxhash64(F.lit(SEED), "doc_id", "source", "size")
    rows = rows.withColumns({"key": key, "prob": F.col("many") - F.col("base"), "blocks": blocks, "s_key": F.xxhash64("source")})
    rows = rows.withColumn("block", F.pmod("key", "blocks")).drop("many", "n", "rows")
    # nothing to balance for these: each is decided by itself
    coin = (F.pmod(F.xxhash64(F.lit(SEED + 1), "key"), F.lit(2**30)) / 2**30 < F.col("prob")).cast("double")
    rows = rows.withColumn("prob", F.when(F.col("words") == 0, coin).otherwise(F.col("prob")))
    rows = rows.withColumn("size_", F.col("size")).withColumn("size", F.col("words").cast("double"))
    rows = stored(rows, "open")
    most = rows.agg(F.max("blocks")).first()[0] or 1
    is_open = "prob > 0 AND prob < 1"
    done = [rows.where(f"NOT ({is_open})")]
    now = rows.where(is_open)
    for level in range(1 + math.ceil(math.log(max(most, 1)) / math.log(FAN_IN) + 1e-9)):
        played = stored(_level(now, level), "level")
        done.append(played.where(f"NOT ({is_open})"))
        now = played.where(is_open)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = (F.col("base") + F.col("prob").cast("int")).alias("copies")
    return out.select("doc_id", "source", F.col("size_").alias("size"), "source_size", "target", copies)


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``."""
    sizes = stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sizes")
    made = decide(sizes).select(*[F.col(c).alias(f"d_{c}") for c in ("doc_id", "source", "size", "source_size", "target", "copies")])
    same = [sizes[c].eqNullSafe(made[f"d_{c}"]) for c in ("doc_id", "source", "size")]
    rows = sizes.join(made, same)
    return rows.select(
        "doc_id", "size", F.col("d_source_size").alias("source_size"), F.col("d_target").alias("target"),
        (F.col("size") * F.col("d_copies")).alias("taken"),
    )


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` the mix takes, each as often as it is taken, numbered in ``mix_copy``."""
    docs = docs.drop("mix_copy")
    sizes = stored(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sizes")
    made = decide(sizes).where("copies > 0").select(*[F.col(c).alias(f"d_{c}") for c in ("doc_id", "source", "size", "copies")])
    same = [docs["doc_id"].eqNullSafe(made["d_doc_id"]), docs["source"].eqNullSafe(made["d_source"]), size_of(docs["text"]).eqNullSafe(made["d_size"])]
    copies = F.explode(F.sequence(F.lit(1), F.col("d_copies"))).alias("mix_copy")
    return docs.join(made, same).select(*[docs[c] for c in docs.columns], copies)
