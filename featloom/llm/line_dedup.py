"""Line dedup through deletion neighbourhoods, with words as the letters of a line.

Two lines are alike if their words are the same or, in lines of at least
``NEAR_WORDS`` words, if one inserted, deleted or replaced word makes them the
same; lines without words are left alone.  A line goes if a like line stands
earlier, by (doc_id, line number), in the input.

Each different line is looked at once, at its earliest place.  Its neighbourhood
is the line without one of its words, for each of them; equal variants meet by
hash, and the place of the missing word tells whether the lines are one edit
apart (same place: a replaced word; a whole line and a variant: a missing one),
so no pair is ever written out.  Two lines one edit apart share their first or
last half of words; only lines that share a half emit their neighbourhood.

Hashes have 128 bits where they decide.  Cases: NULL text has no lines and stays
NULL; repeated rows (same id and text) are one document; a document may lose all
its lines and is then left with an empty text (``deduplicate`` drops it if
asked); NULL ids stand last; an empty table gives an empty result; further
columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import LAST_ID, mix, near_keys, rows_of, stored
from featloom.llm.winnow import BASE, powers, prefix_sums, span_hash

NEAR_WORDS = 10
GROUP_WORDS = 300_000
SECOND = np.uint64(0xD6E8FEB86659FD93)  # makes the second half of a 128-bit hash
PLACE = "decimal(38,0)"


def place(doc: Column, line: Column) -> Column:
    """(doc, line) as one number in the same order; NULL ids last."""
    return F.coalesce(doc, F.lit(LAST_ID)).cast(PLACE) * F.lit(2**31).cast("decimal(11,0)") + line.cast("decimal(11,0)")


def pair_hash(value: np.ndarray, again: np.ndarray, *tags) -> tuple[np.ndarray, np.ndarray]:
    tag = np.zeros(1, np.uint64)
    for t in tags:
        tag = mix(tag ^ (np.asarray(t).astype(np.int64).view(np.uint64) + np.uint64(1)))
    return mix(value ^ tag).view(np.int64), mix(again ^ mix(tag)).view(np.int64)


class Words:
    """The words of many lines one after the other, with hashes of any span of them."""

    def __init__(self, lines: list[list[bytes]]):
        digest = xxhash.xxh64_intdigest
        self.size = np.array([len(x) for x in lines], np.int64)
        self.stop = np.cumsum(self.size)
        self.start = self.stop - self.size
        hashed = np.fromiter((digest(w) for line in lines for w in line), np.uint64, int(self.size.sum()))
        self.sums = prefix_sums(hashed), prefix_sums(mix(hashed * SECOND))

    def spans(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(span_hash(s, start, stop) for s in self.sums)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, mark, line, again, c1, c2, keys): lines to compare; keys are those of their halves."""
    names = ["doc_id", "mark", "line", "again", "c1", "c2", "keys"]

    def flush(docs: list, marks: list, at: list, lines: list) -> pa.RecordBatch:
        w = Words(lines)
        n = w.size
        c1, c2 = pair_hash(*w.spans(w.start, w.stop), n)
        keys = []
        for longer in (0, 1):  # as one of two lines of n words, and as the shorter of n and n + 1
            half = (n + longer - 1) // 2
            for side, (a, b) in enumerate(((w.start, w.start + half), (w.stop - half, w.stop))):
                keys.append(pair_hash(*w.spans(a, b), n + longer, np.full(len(n), side))[0])
        near = n >= NEAR_WORDS
        near_but_long = n >= NEAR_WORDS - 1  # may be the shorter of a pair
        flat = np.stack(keys, axis=1)
        lists = [k if full else k[2:] if some else [] for k, full, some in zip(flat, near, near_but_long)]
        seen: dict = {}
        again = []
        for i, *key in zip(at, docs, marks, c1.tolist(), c2.tolist()):
            again.append(seen.setdefault(tuple(key), i) < i)  # a repeated row has the same line numbers
        arrays = [pa.array(docs, pa.int64()), pa.array(marks, pa.int64()), pa.array(at, pa.int32()), pa.array(again), pa.array(c1), pa.array(c2), pa.array(lists, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    docs, marks, at, lines, size = [], [], [], [], 0
    for doc, mark, text in rows_of(batches, "doc_id", "mark", "text"):
        for i, line in enumerate((text or b"").split(b"\n")):
            words = line.split()
            if words:
                docs.append(doc), marks.append(mark), at.append(i), lines.append(words)
                size += len(words)
        if size > GROUP_WORDS:
            yield flush(docs, marks, at, lines)
            docs, marks, at, lines, size = [], [], [], [], 0
    if lines:
        yield flush(docs, marks, at, lines)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v1, v2, kind, doc_id, mark, line): neighbourhoods of the chosen lines of each text.

    Kinds: 0 a line without the word at a place, hashed with the place; 1 the same
    hashed without it; 2 the whole line, hashed like 1.
    """
    for doc, mark, text, chosen in rows_of(batches, "doc_id", "mark", "text", "lines"):
        every = text.split(b"\n")
        for begin in range(0, len(chosen), 64):
            at = chosen[begin : begin + 64]
            w = Words([every[i].split() for i in at])
            of = np.repeat(np.arange(len(at)), w.size)
            here = np.arange(len(of))
            n = w.size[of]
            left, right = w.spans(w.start[of], here), w.spans(here + 1, w.stop[of])
            back = here - w.start[of]
            joined = tuple(span_joined(x, y, back) for x, y in zip(left, right))
            near = n >= NEAR_WORDS
            parts = [
                (pair_hash(*joined, n, back), 0, of, near),
                (pair_hash(*joined, n - 1), 1, of, near),
                (pair_hash(*w.spans(w.start, w.stop), w.size), 2, np.arange(len(at)), np.ones(len(at), bool)),
            ]
            v1 = np.concatenate([h[0][ok] for h, _, _, ok in parts])
            v2 = np.concatenate([h[1][ok] for h, _, _, ok in parts])
            kind = np.concatenate([np.full(int(ok.sum()), k, np.int8) for _, k, _, ok in parts])
            line = np.array(at, np.int32)[np.concatenate([o[ok] for _, _, o, ok in parts])]
            ids, marks = (pa.array(np.full(len(v1), x, np.int64)) for x in (doc, mark))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v1), pa.array(v2), pa.array(kind), ids, marks, pa.array(line)], names=["v1", "v2", "kind", "doc_id", "mark", "line"]
            )


def span_joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of two spans put together, the first of ``size`` symbols."""
    return left + right * powers(BASE, int(size.max(initial=0)) + 1)[size]


def marked(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))


def removed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, lines): the numbers of the lines that go, for documents (id and hash of the text) that lose any."""
    schema = "doc_id long, mark long, line int, again boolean, c1 long, c2 long, keys array<long>"
    lines = stored(marked(docs).mapInArrow(_lines, schema), "lines")
    earliest = F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc_id"), "line", F.col("mark")))
    classes = stored(lines.groupBy("c1", "c2").agg(earliest.alias("e"), F.first("keys").alias("keys")), "classes")

    keyed = classes.select("e", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chosen = keyed.join(shared, "key", "left_semi").select("e.*").distinct()
    chosen = stored(chosen.groupBy("doc_id", "mark").agg(F.sort_array(F.collect_list("line")).alias("lines")), "chosen")

    texts = near_keys(marked(docs), chosen, "mark").withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST_ID))).dropDuplicates(["doc_id", "mark"])
    texts = texts.join(chosen, ["doc_id", "mark"]).select("doc_id", "mark", "text", "lines")
    rows = texts.mapInArrow(_variants, "v1 long, v2 long, kind byte, doc_id long, mark long, line int")
    rows = stored(rows.select("v1", "v2", "kind", "mark", place(F.col("doc_id"), F.col("line")).alias("e")), "variants")
    firsts = rows.groupBy("v1", "v2").agg(
        *[F.min(F.when(F.col("kind") == k, F.col("e"))).alias(f"e{k}") for k in range(3)], F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    met = rows.join(firsts, ["v1", "v2"])
    earlier = F.when(F.col("kind") == 0, F.col("e0")).when(F.col("kind") == 1, F.col("e2")).otherwise(F.col("e1"))
    near = stored(met.where(earlier < F.col("e")).select("e", F.col("mark").alias("e_mark")).distinct(), "near")

    known = classes.select("c1", "c2", place(F.col("e.doc_id"), F.col("e.line")).alias("e"), F.col("e.mark").alias("e_mark"))
    known = known.join(near.withColumn("goes", F.lit(True)), ["e", "e_mark"], "left")
    found = lines.join(known, ["c1", "c2"])
    here = place(F.col("doc_id"), F.col("line"))
    gone = F.col("again") | F.col("goes").isNotNull() | (F.col("e") < here) | ((F.col("e") == here) & (F.col("e_mark") < F.col("mark")))
    return found.where(gone).groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("line")).alias("lines"))


def without(text: Column, lines: Column) -> Column:
    """The text's lines but those whose (sorted) numbers are given."""
    parts = F.split(text, "\n")
    return F.array_join(F.filter(parts, lambda x, i: ~F.array_contains(lines, i)), "\n")


def with_removed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``l_removed`` (array or NULL) and ``l_text``."""
    gone = removed_lines(docs).select(F.col("doc_id").alias("l_id"), F.col("mark").alias("l_mark"), F.col("lines").alias("l_removed"))
    same = docs["doc_id"].eqNullSafe(gone["l_id"]) & (F.xxhash64(docs["text"]) == gone["l_mark"])
    rows = docs.join(gone, same, "left").drop("l_id", "l_mark")
    text = F.when(F.col("l_removed").isNull(), F.col("text")).otherwise(without(F.col("text"), F.col("l_removed")))
    return rows.withColumn("l_text", text)


def deduplicate(docs: DataFrame, drop_empty: bool = True) -> DataFrame:
    """``docs`` without the lines that go; documents that lose every word go too, if ``drop_empty``."""
    rows = with_removed(docs)
    if drop_empty:
        rows = rows.where(F.col("l_removed").isNull() | F.col("l_text").rlike(r"[^\x20\x09-\x0D]"))
    out = {c: F.col(c) for c in docs.columns} | {"text": F.col("l_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("l_removed").isNull(), F.col("n_chars")).otherwise(F.length("l_text")).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[v.alias(c) for c, v in out.items()])


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) for each row of ``docs``."""
    gone = stored(removed_lines(docs), "removed").withColumn("key", F.xxhash64("doc_id", "mark"))
    rows = marked(docs).withColumn("key", F.xxhash64("doc_id", "mark"))
    changed = near_keys(rows, gone, "key").dropDuplicates(["doc_id", "mark"]).join(
        gone.select(F.col("doc_id").alias("g_id"), F.col("mark").alias("g_mark"), "lines"),
        F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("mark") == F.col("g_mark")),
    )
    changed = changed.select(
        F.col("g_id"), F.col("g_mark"), F.size("lines").alias("n"), F.sha2(without(F.col("text").cast("string"), F.col("lines")), 256).alias("sha")
    )
    text = F.coalesce("text", F.lit(""))
    base = docs.select(
        "doc_id", F.xxhash64("text").alias("mark"), F.sha2(text, 256).alias("whole"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
    )
    base = base.join(changed, base["doc_id"].eqNullSafe(changed["g_id"]) & (base["mark"] == changed["g_mark"]), "left")
    return base.select("doc_id", "n_lines", F.coalesce("n", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"))


# the rows of @docs (doc_id, text) without the lines that go, in DuckDB; doc_id is taken to be unique
SQL = r"""
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM @docs WHERE text IS NOT NULL),
lw AS (SELECT doc_id, k, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
c AS (SELECT ws, min((doc_id, k)) AS e FROM lw WHERE len(ws) > 0 GROUP BY ws),
v AS (SELECT ws, e, unnest(range(1, len(ws) + 1)) AS i FROM c WHERE len(ws) >= 10),
d AS (SELECT e, i, len(ws) AS n, ws[1:i-1] || ws[i+1:] AS g FROM v),
s AS (SELECT e, min(e) OVER (PARTITION BY g, i, n) AS f FROM d),
near AS (SELECT e FROM s WHERE f < e
         UNION SELECT d.e FROM d JOIN c ON d.g = c.ws WHERE c.e < d.e
         UNION SELECT c.e FROM d JOIN c ON d.g = c.ws WHERE d.e < c.e),
judged AS (SELECT lw.*, coalesce(c.e < (doc_id, k) OR near.e IS NOT NULL, false) AS gone
           FROM lw LEFT JOIN c ON lw.ws = c.ws LEFT JOIN near ON c.e = near.e),
deduped AS (SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
              coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS good FROM judged GROUP BY doc_id)
"""
REPORT_SQL = (
    "WITH " + SQL.replace("@docs", "documents")
    + " SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(good, '')) AS kept_sha256"
    + " FROM documents LEFT JOIN deduped USING (doc_id)"
)
