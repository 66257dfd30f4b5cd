"""Benchmark decontamination by winnowing.

Every window of a document has an anchor, its k-gram of smallest hash, and so has
every window of a benchmark item; a shared window has the same anchor on both
sides.  Documents' anchors are matched with those of the benchmark, the windows
around a matched anchor are joined with the benchmark's by their words, and the
hits are put together to the document's hit words.  Nothing is sampled: a span
of at least one window that both sides share is always found.

The anchors of the benchmark also go to the tasks as a bitmap of bounded
size (``common.MAX_BITS``); it spares rows that cannot join and decides nothing.

Cases: NULL and empty texts have no words, n_hit 0 and are not contaminated; an
item without words has no window; NULL item ids hit but are not listed; an
empty benchmark hits nothing; repeated rows get equal results; further columns
are kept by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import bitmap, may_hold, rows_of, stored
from featloom.llm.winnow import find_runs, rolling

WINDOW, GRAM = 13, 5
GROUP_WORDS = 300_000
# words are digits, letters and all beyond ASCII; A-Z is lower-cased, the rest of ASCII separates
TABLE = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
HITS = "array<struct<fp: bigint, size: int, window: binary, starts: array<int>>>"
HIT_TYPE = pa.list_(pa.struct([("fp", pa.int64()), ("size", pa.int32()), ("window", pa.binary()), ("starts", pa.list_(pa.int32()))]))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(TABLE).split()


def symbols(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def windows_of(groups: list[list[bytes]], short: list[int], passes) -> list[dict]:
    """For each document {(fp, size, window): starts}, of windows whose fingerprint ``passes``."""
    hashed = [symbols(w) for w in groups]
    found: list[dict] = [{} for _ in groups]

    def note(doc: int, at: int, size: int, fp: int) -> None:
        key = (fp, size, b" ".join(groups[doc][at : at + size]))
        found[doc].setdefault(key, []).append(at)

    runs = find_runs(hashed, WINDOW, GRAM)
    for r in np.flatnonzero(passes(runs.anchor)):
        for at in range(int(runs.first[r]), int(runs.last[r]) + 1):
            note(int(runs.doc[r]), at, WINDOW, int(runs.anchor[r].view(np.int64)))
    for size in short:
        for doc, h in enumerate(hashed):
            grams = rolling(h, size)
            for at in np.flatnonzero(passes(grams)):
                note(doc, int(at), size, int(grams[at].view(np.int64)))
    return found


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of benchmark items; an item below WINDOW words is one window."""
    everything = lambda fp: np.ones(len(fp), bool)
    for batch in batches:
        rows = []
        for item, text in rows_of([batch], "item_id", "text"):
            words = words_of(text)
            if words:
                short = [len(words)] if len(words) < WINDOW else []
                rows += [(item, size, fp, window) for fp, size, window in windows_of([words], short, everything)[0]]
        cols = list(zip(*rows)) or [[], [], [], []]
        types = [pa.string(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["item", "size", "fp", "window"])


def benchmark_windows(bench: DataFrame) -> DataFrame:
    """(fp, window, size, items): each window once, with the ids of its items as strings."""
    rows = bench.select(F.col("item_id").cast("string"), F.col("text").cast("binary").alias("text"))
    rows = rows.mapInArrow(_items, "item string, size int, fp long, window binary")
    return rows.groupBy("fp", "window", "size").agg(F.collect_set("item").alias("items"))


def matches(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """(doc_id, mark, n_words, hits) for each row of ``docs``; hits are windows whose fingerprint the benchmark may have."""
    short = sorted(r.size for r in bench.where(F.col("size") < WINDOW).select(F.col("size").alias("size")).distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(bench.select("fp").distinct(), "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value
        passes = lambda fp: may_hold(table, fp)

        def flush(ids: list, marks: list, groups: list) -> pa.RecordBatch:
            hits = [[{"fp": f, "size": s, "window": w, "starts": at} for (f, s, w), at in d.items()] for d in windows_of(groups, short, passes)]
            counts = pa.array([len(g) for g in groups], pa.int64())
            arrays = [pa.array(ids, pa.int64()), pa.array(marks, pa.int64()), counts, pa.array(hits, HIT_TYPE)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "mark", "n_words", "hits"])

        ids, marks, groups, size = [], [], [], 0
        for doc, mark, text in rows_of(batches, "doc_id", "mark", "text"):
            ids.append(doc), marks.append(mark), groups.append(words_of(text))
            size += len(groups[-1]) + 10
            if size > GROUP_WORDS:
                yield flush(ids, marks, groups)
                ids, marks, groups, size = [], [], [], 0
        if ids:
            yield flush(ids, marks, groups)

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, mark long, n_words long, hits {HITS}")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, mark, n_words, n_hit, n_items, items_sha256, contaminated) for each row of ``docs``; mark is the text's hash."""
    bench = stored(benchmark_windows(benchmark), "benchmark-windows")
    base = stored(matches(docs, bench), "matches")
    hits = base.where(F.size("hits") > 0).select("doc_id", "mark", F.inline("hits")).drop("size")
    hits = hits.join(bench, ["fp", "window"])
    spans = F.transform("starts", lambda s: F.struct(s.alias("a"), (s + F.col("size")).alias("b")))
    found = hits.groupBy("doc_id", "mark").agg(
        F.array_sort(F.flatten(F.collect_list(spans))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "spans",
        zero,
        lambda a, x: F.struct(F.greatest(a["end"], x["b"]).alias("end"), (a["n"] + F.greatest(x["b"] - F.greatest(x["a"], a["end"]), F.lit(0))).alias("n")),
    )["n"]
    found = found.select(
        F.col("doc_id").alias("f_id"), F.col("mark").alias("f_mark"), covered.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("items"),
    )
    same = base["doc_id"].eqNullSafe(found["f_id"]) & base["mark"].eqNullSafe(found["f_mark"])
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return base.join(found, same, "left").select(
        "doc_id",
        "mark",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = report(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("b_id"), F.col("mark").alias("b_mark")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["b_id"]) & (F.xxhash64(docs["text"]) == bad["b_mark"]), "left_anti")


SQL = r"""
WITH dw AS (SELECT doc_id, text, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM bw WHERE len(ws) > 0),
bx AS (SELECT item_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS i FROM bi),
bwin AS (SELECT DISTINCT item_id, n, ws[i:i+n-1] AS g FROM bx),
dx AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM bwin) WHERE len(ws) >= n),
hit AS (SELECT doc_id, i, dx.n AS n, item_id FROM dx JOIN bwin ON dx.n = bwin.n AND ws[i:i+dx.n-1] = g),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id),
r AS (SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256 FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id))
SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM r
"""
