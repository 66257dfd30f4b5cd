"""Windows of symbols that also start earlier, found exactly and without pairs.

Windows with one anchor that follow each other are a run; a run's context is all
its symbols.  Runs with equal contexts (anchor at the same place) are equal as a
whole: all but the first repeat.  Of each different context only its first run
goes on, and only if its anchor occurs in another context as well.  Its windows
are put into blocks by their distance to the anchor; a block goes on if what all
its windows share occurs elsewhere, too, and its windows are then compared one by
one, by hash.  A window equals another only if anchor, distance and shared part
are equal, so no repeat is lost.

Skew: tasks reduce what they read to the first run of each context before
anything is shuffled; runs are dealt out by ranges of (anchor, context), so that
a frequent anchor is many partitions; the joins behind it are left to AQE.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import LAST_ID, mix, near_keys, rows_of, stored
from featloom.llm.winnow import BASE, find_runs, prefix_sums, span_hash

BLOCK = 8  # distances to the anchor that are looked at together
WIDE = 4096  # over the length of any window
RUNS = 400_000  # that a task holds before it reduces and passes them on
SECOND = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Spec:
    """What a window is, and whether a repeat inside one document counts."""

    symbols: Callable[[bytes], np.ndarray]
    length: int
    gram: int
    within: bool


def key_columns() -> list[Column]:
    """d and tag: the id, with NULL last, and a hash of the text, which tells apart rows that share an id."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("d"), F.xxhash64("text").alias("tag")]


def keyed(docs: DataFrame) -> DataFrame:
    """(d, tag, text, key) of each row; key is a hash of d and tag."""
    return docs.select(*key_columns(), F.col("text").cast("binary").alias("text")).withColumn("key", F.xxhash64("d", "tag"))


def merged(d: np.ndarray, tag: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges in order of (d, tag, first), with those that touch made one."""
    if not len(d):
        return d, tag, first, last
    new = np.concatenate(([True], (np.diff(d) != 0) | (np.diff(tag) != 0) | (first[1:] > last[:-1] + 1)))
    begin = np.flatnonzero(new)
    return d[begin], tag[begin], first[begin], np.maximum.reduceat(last, begin)


def reduced(
    a: np.ndarray, b: np.ndarray, d: np.ndarray, tag: np.ndarray, first: np.ndarray, last: np.ndarray, offset: np.ndarray, within: bool
) -> pa.RecordBatch:
    """Rows (a, b, d, tag, first, span, flag): the first of each class (a, b), and merged ranges of those that repeat it.

    The span of the former also holds the anchor's distance from the first start.
    """
    order = np.lexsort((first, tag, d))
    a, b, d, tag, first, last, offset = (x[order] for x in (a, b, d, tag, first, last, offset))
    if len(d):
        same = np.concatenate(([False], (np.diff(d) == 0) & (np.diff(tag) == 0) & (np.diff(first) == 0)))
        a, b, d, tag, first, last, offset = (x[~same] for x in (a, b, d, tag, first, last, offset))
    by = np.argsort(mix(a.view(np.uint64) ^ mix(b.view(np.uint64))), kind="stable")
    sa, sb = a[by], b[by]
    new = np.concatenate((np.ones(min(1, len(by)), bool), (np.diff(sa) != 0) | (np.diff(sb) != 0)))
    head = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))] if len(by) else by
    flag = np.zeros(len(d), bool)
    later = d[by] > d[head]
    if within:
        later |= (d[by] == d[head]) & (tag[by] == tag[head]) & (first[by] > first[head])
    flag[by] = later
    fd, ft, ff, fl = merged(*(x[flag] for x in (d, tag, first, last)))
    spread = mix(fd.view(np.uint64) * BASE ^ ff.astype(np.uint64)).view(np.int64)  # these meet nobody: any partition will do
    keep = ~flag
    columns = [
        np.concatenate((a[keep], spread)),
        np.concatenate((b[keep], np.zeros(len(fd), np.int64))),
        np.concatenate((d[keep], fd)),
        np.concatenate((tag[keep], ft)),
        np.concatenate((first[keep], ff)),
        np.concatenate(((offset * WIDE + last - first)[keep], fl - ff)).astype(np.int32),
        np.concatenate((np.zeros(int(keep.sum()), bool), np.ones(len(fd), bool))),
    ]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "d", "tag", "first", "span", "flag"])


ROWS = "a long, b long, d long, tag long, first long, span int, flag boolean"


class Collector:
    """Gathers arrays (a, b, d, tag, first, last, offset) and gives reduced batches."""

    def __init__(self, within: bool):
        self.parts, self.size, self.within = [], 0, within

    def add(self, *arrays: np.ndarray) -> None:
        self.parts.append(arrays)
        self.size += len(arrays[0])

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if self.parts and self.size >= least:
            yield reduced(*(np.concatenate(x) for x in zip(*self.parts)), self.within)
            self.parts, self.size = [], 0


def _runs(spec: Spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Collector(spec.within)

        def look(ids: list, tags: list, parts: list) -> None:
            r = find_runs(parts, spec.length, spec.gram)
            out.add(r.anchor.view(np.int64), r.context.view(np.int64), np.array(ids, np.int64)[r.doc], np.array(tags, np.int64)[r.doc], r.first, r.last, r.offset)

        ids, tags, parts, size = [], [], [], 0
        for d, tag, text in rows_of(batches, "d", "tag", "text"):
            part = spec.symbols(text or b"")
            if len(part) < spec.length:
                continue
            ids.append(d), tags.append(tag), parts.append(part)
            size += len(part)
            if size > 500_000:
                look(ids, tags, parts)
                ids, tags, parts, size = [], [], [], 0
                yield from out.batches(RUNS)
        if ids:
            look(ids, tags, parts)
        yield from out.batches(0)

    return run


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, b, d) to (d, tag, first, span, open): repeats, and first runs whose anchor has other contexts.

    Anchors at the edge of the partition may go on in the next one and count as having others.
    """

    def send(d, tag, start, span, is_open) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (d, tag, start, span, is_open)], names=["d", "tag", "first", "span", "open"])

    held = None  # rows of the anchor the last batch ended in: those not yet given out, or one that was, as a mark
    many = True  # whether that anchor has other contexts
    for batch in batches:
        a, b, d, tag, start, span, flag = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
        if flag.any():
            yield send(d[flag], tag[flag], start[flag], span[flag], np.zeros(int(flag.sum()), bool))
        now = [x[~flag] for x in (a, b, d, tag, start, span)]
        ghost = np.zeros(len(now[0]), bool)
        if not len(ghost):
            continue
        if held is not None:
            now = [np.concatenate(x) for x in zip(held[:6], now)]
            ghost = np.concatenate((held[6], ghost))
        a, b, d, tag, start, span = now
        new_a = np.concatenate(([True], np.diff(a) != 0))
        new_b = new_a | np.concatenate(([True], np.diff(b) != 0))
        first = np.maximum.accumulate(np.where(new_b, np.arange(len(a)), 0))
        again = d > d[first]
        group = np.cumsum(new_a) - 1
        several = np.bincount(group, weights=new_b) > 1
        several[0] |= many
        last = group == group[-1]
        ends_open = several[-1]
        wait = last & ~again & ~ends_open
        give = ~again & several[group] & ~ghost & ~wait
        again &= ~ghost
        out = give | again
        yield send(d[out], tag[out], start[out], np.where(give, span, span % WIDE)[out], give[out])
        if ends_open:
            mark = np.array([first[-1]])
            held, many = [x[mark] for x in now] + [np.ones(1, bool)], True
        else:
            held, many = [x[wait] for x in now] + [ghost[wait]], False
    if held is not None:
        rest = ~held[6]
        yield send(held[2][rest], held[3][rest], held[4][rest], held[5][rest], np.ones(int(rest.sum()), bool))


def _blocks(spec: Spec):
    """(c, d, tag, first, span): blocks of windows of the open runs; c is the hash of what a block's windows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["c", "d", "tag", "first", "span"])

        for d, tag, text, first, span in rows_of(batches, "d", "tag", "text", "first", "span"):
            part = spec.symbols(text)
            sums = prefix_sums(part)
            f, s = np.array(first, np.int64), np.array(span, np.int64)
            anchor, last = f + s // WIDE, f + s % WIDE
            low, high = (anchor - last) // BLOCK, (anchor - f) // BLOCK
            of = np.repeat(np.arange(len(f)), high - low + 1)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
            block = low[of] + nth
            near = anchor[of] - block * BLOCK  # the last start of the whole block
            begin, end = np.maximum(f[of], near - BLOCK + 1), np.minimum(last[of], near)
            c = mix(span_hash(sums, near, near - BLOCK + 1 + spec.length) ^ mix(block.astype(np.uint64)))
            parts.append((c.view(np.int64), np.full(len(of), d, np.int64), np.full(len(of), tag, np.int64), begin, (end - begin).astype(np.int32)))
            size += len(of)
            if size > RUNS:
                yield flush()
                parts, size = [], 0
        if parts:
            yield flush()

    return run


def _windows(spec: Spec):
    """Single windows of the ranges of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Collector(spec.within)
        for d, tag, text, first, span in rows_of(batches, "d", "tag", "text", "first", "span"):
            part = spec.symbols(text)
            sums = prefix_sums(part), prefix_sums(mix(part * SECOND))
            n = np.array(span, np.int64) + 1
            start = np.repeat(np.array(first, np.int64), n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            a, b = (mix(span_hash(s, start, start + spec.length)).view(np.int64) for s in sums)
            out.add(a, b, np.full(len(start), d, np.int64), np.full(len(start), tag, np.int64), start, start, np.zeros_like(start))
            yield from out.batches(RUNS)
        yield from out.batches(0)

    return run


def _with_texts(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(d, tag, text, first, span) of the documents in ``found`` (d, tag, first, span), which becomes a list for each."""
    lists = found.groupBy("d", "tag").agg(F.collect_list(F.struct("first", "span")).alias("r"))
    lists = stored(lists.select("d", "tag", F.col("r.first").alias("first"), F.col("r.span").alias("span"), F.xxhash64("d", "tag").alias("key")), "lists")
    texts = near_keys(rows, lists, "key").dropDuplicates(["d", "tag"])
    return texts.join(lists.drop("key"), ["d", "tag"]).select("d", "tag", "text", "first", "span")


def repeated_starts(docs: DataFrame, spec: Spec) -> DataFrame:
    """(d, tag, key, ranges): for documents with any, the sorted ranges (first, last) of starts of windows that also start earlier."""
    rows = keyed(docs)
    runs = rows.select("d", "tag", "text").mapInArrow(_runs(spec), ROWS)
    runs = runs.repartitionByRange("a", "b").sortWithinPartitions("a", "b", "d")
    found = stored(runs.mapInArrow(_classify, "d long, tag long, first long, span int, open boolean"), "runs")

    texts = _with_texts(rows, found.where("open").drop("open"))
    blocks = stored(texts.mapInArrow(_blocks(spec), "c long, d long, tag long, first long, span int"), "blocks")
    others = F.count(F.lit(1)) > 1 if spec.within else F.min("d") < F.max("d")
    shared = blocks.groupBy("c").agg(others.alias("shared")).where("shared")
    texts = _with_texts(rows, blocks.join(shared, "c", "left_semi").select("d", "tag", "first", "span"))
    single = stored(texts.mapInArrow(_windows(spec), ROWS), "windows")

    fresh = single.where("NOT flag")
    least = fresh.groupBy("a", "b").agg(F.min("d").alias("least"), F.max("d").alias("most")).where("least < most")
    later = fresh.join(least, ["a", "b"]).where("d > least").select("d", "tag", "first", F.lit(0).alias("span"))
    later = later.unionByName(single.where("flag").select("d", "tag", "first", "span"))
    later = later.unionByName(found.where("NOT open").select("d", "tag", "first", "span"))
    pair = F.struct("first", (F.col("first") + F.col("span")).alias("last"))
    ranges = later.groupBy("d", "tag").agg(F.array_sort(F.collect_list(pair)).alias("ranges"))
    return stored(ranges.withColumn("key", F.xxhash64("d", "tag")), "ranges")


def covered_spans(ranges: list, length: int) -> list[tuple[int, int]]:
    """Maximal covered spans [begin, end) of sorted ranges of window starts."""
    spans: list[list[int]] = []
    for r in ranges:
        begin, end = r["first"], r["last"] + length
        if spans and begin <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([begin, end])
    return [tuple(s) for s in spans]


def changed_texts(docs: DataFrame, ranges: DataFrame, digest, schema: str) -> DataFrame:
    """``digest`` (batches of d, tag, text, ranges to ``schema``) over the documents that have ranges."""
    texts = near_keys(keyed(docs), ranges, "key").dropDuplicates(["d", "tag"]).join(ranges.drop("key"), ["d", "tag"])
    return texts.select("d", "tag", "text", "ranges").mapInArrow(digest, schema)


def with_changes(base: DataFrame, changed: DataFrame) -> DataFrame:
    """``base`` (with d and tag) beside its row of ``changed``, if any."""
    changed = changed.withColumnsRenamed({"d": "c_d", "tag": "c_tag"})
    return base.join(changed, (base["d"] == changed["c_d"]) & (base["tag"] == changed["c_tag"]), "left").drop("c_d", "c_tag")
