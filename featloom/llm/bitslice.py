"""SimHash near-duplicates, compared bit plane by bit plane.

Fingerprints within the radius agree on one of five blocks of bits (pigeonhole),
so only those that share a block meet.  Where they meet, the bits
of many fingerprints stand in vertical planes, 64 to a machine word; carry-save
counters add up the differing bits of 64 pairs at a time, and words whose pairs
have all passed the radius are dropped.

Cases: NULL and empty texts have the fingerprint zero and are linked like any
other; equal fingerprints are one node; NULL ids take part but never name a
component that has another id; very long texts are hashed in pieces; an empty table gives an empty result; extra
columns are ignored by ``fingerprints`` and kept by ``deduplicate``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import stored
from featloom.llm.components import components

RADIUS = 4
SHINGLE = 4
GROUP = 8192  # fingerprints that meet in one unit; more are split, none dropped
CHUNK = 200_000
PIECE = 2**18  # bytes of a text that are words in memory at once
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK]
        total += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return total


def pieces(text: bytes | pa.Buffer) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, some ``PIECE`` bytes at a time."""
    at, view = 0, memoryview(text)
    while at < len(view):
        end = SPACE.search(view, min(at + PIECE, len(view)))
        stop = end.start() if end else len(view)
        yield bytes(view[at:stop]).lower().split()
        at = stop


def fingerprint(text: bytes | pa.Buffer | None, size: int = SHINGLE) -> int:
    """64-bit SimHash of the lower-cased text's shingles, as a signed number; a long text is gone through in pieces."""
    digest = xxhash.xxh64_intdigest
    total, count, words = np.zeros(64, np.int64), 0, []
    for more in pieces(text or b""):
        words += more
        if len(words) < size:
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[: len(words) - size]))
        stops = ends[size - 1 :] - 1
        hashes = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts.tolist(), stops.tolist())), np.uint64, len(starts))
        total += bit_counts(hashes)
        count += len(hashes)
        words = words[len(words) - size + 1 :]
    if not count:
        if not words:
            return 0
        total, count = bit_counts(np.array([digest(b" ".join(words), 42)], np.uint64)), 1
    return int(np.packbits(2 * total > count, bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([fingerprint(t.as_buffer()) for t in batch.column("text")], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, fp long")


def block_masks(bits: list[int], blocks: int) -> list[int]:
    """The bit positions cut into ``blocks`` masks of nearly equal size."""
    cut = np.array_split(np.array(bits), blocks)
    return [sum(1 << int(b) for b in part) for part in cut]


def choices(radius: int = RADIUS) -> list[int]:
    """Masks, one of which two fingerprints within the radius agree on entirely: one block more than bits may differ."""
    return block_masks(list(range(64)), radius + 1)


def signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def planes_of(values: np.ndarray) -> np.ndarray:
    """(64, words): word w of plane b holds bit b of the values 64 w to 64 w + 63."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")).view(np.uint64)


def packed(flags: np.ndarray, words: int) -> np.ndarray:
    full = np.zeros(words * 64, np.uint8)
    full[: len(flags)] = flags
    return np.packbits(full, bitorder="little").view(np.uint64)


def close_pairs(values: np.ndarray, left: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of values that differ in at most ``radius`` bits; ``left[i]`` values from i on meet each other.

    Lane i is compared with lane i + s for growing s, all lanes at once.
    """
    assert radius == 4, "the counters stop at five"
    planes = planes_of(values)
    words = planes.shape[1]
    planes = np.concatenate([planes, np.zeros((64, 1), np.uint64)], axis=1)
    for s in range(1, int(left.max(initial=1))):
        valid = packed(left > s, words)
        at = np.flatnonzero(valid)
        live = valid[at]
        skip, shift = divmod(s, 64)
        ones, twos, fours, over = (np.zeros(len(at), np.uint64) for _ in range(4))
        for b in range(64):
            plane = planes[b]
            low = np.minimum(at + skip, words)
            other = plane[low]
            if shift:
                other = (other >> np.uint64(shift)) | (plane[np.minimum(low + 1, words)] << np.uint64(64 - shift))
            carry = plane[at] ^ other
            ones, carry = ones ^ carry, ones & carry
            twos, carry = twos ^ carry, twos & carry
            fours, carry = fours ^ carry, fours & carry
            over |= carry
            if b % 8 == 7:
                over |= fours & (ones | twos)
                going = (live & ~over) != 0
                if not going.all():
                    at, live, ones, twos, fours, over = (x[going] for x in (at, live, ones, twos, fours, over))
                if not len(at):
                    break
        if len(at):
            hit = np.unpackbits((live & ~over).view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
            word, lane = np.nonzero(hit)
            i = at[word] * 64 + lane
            yield i, i + s


def forest(pairs: Iterator[tuple[np.ndarray, np.ndarray]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what all pairs connect, without those inside what is connected already."""
    root = np.arange(size)
    us, vs = [], []
    for i, j in pairs:
        while len(i):
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
            _, one = np.unique(high, return_index=True)
            us.append(i[one]), vs.append(j[one])
            root[high[one]] = low[one]
            while (root[root] != root).any():
                root = root[root]
    if not us:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(us), np.concatenate(vs)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) between the names of close fingerprints; rows come sorted by unit."""

    def flush(unit: np.ndarray, fp: np.ndarray, name: np.ndarray) -> pa.RecordBatch:
        last = np.append(np.flatnonzero(np.diff(unit)), len(unit) - 1)
        ends = np.repeat(last + 1, np.diff(np.concatenate(([-1], last))))
        left = ends - np.arange(len(unit))
        u, v = forest(close_pairs(fp.view(np.uint64), left), len(unit))
        return pa.RecordBatch.from_arrays([pa.array(name[u]), pa.array(name[v])], names=["u", "v"])

    kept: list[np.ndarray] | None = None
    for batch in batches:
        new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        now = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
        whole = np.searchsorted(now[0], now[0][-1]) if len(now[0]) else 0  # the last unit may go on
        if whole >= CHUNK // 4:
            yield flush(*(x[:whole] for x in now))
            now = [x[whole:] for x in now]
        kept = now
    if kept is not None and len(kept[0]):
        yield flush(*kept)


def _split(rows: DataFrame, group: int) -> DataFrame:
    """``rows`` (key, ...) with the number of rows of keys that have more than ``group``, else NULL."""
    large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > group)
    return rows.join(large, "key", "left")


def links(nodes: DataFrame, group: int = GROUP) -> DataFrame:
    """Edges (u, v) that connect all of ``nodes`` (fp, name) within the radius of each other.

    Keys that more than ``group`` fingerprints share are cut again by the blocks of
    their remaining bits; what is still larger is cut into chunks that meet in pairs.
    """
    masks = choices()
    fp = F.col("fp")

    def key(*parts: Column) -> Column:
        return F.xxhash64(*parts)

    picks = F.posexplode(F.array(*[key(F.lit(i), fp.bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)]))
    rows = _split(nodes.select("fp", "name", picks.alias("pick", "key")), group)
    finer = F.array(
        *[
            F.array(*[F.lit(signed(x)) for x in block_masks([b for b in range(64) if not m >> b & 1], RADIUS + 1)])
            for m in masks
        ]
    )
    again = F.transform(F.get(finer, F.col("pick")), lambda m: key(F.col("key"), m, fp.bitwiseAND(m)))
    keys = F.when(F.col("n").isNull(), F.array("key")).otherwise(again)
    rows = _split(rows.select("fp", "name", F.explode(keys).alias("key")), group)
    chunks = F.ceil(F.col("n") / group)
    mine = F.pmod(F.xxhash64("fp"), chunks)
    units = F.transform(
        F.sequence(F.lit(0).cast("long"), chunks - 1), lambda c: key(F.col("key"), F.least(mine, c), F.greatest(mine, c))
    )
    units = F.when(F.col("n").isNull(), F.array("key")).otherwise(units)
    rows = rows.select(F.explode(units).alias("unit"), "fp", "name")
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(_links, "u long, v long")


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, fp, component_id): documents connected through fingerprints within the radius."""
    prints = stored(fingerprints(docs), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("name"))
    named = stored(nodes, "nodes")
    roots = components(links(named.where("name IS NOT NULL"), group))
    roots = named.join(roots.withColumnRenamed("node", "name"), "name", "left")
    roots = roots.select("fp", F.coalesce("root", "name").alias("component_id"))
    return prints.join(roots, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: the one whose id names it; rows without an id stay."""
    found = near_duplicates(docs).where("doc_id = component_id").select(F.col("doc_id").alias("keep_id")).distinct()
    kept = docs.join(found, docs["doc_id"] == found["keep_id"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as 16 hexadecimal digits, component_id)."""
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return near_duplicates(docs).select("doc_id", shown, "component_id")
