"""Near-duplicates by SimHash and exact verification: word shingles of five, Jaccard similarity 0.8 or more.

At that similarity fingerprints differ in some ten of 64 bits, at most ``RADIUS`` in
nearly all cases, too many for blocks of equal bits.  So documents meet where they
agree on ``BITS`` bits of one of ``TABLES`` random choices, and are compared there in
vertical bit planes with carry-save counters, as in ``bitslice``.  A unit gives edges
that connect all it has found close, closest first; the shingle sets of both ends
decide which edges hold, and connected documents are a group.

Fingerprints miss a pair if no choice of bits agrees, if it is further than ``RADIUS``, or if
only edges that do not hold connect it.  So an exact search follows, between what is still
apart: in one order of all shingles, the first fifth (and one) of the shingles of two
documents that are alike have one in common.  Shingles that many such beginnings share
come last in the order.  What meets and may be alike by its sizes and places is verified.

Before shingle sets are joined with pairs, parity bits of the sets rule pairs out: each bit in
which they differ is a shingle that only one of the two has, so no pair that is alike is lost, and
what is joined follows the pairs near the bound and not all that meet.  Where many beginnings meet
at one shingle, the bits are at hand and pairs are ruled out before they are written.

Cases: documents of the same lower-cased words are one node; NULL and texts without
words are alike; NULL ids stay and meet nobody; very long texts are hashed in
pieces; an empty table gives an empty result; further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.bitslice import _split, bit_counts, fingerprint, forest, packed, pieces, planes_of, signed
from featloom.llm.common import bitmap, may_hold, near_keys, stored
from featloom.llm.components import components

SHINGLE = 5
RADIUS, TABLES, BITS = 14, 32, 12
STEPS = (3, 8, RADIUS)  # closest first: each step connects what the one before left apart
GROUP = 2048
ROWS = 50_000
OFTEN = 64  # beginnings that share a shingle; more make it one of the last in the order


def masks(tables: int = TABLES, bits: int = BITS) -> list[int]:
    rng = np.random.default_rng(8)
    return [sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in range(tables)]


def pairs_within(values: np.ndarray, left: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of values that differ in at most ``radius`` (below 16) bits; ``left[i]`` values from i on meet each other."""
    planes = planes_of(values)
    words = planes.shape[1]
    planes = np.concatenate([planes, np.zeros((64, 1), np.uint64)], axis=1)
    bound = radius + 1
    for s in range(1, int(left.max(initial=1))):
        valid = packed(left > s, words)
        at = np.flatnonzero(valid)
        live = valid[at]
        skip, shift = divmod(s, 64)
        count = [np.zeros(len(at), np.uint64) for _ in range(4)]
        over = np.zeros(len(at), np.uint64)
        for b in range(64):
            plane = planes[b]
            low = np.minimum(at + skip, words)
            other = plane[low]
            if shift:
                other = (other >> np.uint64(shift)) | (plane[np.minimum(low + 1, words)] << np.uint64(64 - shift))
            carry = plane[at] ^ other
            for k in range(4):
                count[k], carry = count[k] ^ carry, count[k] & carry
            over |= carry
            if b % 16 == 15:
                over |= at_least(count, bound)
                going = (live & ~over) != 0
                if not going.all():
                    at, live, over = at[going], live[going], over[going]
                    count = [c[going] for c in count]
                if not len(at):
                    break
        if len(at):
            hit = np.unpackbits((live & ~over).view(np.uint8).reshape(len(at), 8), axis=1, bitorder="little")
            word, lane = np.nonzero(hit)
            i = at[word] * 64 + lane
            yield i, i + s


def at_least(count: list[np.ndarray], bound: int) -> np.ndarray:
    """Lanes whose four-bit number is ``bound`` or more."""
    more, same = np.zeros_like(count[0]), np.full_like(count[0], 2**64 - 1)
    for k in (3, 2, 1, 0):
        if bound >> k & 1:
            same = same & count[k]
        else:
            more |= same & count[k]
            same = same & ~count[k]
    return more | same


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) between the names of close fingerprints; rows come sorted by unit."""

    def flush(unit: np.ndarray, fp: np.ndarray, name: np.ndarray) -> pa.RecordBatch:
        last = np.append(np.flatnonzero(np.diff(unit)), len(unit) - 1)
        left = np.repeat(last + 1, np.diff(np.concatenate(([-1], last)))) - np.arange(len(unit))
        values = fp.view(np.uint64)
        found = (pair for radius in STEPS for pair in pairs_within(values, left, radius))
        u, v = forest(found, len(unit))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(name[u], name[v])), pa.array(np.maximum(name[u], name[v]))], names=["u", "v"])

    for part in whole_units(batches, "unit", "fp", "name"):
        yield flush(*part)


def whole_units(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list[np.ndarray]]:
    """The named columns, some ``ROWS`` rows at a time; the first is sorted, and no value of it is divided."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        new = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
        now = new if kept is None else [np.concatenate(x) for x in zip(kept, new)]
        whole = np.searchsorted(now[0], now[0][-1]) if len(now[0]) else 0  # the last unit may go on
        if whole >= ROWS:
            yield [x[:whole] for x in now]
            now = [x[whole:] for x in now]
        kept = now
    if kept is not None and len(kept[0]):
        yield kept


def units(rows: DataFrame, group: int) -> DataFrame:
    """``rows`` (key, n, name, ...) with ``unit`` for key, sorted by it; more than ``group`` (n, else NULL) are cut into chunks that meet in pairs."""
    chunks = F.ceil(F.col("n") / group)
    mine = F.pmod(F.xxhash64("name"), chunks)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), chunks - 1), lambda c: F.xxhash64(F.col("key"), F.least(mine, c), F.greatest(mine, c))
    )
    each = F.when(F.col("n").isNull(), F.array("key")).otherwise(pairs)
    return rows.withColumn("unit", F.explode(each)).drop("key", "n").repartition("unit").sortWithinPartitions("unit")


def candidates(nodes: DataFrame, group: int = GROUP) -> DataFrame:
    """(u, v), u < v: edges between ``nodes`` (fp, name) that connect those found close.

    More than ``group`` nodes of one key are cut into chunks that meet in pairs.
    """
    fp = F.col("fp")
    keys = F.array(*[F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks())])
    rows = units(_split(nodes.select("fp", "name", F.explode(keys).alias("key")), group), group)
    return rows.mapInArrow(_edges, "u long, v long").distinct()


def shingle_hashes(text: pa.Buffer | bytes | None, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Hashes of the lower-cased text's shingles, as ``fingerprint`` has them, those of a long text in pieces."""
    digest, words, some = xxhash.xxh64_intdigest, [], False
    for more in pieces(text or b""):
        words += more
        if len(words) < size:
            continue
        line = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = np.concatenate(([0], ends[: len(words) - size]))
        stops = ends[size - 1 :] - 1
        yield np.fromiter((digest(line[a:b], 42) for a, b in zip(starts.tolist(), stops.tolist())), np.uint64, len(starts))
        words, some = words[len(words) - size + 1 :], True
    if words and not some:
        yield np.array([digest(b" ".join(words), 42)], np.uint64)


def shingles(text: pa.Buffer | bytes | None, size: int = SHINGLE) -> np.ndarray:
    """The set of the lower-cased text's shingles, as sorted hashes."""
    found = [np.unique(part) for part in shingle_hashes(text, size)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def beginning(found: np.ndarray, often: np.ndarray | None = None) -> np.ndarray:
    """So many of a sorted set's first shingles that two sets of similarity 0.8 have one in common; those of the bitmap ``often`` stand last."""
    if often is not None:
        last = may_hold(often, found)
        found = np.concatenate([found[~last], found[last]])
    return found[: len(found) // 5 + 1]


def parity(found: np.ndarray) -> bytes:
    """Whether each bit is hit by an odd number of the set's shingles; two to four bits a shingle, a power of two."""
    bits = 64
    while bits < 2 * len(found):
        bits *= 2
    hit = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(hit.astype(np.uint8), bitorder="little").tobytes()


def differing(a: np.ndarray, b: np.ndarray) -> int:
    """At most the number of shingles that only one of two sets has; the longer parity is folded to the shorter."""
    while len(a) != len(b):
        a, b = (a, b) if len(a) > len(b) else (b, a)
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _may_be_alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose differing bits do not yet rule out a similarity of 0.8."""
    for batch in batches:
        size = batch.column("a_size").to_numpy() + batch.column("b_size").to_numpy()
        ends = zip(*([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)] for c in ("a_bits", "b_bits")))
        keep = [9 * differing(a, b) <= n for (a, b), n in zip(ends, size.tolist())]
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def possible(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (u, v) of ``nodes`` (name, size, bits) that may be alike; an id of several texts stands for all of them."""
    for side, end in (("a", "u"), ("b", "v")):
        edges = edges.join(nodes.select(F.col("name").alias(end), F.col("size").alias(f"{side}_size"), F.col("bits").alias(f"{side}_bits")), end)
    edges = edges.where((4 * F.col("a_size") <= 5 * F.col("b_size")) & (4 * F.col("b_size") <= 5 * F.col("a_size")))
    edges = edges.select("u", "v", "a_size", "b_size", "a_bits", "b_bits")
    return edges.mapInArrow(_may_be_alike, "u long, v long").distinct()


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, w1, w2, fp, size, first): hashes of the lower-cased words, the fingerprint, number and beginning of the shingles."""
    for batch in _marked(batches):
        yield batch.drop_columns(["bits"])


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The columns of ``_marks``, and bits: the parity of the shingles."""
    for batch in batches:
        rows = []
        for t in batch.column("text"):
            text = t.as_buffer() or b""
            total, count, parts = np.zeros(64, np.int64), 0, []
            for hashes in shingle_hashes(text):
                total += bit_counts(hashes)
                count += len(hashes)
                parts.append(np.unique(hashes))
            found = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
            fp = int(np.packbits(2 * total > count, bitorder="little").view(np.int64)[0]) if count else 0
            rows.append((*words_mark(text), fp, len(found), beginning(found).view(np.int64), parity(found)))
        columns = list(zip(*rows)) if rows else [[]] * 6
        arrays = [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.list_(pa.int64())), pa.array(columns[5], pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "w1", "w2", "fp", "size", "first", "bits"])


def words_mark(text: pa.Buffer | bytes) -> list[int]:
    """128 bits of hash of the lower-cased words."""
    state = xxhash.xxh3_128()
    for words in pieces(text):
        if words:
            state.update(b" ".join(words) + b" ")
    return np.frombuffer(state.digest(), np.int64).tolist()


def _again(often):
    """(w1, w2, other): the beginning with the shingles of ``often`` last, of texts whose plain beginning has any of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                text = t.as_buffer()
                found = shingles(text)
                if may_hold(often.value, beginning(found)).any():
                    rows.append((*words_mark(text or b""), beginning(found, often.value).view(np.int64)))
            w1, w2, other = zip(*rows) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(w1, pa.int64()), pa.array(w2, pa.int64()), pa.array(other, pa.list_(pa.int64()))], names=["w1", "w2", "other"])

    return run


class Parities:
    """Parity bits of the rows of one unit, those of one length in one matrix."""

    def __init__(self, bits: np.ndarray):
        self.width = np.array([len(b) // 8 for b in bits])
        self.place = np.zeros(len(bits), np.int64)
        self.rows: dict[int, dict[int, np.ndarray]] = {}
        for width in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == width)
            self.place[at] = np.arange(len(at))
            self.rows[width] = {width: np.frombuffer(b"".join(bits[at]), np.uint64).reshape(-1, width)}

    def folded(self, width: int, to: int) -> np.ndarray:
        """The rows of one length, folded to ``to`` words."""
        made = self.rows[width]
        if to not in made:
            wide = self.folded(width, 2 * to)
            made[to] = wide[:, :to] ^ wide[:, to:]
        return made[to]

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """As ``differing`` of row ``i`` and each of ``others``."""
        out, mine = np.zeros(len(others), np.int64), int(self.width[i])
        for width in np.unique(self.width[others]).tolist():
            at, to = np.flatnonzero(self.width[others] == width), min(width, mine)
            rows = self.folded(width, to)[self.place[others[at]]]
            out[at] = np.bitwise_count(rows ^ self.folded(mine, to)[self.place[i]]).sum(1)
        return out


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v) of different roots that share a shingle and may be alike by their sizes and its places; rows come sorted by unit.

    In units that come with bits, those must not rule the pair out.
    """

    def fits(size: np.ndarray, at: np.ndarray, root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        left = 1 + np.minimum(size[i] - at[i] - 1, size[j] - at[j] - 1)
        return (root[i] != root[j]) & (9 * left >= 4 * (size[i] + size[j]))

    for unit, name, size, at, root, bits in whole_units(batches, "unit", "name", "size", "at", "root", "bits"):
        begin = np.flatnonzero(np.diff(unit, prepend=unit[0] - 1 if unit[0] else 1))
        count = np.diff(np.append(begin, len(unit)))
        mixed = np.minimum.reduceat(root, begin) != np.maximum.reduceat(root, begin)
        us, vs = [], []
        left = np.repeat(np.where(mixed & (count <= OFTEN), begin + count, 0), count) - np.arange(len(unit))
        for s in range(1, int(left.max(initial=1))):
            i = np.flatnonzero(left > s)
            ok = fits(size, at, root, i, i + s)
            us.append(name[i[ok]]), vs.append(name[i[ok] + s])
        for a, n in zip(begin[mixed & (count > OFTEN)], count[mixed & (count > OFTEN)]):
            every = np.arange(a, a + n)
            values, where, each = np.unique(root[every], return_inverse=True, return_counts=True)
            parities = Parities(bits[every]) if bits[a] is not None else None
            for i in every[where != each.argmax()]:  # the rest is apart from nobody else
                j = every[fits(size, at, root, np.full(n, i), every)]
                if parities is not None and len(j):
                    j = j[9 * parities.apart(i - a, j - a) <= size[i] + size[j]]
                us.append(np.full(len(j), name[i])), vs.append(name[j])
        u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (us, vs))
        pairs = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["u", "v"])


def apart(texts: DataFrame, nodes: DataFrame, group: int = GROUP, often: int = OFTEN) -> DataFrame:
    """(u, v): all pairs of ``nodes`` (w1, w2, name, size, first, root) of different roots that may be alike.

    With the column ``bits``, rows of shingles that more than ``often`` beginnings share take it along.
    """
    shared = nodes.select(F.explode("first").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = stored(shared.where(F.col("n") > often).select("key"), "shared")
    if shared.head(1):
        bits = texts.sparkSession.sparkContext.broadcast(bitmap(shared, "key"))
        other = texts.mapInArrow(_again(bits), "w1 long, w2 long, other array<long>").dropDuplicates(["w1", "w2"])
        other = stored(other, "again")
        nodes = nodes.join(other, ["w1", "w2"], "left").withColumn("first", F.coalesce("other", "first"))
        large = other.select(F.explode("other").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        large = stored(large.where(F.col("n") > min(often, group - often)), "large")
    else:
        large = shared.withColumn("n", F.lit(1).cast("long"))
    bits = F.col("bits") if "bits" in nodes.columns else F.lit(None).cast("binary")
    rows = nodes.select("name", "size", "root", bits.alias("bits"), F.posexplode("first").alias("at", "key"))
    rows = rows.withColumn("at", F.col("at").cast("long")).join(large, "key", "left").withColumn("bits", F.when(F.col("n").isNotNull(), F.col("bits")))
    return units(rows, group).mapInArrow(_meet, "u long, v long").distinct()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.as_buffer()).view(np.int64) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], names=["name", "s"])


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of similarity 0.8 or more."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("a"), batch.column("b")):
            a, b = (x.values.to_numpy().view(np.uint64) for x in (a, b))
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(5 * both >= 4 * (len(a) + len(b) - both))
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def verified(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """The edges (u, v) between documents that are alike."""
    ends = stored(edges.select(F.explode(F.array("u", "v")).alias("name")).distinct(), "ends")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    texts = near_keys(texts, ends.withColumnRenamed("name", "doc_id"), "doc_id") if ends.head(1) else texts.limit(0)
    texts = texts.dropDuplicates(["doc_id"]).join(ends, F.col("doc_id") == F.col("name"), "left_semi")
    sets = stored(texts.mapInArrow(_sets, "name long, s array<long>"), "sets")
    pairs = edges.join(sets.select(F.col("name").alias("u"), F.col("s").alias("a")), "u")
    pairs = pairs.join(sets.select(F.col("name").alias("v"), F.col("s").alias("b")), "v")
    return pairs.select("u", "v", "a", "b").mapInArrow(_alike, "u long, v long")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id): each document with the smallest id of its group of near-duplicates."""
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    marks = stored(rows.mapInArrow(_marked, "doc_id long, w1 long, w2 long, fp long, size long, first array<long>, bits binary"), "marks")
    one = F.first(F.struct("fp", "size", "first", "bits")).alias("one")
    nodes = stored(marks.groupBy("w1", "w2").agg(F.min("doc_id").alias("name"), one).select("w1", "w2", "name", "one.*"), "nodes")
    edges = stored(verified(docs, stored(possible(candidates(nodes), nodes), "candidates")), "alike")

    def rooted(edges: DataFrame) -> DataFrame:
        roots = components(edges).select(F.col("node").alias("name"), "root")
        return nodes.join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))

    more = stored(possible(apart(rows.select("text"), rooted(edges)), nodes), "apart")
    more = stored(verified(docs, more), "more")
    named = rooted(edges.unionByName(more)).select("w1", "w2", F.col("root").alias("component_id"))
    return marks.select("doc_id", "w1", "w2").join(named, ["w1", "w2"]).select("doc_id", "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group: the one whose id names it; rows without an id stay."""
    kept = groups(docs).where("doc_id = component_id").select(F.col("doc_id").alias("keep_id")).distinct()
    rows = docs.join(kept, docs["doc_id"] == kept["keep_id"], "left_semi").dropDuplicates(["doc_id"])
    return rows.unionByName(docs.where("doc_id IS NULL"))
