"""Approximate nearest neighbours by inner product on robust-pruned directed graphs.

The different vectors are dealt out by hash to shards of some ``SHARD_ROWS``, and
each shard gets a graph of its own: nodes are inserted in growing batches, a
greedy search from the shard's middle proposes neighbours, and relaxed distance
pruning keeps an edge only if no kept neighbour is closer to its end by the factor
``ALPHA``.  The graph is one of directions, so long vectors do not drown short ones;
a beam search goes along its edges by inner product, from the longest vector.  A
query is sent to every shard, and the best of all shards remain.  A task holds one
shard and streams the queries past it.

Every row is in the index: equal vectors are one node, with as many of their
smallest ids as a result can hold.  Scores are summed in double precision, in the
order of the components.

Cases: vectors that are NULL, empty, zero or have NULL or non-finite components,
and rows without an id, take no part; vectors of different lengths do not meet;
equal scores rank by id; a repeated row is one row, and a query never finds its
own id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.llm.common import stored

NEAREST = 20
QUERY_STEP = 20  # rows whose id this divides are the queries of the report
SHARD_ROWS = 8192
DEGREE, WIDE = 32, 64  # edges left by pruning; edges a node may gather before it is pruned again
ALPHA = 1.2
BUILD_BEAM, BEAM, EXPAND = 64, 96, 8  # nodes kept in a search; nodes expanded at once
BLOCK = 256  # searches that run side by side
FAR = np.float32(np.inf)


def directions(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1)[:, None]
    return (vectors / np.sqrt((vectors**2).sum(1))[:, None]).astype(np.float32)


def greedy(x: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> np.ndarray:
    """The ``beam`` nodes of largest inner product each search has seen, best first; -1 where there are fewer.

    Among vectors of one length these are also the closest.
    """
    n, b = len(x), len(queries)
    ids = np.full((b, beam), -1, np.int32)
    dist = np.full((b, beam), FAR, np.float32)
    fresh = np.zeros((b, beam), bool)
    seen = np.zeros(b * n, np.int32)  # the number a pair of search and node was found under
    ids[:, 0], dist[:, 0], fresh[:, 0] = start, -(queries @ x[start]), True
    seen[np.arange(b) * n + start] = 1
    last, going = 1, np.arange(b)
    while len(going):
        mine = fresh[going]
        row, col = np.nonzero(mine & (np.cumsum(mine, axis=1) <= EXPAND))
        fresh[going[row], col] = False
        near = edges[ids[going[row], col]]
        at = np.repeat(row, near.shape[1])
        near = near.ravel()
        good = near >= 0
        at, near = at[good], near[good]
        pair = going[at] * n + near
        new = np.flatnonzero(seen[pair] == 0)
        number = np.arange(last + 1, last + 1 + len(new), dtype=np.int32)
        seen[pair[new]] = number
        new = new[seen[pair[new]] == number]  # once for each pair
        last += len(number)
        at, near = at[new], near[new]
        if len(at):
            d = -np.einsum("ij,ij->i", x[near], queries[going[at]])
            count = np.bincount(at, minlength=len(going))
            place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
            wide = count.max()
            more_ids = np.full((len(going), wide), -1, np.int32)
            more_dist = np.full((len(going), wide), FAR, np.float32)
            more_ids[at, place], more_dist[at, place] = near, d
            all_dist = np.concatenate([dist[going], more_dist], axis=1)
            all_ids = np.concatenate([ids[going], more_ids], axis=1)
            all_fresh = np.concatenate([fresh[going], more_ids >= 0], axis=1)
            best = np.argsort(all_dist, axis=1, kind="stable")[:, :beam]
            dist[going] = np.take_along_axis(all_dist, best, 1)
            ids[going] = np.take_along_axis(all_ids, best, 1)
            fresh[going] = np.take_along_axis(all_fresh, best, 1)
        going = going[fresh[going].any(1)]
    return ids


def pruned(x: np.ndarray, nodes: np.ndarray, found: np.ndarray) -> np.ndarray:
    """(nodes, DEGREE): for each node the found neighbours that no closer kept one replaces; -1 where there are fewer."""
    out = np.full((len(nodes), DEGREE), -1, np.int32)
    for a in range(0, len(nodes), BLOCK):
        node, ids = nodes[a : a + BLOCK], found[a : a + BLOCK]
        near = x[ids]
        d = ((near - x[node][:, None]) ** 2).sum(2)
        d[(ids < 0) | (ids == node[:, None])] = FAR
        order = np.argsort(d, axis=1, kind="stable")
        ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
        near = np.take_along_axis(near, order[:, :, None], 1)
        square = (near * near).sum(2)
        between = square[:, :, None] + square[:, None, :] - 2 * near @ near.transpose(0, 2, 1)
        alive, rows = np.isfinite(d), np.arange(len(node))
        for k in range(DEGREE):
            first = alive.argmax(1)
            some = alive[rows, first]
            if not some.any():
                break
            out[a : a + BLOCK, k][some] = ids[rows, first][some]
            alive[rows, first] = False
            alive &= ALPHA**2 * between[rows, first] > d
    return out


def graph(vectors: np.ndarray, seed: int = 0) -> np.ndarray:
    """Edges of each node, -1 where there are fewer."""
    x = directions(vectors)
    n = len(x)
    start = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    edges = np.full((n, WIDE), -1, np.int32)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    done = 1
    while done < n:
        batch = order[done : done + min(max(done, 8), 1024)]
        found = np.concatenate([greedy(x, edges, start, x[batch[a : a + BLOCK]], BUILD_BEAM) for a in range(0, len(batch), BLOCK)])
        kept = pruned(x, batch, found)
        edges[batch, :DEGREE] = kept
        source, k = np.nonzero(kept >= 0)
        backward(x, edges, kept[source, k], batch[source])
        done += len(batch)
    return edges


def backward(x: np.ndarray, edges: np.ndarray, node: np.ndarray, new: np.ndarray) -> None:
    """Adds the edges node -> new; a node that then has more than ``WIDE`` keeps what pruning leaves of the closest."""
    d = ((x[node] - x[new]) ** 2).sum(1)
    order = np.lexsort((d, node))
    node, new = node[order], new[order]
    which, first, count = np.unique(node, return_index=True, return_counts=True)
    place = np.arange(len(node)) - np.repeat(first, count)
    near = place < WIDE
    row = np.repeat(np.arange(len(which)), count)
    both = np.concatenate([edges[which], np.full((len(which), WIDE), -1, np.int32)], axis=1)
    both[row[near], WIDE + place[near]] = new[near]
    packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
    over = packed[:, WIDE] >= 0
    edges[which[~over]] = packed[~over, :WIDE]
    if over.any():
        edges[which[over]] = -1
        edges[which[over], :DEGREE] = pruned(x, which[over], packed[over])


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vec, size) of the rows that take part; float components stay floats."""
    kind = vectors.schema["embedding"].dataType.elementType
    kind = "array<float>" if isinstance(kind, T.FloatType) else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~odd & F.exists("vec", lambda x: x != 0))
    return rows.withColumn("size", F.size("vec"))


def different(rows: DataFrame) -> DataFrame:
    """(vec, size, ids): each different vector with its smallest ids, one more than a result can hold; the other copies
    of a vector stay in their tasks."""
    place = F.dense_rank().over(Window.partitionBy("vec").orderBy("vec_id"))
    first = rows.withColumn("place", place).where(F.col("place") <= NEAREST + 1)
    return first.groupBy("vec").agg(F.max("size").alias("size"), F.array_sort(F.collect_set("vec_id")).alias("ids"))


UNIT = ["size", "bucket"]  # vectors of one length, dealt out by hash


def dealt(rows: DataFrame, shards: int, *order: str) -> DataFrame:
    """A partition for each bucket, in which the units stand one after the other."""
    part = F.pmod(F.col("bucket") + F.col("size"), F.lit(shards)).cast("int")
    return rows.repartitionById(shards, part).sortWithinPartitions(*UNIT, *order)


def runs(batch: pa.RecordBatch, *keys: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows that agree on integer columns."""
    values = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
    ends = [*(np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1).tolist(), len(values)]
    for a, b in zip([0, *ends], ends):
        if b > a:
            yield tuple(values[a].tolist()), batch.slice(a, b - a)


def matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def built(unit: tuple, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        edges = graph(matrix(rows, "vec", unit[0]).astype(np.float64), seed=unit[1])
        near = pa.FixedSizeListArray.from_arrays(pa.array(edges.ravel()), WIDE).cast(pa.list_(pa.int32()))
        node = np.arange(len(edges), dtype=np.int32)
        return rows.append_column("node", pa.array(node)).append_column("edges", near)

    unit, parts = None, []
    for batch in batches:
        for now, rows in runs(batch, *UNIT):
            if parts and now != unit:
                yield built(unit, parts)
                parts = []
            unit = now
            parts.append(rows)
    if parts:
        yield built(unit, parts)


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graphs of all shards: a row for each different vector, with its node number and edges."""
    rows = stored(different(usable(vectors)), "vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("vec"), F.lit(shards)).cast("int"))
    more = [T.StructField("node", T.IntegerType()), T.StructField("edges", T.ArrayType(T.IntegerType()))]
    schema = T.StructType(rows.schema.fields + more)
    return stored(dealt(rows, shards).mapInArrow(_index, schema), "graphs")


def exact_scores(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Inner products of each query with the vectors of its ids, summed component by component."""
    total = np.zeros(ids.shape)
    for j in range(queries.shape[1]):
        total += queries[:, j, None] * vectors[ids, j]
    return total


def _search(nearest: int, beam: int):
    class Shard:
        def __init__(self, parts: list[pa.RecordBatch], size: int):
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            node = rows.column("node").to_numpy()
            rows = rows.take(pa.array(np.argsort(node)))
            self.vectors = matrix(rows, "vec", size).astype(np.float64)
            scaled = self.vectors / np.abs(self.vectors).max()
            self.x, self.start = scaled.astype(np.float32), int((scaled**2).sum(1).argmax())
            self.edges = matrix(rows, "edges", WIDE)
            lists = rows.column("ids")
            self.count = lists.value_lengths().to_numpy().astype(np.int64)
            self.names = lists.flatten().to_numpy()
            self.first = np.cumsum(self.count) - self.count

        def find(self, name: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """(query_id, vec_id, score) of the nearest of the shard."""
            scaled = queries / np.abs(queries).max(1)[:, None]
            ids = greedy(self.x, self.edges, self.start, scaled.astype(np.float32), beam)
            score = np.where(ids >= 0, exact_scores(queries, self.vectors, ids), -np.inf)
            least = self.names[self.first[ids]]
            best = np.lexsort((least, -score), axis=1)[:, : nearest + 1]
            ids, score = np.take_along_axis(ids, best, 1), np.take_along_axis(score, best, 1)
            row, col = np.nonzero(ids >= 0)
            ids, score = ids[row, col], score[row, col]
            count = self.count[ids]
            inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            vec = self.names[np.repeat(self.first[ids], count) + inside]
            row, score = np.repeat(row, count), np.repeat(score, count)
            other = vec != name[row]
            row, vec, score = row[other], vec[other], score[other]
            order = np.lexsort((vec, -score, row))
            row, vec, score = row[order], vec[order], score[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            near = place < nearest
            return name[row[near]], vec[near], score[near]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, parts, shard = None, [], None
        for batch in batches:
            for (size, bucket, query), rows in runs(batch, *UNIT, "query"):
                if (size, bucket) != unit:
                    unit, parts, shard = (size, bucket), [], None
                if not query:
                    parts.append(rows)
                    continue
                if shard is None and parts:
                    parts, shard = [], Shard(parts, size)
                for a in range(0, rows.num_rows if shard else 0, BLOCK):
                    block = rows.slice(a, BLOCK)
                    found = shard.find(block.column("query_id").to_numpy(), matrix(block, "vec", size).astype(np.float64))
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["query_id", "vec_id", "score"])

    return run


def search(graphs: DataFrame, queries: DataFrame, nearest: int = NEAREST, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the rows found nearest to each row of ``queries`` (vec_id, embedding)."""
    assert nearest <= NEAREST and nearest < beam, "the index holds ids for NEAREST results"
    shards = (graphs.agg(F.max("bucket")).first()[0] or 0) + 1
    asked = usable(queries).distinct().withColumnRenamed("vec_id", "query_id")
    asked = asked.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = graphs.withColumn("query", F.lit(0)).unionByName(asked.withColumn("query", F.lit(1)), allowMissingColumns=True)
    found = dealt(both, shards, "query").mapInArrow(_search(nearest, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return best.select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame) -> DataFrame:
    """The ``NEAREST`` nearest rows of every row whose id ``QUERY_STEP`` divides."""
    return search(index(vectors), vectors.where(F.col("vec_id") % QUERY_STEP == 0))
