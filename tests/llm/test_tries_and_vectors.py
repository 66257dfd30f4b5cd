"""Operators 11 to 13 against plain Python, with NULLs, ties, repeated rows, empty tables and extra columns."""

import hashlib
import random
from collections import defaultdict
from functools import reduce
from math import floor, isfinite, nan
from zlib import crc32

import numpy as np
import pytest

from featloom.llm import hadamard, prefix_trie, pruned_graph

TURNS = "conv_id long, turn long, role string, text string, depth int, chain string, pos int"
VECTORS = "vec_id long, embedding array<double>, label int, cluster int, ids string, rank int"


# conversations


def plain_trie(rows):
    """{(conv_id, depth): other columns}; ``rows`` are (conv_id, [(role, text), ...]) in order."""
    paths = {}
    for c, own in rows.items():
        base, h = rows.get(c - c % 5, []), crc32(str(c).encode()) % 9
        paths[c] = tuple(base[:h] + own[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def subtree(path):
        saved = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        parts = [subtree(c) for c in children[path]]
        leaves = sum(p[0] for p in parts) if parts else 1
        return leaves, saved + sum(p[1] for p in parts), 1 + sum(p[2] for p in parts)

    out = {}
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(paths[c]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        leaves, saved, nodes = subtree(path)
        out[min(ids), len(path)] = (parent, len(ids), len(children[path]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest(), nodes)
    return out


def found_trie(df):
    names = ["parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "n_nodes"]
    return {(r.conv_id, r.depth): tuple(r[n] for n in names) for r in df.collect()}


def some_conversations(seed, count):
    rng = random.Random(seed)
    rows = {}
    for c in rng.sample(range(count * 2), count):
        rows[c] = [(rng.choice("ab"), rng.choice(["", "yes", "né", "a longer turn"])) for _ in range(rng.randint(1, 6))]
    rows[count * 2 + 5] = [("a", f"turn {i}") for i in range(120)]
    return rows


@pytest.mark.parametrize("seed,count", [(1, 40), (2, 400)])
def test_trie(spark, monkeypatch, seed, count):
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = some_conversations(seed, count)
    flat = [(c, None if i == 0 else i * 10, r, t, 1, "x", 5) for c, turns in rows.items() for i, (r, t) in enumerate(turns)]
    random.Random(3).shuffle(flat)
    df = spark.createDataFrame(flat, TURNS).repartition(5)
    assert found_trie(prefix_trie.report(df)) == plain_trie(rows)
    convs, turns = prefix_trie.rebuilt(df)
    assert found_trie(prefix_trie.trie(convs, turns, base=4)) == plain_trie(rows)  # rulers have rulers of their own


def test_trie_of_odd_rows(spark):
    rows = [
        (None, 1, "a", "no conversation", 1, "x", 1), (1, 1, None, None, None, None, None), (1, 1, "", "", None, None, None),
        (3, None, "a", "z" * 300_000, None, None, None), (7, 2, "a", "b", None, None, None), (-4, 1, "a", "b", None, None, None),
    ]
    found = found_trie(prefix_trie.report(spark.createDataFrame(rows, TURNS)))
    assert found[-4, 0][1] == 4 and all(v[3] >= 1 for v in found.values())
    kept = {c: len(range(crc32(str(c).encode()) % 9, n)) for c, n in {1: 2, 3: 1, 7: 1, -4: 1}.items()}
    assert max(d for _, d in found) == max(kept.values())
    assert prefix_trie.report(spark.createDataFrame([], TURNS)).count() == 0


def test_repeated_turns_are_turns(spark):
    rows = [(5, 1, "a", "b", None, None, None)] * 3
    convs = spark.createDataFrame([(5,)], "conv_id long")
    turns = prefix_trie.turns(spark.createDataFrame(rows, TURNS)).drop("base")
    found = found_trie(prefix_trie.trie(convs, turns))
    assert sorted(found) == [(5, 0), (5, 1), (5, 2), (5, 3)] and found[5, 0][3:5] == (1, 0)


# clusters


def plain_clusters(rows, clusters=40, rounds=5):
    kept = [(i, [floor(256 * x) for x in v]) for i, v in rows if v and len(v) == 64 and all(x is not None and isfinite(x) for x in v)]
    kept.sort(key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    x = np.array([v for _, v in kept])
    centre = x[:clusters].copy()

    def assign():
        d = ((x[:, None] - centre[None]) ** 2).sum(2)
        return d.argmin(1), d.min(1)

    for _ in range(rounds):
        c, _ = assign()
        for k in set(c.tolist()):
            centre[k] = [int(s) // int((c == k).sum()) for s in x[c == k].sum(0)]
    c, d = assign()
    names = [hashlib.sha256(",".join(map(str, k)).encode()).hexdigest() for k in centre.tolist()]
    return sorted((str(i), int(k), int(e), int(d[c == k].sum()), int(d.sum()), names[k]) for (i, _), k, e in zip(kept, c, d))


def some_vectors(seed, count, size=64):
    rng = np.random.default_rng(seed)
    return [(i, rng.normal(size=size).round(2).tolist()) for i in range(count)]


def odd_vectors(rows):
    bad = [(900, None), (901, []), (902, [1.0] * 63), (903, [nan] * 64), (904, [None] * 64), (905, [float("inf")] * 64)]
    return rows + bad + [(None, rows[0][1]), rows[3], rows[3], (950, rows[5][1]), (951, [0.0] * 64), (952, [-0.25] * 64)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, 1, "x", 2) for i, v in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("count", [10, 300])
def test_clusters(spark, count):
    rows = odd_vectors(some_vectors(4, count))
    found = hadamard.report(frame(spark, rows)).collect()
    got = sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in found)
    assert got == plain_clusters(rows)


def test_no_vectors(spark):
    assert hadamard.report(frame(spark, [(1, [0.5])])).count() == 0
    assert hadamard.report(frame(spark, [(1, [1e9] * 64)])).count() == 0  # beyond LIMIT
    assert pruned_graph.report(frame(spark, [(1, None), (20, [0.0] * 64)])).count() == 0


def test_progressive_search_keeps_ties():
    rng = np.random.default_rng(5)
    rows, centre = rng.integers(-3, 4, (500, 64)), rng.integers(-3, 4, (40, 64))
    centre[30] = centre[4]
    rows[:50] = centre[rng.integers(0, 40, 50)]
    number, part = hadamard.nearest(hadamard.transform(rows), hadamard.transform(centre))
    d = ((rows[:, None] - centre[None]) ** 2).sum(2)
    assert number.tolist() == d.argmin(1).tolist() and part.tolist() == (64 * d.min(1)).tolist()


def test_transform_is_exact_and_coarse_first():
    eye = hadamard.transform(np.eye(64, dtype=np.int64))
    assert (eye.T @ eye == 64 * np.eye(64)).all()
    assert (np.diff(eye, axis=0) != 0).sum(0).tolist() == list(range(64))


# neighbours


def plain_nearest(rows, nearest=20, step=20):
    kept = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and isfinite(x) for x in v) and any(v)})
    out = {}
    for q, v in kept:
        if q % step == 0:
            inner = lambda w: reduce(lambda t, p: t + p[0] * p[1], zip(v, w), 0.0)  # noqa: B023, E731  sum() would compensate
            scores = [(-inner(w), i) for i, w in kept if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:nearest]]
    return out


def found_nearest(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return dict(out)


def test_neighbours_of_odd_vectors(spark):
    rows = odd_vectors(some_vectors(6, 120)) + [(960, [1.0, 2.0]), (961, [3.0, 1.0]), (980, [1.0, 0.5])]
    want = plain_nearest(rows)
    assert found_nearest(pruned_graph.report(frame(spark, rows))) == want and len(want[960]) == 2


def test_copies_of_one_vector(spark):
    rows = some_vectors(7, 200)
    rows += [(1000 + i, rows[10][1]) for i in range(150)]
    want = plain_nearest(rows)
    assert found_nearest(pruned_graph.report(frame(spark, rows))) == want
    assert [i for i, _ in want[1000]][:2] == [10, 1001]


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_over_shards(spark, scaled):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 64))
    if scaled:  # lengths that differ by a factor of ten
        x *= rng.uniform(0.3, 3, 6000)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    graphs = pruned_graph.index(frame(spark, rows), shard_rows=2000)
    assert graphs.select("bucket").distinct().count() == 3 and graphs.count() == 6000
    found = found_nearest(pruned_graph.search(graphs, frame(spark, rows[:100])))
    score = x[:100] @ x.T
    score[np.arange(100), np.arange(100)] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    recall = np.mean([len(set(best[q]) & {i for i, _ in found[q]}) / 20 for q in range(100)])
    assert recall >= 0.95, recall
    for q in range(100):
        assert np.allclose([s for _, s in found[q]], score[q, [i for i, _ in found[q]]], rtol=1e-12)
