"""Near copies by SimHash and verification against exact Jaccard similarity."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.llm import near_copies

DOCS = "doc_id long, text string, name string, u long, key int"


def plain_shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def plain_groups(texts):
    """{id: smallest id connected through pairs of similarity 0.8 or more}."""
    sets = {d: plain_shingles(t) for d, t in texts.items()}
    having = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d, s in sets.items():
        for e in {e for x in s for e in having[x] if e < d}:
            both = len(s & sets[e])
            if 5 * both >= 4 * (len(s) + len(sets[e]) - both):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in texts}


def changed(rng, words, share):
    """About ``share`` of the shingles changed, by single words."""
    words = list(words)
    for i in rng.sample(range(len(words)), max(1, int(len(words) * share / 5))):
        words[i] = f"new{rng.randrange(10**6)}"
    return words


def test_groups_of_near_copies(spark):
    rng = random.Random(1)
    texts = {}
    for i in range(150):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(60, 300))]
        for k in range(rng.choice([1, 1, 2, 3, 6])):
            texts[len(texts) * 3] = " ".join(changed(rng, words, rng.choice([0.04, 0.12, 0.4])) if k else words)
    flat = [(d, t, "x", 1, 2) for d, t in texts.items()]
    rng.shuffle(flat)
    found = {r.doc_id: r.component_id for r in near_copies.groups(spark.createDataFrame(flat, DOCS).repartition(4)).collect()}
    want = plain_groups(texts)
    assert all(want[d] == want[c] for d, c in found.items())
    gone = sum(d != c for d, c in want.items())
    assert gone > 100 and sum(d != c for d, c in found.items()) >= 0.9 * gone


@pytest.mark.parametrize("radius", [3, 8, 14])
def test_pairs_within(radius):
    rng = np.random.default_rng(2)
    v = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = v.copy()
    for k in range(12):
        near ^= np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)
    v = np.concatenate([v, near])
    left = len(v) - np.arange(len(v))
    found = {(i, j) for a, b in near_copies.pairs_within(v, left, radius) for i, j in zip(a.tolist(), b.tolist())}
    assert found == {(i, j) for i, j in zip(*np.nonzero(np.bitwise_count(v[:, None] ^ v[None]) <= radius)) if i < j}


def test_large_groups_are_cut(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(changed(rng, words, 0.05)), None, None, None) for i in range(300)]
    nodes = [(d, near_copies.fingerprint(t.encode(), 5)) for d, t, *_ in rows]
    edges = near_copies.candidates(spark.createDataFrame(nodes, "name long, fp long"), group=16)
    kept = near_copies.verified(spark.createDataFrame(rows, DOCS), edges)
    from featloom.llm.components import components

    assert {r.root for r in components(kept).collect()} == {0}


def test_odd_rows(spark):
    long = " ".join(f"word{i % 4999}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "one two three"), (7, long), (8, long + " end"), (None, long), (9, "same"), (9, "same")]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], DOCS)
    out = near_copies.deduplicate(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text == long) for r in out.collect()) == [(0, True), (1, False), (4, False), (6, False), (7, True), (9, False)]
    assert near_copies.deduplicate(df.limit(0)).count() == 0


def templates(rng, number):
    """Texts at the edge of similarity 0.8 and beyond, around shared passages that many texts have."""
    shared = [[f"s{k}x{i}" for i in range(120)] for k in range(3)]
    texts = {}
    for i in range(number):
        words = list(rng.choice(shared)) + [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 60))]
        for k in range(rng.choice([1, 2, 3])):
            texts[len(texts) + 1] = " ".join(changed(rng, words, rng.choice([0.02, 0.08, 0.1, 0.12])) if k else words)
    return texts


@pytest.mark.parametrize("group", [16, 2048])
def test_no_pair_is_left_out(spark, group):
    texts = templates(random.Random(5), 150)
    rows = [(d, t, None, None, None) for d, t in texts.items()]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    marks = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        near_copies._marks, "doc_id long, w1 long, w2 long, fp long, size long, first array<long>"
    )
    nodes = marks.withColumn("name", F.col("doc_id")).withColumn("root", F.col("doc_id"))
    text = docs.select(F.col("text").cast("binary").alias("text"))
    found = {(r.u, r.v) for r in near_copies.apart(text, nodes, group, often=8).collect()}
    sets = {d: plain_shingles(t) for d, t in texts.items()}
    want = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert len(want) > 100 and want <= found


def test_all_groups_of_templates(spark):
    texts = templates(random.Random(6), 200)
    rows = [(d, t, None, None, None) for d, t in texts.items()]
    found = {r.doc_id: r.component_id for r in near_copies.groups(spark.createDataFrame(rows, DOCS).repartition(4)).collect()}
    assert found == plain_groups(texts)


def test_marks_are_fingerprints_of_the_text():
    import pyarrow as pa

    texts = ["", None, "one two", "a b c d e f g " * 30, " ".join(f"word{i % 4999}" for i in range(60_000))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array([t and t.encode() for t in texts], pa.binary())], names=["doc_id", "text"])
    (out,) = near_copies._marks(iter([batch]))
    assert out.column("fp").to_pylist() == [near_copies.fingerprint((t or "").encode(), 5) for t in texts]
    assert out.column("size").to_pylist()[:3] == [0, 0, 1]


def test_parity_rules_out_pairs_and_none_that_is_alike(spark):
    rng = np.random.default_rng(4)
    sets, rows = {}, []
    for d in range(0, 240, 2):
        size = int(rng.integers(1, 900))
        one = rng.integers(0, 2**63, size, dtype=np.uint64)
        gone = int(size * rng.choice([0.05, 0.1, 0.12, 0.5]))
        other = np.concatenate([one[gone:], rng.integers(0, 2**63, int(rng.integers(0, gone + 1)), dtype=np.uint64)])
        for k, found in ((d, one), (d + 1, other)):
            sets[k] = set(found.tolist())
            rows.append((k, len(found), near_copies.parity(np.sort(found))))
    nodes = spark.createDataFrame(rows, "name long, size long, bits binary").repartition(3)
    pairs = [(a, b) for a in sets for b in sets if a < b]
    found = {(r.u, r.v) for r in near_copies.possible(spark.createDataFrame(pairs, "u long, v long"), nodes).collect()}
    want = {(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    fair = {(a, b) for a, b in pairs if 4 * len(sets[a]) <= 5 * len(sets[b]) and 4 * len(sets[b]) <= 5 * len(sets[a])}
    assert len(want) > 40 and want <= found and len(found & fair) < 2 * len(want)
    # an id of two texts keeps a pair that one of them may form
    twice = spark.createDataFrame([(1, 1, near_copies.parity(np.array([5], np.uint64))), *[(k, 200, near_copies.parity(np.arange(k, k + 200, dtype=np.uint64))) for k in (1, 2)]], nodes.schema)
    assert [tuple(r) for r in near_copies.possible(spark.createDataFrame([(1, 2)], "u long, v long"), twice).collect()] == [(1, 2)]


def test_bits_of_a_unit_are_those_of_its_pairs():
    rng = np.random.default_rng(5)
    bits = [near_copies.parity(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 20, 40, 100, 300, 300, 310, 900)]
    held = near_copies.Parities(np.array(bits, object))
    for i, one in enumerate(bits):
        want = [near_copies.differing(np.frombuffer(one, np.uint64), np.frombuffer(b, np.uint64)) for b in bits]
        assert held.apart(i, np.arange(len(bits))).tolist() == want


def test_pairs_of_one_common_passage_are_ruled_out_where_they_meet(spark):
    """A group of texts with one passage in common writes no pair for each two of them."""
    rng = random.Random(8)
    passage = [f"s{i}" for i in range(120)]
    texts = {d: " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(100)]) for d in range(1, 201)}
    texts[500] = texts[7] + " end"
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in texts.items()], DOCS).repartition(4)
    marks = docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        near_copies._marked, "doc_id long, w1 long, w2 long, fp long, size long, first array<long>, bits binary"
    )
    # all shingles are as if in the often part: beginnings are of the passage's alone
    nodes = marks.withColumn("name", F.col("doc_id")).withColumn("root", F.col("doc_id")).withColumn("at", F.lit(0).cast("long"))
    rows = nodes.select("name", "size", "root", "bits", "at", F.lit(1).cast("long").alias("unit")).sortWithinPartitions("unit").coalesce(1)
    plain = rows.withColumn("bits", F.lit(None).cast("binary"))
    found, every = ({(r.u, r.v) for r in x.mapInArrow(near_copies._meet, "u long, v long").collect()} for x in (rows, plain))
    assert found == {(7, 500)} and len(every) > 10_000
