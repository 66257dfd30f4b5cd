"""Operators against plain Python on small fixtures."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from math import log10
from zlib import crc32

import numpy as np
import pytest
import xxhash

from featloom.llm import bitslice, decontaminate, importance, line_dedup, mixing, prefix_free, seed_extend, secrets, suffix_tree
from featloom.llm.components import components

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def some_text(rng, n, alphabet="abcdé "):
    return "".join(rng.choice(alphabet) for _ in range(n))


# repeated strings of bytes


def cut_bytes(rows, length=100):
    seen, out = set(), {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out[d] = (len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_prefix_free_parsing(spark, parts):
    rng = random.Random(4)
    a, b = some_text(rng, 300), some_text(rng, 130)
    made = []
    for i in range(120):
        t = some_text(rng, rng.randint(0, 400))
        t += a[rng.randint(0, 80) : 300 - rng.randint(0, 90)] if rng.random() < 0.5 else ""
        t += some_text(rng, rng.randint(0, 90)) + (b if rng.random() < 0.4 else "") + some_text(rng, rng.randint(0, 60))
        made.append((i, t))
    made += [(200, "a" * 1000), (201, "a" * 99), (202, "ab" * 300), (203, ""), (205, made[3][1]), (206, "x" + "ab" * 300)]
    rng.shuffle(made)
    found = prefix_free.report(spark.createDataFrame(made, DOCS).repartition(parts)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == cut_bytes(made)


def test_prefix_free_parsing_of_documents(docs, rows):
    found = prefix_free.report(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == cut_bytes(rows)


# repeated windows of words


def cut_words(rows, length=50):
    least = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            least[key] = min(d, least.get(key, d))
    out = {}
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - length + 1):
            if least[tuple(w[i : i + length])] < d:
                gone |= set(range(i, i + length))
        out[d] = (len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_seed_extend(spark, parts):
    rng = random.Random(5)
    word = lambda: rng.choice("the of and in a to is red blue".split())
    a, b = [word() for _ in range(160)], [word() for _ in range(55)]
    made = []
    for i in range(100):
        w = [word() for _ in range(rng.randint(0, 150))]
        w += a[rng.randint(0, 60) : 160 - rng.randint(0, 60)] if rng.random() < 0.5 else []
        w += b if rng.random() < 0.4 else []
        made.append((i, " ".join(w + [word() for _ in range(rng.randint(0, 40))])))
    made += [(200, "x " * 500), (201, "x " * 49), (202, "x " * 50), (203, "y z " * 200), (204, ""), (205, made[7][1])]
    rng.shuffle(made)
    found = seed_extend.report(spark.createDataFrame(made, DOCS).repartition(parts)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == cut_words(made)


# fingerprints


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(s, 42) for s in [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [b" ".join(w)]]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(values):
    v = np.array(values, dtype=np.uint64)
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    label = np.arange(len(v))
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


def near_values(seed, count):
    rng = np.random.default_rng(seed)
    out = []
    for x in rng.integers(0, 2**63, count, dtype=np.uint64):
        for _ in range(rng.integers(1, 8)):
            y = int(x)
            for bit in rng.choice(64, rng.integers(0, 7), replace=False):
                y ^= 1 << int(bit)
            out.append(y)
    return np.unique(np.array(out, dtype=np.uint64))


def test_bit_sliced_pairs():
    v = near_values(1, 120)
    np.random.default_rng(2).shuffle(v)
    left = len(v) - np.arange(len(v))
    found = {(i, j) for a, b in bitslice.close_pairs(v, left) for i, j in zip(a.tolist(), b.tolist())}
    near = np.bitwise_count(v[:, None] ^ v[None, :]) <= 4
    assert found == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}


@pytest.mark.parametrize("group", [8192, 16])
def test_links_connect_what_is_near(spark, group):
    v = near_values(3, 80)
    nodes = spark.createDataFrame([(int(x.view(np.int64)), i) for i, x in enumerate(v)], "fp long, name long")
    root = {r.node: r.root for r in components(bitslice.links(nodes, group)).collect()}
    want = plain_components(v)
    assert [root.get(i, i) for i in range(len(v))] == want.tolist()


def test_simhash_of_documents(docs, rows):
    rows = sorted(rows)
    prints = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(prints)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in bitslice.report(docs).collect()}
    assert found == {d: (format(p, "016x"), rows[c][0]) for (d, _), p, c in zip(rows, prints, label)}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# decontamination


def plain_hits(rows, items):
    split = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())
    out = {}
    for d, t in rows:
        w, hit, ids = split(t), set(), set()
        for item, it in items:
            x = split(it)
            n = min(13, len(x))
            for k in range(len(x) - n + 1 if n else 0):
                for i in range(len(w) - n + 1):
                    if w[i : i + n] == x[k : k + n]:
                        hit |= set(range(i, i + n))
                        ids.add(str(item))
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out[d] = (len(w), len(hit), len(ids), sha, len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def test_decontamination_with_short_items(spark):
    rng = random.Random(6)
    word = lambda: rng.choice("Alpha beta GAMMA delta über 42 x-ray".split())
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 12, 13, 20, 40])))) for i in range(14)] + [(99, ""), (98, None), (97, items_text := "!!! ?")]
    made = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(40)]
    made += [(100 + i, "one two " + (t or "").upper() + " three") for i, t in items] + [(300, None), (301, "")]
    assert items_text
    found = decontaminate.report(spark.createDataFrame(made, DOCS).repartition(4), spark.createDataFrame(items, "item_id long, text string"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()}
    assert got == plain_hits(made, items)


# lines


def alike(a, b):
    if a == b:
        return True
    if max(len(a), len(b)) < 10 or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def test_line_dedup(spark):
    rng = random.Random(7)
    word = lambda: rng.choice("aa bb cc dd".split())
    base = [[word() for _ in range(n)] for n in (3, 5, 8, 9, 10, 11, 14, 30) for _ in range(3)]
    made = []
    for d in range(40):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = list(rng.choice(base))
            kind = rng.random()
            if kind < 0.25:
                w[rng.randrange(len(w))] = word()
            elif kind < 0.5:
                del w[rng.randrange(len(w))]
            elif kind < 0.75:
                w.insert(rng.randrange(len(w) + 1), word())
            lines.append("  ".join(w) if rng.random() < 0.2 else " ".join(w))
        made.append((d, "\n".join(lines)))
    seen, want = [], {}
    for d, t in made:
        kept, n = [], 0
        for line in t.split("\n"):
            w = line.split()
            gone = len(w) >= 5 and any(len(x) >= 5 and alike(x, w) for x in seen)
            seen.append(w)
            n += gone
            if not gone:
                kept.append(line)
        want[d] = (t.count("\n") + 1, n, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    rng.shuffle(made)
    found = line_dedup.report(spark.createDataFrame(made, DOCS).repartition(5)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in found} == want


# mixing


def plain_targets(size):
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(size.values()), set(order), {}
    while True:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > 2 * size[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = 2.0 * size[s]
            left -= out[s]
            open_.remove(s)


def test_mix_meets_its_targets(spark):
    rng = random.Random(8)
    made = []
    for i in range(3000):
        source = rng.choice(["a", "B", "é", None, "c", "c", "c", "c"])
        made.append((i, source, " ".join("w" for _ in range(rng.randint(0, 40)))))
    df = spark.createDataFrame(made, "doc_id long, source string, text string")
    found = mixing.report(df).collect()
    of = {d: s for d, s, _ in made}
    size, taken, most = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        s = of[r.doc_id]
        size[s] += r.size
        taken[s] += r.taken
        most[s] = max(most[s], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    target = plain_targets(size)
    for r in found:
        s = of[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(target[s])
    assert all(abs(taken[s] - target[s]) <= most[s] for s in size)
    again = {r.doc_id: r.taken for r in mixing.report(df.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in found}


def test_rounding_keeps_expectations():
    prob, size = np.full(6, 0.3), np.array([1.0, 2, 3, 4, 5, 6])
    total = np.zeros(6)
    for seed in range(4000):
        key = np.array([hash((seed, i)) % 2**63 for i in range(6)])
        total += mixing.round_block(prob, size, key, 0, True)
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_mix_repeats_rows(spark):
    df = spark.createDataFrame([(i, "s", "one two three", "x") for i in range(50)], "doc_id long, source string, text string, mix_copy string")
    rows = mixing.mix(df).collect()
    copies = Counter(r.doc_id for r in rows)
    assert abs(len(rows) - 75) <= 1 and max(copies.values()) <= 2 and {r.mix_copy for r in rows} == {1, 2}


# suffix tree


def test_suffix_tree_scores(docs, rows):
    held = {d: crc32(str(d).encode()) % 10 == 0 for d, _ in rows}
    split = {d: (t or "").encode().lower().split() + [b"\n"] for d, t in rows}
    count = Counter(w for d, ws in split.items() if not held[d] for w in ws)
    total, whole = sum(count.values()), sum(count.values()) + 0.1 * (len(count) + 1)
    found = suffix_tree.report(docs).collect()
    assert {r.doc_id for r in found} == set(split)
    for r in found:
        ws = split[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(ws), total)
        assert r.n_known == sum(count[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(sum(log10((count[w] + 0.1) / whole) for w in ws))
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_suffix_tree_is_a_distribution(spark):
    rng = random.Random(9)
    made = []
    for i in range(200):
        w, a, b = [], i % 7, i % 5
        for _ in range(30):  # each word depends on the two before it
            a, b = b, (a * 2 + b + (rng.random() < 0.1)) % 7
            w.append(f"w{b}")
        made.append((i, " ".join(w)))
    model = suffix_tree.train(spark.createDataFrame(made, DOCS))
    number = {w: i for i, w in enumerate(model.words)}
    assert len(model.tree.one.keys) and len(model.tree.two.keys)
    for context in ([], [b"w1"], [b"w3"], [b"w1", b"w2"], [b"w2", b"w5"], [b"w6", b"w6"]):
        mass = 0.0
        for nxt in [*model.words, None]:
            ids = np.array([number[w] for w in context] + [number.get(nxt, -1)])
            p = suffix_tree.score(model.tree, ids, np.array([0]))[-1] + (model.tree.unseen if nxt is None else 0)
            mass += 10**p
        assert mass == pytest.approx(1, abs=1e-5)


def plain_suffix_tree(train, texts):
    """log10 score of each text by the model of all contexts of ``train``, in dictionaries."""
    split = lambda t: (t or "").encode().lower().split() + [b"\n"]
    count, grams = Counter(), (defaultdict(Counter), defaultdict(Counter))
    for t in train:
        w = split(t)
        count.update(w)
        for k in (1, 2):
            for i in range(k, len(w)):
                grams[k - 1][tuple(w[i - k : i])][w[i]] += 1
    whole = sum(count.values()) + 0.1 * (len(count) + 1)
    root = lambda w: (count[w] + 0.1) / whole

    def prob(c, w):
        n, t = grams[len(c) - 1][c], sum(grams[len(c) - 1][c].values())
        lower = prob(c[1:], w) if len(c) > 1 else root(w)
        return (max(n[w] - 0.75, 0) + 0.75 * len(n) * lower) / t

    keep = set()
    for k in (1, 0):
        for c, n in grams[k].items():
            lower = (lambda w: prob(c[1:], w)) if k else root
            if sum(n.values()) >= 2 and sum(m * np.log(prob(c, w) / lower(w)) - 1 for w, m in n.items()) >= 10:
                keep |= {c, c[-1:]}
    out = []
    for t in texts:
        w = split(t)
        best = [max((c for c in (tuple(w[max(i - k, 0) : i]) for k in (1, 2)) if c in keep), key=len, default=()) for i in range(len(w))]
        out.append(sum(log10(prob(c, x) if c else root(x)) for c, x in zip(best, w)))
    return out


@pytest.mark.parametrize("head", [None, (2e-3, 5e-3, 1e-3), (1.0, 1.0, 1.0)])
def test_suffix_tree_keeps_rare_contexts(spark, monkeypatch, head):
    """The score does not depend on what is frequent enough to be broadcast."""
    if head:
        for name, share in zip(("WORD", "CONTEXT", "EDGE"), head):
            monkeypatch.setattr(suffix_tree, name, share)
    rng = random.Random(12)
    made = []
    for i in range(150):
        w = []
        for _ in range(12):  # rare words that are always followed by the same one, between frequent ones
            k = rng.randrange(60)
            w += [f"x{k}", f"y{k}", f"z{k % 7}"] if rng.random() < 0.5 else [rng.choice("the of and".split()), rng.choice("a to in".split())]
        made.append((i, " ".join(w)))
    made += [(500, None), (501, "x1 y1 unseen x2 z5 the"), (501, "x1 y1 unseen x2 z5 the")]
    train = [t for d, t in made if crc32(str(d).encode()) % 10]
    found = suffix_tree.report(spark.createDataFrame(made, DOCS).repartition(4)).collect()
    want = dict(zip((d for d, _ in made), plain_suffix_tree(train, [t for _, t in made])))
    assert len(found) == len(made)
    assert {r.doc_id: r.score for r in found} == pytest.approx(want)


# learned filters


def test_importance_prefers_the_target(spark):
    rng = random.Random(10)
    good, bad = "sun tree river stone bird".split(), "spam click win cash now".split()
    made = [(i, " ".join(rng.choice(bad if i % 4 == 0 else good) for _ in range(60))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 400, 3)], "doc_id long, quality int, toxic int")
    found = importance.classify(spark.createDataFrame(made, DOCS), labels).collect()
    kept = {r.doc_id for r in found if r.kept}
    assert len(kept) == round(400 * sum(i % 4 != 0 for i in range(0, 400, 3)) / len(range(0, 400, 3)))
    assert sum(d % 4 == 0 for d in kept) <= 3


def test_secret_scan(spark):
    rng = random.Random(11)
    hexa = lambda n, a="0123456789abcdef": "".join(rng.choice(a) for _ in range(n))
    word = lambda n: "".join(rng.choice("aeioustrnl") for _ in range(n))
    made = []
    for i in range(300):
        w = [word(rng.randint(2, 7)) for _ in range(30)]
        w.insert(5, word(rng.randint(16, 30)))
        if i % 3 == 0:
            w[9:9] = ["token", "=", f'"{hexa(40)}"']
        if i % 50 == 1:
            w[9:9] = ["token", "=", f'"{hexa(40, "0123456789ABCDEF")}"']  # of no known form
        made.append((i, "src", " ".join(w)))
    rows = secrets.scan(spark.createDataFrame(made, "doc_id long, source string, text string")).collect()
    found = {r.doc_id for r in rows if r.probability > 0.5}
    assert found == {i for i in range(300) if i % 3 == 0 or i % 50 == 1}
    assert len(rows) == 300 + sum((i % 3 == 0) + (i % 50 == 1) for i in range(300))


def test_every_candidate_of_a_word(spark):
    keys = ["0123456789abcdef" * 2, "Zm9vYmFyYmF6cXV4Zm9vYmFyYmF6cXV4MTIzNDU2"]
    text = f'first aws_secret_access_key:"{keys[1]}" ["{keys[0]}","short","{keys[1]}"] a/b?x={keys[0]}&y={keys[1]} last'
    rows = secrets.scan(spark.createDataFrame([(1, text), (2, None), (3, "")], DOCS)).collect()
    want = [(1, 0, "aws_secret_access_key"), (1, 1, keys[1]), (2, 0, keys[0]), (2, 1, keys[1]), (3, 0, f"b?x={keys[0]}"[2:]), (3, 1, f"y={keys[1]}")]
    assert sorted((r.at, r.part, r.value) for r in rows) == want
