"""Rows without an id, and different rows of one id, in the operators that remove parts of texts."""

import hashlib
import random
from collections import Counter

import pytest

from featloom.llm import bitslice, line_dedup, prefix_free, seed_extend

DOCS = "doc_id long, text string"


def some_rows(seed, unit):
    """2,000 rows without an id, 60 that share two ids, and some of their own; passages recur among them."""
    rng = random.Random(seed)
    shared = [unit(rng, 140) for _ in range(30)]
    ids = [None] * 2000 + [7] * 30 + [8] * 30 + list(range(100, 140))
    out = []
    for i in ids:
        parts = [unit(rng, rng.randint(0, 90))]
        if rng.random() < 0.3:
            parts.append(rng.choice(shared))
        parts.append(unit(rng, rng.randint(0, 40)))
        out.append((i, " ".join(parts)))
    return out + [out[5], out[2005]]


def words(rng, n):
    return " ".join(f"{rng.randrange(10**6):x}" for _ in range(n))


def plain(rows, split, join, length, within):
    """Counter of (id, removed, hash of what is left)."""
    last = 2**63 - 1
    first = {}
    for i, text in rows:
        s = split(text)
        for k in range(len(s) - length + 1):
            key = tuple(s[k : k + length])
            first[key] = min(first.get(key, last), last if i is None else i)
    out = Counter()
    for i, text in rows:
        s, gone, mine = split(text), set(), set()
        for k in range(len(s) - length + 1):
            key = tuple(s[k : k + length])
            if first[key] < (last if i is None else i) or (within and key in mine):
                gone |= set(range(k, k + length))
            mine.add(key)
        left = join(x for k, x in enumerate(s) if k not in gone)
        out[i, len(gone), hashlib.sha256(left).hexdigest()] += 1
    return out


@pytest.mark.parametrize("parts", [1, 7])
def test_words(spark, parts):
    rows = some_rows(1, words)
    random.Random(2).shuffle(rows)
    found = seed_extend.report(spark.createDataFrame(rows, DOCS).repartition(parts)).collect()
    want = plain(rows, lambda t: t.encode().split(), b" ".join, 50, within=False)
    assert Counter((r.doc_id, r.n_removed, r.kept_sha256) for r in found) == want and any(k[0] is None and k[1] for k in want)


def test_bytes(spark):
    rows = some_rows(3, lambda rng, n: words(rng, n // 5))
    found = prefix_free.report(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    want = plain(rows, lambda t: list(t.encode()), lambda s: bytes(s), 100, within=True)
    assert Counter((r.doc_id, r.n_removed, r.kept_sha256) for r in found) == want


def test_lines_of_other_rows_stay(spark):
    a, b = [f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)]
    for key in (None, 7):
        rows = [(1, " ".join(a)), (key, " ".join(a[:11] + ["X"])), (key, " ".join(b))]
        found = line_dedup.deduplicate(spark.createDataFrame(rows, DOCS)).collect()
        assert Counter((r.doc_id, r.text) for r in found) == Counter([(1, " ".join(a)), (key, " ".join(b))])
    rng = random.Random(4)
    rows = [(None if i % 3 else 7, "\n".join(words(rng, 12) for _ in range(3))) for i in range(2000)]
    rows += [(None, rows[1][1].split("\n")[0]), (9, rows[0][1].split("\n")[1])]
    found = line_dedup.deduplicate(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    assert sum(len(r.text.split("\n")) for r in found) == 6000


def test_fingerprints_of_pieces(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["", "one", "one two three", words(rng, 4), words(rng, 900), " \t" * 50 + words(rng, 300) + "\n\n"]
    whole = [bitslice.fingerprint(t.encode()) for t in texts]
    for piece in (1, 10, 1000):
        monkeypatch.setattr(bitslice, "PIECE", piece)
        assert [bitslice.fingerprint(t.encode()) for t in texts] == whole
