"""The whole pipeline against its stages in plain Python and DuckDB."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from featloom.llm import decontaminate, line_dedup, line_rules
from featloom.llm.common import stored
from test_brute import plain_hits
from test_near_copies import plain_groups

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage returned."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER), name)
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def in_duckdb(rows, sql):
    con = duckdb.connect()
    con.execute("CREATE TABLE docs (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO docs VALUES (?, ?)", list(rows.items()))
    return dict(con.execute(sql).fetchall())


def test_stages(spark, steps):
    first, lines, near, clean, mixed = steps
    start = texts(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    want = in_duckdb(start, "WITH " + line_rules.SQL.replace("@docs", "docs") + "SELECT doc_id, good FROM judged WHERE kept")
    assert texts(first) == want
    kept = in_duckdb(want, "WITH " + line_dedup.SQL.replace("@docs", "docs") + "SELECT doc_id, good FROM deduped")
    want = {d: t for d, t in kept.items() if t.split()}
    assert texts(lines) == want
    group = plain_groups(want)
    left = texts(near)
    # no text goes without a near copy that stays, and nearly all groups are found whole
    assert left.items() <= want.items() and {group[d] for d in left} == set(group.values())
    assert len(want) - len(left) >= 0.9 * (len(want) - len(set(group.values())))
    want = left
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    hits = plain_hits(list(want.items()), items)
    want = {d: t for d, t in want.items() if not hits[d][4]}
    assert texts(clean) == want
    rows = mixed.collect()
    assert {r.doc_id: r.text for r in rows}.items() <= want.items()
    words = lambda x: sum(len(t.split()) for t in x)
    most = max(len(t.split()) for t in want.values())
    assert abs(words(r.text for r in rows) - 1.5 * words(want.values())) <= 20 * most
    assert max(Counter(r.doc_id for r in rows).values()) <= 2


def test_run_equals_its_stages(spark, steps):
    found = corpus_pipeline.run(spark, FOLDER)
    assert found.columns == steps[-1].columns and found.exceptAll(steps[-1]).count() == 0 == steps[-1].exceptAll(found).count()
    assert decontaminate.report(found, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("contaminated").count() == 0
