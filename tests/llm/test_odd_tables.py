"""NULLs in any column, empty and very long texts, ties, repeated rows, empty tables, extra columns."""

from collections import Counter

import pytest

import corpus_pipeline
from featloom.llm import bitslice, decontaminate, importance, line_dedup, line_rules, mixing, prefix_free, secrets, seed_extend, suffix_tree

EXTRA = "kept string, size int, rank int, target string, fp string, mark int, d string, tag string, key string, words string, component_id int, copies int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def row(doc_id, text, source="s"):
    return (doc_id, text, None, source, None, None, 1, 2, "t", "f", 3, "d", "g", "k", "w", 4, 5)


LONG = " ".join(f"word{i % 4999}" for i in range(60_000))
ROWS = [
    row(1, None), row(2, ""), row(3, " \n\t\n "), row(4, LONG), row(5, LONG), row(6, "x" * 100_000), row(7, "same words here again " * 30, None),
    row(7, "same words here again " * 30, None), row(7, "another text of the same id", "s"), row(None, "a text without an id " * 20), row(None, None, None),
    row(8, "über größe   naïve \U0001f600 text.\n" * 5), row(9, "\n".join(["| a | b | c |"] * 4)),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "same words here again same words"), (None, "a text without"), (2, None), (2, "")], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 1, None), (7, 0, 1), (7, 1, 0), (None, 1, 0), (99, 1, 0), (6, 0, 0), (8, 0, 0), (98, 0, None)], "doc_id long, quality int, toxic int")


def reports(bench, labels):
    return {
        "mixing": mixing.report,
        "suffix_tree": suffix_tree.report,
        "prefix_free": prefix_free.report,
        "secrets": secrets.report,
        "decontaminate": lambda d: decontaminate.report(d, bench),
        "importance": lambda d: importance.report(d, labels),
        "line_dedup": line_dedup.report,
        "bitslice": bitslice.report,
        "seed_extend": seed_extend.report,
        "line_rules": line_rules.report,
    }


NAMES = list(reports(None, None))


@pytest.mark.parametrize("name", NAMES)
def test_each_row_has_its_result(odd, bench, labels, name):
    found = [r.asDict() for r in reports(bench, labels)[name](odd).collect()]
    if name == "secrets":
        assert all(r["doc_id"] in (4, 5, 6, 7, 8, None) for r in found)
        return
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in ROWS)
    by_id = {r["doc_id"]: r for r in found}
    if name == "mixing":
        assert by_id[1]["size"] == by_id[2]["size"] == by_id[3]["taken"] == 0
    if name == "suffix_tree":
        assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == 1 and by_id[4]["n_tokens"] == 60_001
    if name == "prefix_free":
        assert by_id[4]["n_removed"] < by_id[5]["n_removed"] == by_id[5]["n_bytes"] and by_id[6]["n_removed"] == 99_999
    if name == "seed_extend":
        assert by_id[4]["n_removed"] == 0 and by_id[5]["n_removed"] == 60_000 and by_id[6]["n_words"] == 1
        assert [r["n_removed"] for r in found if r["doc_id"] == 7] == [0, 0, 0]
    if name == "decontaminate":
        assert by_id[1]["n_hit"] == 0 and not by_id[2]["contaminated"]
        assert sorted(r["n_hit"] for r in found if r["doc_id"] == 7) == [0, 118, 118]
        assert sorted((r["n_hit"], r["n_items"]) for r in found if r["doc_id"] is None) == [(0, 0), (60, 0)]
    if name == "importance":
        assert not by_id[1]["kept"] and not by_id[2]["kept"]
    if name == "line_dedup":
        assert by_id[1]["n_lines"] == 0 and by_id[5]["n_removed"] == 1 and by_id[8]["n_removed"] == 4 - 0 and by_id[4]["n_removed"] == 0
        assert [r["n_removed"] for r in found if r["doc_id"] == 7] == [0, 0, 0]
    if name == "bitslice":
        assert by_id[2]["component_id"] == by_id[3]["component_id"] == 1 and by_id[1]["fingerprint"] == "0" * 16
        assert by_id[5]["component_id"] == 4
    if name == "line_rules":
        assert by_id[1]["base_failed"] and by_id[4]["kept"] is (not by_id[4]["base_failed"]) and not by_id[9]["kept"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables_have_empty_results(none, bench, labels, name):
    assert reports(bench, labels)[name](none).count() == 0


def test_empty_side_tables(odd, spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(odd, bench).where("contaminated OR n_hit > 0").count() == 0
    assert decontaminate.remove(odd, bench).count() == len(ROWS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert importance.report(odd, labels).where("kept").count() == len(ROWS)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_keep_columns_and_survive(odd, none, spark, tmp_path, bench, name, stage):
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    found = stage(spark, odd, str(tmp_path))
    more = ["mix_copy"] if name == "mixing" else []
    assert found.columns == odd.columns + more
    before = Counter(tuple(r) for r in odd.drop("text", "n_chars").collect())
    after = Counter(tuple(r) for r in found.drop("text", "n_chars", *more).collect())
    assert set(after) <= set(before) and (more or not after - before)
    assert stage(spark, none, str(tmp_path)).count() == 0
