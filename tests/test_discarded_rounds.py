"""Rounds that later ones have replaced leave no files, so disk does not grow with their number."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from featloom.operators import factorisation as fm
from featloom.operators import topic_model, topics
from featloom.plans.sizing import cut_lineage, discard, shared_folder


@pytest.fixture(scope="module")
def cells(spark):
    rows = [(i, f"t{j}", float((i * 7 + j * 3) % 5 + 1)) for i in range(30) for j in range(12) if (i + j) % 3]
    return spark.createDataFrame(rows, "id long, term string, w double")


def folders(spark) -> set[str]:
    return {p.name for p in Path(shared_folder(spark).removeprefix("file://")).iterdir()}


def left(spark, run) -> int:
    """Folders of a run that are still there once its result can be read."""
    before = folders(spark)
    assert run().count() > 0
    return len(folders(spark) - before)


def test_discarded_frames_have_no_files(spark, cells):
    before = folders(spark)
    frame = cut_lineage(cells)
    assert frame.count() == cells.count() and len(folders(spark) - before) == 1
    discard(frame, frame, cells, None)
    assert folders(spark) == before


@pytest.mark.parametrize("name", ["nmf", "lda", "svd", "fm"])
def test_files_do_not_grow_with_rounds(spark, cells, name):
    docs = cells.select("id").distinct().withColumns({"split": F.lit("train"), "fold": F.pmod("id", F.lit(2)), "label": F.pmod("id", F.lit(3)).cast("double")})
    runs = {
        "nmf": lambda n: topics.nmf_topics(cells, "id", "w", 2, iters=n)[0],
        "lda": lambda n: topic_model.lda_fit(cells, "id", "w", 2, rounds=n)[0],
        "svd": lambda n: topics.svd_rows(cells, "id", "w", 1, rounds=n, seed=n),
        "fm": lambda n: fm.fm_oof(docs, cells, "id", folds=2, rounds=n, factors=1),
    }
    assert left(spark, lambda: runs[name](2)) == left(spark, lambda: runs[name](4))
