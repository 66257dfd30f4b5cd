"""Substring dedup by seed and extend: passages of 50 words that an earlier document has.

Seeds are winnowed anchors.  Around a seed the match is extended both ways: over
the whole run of windows if the run's context is known from an earlier document,
else window by window; extensions that touch are joined to maximal repeats.  All
of them have at least ``LENGTH`` words, and each word of one is removed.

Cases: NULL and empty texts have no words; a document below ``LENGTH`` words
loses nothing; a passage that only repeats inside one document stays; rows that
share an id are not earlier than each other; NULL ids come last; repeated rows
get equal results; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import rows_of, words
from featloom.llm.repeats import Spec, changed_texts, covered_spans, key_columns, repeated_starts, with_changes

LENGTH, GRAM = 50, 12


def symbols(text: bytes) -> np.ndarray:
    found = text.split()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in found), np.uint64, len(found))


def spec(length: int = LENGTH, gram: int = GRAM) -> Spec:
    return Spec(symbols, length, gram, within=False)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, tag, text, ranges in rows_of([batch], "d", "tag", "text", "ranges"):
                found, kept, at = text.split(), [], 0
                for begin, end in covered_spans(ranges, length):
                    kept += found[at:begin]
                    at = end
                kept += found[at:]
                rows.append((d, tag, len(found) - len(kept), b" ".join(kept)))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["d", "tag", "removed", "kept"])

    return run


def cut_texts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(d, tag, removed, kept): count of removed words and words left, for the documents that lose any."""
    ranges = repeated_starts(docs, spec(length, gram))
    return changed_texts(docs, ranges, _cut(length), "d long, tag long, removed long, kept binary")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for each row of ``docs``."""
    changed = cut_texts(docs).select("d", "tag", "removed", F.sha2("kept", 256).alias("sha"))
    base = docs.select("doc_id", words(F.col("text")).alias("w"), *key_columns())
    base = base.select("doc_id", "d", "tag", F.size("w").cast("long").alias("n_words"), F.sha2(F.array_join("w", " "), 256).alias("whole"))
    rows = with_changes(base, changed)
    return rows.select("doc_id", "n_words", F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("sha", "whole").alias("kept_sha256"))


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS m FROM x),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM f WHERE m < doc_id),
k AS (SELECT doc_id, count(p) AS n_removed FROM gone GROUP BY doc_id),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.p) AS t FROM u LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY u.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
