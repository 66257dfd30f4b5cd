"""Bytes of the corpus that repeat an earlier string of 100 bytes, by prefix-free parsing.

Triggers are chosen by a rolling hash of ``GRAM`` bytes (the smallest in a
window), so the same text has the same triggers wherever it stands, no phrase is
longer than the window, and every string of ``LENGTH`` bytes holds one.  A
suffix of the corpus is then a suffix of a phrase, up to its trigger, followed by
the rest of the parse.  The dictionary has each different phrase with its
following context once, at its first place; the parse says which of them stands
where.  Where the parse repeats an entry, all of its suffixes repeat.  Suffixes of
different entries can only be equal if both parts are, the piece before the
trigger and the parse after it; they are grouped by both.

The contract asks which suffixes agree over ``LENGTH`` bytes, not for their
order, so suffixes have hashed classes where a suffix array has ranks: sorting
them would take some bytes for each byte of the corpus, more than it has itself.

Cases: NULL and empty texts have no bytes; a document below ``LENGTH`` bytes
loses nothing; rows that share an id are not earlier than each other; NULL ids
come last; repeated rows get equal results; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm.common import mix, rows_of
from featloom.llm.repeats import Spec, changed_texts, covered_spans, key_columns, repeated_starts, with_changes

LENGTH, GRAM = 100, 34
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def symbols(text: bytes) -> np.ndarray:
    return BYTES[np.frombuffer(text, np.uint8)]


def spec(length: int = LENGTH, gram: int = GRAM) -> Spec:
    return Spec(symbols, length, gram, within=True)


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for d, tag, text, ranges in rows_of([batch], "d", "tag", "text", "ranges"):
                spans = covered_spans(ranges, length)
                kept, at = [], 0
                for begin, end in spans:
                    kept.append(text[at:begin])
                    at = end
                left = b"".join([*kept, text[at:]])
                rows.append((d, tag, len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), [list(s) for s in spans]))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64()))]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=["d", "tag", "removed", "n_spans", "sha", "spans"])

    return run


def removed_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(d, tag, removed, n_spans, sha, spans): maximal removed runs as [begin, end), for the documents that lose bytes."""
    ranges = repeated_starts(docs, spec(length, gram))
    schema = "d long, tag long, removed long, n_spans long, sha string, spans array<array<bigint>>"
    return changed_texts(docs, ranges, _cut(length), schema)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row of ``docs``."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", *key_columns(), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    rows = with_changes(base, removed_spans(docs).drop("spans"))
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id", "n_bytes", F.coalesce("removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("sha", "whole").alias("kept_sha256"),
    )
