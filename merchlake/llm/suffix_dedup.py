"""Repeated byte strings by bucket-pointer refinement.

Every byte that a 200-byte string covers is removed if that string starts at any other place, in
the same document or another. Strings that may repeat are found by content-picked grams (see
``repeats``); the suffixes that meet by gram are then refined as buckets: suffixes start in buckets
of equal 50-grams, and each round sorts those still sharing a bucket by the bucket of their own place
and of the place one bucket length later, so the bucket ids of one round double the length that the
next one tells apart. A suffix alone in its bucket leaves. After 50, 100 and 200 bytes the buckets
with several suffixes are the repeated strings.

Nulls and edge cases: a null text is empty; a text under 200 bytes loses nothing; rows that repeat
doc_id are one document, and its spans apply to each of the rows; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import repeats as R
from merchlake.llm import words as W

LENGTH = 200
GRAM = 112
FIRST_BUCKETS = 50
WINDOWS = R.Windows(R.parse_bytes, LENGTH, GRAM, block=16)


def _shared_buckets(at: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Bucket ids by key for the given places; -1 elsewhere and where a bucket has one place."""
    ids = np.full(size, -1, np.int64)
    _, bucket, many = np.unique(keys, return_inverse=True, return_counts=True)
    ids[at] = np.where(many[bucket] > 1, bucket, -1)
    return ids


def refine(data: np.ndarray, offsets: np.ndarray, length: int, first: int = FIRST_BUCKETS) -> np.ndarray:
    """Bucket ids of the ``length``-byte strings that start at each place and end in the same text;
    -1 where none does or where it occurs once."""
    size = len(data)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    reach = min(first, length)
    grams = W.gram_hash(W.prefix_sums(data), reach)
    at = np.flatnonzero(owner[: len(grams)] == owner[reach - 1 :]) if len(grams) else np.empty(0, np.int64)
    ids = _shared_buckets(at, grams[at], size)
    while reach < length:
        step = min(reach, length - reach)
        at = np.flatnonzero((ids[: max(size - step, 0)] >= 0) & (ids[step:] >= 0))
        at = at[at + reach + step <= size]
        at = at[owner[at] == owner[at + reach + step - 1]]
        ids = _shared_buckets(at, ids[at] * size + ids[at + step], size)
        reach += step
    return ids


def _repeated(length: int):
    def judge(pool: R.Pool) -> tuple[np.ndarray, np.ndarray]:
        ids = refine(pool.data, pool.offsets, length)
        at = np.flatnonzero(ids >= 0)
        stretch = np.searchsorted(pool.offsets, at, side="right") - 1
        # Stretches that occur again as a whole are removed as a whole.
        open_ones = ~pool.again[stretch]
        return stretch[open_ones], (at - pool.offsets[stretch])[open_ones]

    return judge


def repeated_spans(docs: DataFrame, spec: R.Windows = WINDOWS) -> DataFrame:
    """Spans (_k, _start, _end) of all windows that occur more than once."""
    C.prepare(docs.sparkSession)
    return R.repeated(docs, spec, _repeated(spec.length), F.lit(True))


def remove_repeats(docs: DataFrame, spec: R.Windows = WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes left, binary)."""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = C.string_bytes(batch.column("_text"))
            removed, runs, kept = [], [], []
            for row, spans in enumerate(batch.column("_spans")):
                text = data[offsets[row] : offsets[row + 1]]
                gone = R.covered(len(text), spans.values.to_numpy() if spans.is_valid else None)
                removed.append(int(gone.sum()))
                runs.append(int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0)
                kept.append(text[~gone].tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_k"),
                    pa.array(np.diff(offsets)),
                    pa.array(removed, pa.int64()),
                    pa.array(runs, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                names=["_k", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    done = R.with_spans(docs, repeated_spans(docs, spec)).mapInArrow(
        strip, "_k long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return done.select(C.document_id().alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept")
