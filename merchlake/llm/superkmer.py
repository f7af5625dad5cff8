"""Repeated word windows by super-k-mers.

A window of 20 words picks its minimiser, the ten words with the smallest hash; consecutive windows
with the same minimiser form a super-k-mer, which travels as one packed string to the minimiser's
bucket (see ``repeats``). There its windows are numbered by content, word by word and then by pairs of
shorter stretches, and sorted by number, document and place; every window but the first of its kind
starts earlier elsewhere, and the words it covers are removed.

Nulls and edge cases: a null text has no words; a text under 20 words loses nothing; documents are
ordered by doc_id with null first; rows that repeat doc_id are one document, and its spans apply to
each of the rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import repeats as R

LENGTH = 20
MINIMISER = 10
WINDOWS = R.Windows(R.parse_words, LENGTH, MINIMISER, block=4)


def window_ranks(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows that start at each word of all texts, equal for equal words only, and
    per text the number of words before it. Windows that leave their text have a number as well."""
    # bytes.split parts at exactly the separators of a word.
    texts = [data[a:b].tobytes().split() for a, b in zip(offsets, offsets[1:])]
    places = np.cumsum([0, *[len(words) for words in texts]])
    ranks = pa.array(chain.from_iterable(texts), pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    have = 1
    while have < length and len(ranks):
        step = min(have, length - have)
        pairs = ranks[: max(len(ranks) - step, 0)] * len(ranks) + ranks[step:]
        ranks = np.unique(pairs, return_inverse=True)[1]
        have += step
    return ranks, places


def _later(length: int):
    def judge(pool: R.Pool) -> tuple[np.ndarray, np.ndarray]:
        ranks, places = window_ranks(pool.data, pool.offsets, length)
        owner = np.repeat(np.arange(len(places) - 1), np.diff(places))
        at = np.flatnonzero(owner[: len(ranks)] == owner[length - 1 :]) if len(ranks) else np.empty(0, np.int64)
        stretch = owner[at]
        window = at - places[stretch]
        place, doc, rank = pool.place[stretch] + window, pool.doc[stretch], ranks[at]
        order = np.lexsort((place, doc, rank))
        same = rank[order][1:] == rank[order][:-1]
        # The place of each row's first equal.
        first = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(order)), 0)) if len(order) else order
        head = order[first]
        later = (doc[order] != doc[head]) | (place[order] != place[head])
        hit = np.sort(order[later])
        return stretch[hit], window[hit]

    return judge


def later_spans(docs: DataFrame, spec: R.Windows = WINDOWS) -> DataFrame:
    """Spans (_k, _start, _end) in words of all windows that also start earlier."""
    C.prepare(docs.sparkSession)
    return R.repeated(docs, spec, _later(spec.length), F.col("_o") > F.col("_first"))


def remove_later(docs: DataFrame, spec: R.Windows = WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = C.string_bytes(batch.column("_text"))
            counts, removed, kept = [], [], []
            for row, spans in enumerate(batch.column("_spans")):
                # bytes.split parts at exactly the separators of a word.
                words = data[offsets[row] : offsets[row + 1]].tobytes().split()
                gone = R.covered(len(words), spans.values.to_numpy() if spans.is_valid else None)
                counts.append(len(words))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(compress(words, ~gone) if removed[-1] else words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_k"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                names=["_k", "n_words", "n_removed", "kept"],
            )

    done = R.with_spans(docs, later_spans(docs, spec)).mapInArrow(
        strip, "_k long, n_words long, n_removed long, kept string"
    )
    return done.select(C.document_id().alias("doc_id"), "n_words", "n_removed", "kept")
