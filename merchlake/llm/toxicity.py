"""Toxicity scores: logistic regression trained with FTRL-proximal over hashed word n-grams and
skip-grams.

Features of a text are the distinct hashed words, word pairs and pairs with one word left out. The
model is trained on a bounded sample of labelled rows (``TRAIN_ROWS``, taken by a hash of doc_id) in
one task, with per-coordinate rates and L1 shrinkage. Averaging models of parts of the sample was
tried and lost a tenth of the recall. L1 leaves few weights, at most one per hash bucket, which
every scoring task gets. Scoring reads every whole text once and shuffles nothing.

Nulls and edge cases: a null or empty text gets the score of the bias alone; labels that are null or
have no document are left out; without any labelled rows every score is one third; repeated rows
get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import words as W

BUCKET_BITS = 20
# Labelled rows that the model is fitted on at most.
TRAIN_ROWS = 20_000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 4.0, 0.1
HOLD_OUT = 5
_SKIP, _PAIR = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all features of a chunk of texts, and the text each belongs to."""
    hashes, _, _, places = W.word_hashes(data, offsets, lower=True, separator=W.PUNCTUATION)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(places))
    kinds, owners = [hashes], [text]
    for gap, salt in ((1, _PAIR), (2, _SKIP)):
        if len(hashes) > gap:
            inside = text[gap:] == text[:-gap]
            kinds.append(W.mix(hashes[:-gap][inside] * salt + hashes[gap:][inside]))
            owners.append(text[gap:][inside])
    found = np.concatenate(kinds) >> np.uint64(64 - BUCKET_BITS)
    return found.astype(np.int32), np.concatenate(owners)


@dataclass(frozen=True)
class Model:
    """Non-zero weights by bucket, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self) -> Column:
        """A column function from text to score."""
        model = self

        @F.arrow_udf("double")
        def score(texts: pa.Array) -> pa.Array:
            table = np.zeros(1 << BUCKET_BITS, np.float32)
            table[model.buckets] = model.weights
            data, offsets = C.string_bytes(texts)
            out = np.full(len(texts), model.bias)
            for first, last in C.runs_of(offsets, C.CHUNK_BYTES):
                chunk = data[offsets[first] : offsets[last]]
                found, owner = features(chunk, offsets[first : last + 1] - offsets[first])
                weighty = np.flatnonzero(table[found])
                # A feature counts once per text.
                once = np.unique(owner[weighty].astype(np.int64) << BUCKET_BITS | found[weighty])
                add = table[once & ((1 << BUCKET_BITS) - 1)]
                out[first:last] += np.bincount(once >> BUCKET_BITS, weights=add, minlength=last - first)
            return pa.array(1 / (1 + np.exp(-np.clip(out, -40, 40))))

        return score


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights of all buckets and the bias after passes over the rows in the given order."""
    z, n = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    positive = labels.sum()
    start = float(np.log((positive + 0.5) / (len(labels) - positive + 1.0)))
    bias, bias_n = start, 0.0

    def weight(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zi) * np.maximum(np.abs(zi) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ni)) / ALPHA + L2)

    for _ in range(epochs):
        for at, label in zip(rows, labels, strict=True):
            zi, ni = z[at], n[at]
            w = weight(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(bias + w.sum(), -40, 40)))
            g = p - label
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * w
            n[at] = ni + g * g
            bias_n += g * g
            bias -= 0.5 * ALPHA * g / (BETA + np.sqrt(bias_n))
    return weight(z, n), bias


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt."""
    return F.crc32(doc_id.cast("string")) % HOLD_OUT == 0


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""
    C.prepare(docs.sparkSession)
    picked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("bigint").alias("_k"))
        .agg(F.max(F.col(label).cast("int")).alias("_label"))
        .orderBy(F.xxhash64("_k"), "_k")
        .limit(rows)
    )
    # At most ``rows`` ids are broadcast, so no text is shuffled.
    sample = C.texts(docs).join(F.broadcast(picked), "_k")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for first, last, data, offsets in C.text_chunks(batch):
                bucket, owner = features(data, offsets)
                key = np.unique(owner.astype(np.int64) << BUCKET_BITS | bucket)
                cuts = np.searchsorted(key >> BUCKET_BITS, np.arange(last - first + 1))
                bucket = (key & ((1 << BUCKET_BITS) - 1)).astype("<i4")
                found += [bucket[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k"), batch.column("_label"), pa.array(found, pa.binary())],
                names=["_k", "_label", "_found"],
            )

    def fit(table: pa.Table) -> pa.Table:
        # The order of learning is that of a hash, whatever order the rows arrived in.
        ids = table.column("_k").to_numpy()
        order = np.lexsort((ids, W.mix(ids.view(np.uint64))))
        found = table.column("_found").to_pylist()
        weights, bias = ftrl(
            [np.frombuffer(found[i], "<i4") for i in order], table.column("_label").to_numpy()[order].astype(float)
        )
        kept = np.flatnonzero(weights)
        return pa.table({"_bucket": np.r_[-1, kept].astype(np.int32), "_weight": np.r_[bias, weights[kept]]})

    learnt = (
        sample.mapInArrow(extract, "_k long, _label int, _found binary")
        .withColumn("_all", F.lit(0))
        .groupBy("_all")
        .applyInArrow(fit, "_bucket int, _weight double")
        # At most one row per bucket.
        .toArrow()
    )
    buckets, weights = learnt.column("_bucket").to_numpy(), learnt.column("_weight").to_numpy()
    trained = buckets < 0
    if not trained.any():
        return Model(np.empty(0, np.int32), np.empty(0, np.float32), float(np.log(0.5)))
    return Model(buckets[~trained], weights[~trained].astype(np.float32), float(weights[trained][0]))


def scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = train(docs, labels, rows=rows)
    return docs.select(
        F.col("doc_id"),
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        model.scorer()(F.col("text").cast("string")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents with a score below ``threshold``, all columns kept."""
    model = train(docs, labels)
    return docs.where(model.scorer()(F.col("text").cast("string")) < threshold)
