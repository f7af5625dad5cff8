"""Exact duplicates by counting quotient filters.

Every task folds its documents' 64-bit fingerprints into a counting quotient filter: the leading
bits of a fingerprint name a segment, the next eight its quotient (stored as run lengths only), the
rest is the remainder, kept sorted, with a count where it occurs more than once. Filters of
different tasks merge segment by segment without loss. Fingerprints counted more than once send
their documents to byte verification, which groups them by the text itself; all other documents
are unique and never meet.

Copies fold into one filter entry per task, and into one row per task before the verification
exchange, so a text that a third of all documents share costs a row per task, not per document.

Nulls and edge cases: a null text counts as empty; empty texts are copies of each other; a null
doc_id orders before every other; of rows that repeat both doc_id and text, exactly one is kept;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlake.llm import common as C

QUOTIENT_BITS = 8
REMAINDER_BYTES = 6
# Fingerprints that a task holds before it hands on a filter.
FILTER_ROWS = 1 << 20
# Copies of one row that are numbered in one list.
COPIES_LISTED = 1 << 16


def segment_bits(partitions: int) -> int:
    """Enough segments to spread over the exchange; the remainder must fit its bytes."""
    return min(16, max(64 - QUOTIENT_BITS - 8 * REMAINDER_BYTES, math.ceil(math.log2(2 * max(1, partitions)))))


def encode(prints: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """One segment's sorted distinct fingerprints and their counts as a quotient filter."""
    rest = np.uint64(64 - bits - QUOTIENT_BITS)
    quotients = (prints >> rest) & np.uint64((1 << QUOTIENT_BITS) - 1)
    runs = np.bincount(quotients.astype(np.int64), minlength=1 << QUOTIENT_BITS).astype("<u4")
    remainders = (prints & np.uint64((1 << int(rest)) - 1)).astype("<u8")
    packed = remainders.view(np.uint8).reshape(-1, 8)[:, :REMAINDER_BYTES]
    many = np.flatnonzero(counts > 1)
    return b"".join(
        (
            len(prints).to_bytes(4, "little"),
            runs.tobytes(),
            packed.tobytes(),
            many.astype("<u4").tobytes(),
            counts[many].astype("<u8").tobytes(),
        )
    )


def decode(segment: int, payload: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The fingerprints of an encoded segment, sorted, and their counts."""
    size = int.from_bytes(payload[:4], "little")
    at = 4 + 4 * (1 << QUOTIENT_BITS)
    runs = np.frombuffer(payload, "<u4", 1 << QUOTIENT_BITS, 4)
    quotients = np.repeat(np.arange(1 << QUOTIENT_BITS, dtype=np.uint64), runs)
    wide = np.zeros((size, 8), np.uint8)
    wide[:, :REMAINDER_BYTES] = np.frombuffer(payload, np.uint8, size * REMAINDER_BYTES, at).reshape(size, -1)
    at += size * REMAINDER_BYTES
    many = (len(payload) - at) // 12
    counts = np.ones(size, np.int64)
    counts[np.frombuffer(payload, "<u4", many, at)] = np.frombuffer(payload, "<u8", many, at + 4 * many)
    rest = np.uint64(64 - bits - QUOTIENT_BITS)
    high = np.uint64(segment) << np.uint64(64 - bits)
    return high | (quotients << rest) | wide.view("<u8").reshape(-1), counts


def merge(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct fingerprints with their counts added up."""
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    first = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]]) if len(prints) else np.empty(0, np.int64)
    return prints[first], np.add.reduceat(counts, first) if len(first) else counts


def repeated_fingerprints(prints: DataFrame, partitions: int) -> DataFrame:
    """Fingerprints (_f) that occur more than once, from the merged filters of all tasks."""
    bits = segment_bits(partitions)

    def filters(parts: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        segments = (values >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, segments[1:] != segments[:-1], True])
        rows = [(int(segments[a]), encode(values[a:b], counts[a:b], bits)) for a, b in zip(cuts, cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in rows], pa.int64()), pa.array([p for _, p in rows], pa.binary())],
            names=["_segment", "_filter"],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
                held += batch.num_rows
            if held >= FILTER_ROWS:
                yield filters(parts)
                parts, held = [], 0
        if held:
            yield filters(parts)

    def combine(table: pa.Table) -> pa.Table:
        parts = [
            decode(s.as_py(), p.as_py(), bits) for s, p in zip(table.column("_segment"), table.column("_filter"))
        ]
        values, counts = merge(np.concatenate([v for v, _ in parts]), np.concatenate([c for _, c in parts]))
        return pa.table({"_f": values[counts > 1].view(np.int64)})

    built = prints.mapInArrow(build, "_segment long, _filter binary")
    return built.groupBy("_segment").applyInArrow(combine, "_f long")


def groups(docs: DataFrame) -> DataFrame:
    """One row per text that occurs more than once: its SHA-256 (_sha), how many documents have it
    (_size) and the largest doc_id among them (_keep)."""
    spark = docs.sparkSession
    C.prepare(spark)
    rows = C.texts(docs).withColumn("_f", F.xxhash64("_text"))
    repeated = repeated_fingerprints(rows.select("_f"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Grouping by the text compares bytes, so equal fingerprints of different texts part here.
    return (
        rows.join(repeated, "_f")
        .groupBy("_text")
        .agg(F.count(F.lit(1)).alias("_size"), F.max("_k").alias("_keep"))
        .where("_size > 1")
        .select(F.sha2("_text", 256).alias("_sha"), "_size", "_keep")
    )


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id (the largest doc_id with this text), group_size, kept,
    text_sha256."""
    found = groups(docs)
    # Rows that repeat doc_id and text are told apart by a number only.
    rows = (
        C.texts(docs)
        .select("_k", F.sha2("_text", 256).alias("_sha"))
        .groupBy("_k", "_sha")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    keep = F.coalesce("_keep", "_k")
    # Numbered in two steps, so that no row holds a list of all its copies.
    run = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(COPIES_LISTED).cast("bigint")))
    last = F.least(F.col("_copies"), F.col("_run") + COPIES_LISTED)
    return (
        rows.join(found, "_sha", "left")
        .select("*", run.alias("_run"))
        .select("*", F.explode(F.sequence(F.col("_run") + 1, last)).alias("_copy"))
        .select(
            C.document_id().alias("doc_id"),
            F.when(keep != F.lit(C.NULL_ID), keep).alias("keep_id"),
            F.coalesce("_size", "_copies").cast("bigint").alias("group_size"),
            ((F.col("_k") == keep) & (F.col("_copy") == 1)).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with only one of each group of equal texts left, all columns kept."""
    found = groups(docs)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    rows = rows.select(
        "_row",
        F.coalesce(F.col("_row.doc_id").cast("bigint"), F.lit(C.NULL_ID)).alias("_k"),
        F.sha2(F.coalesce(F.col("_row.text"), F.lit("")), 256).alias("_sha"),
    )
    judged = rows.join(found, "_sha", "left")
    single = judged.where("_keep IS NULL").select("_row")
    # Of a group only the rows with its last id are left, so numbering them moves few rows.
    last = judged.where("_keep = _k").withColumn(
        "_copy", F.row_number().over(Window.partitionBy("_sha").orderBy("_k"))
    )
    return single.unionByName(last.where("_copy = 1").select("_row")).select("_row.*")
