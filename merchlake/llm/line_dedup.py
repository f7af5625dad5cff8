"""Line dedup by pairwise alignment.

Documents that overlap are found through the lines they share. A rare line, of at most ``RARE``
holders, makes partners of each two of them. Of a more frequent line every holder is a partner of the
one before it and of the first, so that every shared line leads to a document that holds it,
and pairs grow with the lines and not with the square of a line's holders. A pair is aligned by patience
diff over line hashes: lines that occur once on either side, in longest increasing order, split both
documents, and equal lines at the borders of the gaps join in. Lines aligned with any partner are
deleted from the later document.

Nulls and edge cases: a null text is empty and has one empty line; empty lines lead nowhere but are
deleted inside aligned blocks; a null doc_id is earlier than every other; rows that repeat doc_id are
one document, and its deletions apply to each of the rows; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import words as W

# Holders of a line that are all compared with each other.
RARE = 8
# Frequent lines: holders whose ids agree above these bits are ordered together.
_RANGE_BITS = 10
# Hash of an empty line; no other line gets it.
EMPTY = 0
_NEWLINE = np.arange(256) == 0x0A


def line_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lines of a chunk, and per text the number of lines before it."""
    breaks = np.flatnonzero(_NEWLINE[data])
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    ends = np.sort(np.concatenate([breaks, offsets[1:]]))
    found = W.span_hash(W.prefix_sums(data), starts, ends) if len(starts) else np.empty(0, np.uint64)
    found[starts == ends] = EMPTY
    before = np.zeros(len(offsets), np.int64)
    owner = np.searchsorted(offsets, breaks, side="right") - 1
    np.cumsum(np.bincount(owner, minlength=len(offsets) - 1) + 1, out=before[1:])
    return found, before


def lines_of(docs: DataFrame) -> DataFrame:
    """Per document its line hashes in order (_lines)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in C.text_chunks(batch):
                found, before = line_hashes(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(found.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_k").slice(first, last - first), lists], names=["_k", "_lines"]
                )

    return C.texts(docs).mapInArrow(read, "_k long, _lines array<long>")


def partners(lines: DataFrame, rare: int = RARE) -> DataFrame:
    """Pairs of a document (_k) and an earlier one (_hub) to align it with."""
    held = lines.select("_k", F.explode(F.array_distinct("_lines")).alias("_h")).where(F.col("_h") != EMPTY).distinct()
    counted = (
        held.groupBy("_h")
        .agg(F.min("_k").alias("_first"), F.count(F.lit(1)).alias("_holders"))
        .where("_holders > 1")
        # So that the join can split a line that very many documents hold.
        .checkpoint()
    )
    shared = C.stored(held.join(counted, "_h"), "shared")
    # At most ``rare`` holders.
    few = shared.where(F.col("_holders") <= rare).groupBy("_h").agg(F.collect_list("_k").alias("_all"))
    each = few.select("_all", F.explode("_all").alias("_k")).select("_k", F.explode("_all").alias("_hub"))
    # The holder before: inside a range of ids, or the last one of the range before. A range holds
    # 2^_RANGE_BITS ids at most, and a row per range is ordered by line.
    many = shared.where(F.col("_holders") > rare).withColumn("_range", F.shiftright("_k", _RANGE_BITS))
    inside = Window.partitionBy("_h", "_range").orderBy("_k")
    ranges = many.groupBy("_h", "_range").agg(F.max("_k").alias("_last"))
    before = ranges.withColumn("_last", F.lag("_last").over(Window.partitionBy("_h").orderBy("_range"))).checkpoint()
    linked = many.withColumn("_near", F.lag("_k").over(inside))
    linked = linked.where("_near IS NOT NULL").select("_k", "_first", "_near").unionByName(
        linked.where("_near IS NULL").join(before, ["_h", "_range"]).select("_k", "_first", F.col("_last").alias("_near"))
    )
    chained = linked.select("_k", F.explode(F.array("_first", "_near")).alias("_hub"))
    return each.unionByName(chained).where("_hub < _k").distinct()


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given by rising first numbers, whose second numbers rise too."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for at, (_, b) in enumerate(pairs):
        pile = bisect_left(tops, b)
        back.append(piles[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(b)
            piles.append(at)
        else:
            tops[pile], piles[pile] = b, at
    chain, at = [], piles[-1] if piles else -1
    while at >= 0:
        chain.append(pairs[at])
        at = back[at]
    return chain[::-1]


def patience(earlier: list[int], later: list[int]) -> list[tuple[int, int]]:
    """Aligned equal lines as places in both documents."""
    matched, open_ranges = [], [(0, len(earlier), 0, len(later))]
    while open_ranges:
        a, a_end, b, b_end = open_ranges.pop()
        while a < a_end and b < b_end and earlier[a] == later[b]:
            matched.append((a, b))
            a, b = a + 1, b + 1
        while a < a_end and b < b_end and earlier[a_end - 1] == later[b_end - 1]:
            a_end, b_end = a_end - 1, b_end - 1
            matched.append((a_end, b_end))
        if a == a_end or b == b_end:
            continue
        once = Counter(earlier[a:a_end])
        also = Counter(later[b:b_end])
        where = {line: at for at, line in enumerate(later[b:b_end], b) if also[line] == 1}
        unique = [
            (at, where[line]) for at, line in enumerate(earlier[a:a_end], a) if once[line] == 1 and line in where
        ]
        for next_a, next_b in _increasing(unique):
            matched.append((next_a, next_b))
            open_ranges.append((a, next_a, b, next_b))
            a, b = next_a + 1, next_b + 1
        if unique:
            open_ranges.append((a, a_end, b, b_end))
    return matched


def aligned_lines(lines: DataFrame, pairs: DataFrame) -> DataFrame:
    """Per document the lines (_gone) that are aligned with any of its partners."""
    both = (
        pairs.join(lines.select(F.col("_k").alias("_hub"), F.col("_lines").alias("_earlier")), "_hub")
        .join(lines, "_k")
        .select("_k", "_earlier", "_lines")
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = [
                sorted(b for _, b in patience(earlier, later))
                for earlier, later in zip(
                    batch.column("_earlier").to_pylist(), batch.column("_lines").to_pylist(), strict=True
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k"), pa.array(gone, pa.list_(pa.int32()))], names=["_k", "_gone"]
            )

    # At most as many partners as the document has lines.
    return (
        both.mapInArrow(align, "_k long, _gone array<int>")
        .groupBy("_k")
        .agg(F.array_distinct(F.flatten(F.collect_list("_gone"))).alias("_gone"), F.count(F.lit(1)).alias("_partners"))
    )


def remove_aligned(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_partners, kept (the text left)."""
    C.prepare(docs.sparkSession)
    lines = C.stored(lines_of(docs), "lines")
    gone = aligned_lines(lines, partners(lines))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, out in zip(batch.column("_text").to_pylist(), batch.column("_gone").to_pylist(), strict=True):
                whole, drop = text.split("\n"), set(out or ())
                left = [line for at, line in enumerate(whole) if at not in drop] if drop else whole
                counts.append(len(whole))
                removed.append(len(whole) - len(left))
                kept.append("\n".join(left))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_k"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    batch.column("_partners"),
                    pa.array(kept, pa.string()),
                ],
                names=["_k", "n_lines", "n_removed", "n_partners", "kept"],
            )

    done = (
        C.texts(docs)
        .join(gone, "_k", "left")
        .withColumn("_partners", F.coalesce("_partners", F.lit(0).cast("bigint")))
        .mapInArrow(strip, "_k long, n_lines long, n_removed long, n_partners long, kept string")
    )
    return done.select(C.document_id().alias("doc_id"), "n_lines", "n_removed", "n_partners", "kept")
