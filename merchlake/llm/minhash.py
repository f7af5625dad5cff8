"""Near duplicates by b-bit MinHash.

A document is the set of its word shingles; rows are told apart by doc_id and text, so a repeated id
with another text is another document. Each set gets 208 minima. Bands of five full minima name
candidate buckets; of every minimum only four bits are kept, packed sixteen to a long, and the share
of equal bits, corrected for chance collisions, estimates the similarity of candidates. Candidates
that may reach the threshold are confirmed on their full sets, and linked documents form components.

No bucket's pairs are listed in full. Documents with equal sets are one class, a numbered node. In
each bucket every class first meets the class of the smallest doc_id only, and pairs whose estimate
allows it are confirmed. Pairs inside a component need no look. Buckets that still hold several components are
then searched across components, so that no link is lost: block against block, each pair of blocks in
a group of its own, first by signatures for the classes that may have a link left, then these on their
full sets. Blocks are bounded in rows and in shingles. The largest component of a bucket has blocks
of its own, which do not meet each other, so that a group of very many near copies costs what its
strays cost. Only links are handed on, never pairs. The smallest doc_id of all its classes stands for
a component.

Chances of losing a link of similarity 0.8: below 2e-7 in the bands (1 - 0.8^5)^40, and 4e-6 in the
estimate (4.5 standard deviations); both fall fast above 0.8.

Nulls and edge cases: a null or empty text, or one without words, has an empty set, which is linked
with nothing; a text with fewer words than a shingle has one shingle, its whole sequence; a null
doc_id is smaller than every other; rows that repeat a doc_id with another text are linked, kept and
dropped on their own, rows that repeat both are one document; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import words as W

BANDS, BAND_ROWS = 40, 5
BITS, PER_LONG = 4, 16
MINIMA = 208
LONGS = MINIMA // PER_LONG
SIGNATURE = [f"_s{i}" for i in range(LONGS)]
# Classes in a block of a bucket. Each row of a bucket is sent once per block of it, so blocks are as
# large as a task can compare: two of them take some 150 MB.
BLOCK = 1024
# Shingles of all full sets in a block, about: 32 MB.
SET_ENTRIES = 1 << 22
# Standard deviations that an estimate may fall short by before a candidate is dropped.
SLACK = 4.5

_seeds = W.mix(np.arange(1, 2 * MINIMA + 1, dtype=np.uint64))
_FACTORS = (_seeds[:MINIMA] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFTS = (_seeds[MINIMA:] >> np.uint64(32)).astype(np.uint32)


def minima(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """MINIMA minimum hash values of each text's shingles; texts without shingles get zeros."""
    out = np.zeros((len(places) - 1, MINIMA), np.uint32)
    full = np.flatnonzero(np.diff(places) > 0)
    if len(full):
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        starts = places[:-1][full]
        for i in range(MINIMA):
            out[full, i] = np.minimum.reduceat(short * _FACTORS[i] + _SHIFTS[i], starts)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit bucket name per band, from full minima."""
    rows = least[:, : BANDS * BAND_ROWS].reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(W.mix(np.arange(1, BANDS + 1, dtype=np.uint64)), rows.shape[:2])
    for i in range(BAND_ROWS):
        key = W.mix(key + rows[:, :, i])
    return key


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima, sixteen to a 64-bit number."""
    low = (least & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, LONGS, PER_LONG)
    return (low << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def least_matches(threshold: float) -> int:
    """Equal low bits that a pair of at least this similarity has all but surely."""
    p = threshold + (1 - threshold) / (1 << BITS)
    return int(np.floor(MINIMA * p - SLACK * np.sqrt(MINIMA * p * (1 - p))))


def matches(a: str, b: str) -> Column:
    """How many minima agree in their low bits, by bit counts over two packed signatures."""
    total = F.lit(MINIMA)
    ones = F.lit(0x1111111111111111)
    for name in SIGNATURE:
        x = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(ones)
        total = total - F.bit_count(x)
    return total


def similarity(matched: Column) -> Column:
    """The estimate behind a number of matches, corrected for low bits that agree by chance."""
    chance = 1 / (1 << BITS)
    return (matched / MINIMA - chance) / (1 - chance)


def _sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    hashes, _, _, places = W.word_hashes(data, offsets, lower=True)
    found, where = W.shingles(hashes, places, size)
    distinct = []
    for a, b in zip(where, where[1:]):
        ordered = np.sort(found[a:b])
        distinct.append(ordered[np.r_[True, ordered[1:] != ordered[:-1]]] if len(ordered) else ordered)
    return found, where, distinct


def _named_texts(docs: DataFrame) -> DataFrame:
    """``_k``, ``_text`` and a hash of the text (_h), which tells apart rows that repeat an id."""
    return C.texts(docs).withColumn("_h", F.xxhash64("_text"))


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per document: _k, _h (hash of the text), _n (set size), _digest of the set, packed signature,
    _bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in C.text_chunks(batch):
                found, where, distinct = _sets(data, offsets, size)
                least = minima(found, where)
                low, keys = packed(least).view(np.int64), band_keys(least).view(np.int64)
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in distinct]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_k").slice(first, last - first),
                        batch.column("_h").slice(first, last - first),
                        pa.array([len(s) for s in distinct], pa.int64()),
                        pa.array(digests, pa.binary()),
                        *[pa.array(np.ascontiguousarray(low[:, i])) for i in range(LONGS)],
                        lists,
                    ],
                    names=["_k", "_h", "_n", "_digest", *SIGNATURE, "_bands"],
                )

    longs = ", ".join(f"{name} long" for name in SIGNATURE)
    return _named_texts(docs).mapInArrow(
        sign, f"_k long, _h long, _n long, _digest binary, {longs}, _bands array<long>"
    )


def shingle_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The full sets (_set) of the nodes (_c) that the documents _k, _h stand for; a document that
    is repeated gives its set each time."""

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in C.text_chunks(batch):
                _, _, distinct = _sets(data, offsets, size)
                ends = np.cumsum([0, *[len(s) for s in distinct]]).astype(np.int32)
                values = np.concatenate(distinct).view(np.int64) if len(distinct) else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_c").slice(first, last - first),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    ],
                    names=["_c", "_set"],
                )

    wanted = _named_texts(docs).join(nodes, ["_k", "_h"])
    return wanted.mapInArrow(collect, "_c long, _set array<long>")


def _sets_once(docs: DataFrame, signed: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """One full set per node, also where rows repeat both id and text."""
    times = signed.where("_n > 0").groupBy("_k", "_h").agg(F.count(F.lit(1)).alias("_times"))
    repeated = nodes.join(times.where("_times > 1"), ["_k", "_h"], "left_semi").checkpoint()
    if repeated.isEmpty():
        return shingle_sets(docs, nodes, size)
    single = shingle_sets(docs, nodes.join(repeated, "_c", "left_anti"), size)
    # Equal sets fold to one in every task before they move.
    return single.unionByName(shingle_sets(docs, repeated, size).groupBy("_c").agg(F.first("_set").alias("_set")))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (_a, _b) whose full sets reach the threshold."""
    both = pairs.join(sets.select(F.col("_c").alias("_a"), F.col("_set").alias("_sa")), "_a").join(
        sets.select(F.col("_c").alias("_b"), F.col("_set").alias("_sb")), "_b"
    )
    shared = F.size(F.array_intersect("_sa", "_sb")).cast("long")
    union = F.size("_sa") + F.size("_sb") - F.col("_shared")
    return (
        both.withColumn("_shared", shared).where(100 * F.col("_shared") >= percent * union).select("_a", "_b")
    )


def _labelled(nodes: DataFrame, found: DataFrame, key: str, name: str) -> DataFrame:
    """``nodes`` with the component of ``key`` (itself where it has no links)."""
    labels = found.select(F.col("_node").alias(key), F.col("_root").alias(name))
    return nodes.join(labels, key, "left").withColumn(name, F.coalesce(name, key))


def _mixed(placed: DataFrame, room: Column) -> DataFrame:
    """Rows of buckets that hold several components. ``room`` is what a row takes of a block, which
    holds 1. A bucket that fits one block is one (_blocks is 1, _main null); of a larger one the
    largest component (_main) has _main_blocks blocks of its own, and the others have _blocks."""
    several = (
        placed.groupBy("_band")
        .agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"), F.sum(room).alias("_room"))
        .where("_lo < _hi")
        .select("_band", "_room")
        .checkpoint()
    )
    largest = (
        placed.join(several.where("_room > 1"), "_band")
        .groupBy("_band", "_r")
        .agg(F.sum(room).alias("_own"))
        .groupBy("_band")
        .agg(F.max(F.struct("_own", "_r")).alias("_top"))
        .select("_band", "_top.*")
    )
    dealt = several.join(largest, "_band", "left").select(
        "_band",
        F.col("_r").alias("_main"),
        F.ceil(F.col("_room") - F.coalesce("_own", F.lit(0.0))).alias("_blocks"),
        F.ceil(F.coalesce("_own", F.lit(1.0))).alias("_main_blocks"),
    )
    return placed.join(dealt.checkpoint(), "_band")


def _pairs_of_blocks(rows: DataFrame) -> GroupedData:
    """A bucket's rows in blocks, every pair of blocks a group of its own, but for pairs inside the
    largest component: a row of it is sent once per block of the other components only."""
    main, zero = F.col("_r") == F.col("_main"), F.lit(0).cast("bigint")
    at = F.xxhash64("_c")
    block = F.when(main, F.col("_blocks") + F.pmod(at, F.col("_main_blocks"))).otherwise(F.pmod(at, F.col("_blocks")))
    every = F.col("_blocks") + F.when(F.col("_main").isNull(), zero).otherwise(F.col("_main_blocks"))
    meets = F.when(main, F.col("_blocks")).otherwise(every)
    dealt = rows.withColumn("_block", block).withColumn("_other", F.explode(F.sequence(zero, meets - 1)))
    # Few bytes but much work: a fixed number of tasks, which adaptive execution does not merge.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.withColumn("_i", F.least("_block", "_other"))
        .withColumn("_j", F.greatest("_block", "_other"))
        .drop("_other", "_main", "_blocks", "_main_blocks")
        .repartition(parts, "_band", "_i", "_j")
        .groupBy("_band", "_i", "_j")
    )


def _candidates(table: pa.Table, percent: int) -> np.ndarray:
    """Which pairs of rows of a group may be links: different components, sizes and estimates that
    allow it. Pairs within a block are looked at in the block's group with itself."""
    low = np.stack([table.column(name).to_numpy() for name in SIGNATURE], axis=1).view(np.uint64)
    root, size, block = (table.column(c).to_numpy() for c in ("_r", "_n", "_block"))
    unequal = np.zeros((len(low), len(low)), np.int16)
    for i in range(LONGS):
        x = low[:, i, None] ^ low[None, :, i]
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        unequal += np.bitwise_count(x & np.uint64(0x1111111111111111))
    likely = MINIMA - unequal >= least_matches(percent / 100)
    likely &= root[:, None] != root[None, :]
    likely &= 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
    if table.column("_i")[0] != table.column("_j")[0]:
        likely &= block[:, None] != block[None, :]
    return likely


def _open_classes(percent: int) -> Callable[[pa.Table], pa.Table]:
    def find(table: pa.Table) -> pa.Table:
        likely = _candidates(table, percent).any(axis=0)
        return pa.table({"_c": table.column("_c").to_numpy()[likely]})

    return find


def _links_across(percent: int) -> Callable[[pa.Table], pa.Table]:
    def find(table: pa.Table) -> pa.Table:
        nodes, roots = table.column("_c").to_pylist(), table.column("_r").to_pylist()
        sets = [s.values.to_numpy() for s in table.column("_set")]
        parent: dict[int, int] = {}

        def top(root: int) -> int:
            while root in parent:
                root = parent[root]
            return root

        links = []
        for a, b in np.argwhere(np.triu(_candidates(table, percent), 1)).tolist():
            ra, rb = top(roots[a]), top(roots[b])
            # One link joins two components; more of them tell nothing new.
            if ra == rb:
                continue
            shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                parent[ra] = rb
                links.append((nodes[a], nodes[b]))
        return pa.table({"_a": pa.array([a for a, _ in links], pa.int64()), "_b": pa.array([b for _, b in links], pa.int64())})

    return find


def node_components(docs: DataFrame, size: int, percent: int = 80) -> DataFrame:
    """Per document: _k, _h, _n, and the document that stands for its component, _top_k and _top_h
    (null for empty sets)."""
    C.prepare(docs.sparkSession)
    signed = C.stored(signatures(docs, size), "signatures")
    classes = C.stored(
        signed.where("_n > 0")
        .groupBy("_digest")
        .agg(
            F.min(F.struct("_k", "_h")).alias("_least"),
            F.first("_n").alias("_n"),
            *[F.first(name).alias(name) for name in SIGNATURE],
            F.first("_bands").alias("_bands"),
        )
        # Written once, so the numbers stay as they are.
        .select("*", "_least.*", F.monotonically_increasing_id().alias("_c"))
        .drop("_least"),
        "classes",
    )
    banded = classes.select("_c", "_k", F.explode("_bands").alias("_band"))
    # The class of the smallest doc_id is the hub: a document tends to stand before its copies, and
    # these are more like it than like each other.
    buckets = (
        banded.groupBy("_band")
        .agg(F.min_by("_c", "_k").alias("_hub"), F.min("_c").alias("_least"), F.max("_c").alias("_last"))
        .where("_least < _last")
        .select("_band", "_hub")
        .checkpoint()
    )
    members = banded.select("_band", "_c").join(buckets, "_band").checkpoint()
    stars = members.where("_c <> _hub").select(F.col("_c").alias("_a"), F.col("_hub").alias("_b")).distinct()

    marks = classes.select("_c", "_n", *SIGNATURE)
    enough = least_matches(percent / 100)
    sized = (100 * F.least("l._n", "r._n") >= percent * F.greatest("l._n", "r._n")) & (matches("l", "r") >= enough)
    scored = (
        stars.join(marks.alias("l"), F.col("_a") == F.col("l._c"))
        .join(marks.alias("r"), (F.col("_b") == F.col("r._c")) & sized)
        .select("_a", "_b")
    )
    met = classes.select("_c", "_k", "_h").join(members.select("_c").distinct(), "_c", "left_semi")
    sets = C.stored(_sets_once(docs, signed, met, size), "sets")

    # At most one pair per class and band.
    links = confirmed(scored, sets, percent).checkpoint()
    found = C.components(links)

    # Buckets that still hold several components are searched across them.
    placed = _labelled(members.select("_band", "_c"), found, "_c", "_r").checkpoint()
    even = F.lit(1 / BLOCK)
    maybe = _pairs_of_blocks(_mixed(placed, even).join(marks, "_c")).applyInArrow(_open_classes(percent), "_c long")
    undecided = maybe.distinct().join(classes.select("_c", "_n"), "_c").checkpoint()
    some = _mixed(placed.join(undecided, "_c"), F.greatest(even, F.col("_n") / SET_ENTRIES)).drop("_n")
    some = some.join(marks, "_c").join(sets, "_c")
    links = links.unionByName(
        _pairs_of_blocks(some).applyInArrow(_links_across(percent), "_a long, _b long").distinct()
    ).checkpoint()
    # The links are checkpointed, so nothing reads the sets again.
    C.discard(sets)
    return _with_tops(signed, classes, C.components(links).checkpoint())


def _with_tops(signed: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    """Documents with the smallest document of their component."""
    # Roots have no row of their own among the links.
    roots = found.select(F.col("_root").alias("_node"), "_root").distinct()
    linked = found.unionByName(roots).withColumnRenamed("_node", "_c").join(classes.select("_c", "_k", "_h"), "_c")
    # Checkpointed, so that joins can split a component or class that very many rows are in.
    tops = linked.groupBy("_root").agg(F.min(F.struct("_k", "_h")).alias("_top")).checkpoint()
    tops = linked.select("_c", "_root").join(tops, "_root").select("_c", "_top")
    own = F.struct("_k", "_h")
    named = classes.select("_digest", "_c", "_k", "_h").join(tops, "_c", "left")
    named = named.select("_digest", F.coalesce("_top", own).alias("_top")).checkpoint()
    return (
        signed.select("_k", "_h", "_n", "_digest")
        .join(named, "_digest", "left")
        .select("_k", "_h", "_n", F.col("_top._k").alias("_top_k"), F.col("_top._h").alias("_top_h"))
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that links lead
    to), kept."""
    top = F.coalesce("_top_k", "_k")
    return node_components(docs, size, percent).select(
        C.document_id().alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        F.when(top != F.lit(C.NULL_ID), top).alias("component_id"),
        (F.col("_k") == top).alias("kept"),
    )


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that with the smallest doc_id, all columns kept. Rows that
    repeat doc_id and text are one document."""
    is_top = "_top_k IS NULL OR (_k = _top_k AND _h = _top_h)"
    keep = node_components(docs, size, percent).where(is_top).select("_k", "_h").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")).select(
        "_row",
        F.coalesce(F.col("_row.doc_id").cast("bigint"), F.lit(C.NULL_ID)).alias("_k"),
        F.xxhash64(F.coalesce(F.col("_row.text").cast("string"), F.lit(""))).alias("_h"),
    )
    once = Window.partitionBy("_k", "_h").orderBy("_k")
    return (
        rows.join(keep, ["_k", "_h"], "left_semi")
        .withColumn("_copy", F.row_number().over(once))
        .where("_copy = 1")
        .select("_row.*")
    )
