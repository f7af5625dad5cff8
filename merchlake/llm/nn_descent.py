"""Approximate nearest neighbours by inner product: NN-descent builds a graph, greedy search uses it.

Equal vectors are one node. Every node starts with the best of its neighbours in several orders of
all nodes by random hyperplanes, cut into chunks of consecutive nodes; an order has no hot bucket,
however alike many vectors are. Each round of the descent is a chain of joins: a node's neighbours
and those that name it meet at that node, so that neighbours of neighbours are compared; what beats
a node's worst neighbour is sent to it and merged. A pair of neighbours that met in an earlier round
is not compared again. Rounds end when few lists still change. The graph is built on components
rounded to 8 bits, of which a vector travels once to each block of nodes that needs it. As long as a
block may hold all vectors there are at most ``TASKS`` of them, so that what travels grows with the
input; beyond, blocks are as large as what they may hold allows, and a vector goes to at most as many
blocks as there are nodes at which it meets others.

A query is a node of the graph. It starts with its own neighbours, and as long as one of its
``WIDTH`` best nodes is not expanded, that node's neighbours are scored, in double precision on the
original vectors, and kept if among the ``BEAM`` best.

Whatever is held together is bounded by parameters: ``CHUNK`` nodes, and about ``HELD`` bytes of vectors
for a block of nodes or queries. Reverse neighbours beyond ``REVERSE`` and candidates beyond ``OFFERS`` for
one node in a block are not followed in that round, nor is a candidate whose name of 15 bits is that of
a neighbour; the index is approximate by these parameters, and its recall is measured.

Nulls and edge cases: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do rows without vec_id; of rows that repeat a vec_id one takes part, that whose vector
has the smallest digest; a vector with fewer components than others counts as padded with zeros;
equal scores go by vec_id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import words as W

TOP = 20
NEIGHBOURS = 56
REVERSE = 64
OFFERS = 24
ORDERS, CHUNK, PLANES = 8, 512, 24
# Blocks of nodes or queries while one can hold all vectors, vectors that make a block worth a task, and
# bytes of vectors that a block holds (twice that, and once more in batches, while it is filled).
TASKS, FEWEST, HELD = 8, 2048, 1 << 27
# Offers in one row, and nodes whose offers are merged together.
BUNDLE, BUCKET = 8192, 2048
# The descent ends when fewer of all list entries than this are new.
CHANGED = 0.03
BEAM, WIDTH = 80, 40
_SEED = 20240229


def matrix(column: pa.Array) -> np.ndarray:
    """A list column as rows of a matrix, shorter ones padded with zeros."""
    sizes = column.value_lengths().to_numpy()
    values = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _lists(owner: np.ndarray, rows: int, *values: np.ndarray) -> list[pa.Array]:
    """List columns from values sorted by owner."""
    ends = pa.array(np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(ends, pa.array(v)) for v in values]


def members(rows: DataFrame, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Every vec_id that takes part (_id) with its node (_v), the smallest vec_id of equal vectors; and
    the nodes with their vectors (_v, _vec)."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    valid = rows.where(F.col("vec_id").isNotNull() & whole & F.exists(vector, lambda x: x != 0)).select(
        F.col("vec_id").cast("bigint").alias("_id"),
        F.unhex(F.substring(F.sha2(F.array_join(F.col(vector).cast("array<string>"), " "), 256), 1, 32)).alias("_d"),
        F.col(vector).alias("_vec"),
    )
    once = valid.groupBy("_id").agg(F.min("_d").alias("_d"))
    # Checkpointed, so that the join can split a vector that very many rows hold.
    nodes = once.groupBy("_d").agg(F.min("_id").alias("_v")).checkpoint()
    named = C.stored(once.join(nodes, "_d").select("_id", "_v"), "members")
    own = valid.join(nodes.withColumnRenamed("_v", "_id"), ["_id", "_d"]).dropDuplicates(["_id"])
    return named, own.select(F.col("_id").alias("_v"), "_vec")


def rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components as 8-bit numbers, and the scale of each row."""
    scale = np.abs(vectors).max(axis=1, initial=0).astype(np.float32) / 127
    return np.rint(vectors / np.maximum(scale, np.float32(1e-30))[:, None]).astype(np.int8), scale


def node_table(own: DataFrame) -> DataFrame:
    """Nodes with their vectors, original (_vec) and rounded (_q, _scale)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, scale = rounded(matrix(batch.column("_vec")).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([row.tobytes() for row in q], pa.binary()), pa.array(scale)],
                names=["_v", "_vec", "_q", "_scale"],
            )

    kind = dict(own.dtypes)["_vec"]
    return C.stored(own.mapInArrow(add, f"_v long, _vec {kind}, _q binary, _scale float"), "nodes")


def bytes_matrix(values: list[bytes]) -> np.ndarray:
    """Rounded vectors as rows. In single precision their inner products are exact up to 1,000
    components and near enough beyond."""
    width = max(map(len, values), default=0)
    if all(len(v) == width for v in values):
        return np.frombuffer(b"".join(values), np.int8).reshape(len(values), width)
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.int8).reshape(-1, width)


_NEAR = "_v long, _w array<long>, _s array<float>, _new array<boolean>"
_NAMES = ["_bucket", "_v", "_w", "_s", "_new"]
_OFFERED = "_bucket int, _v array<long>, _w array<long>, _s array<float>, _new array<boolean>"


def bundled(v: np.ndarray, w: np.ndarray, s: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Offers of a neighbour w to a node v as few rows: offers to nodes of one bucket travel together."""
    bucket = (W.mix(v.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket, v, w, s = bucket[order], v[order], w[order], s[order]
    place = np.arange(len(v)) - np.searchsorted(bucket, bucket)
    starts = np.flatnonzero(place % BUNDLE == 0)
    ends = pa.array(np.r_[starts, len(v)].astype(np.int32))
    columns = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (v, w, s.astype(np.float32), np.ones(len(v), bool))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), *columns], names=_NAMES)


def first_offers(nodes: DataFrame, count: int, buckets: int, orders: int = ORDERS, chunk: int = CHUNK) -> DataFrame:
    """The best neighbours of every node among those next to it in each order."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = bytes_matrix(batch.column("_q").to_pylist())
            for order in range(orders):
                planes = np.random.default_rng(_SEED + order).standard_normal((vectors.shape[1], PLANES + 1))
                sides = vectors @ planes
                code = (sides[:, :PLANES] > 0) @ (1 << np.arange(PLANES)[::-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(code), order, np.int32)), pa.array(code.astype(np.int64)),
                        pa.array(sides[:, PLANES]), *[batch.column(c) for c in ("_v", "_q", "_scale")],
                    ],
                    names=["_order", "_code", "_side", "_v", "_q", "_scale"],
                )

    def best(table: pa.Table) -> pa.RecordBatch:
        ids = table.column("_v").to_numpy()
        vectors, scale = bytes_matrix(table.column("_q").to_pylist()).astype(np.float32), table.column("_scale").to_numpy()
        scores = (vectors @ vectors.T) * (scale[:, None] * scale)
        np.fill_diagonal(scores, -np.inf)
        most = min(NEIGHBOURS // 2, len(ids) - 1)
        pick = np.argpartition(-scores, most - 1, axis=1)[:, :most] if most else np.empty((len(ids), 0), np.int64)
        near = np.take_along_axis(scores, pick, 1)
        return bundled(np.repeat(ids, most), ids[pick].ravel(), near.ravel(), buckets)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            start = 0
            marks = batch.column("_order").to_numpy()
            for cut in [*(np.flatnonzero(np.diff(marks)) + 1), batch.num_rows]:
                part = batch.slice(start, cut - start)
                start = cut
                if held and part.num_rows and held[0].column("_order")[0] != part.column("_order")[0]:
                    yield best(pa.Table.from_batches(held))
                    held = []
                if part.num_rows:
                    held.append(part)
                # What is left over joins the last chunk rather than standing alone.
                while sum(b.num_rows for b in held) >= 2 * chunk:
                    table = pa.Table.from_batches(held)
                    yield best(table.slice(0, chunk))
                    held = table.slice(chunk).to_batches()
        if held:
            yield best(pa.Table.from_batches(held))

    parts = max(1, math.ceil(count * orders / (8 * chunk)))
    spread = nodes.select("_v", "_q", "_scale").mapInArrow(
        placed, "_order int, _code long, _side double, _v long, _q binary, _scale float"
    )
    return (
        spread.repartitionByRange(parts, "_order", "_code", "_side")
        .sortWithinPartitions("_order", "_code", "_side")
        .mapInArrow(chunks, _OFFERED)
    )


def merged(offers: DataFrame, buckets: int, most: int = NEIGHBOURS) -> DataFrame:
    """One row per node: its bucket and its ``most`` best neighbours, best first. Of a neighbour that
    is offered several times the oldest entry stays."""

    def merge(bucket: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        v, w, s, new = (
            np.concatenate([b.column(c).flatten().to_numpy(zero_copy_only=False) for b in held]) for c in _NAMES[1:]
        )
        order = np.lexsort((new, w, v))
        v, w, s, new = v[order], w[order], s[order], new[order]
        once = np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])] if len(v) else np.empty(0, bool)
        v, w, s, new = v[once], w[once], s[once], new[once]
        order = np.lexsort((w, -s, v))
        v, w, s, new = v[order], w[order], s[order], new[order]
        keep = np.arange(len(v)) - np.searchsorted(v, v) < most
        ids, owner = np.unique(v[keep], return_inverse=True)
        lists = _lists(owner, len(ids), w[keep], s[keep], new[keep])
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), bucket, np.int32)), pa.array(ids), *lists], names=_NAMES)

    def merge_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            marks = batch.column("_bucket").to_numpy()
            cuts = np.flatnonzero(np.diff(marks)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                if held and now != marks[a]:
                    yield merge(now, held)
                    held = []
                now = int(marks[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield merge(now, held)

    order = offers.repartition(buckets, "_bucket").sortWithinPartitions("_bucket")
    return order.mapInArrow(merge_all, f"_bucket int, {_NEAR}")


def block_count(rows: int, asks: int, vectors: int, size: int) -> int:
    """Blocks for ``rows`` of which each asks for at most ``asks`` of ``vectors`` of ``size`` bytes. Rows
    of one block share vectors, so there are few blocks, until these would hold more than ``HELD``."""
    blocks, held = max(1, min(TASKS, math.ceil(vectors / FEWEST))), max(1, HELD // size)
    if vectors > held:
        # As many rows as ask for that many different vectors, if they ask at random.
        blocks = max(blocks, math.ceil(rows * asks / (-math.log1p(-held / vectors) * vectors)))
    return blocks


def _shape(nodes: DataFrame) -> tuple[int, int]:
    """How many vectors there are, and the components of the longest."""
    row = nodes.agg(F.count(F.lit(1)).alias("count"), F.max(F.size("_vec")).alias("width")).first()
    return row["count"], row["width"] or 0


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("_block")


def _name(key: str | Column) -> Column:
    return F.xxhash64(key).bitwiseAND(F.lit(0x7FFF)).cast("smallint")


def meetings(graph: DataFrame) -> DataFrame:
    """Every node with those that meet there: _w and whether the edge is new (_new). These are its
    neighbours, the ``REVERSE`` nearest of those that name it, and itself."""
    named = graph.select(F.col("_v").alias("_w"), F.explode(F.arrays_zip("_w", "_s", "_new")).alias("_e"))
    named = named.select(F.col("_e._w").alias("_v"), "_w", F.col("_e._s").alias("_s"), F.col("_e._new").alias("_new"))
    nearest = Window.partitionBy("_v").orderBy(F.desc("_s"), "_w")
    back = (
        named.withColumn("_rank", F.row_number().over(nearest))
        .where(F.col("_rank") <= REVERSE)
        .groupBy("_v")
        .agg(F.collect_list("_w").alias("_back"), F.collect_list("_new").alias("_back_new"))
    )

    def joined(own: str, more: str, first: Column) -> Column:
        return F.concat(F.array(first), F.col(own), F.coalesce(more, F.array().cast(dict(graph.dtypes)[own]))).alias(own)

    return graph.join(back, "_v", "left").select(
        "_v", joined("_w", "_back", F.col("_v")), joined("_new", "_back_new", F.lit(False))
    )


def compared(graph: DataFrame, met: DataFrame, nodes: DataFrame, blocks: int, buckets: int) -> DataFrame:
    """Offers from one round: all that meet at a node are compared, but for pairs that met before."""
    asked = met.select("_block", F.explode("_w").alias("_v")).distinct()
    worst = graph.select(
        "_v", _name("_v").alias("_name"), F.transform("_w", _name).alias("_near"),
        F.when(F.size("_s") == NEIGHBOURS, F.element_at("_s", -1)).alias("_worst"),
    )
    vectors = asked.join(nodes.select("_v", "_q", "_scale").join(worst, "_v"), "_v")
    none = F.lit(None)
    together = vectors.select(
        "_block", F.lit(0).alias("_kind"), "_v", "_q", "_scale", F.coalesce("_worst", F.lit(float("-inf"))).cast("float").alias("_worst"),
        "_name", "_near", none.cast("array<long>").alias("_w"), none.cast("array<boolean>").alias("_new"),
    ).unionByName(
        met.select(
            "_block", F.lit(1).alias("_kind"), "_v", none.cast("binary").alias("_q"), none.cast("float").alias("_scale"),
            none.cast("float").alias("_worst"), none.cast("smallint").alias("_name"), none.cast("array<smallint>").alias("_near"),
            "_w", "_new",
        )
    )

    def compare(known: "_Vectors", batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        sizes = batch.column("_w").value_lengths().to_numpy()
        wide = np.arange(sizes.max()) < sizes[:, None]
        at = np.zeros(wide.shape, np.int64)
        at[wide] = known.find(batch.column("_w").flatten().to_numpy())
        new = np.zeros(wide.shape, bool)
        new[wide] = batch.column("_new").flatten().to_numpy(zero_copy_only=False)
        vectors, scale = known.q[at].astype(np.float32), known.scale[at]
        scores = np.matmul(vectors, vectors.transpose(0, 2, 1)) * (scale[:, :, None] * scale[:, None, :])
        fit = wide[:, :, None] & wide[:, None, :] & (new[:, :, None] | new[:, None, :]) & (at[:, :, None] != at[:, None, :])
        row, place, other = np.nonzero(fit & (scores > known.worst[at][:, :, None]))
        v, w, s = at[row, place], at[row, other], scores[row, place, other]
        fresh = ~known.pairs(v, w)
        return v[fresh], w[fresh], s[fresh]

    def finish(known: "_Vectors", found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        v, w, s = (np.concatenate([f[i] for f in found]) for i in range(3))
        order = np.lexsort((w, -s, v))
        v, w, s = v[order], w[order], s[order]
        # Equal pairs have equal scores, so they stand together.
        once = np.r_[True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])] if len(v) else np.empty(0, bool)
        v, w, s = v[once], w[once], s[once]
        keep = np.arange(len(v)) - np.searchsorted(v, v) < OFFERS
        v, w, s = v[keep], w[keep], s[keep]
        return bundled(known.ids[v], known.ids[w], s, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, parts in _per_block(batches, _Vectors):
            # What no longer is among a node's best offers leaves between the batches.
            found: list[tuple[np.ndarray, ...]] = []
            for part in parts:
                for first in range(0, part.num_rows, 128):
                    found.append(compare(known, part.slice(first, 128)))
                if sum(len(f[0]) for f in found) > 1 << 21:
                    yield finish(known, found)
                    found = []
            if found:
                yield finish(known, found)

    order = together.repartitionById(blocks, F.col("_block")).sortWithinPartitions("_block", "_kind", "_v")
    offers = order.mapInArrow(run, _OFFERED)
    old = graph.select(
        "_bucket", F.transform("_w", lambda _: F.col("_v")).alias("_v"), "_w", "_s",
        F.transform("_new", lambda _: F.lit(False)).alias("_new"),
    )
    return offers.unionByName(old)


class _Vectors:
    """The rounded vectors of a block, by node, and the names of the neighbours that these have."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.ids = np.concatenate([b.column("_v").to_numpy() for b in batches])
        parts = [bytes_matrix(b.column("_q").to_pylist()) for b in batches]
        width = max(p.shape[1] for p in parts)
        self.q = np.zeros((len(self.ids), width), np.int8)
        self.name, self.scale, self.worst = (
            np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("_name", "_scale", "_worst")
        )
        # No node is named -1.
        self.near = np.full((len(self.ids), NEIGHBOURS), -1, np.int16)
        at = 0
        for batch, part in zip(batches, parts, strict=True):
            end = at + batch.num_rows
            self.q[at:end, : part.shape[1]] = part
            lists = batch.column("_near")
            here = np.arange(NEIGHBOURS) < lists.value_lengths().to_numpy()[:, None]
            self.near[at:end][here] = lists.flatten().to_numpy()
            at = end

    def find(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)

    def pairs(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Which pairs are neighbours already, by name."""
        out = np.empty(len(v), bool)
        for first in range(0, len(v), 1 << 16):
            cut = slice(first, first + (1 << 16))
            out[cut] = (self.near[v[cut]] == self.name[w[cut], None]).any(axis=1)
        return out


class _Originals:
    """The original vectors of a block, by node."""

    def __init__(self, batches: list[pa.RecordBatch]):
        self.ids = np.concatenate([b.column("_v").to_numpy() for b in batches])
        parts = [matrix(b.column("_vec")) for b in batches]
        width = max(p.shape[1] for p in parts)
        self.vectors = np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])

    def find(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)


def _per_block(batches: Iterator[pa.RecordBatch], collect: type) -> Iterator[tuple]:
    """Blocks of rows sorted by _block and _kind: what ``collect`` makes of the vectors (_kind 0),
    and the other rows batch by batch."""

    def parts() -> Iterator[tuple[int, int, pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            block, kind = batch.column("_block").to_numpy(), batch.column("_kind").to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                yield int(block[a]), int(kind[a]), batch.slice(a, b - a)

    rows = parts()
    here = next(rows, None)
    while here is not None:
        block, held = here[0], []
        while here is not None and here[:2] == (block, 0):
            held.append(here[2])
            here = next(rows, None)
        known, held = collect(held), []

        def rest() -> Iterator[pa.RecordBatch]:
            nonlocal here
            while here is not None and here[0] == block:
                yield here[2]
                here = next(rows, None)

        yield known, rest()


def build(nodes: DataFrame, changed: float = CHANGED) -> DataFrame:
    """The neighbour graph: _v, its neighbours best first (_w) and their rounded scores (_s)."""
    count, width = _shape(nodes)
    # A rounded vector stands with its neighbours' names, its own, its number, scale and worst score.
    blocks = block_count(count, 1 + NEIGHBOURS + REVERSE, count, width + 2 * NEIGHBOURS + 18)
    buckets = max(1, math.ceil(count / BUCKET))
    graph = C.stored(merged(first_offers(nodes, count, buckets), buckets), "graph")
    while True:
        met = C.stored(meetings(graph).withColumn("_block", _block("_v", blocks)), "met")
        before = graph
        graph = C.stored(merged(compared(graph, met, nodes, blocks, buckets), buckets), "graph")
        C.discard(before)
        C.discard(met)
        moved = graph.agg(F.sum(F.size(F.filter("_new", lambda n: n))).alias("new"), F.sum(F.size("_w")).alias("all")).first()
        if not moved["new"] or moved["new"] < changed * moved["all"]:
            return graph


def descend(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """Greedy search from every query node (_v): the ``BEAM`` best nodes found (_w) and their scores
    (_s), best first, the query's own node among them."""
    kind = dict(nodes.dtypes)["_vec"]
    count, width = _shape(nodes)
    blocks = block_count(queries.count(), 1 + WIDTH * NEIGHBOURS, count, 8 + width * (8 if "double" in kind else 4))
    state = C.stored(
        queries.join(nodes.select("_v", "_vec"), "_v").select(
            "_v", "_vec", _block("_v", blocks), F.array("_v").alias("_w"), F.array(F.lit(float("inf"))).alias("_s"),
            F.array(F.lit(False)).alias("_done"),
        ),
        "search",
    )
    schema = f"_v long, _vec {kind}, _block int, _w array<long>, _s array<double>, _done array<boolean>"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for known, parts in _per_block(batches, _Originals):
            for part in parts:
                sizes = part.column("_ask").value_lengths().to_numpy()
                asked = known.find(part.column("_ask").flatten().to_numpy())
                own = known.find(part.column("_v").to_numpy())
                row = np.repeat(np.arange(part.num_rows), sizes)
                scores = np.empty(len(asked))
                for first in range(0, len(asked), 1 << 14):
                    cut = slice(first, first + (1 << 14))
                    mine, other = (known.vectors[at].astype(np.float64) for at in (own[row[cut]], asked[cut]))
                    scores[cut] = (other * mine).sum(axis=1)
                old = part.column("_w").value_lengths().to_numpy()
                row = np.r_[np.repeat(np.arange(part.num_rows), old), row]
                w = np.r_[part.column("_w").flatten().to_numpy(), known.ids[asked]]
                s = np.r_[part.column("_s").flatten().to_numpy(), scores]
                # All but the nodes just asked for were expanded before this round or are now.
                done = np.r_[part.column("_done").flatten().to_numpy(zero_copy_only=False), np.zeros(len(asked), bool)]
                order = np.lexsort((~done, w, row))
                row, w, s, done = row[order], w[order], s[order], done[order]
                last = np.r_[(row[1:] != row[:-1]) | (w[1:] != w[:-1]), True] if len(row) else np.empty(0, bool)
                first = np.r_[True, last[:-1]] if len(row) else last
                # A node's score is the one just computed where it was asked for, else the old one.
                row, w, s, done = row[first], w[first], s[last], done[first]
                order = np.lexsort((w, -s, row))
                row, w, s, done = row[order], w[order], s[order], done[order]
                keep = np.arange(len(row)) - np.searchsorted(row, row) < BEAM
                lists = _lists(row[keep], part.num_rows, w[keep], s[keep], done[keep])
                yield pa.RecordBatch.from_arrays(
                    [part.column("_v"), part.column("_vec"), part.column("_block"), *lists],
                    names=["_v", "_vec", "_block", "_w", "_s", "_done"],
                )

    finished = []
    while True:
        best = F.slice(F.arrays_zip("_w", "_done"), 1, WIDTH)
        opened = state.withColumn("_open", F.transform(F.filter(best, lambda x: ~x["_done"]), lambda x: x["_w"]))
        finished.append(opened.where(F.size("_open") == 0).select("_v", "_w", "_s"))
        opened = C.stored(opened.where(F.size("_open") > 0), "open")
        if opened.isEmpty():
            break
        asks = (
            opened.select("_block", F.col("_v").alias("_q"), F.explode("_open").alias("_v"))
            .join(graph.select("_v", F.col("_w").alias("_next")), "_v")
            .groupBy("_block", "_q")
            .agg(F.flatten(F.collect_list("_next")).alias("_next"))
            # A query's own node is scored like any other.
            .select("_block", F.col("_q").alias("_v"), F.array_distinct(F.concat("_next", F.array("_q"))).alias("_ask"))
        )
        asks = C.stored(asks, "asks")
        needed = asks.select("_block", F.explode("_ask").alias("_v")).distinct()
        none = F.lit(None)
        done = F.zip_with("_w", "_done", lambda w, d: d | F.array_contains("_open", w))
        together = (
            needed.join(nodes.select("_v", "_vec"), "_v")
            .select(
                "_block", F.lit(0).alias("_kind"), "_v", "_vec", none.cast("array<long>").alias("_ask"),
                none.cast("array<long>").alias("_w"), none.cast("array<double>").alias("_s"),
                none.cast("array<boolean>").alias("_done"),
            )
            .unionByName(
                opened.withColumn("_done", done)
                .join(asks.select("_v", "_ask"), "_v")
                .select("_block", F.lit(1).alias("_kind"), "_v", "_vec", "_ask", "_w", "_s", "_done")
            )
        )
        order = together.repartitionById(blocks, F.col("_block")).sortWithinPartitions("_block", "_kind", "_v")
        state = C.stored(order.mapInArrow(score, schema), "search")
    found = finished[0]
    for more in finished[1:]:
        found = found.unionByName(more)
    return found


def nearest(rows: DataFrame, every: int = 20, top: int = TOP, vector: str = "embedding") -> DataFrame:
    """The ``top`` nearest rows found of every row whose vec_id is divisible by ``every``: query_id,
    rank, vec_id, score."""
    C.prepare(rows.sparkSession)
    named, own = members(rows, vector)
    nodes = node_table(own)
    queries = named.where(F.col("_id") % every == 0)
    found = descend(queries.select("_v").distinct(), build(nodes), nodes)
    # The smallest numbers of each node suffice: one more than asked for, as a query drops its own.
    smallest = Window.partitionBy("_v").orderBy("_id")
    few = named.select("_v", "_id").withColumn("_nth", F.row_number().over(smallest)).where(F.col("_nth") <= top + 1)
    by_score = Window.partitionBy("_v").orderBy(F.desc("_score"), "_id")
    answers = (
        found.select("_v", F.explode(F.arrays_zip("_w", "_s")).alias("_e"))
        .select("_v", F.col("_e._w").alias("_w"), F.col("_e._s").alias("_score"))
        .join(few.select(F.col("_v").alias("_w"), "_id"), "_w")
        .withColumn("_nth", F.row_number().over(by_score))
        .where(F.col("_nth") <= top + 1)
        .groupBy("_v")
        # At most top + 1 rows.
        .agg(F.sort_array(F.collect_list(F.struct("_nth", "_id", "_score"))).alias("_all"))
    )
    others = F.slice(F.filter("_all", lambda x: x["_id"] != F.col("_id")), 1, top)
    return (
        queries.select("_v", "_id")
        .join(C.stored(answers, "answers"), "_v")
        .select(F.col("_id").alias("query_id"), F.posexplode(others).alias("_at", "_e"))
        .select(
            "query_id", (F.col("_at") + 1).alias("rank"), F.col("_e._id").alias("vec_id"), F.col("_e._score").alias("score")
        )
    )
