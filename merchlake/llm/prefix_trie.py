"""The prefix trie of rebuilt conversations, by burst tries.

A turn is known by a digest of role and text, a conversation by the sequence of its turns' digests.
Equal sequences fold to one row per 4096 conversation numbers, so a group of copies that a third of
all conversations belong to spreads over all tasks. Sequences lie in containers under the trie's
heads, first one container per first turn. A container of more than ``CAPACITY`` turns bursts: the
smallest and the largest of its sequences tell how far all of them agree, that stretch becomes a
chain of nodes at a new head, and the turn after it chooses the new container. What bursts has
different sequences and splits at their first difference, so this ends. The containers that are
left are sorted and swept, each in one pass, into nodes with their counts; the heads add up what
lies under them, deepest first.

A sweep holds the nodes of one container: at most ``CAPACITY``, or those of one sequence. Conversation
numbers under a node are hashed in order as they stream by, never held.

Nulls and edge cases: a null role or text is empty; a null turn comes first; turns with equal
numbers are ordered by digest; rows without conv_id belong to no conversation; repeated rows are
turns of their own; an empty table gives no node, not even a root. A conversation's digests, 16
bytes a turn, are one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm import common as C

CAPACITY = 1 << 13
# Every ``FAMILY``th conversation lends its first turns, up to ``HEADS`` - 1, to those that follow it.
FAMILY, HEADS = 20, 4
# Conversation numbers that agree above these bits are written as one piece of text.
PIECE_BITS = 12
NOTHING = hashlib.sha256(b"").hexdigest()
# The words that count are runs of characters other than space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"


def digest(text: Column) -> Column:
    """The first half of SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def sequences(rows: DataFrame) -> DataFrame:
    """Every conversation as it stands: _c, and per turn its digest (_ids) and its words (_words)."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("_c"),
        F.struct(
            F.col("turn").alias("turn"),
            # The length parts role and text.
            digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        ).alias("_turn"),
    )
    listed = turns.groupBy("_c").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    return listed.select("_c", F.col("_turns.id").alias("_ids"), F.col("_turns.words").alias("_words"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of their family's first one."""
    taken = (F.crc32(F.col("_c").cast("string")) % HEADS).cast("int")
    lent = own.where(F.col("_c") % FAMILY == 0).select(
        F.col("_c").alias("_base"), *[F.slice(c, 1, HEADS - 1).alias(f"{c}_lent") for c in ("_ids", "_words")]
    )
    joined = own.withColumn("_base", F.col("_c") - F.col("_c") % FAMILY).join(lent, "_base", "left")

    def turns(name: str) -> Column:
        none = F.array().cast(dict(own.dtypes)[name])
        rest = F.when(F.size(name) > taken, F.slice(name, taken + 1, F.size(name))).otherwise(none)
        return F.concat(F.slice(F.coalesce(f"{name}_lent", none), F.lit(1), taken), rest).alias(name)

    return joined.select("_c", turns("_ids"), turns("_words"))


def folded(convs: DataFrame) -> DataFrame:
    """Distinct sequences, a row per piece of numbers: _ids, _words, _piece, and of the conversations
    how many (_n), the smallest (_least) and all in order as text (_ends)."""
    return (
        convs.withColumn("_piece", F.shiftright("_c", PIECE_BITS))
        .groupBy("_ids", "_words", "_piece")
        # At most 2^PIECE_BITS numbers.
        .agg(F.sort_array(F.collect_list("_c")).alias("_all"))
        .select(
            "_ids",
            "_words",
            "_piece",
            F.size("_all").cast("bigint").alias("_n"),
            F.col("_all")[0].alias("_least"),
            F.array_join(F.col("_all").cast("array<string>"), ",").alias("_ends"),
        )
    )


def _prefix(depth: Column) -> Column:
    """A container's key: the digest of the turns that all its sequences begin with."""
    return digest(F.array_join(F.transform(F.slice("_ids", F.lit(1), depth), F.hex), ""))


def burst(rows: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, list[DataFrame]]:
    """The sequences in containers that need not burst (_box, its _depth, _head above it; where _tail
    holds, a sequence that ends at the head itself), and per round the containers that burst: _box,
    _depth, _head, _reach (the depth down to which all agree) and the _words on that way."""

    def boxed(table: DataFrame, head: Column, reach: Column) -> DataFrame:
        tail = F.size("_ids") == reach
        depth = F.when(tail, reach).otherwise(reach + 1)
        return table.select(
            *rows.columns, head.alias("_head"), depth.alias("_depth"), tail.alias("_tail"), _prefix(depth).alias("_box")
        )

    left = C.stored(boxed(rows, digest(F.lit("")), F.lit(0)), "boxes")
    closed, rounds = [], []
    turns = F.sum(F.size("_ids") - F.col("_depth") + 1)
    while True:
        full = left.where(~F.col("_tail")).groupBy("_box").agg(turns.alias("_turns")).where(F.col("_turns") > capacity)
        full = C.stored(full.select("_box"), "full")
        if full.isEmpty():
            return reduce(DataFrame.unionByName, [*closed, left]), rounds
        ends = (
            left.where(~F.col("_tail"))
            .join(full, "_box")
            .groupBy("_box", "_depth", "_head")
            .agg(F.min(F.struct("_ids", "_words")).alias("_low"), F.max("_ids").alias("_high"))
            # A container of one sequence stays, however long or frequent that is.
            .where(F.col("_low._ids") != F.col("_high"))
        )
        agree = F.zip_with("_low._ids", "_high", lambda a, b: a.eqNullSafe(b))
        reach = F.array_position(agree, False).cast("int") - 1
        bursting = C.stored(
            ends.withColumn("_reach", reach).select(
                "_box", "_depth", "_head", "_reach", F.slice("_low._words", F.lit(1), F.col("_reach")).alias("_words")
            ),
            "bursting",
        )
        if bursting.isEmpty():
            return reduce(DataFrame.unionByName, [*closed, left]), rounds
        rounds.append(bursting)
        which = bursting.select("_box", "_reach")
        stays = left.join(which.select("_box", F.lit(False).alias("_tail")), ["_box", "_tail"], "left_anti")
        closed.append(stays.select(left.columns))
        goes = left.where(~F.col("_tail")).join(which, "_box")
        left = C.stored(boxed(goes, F.col("_box"), F.col("_reach")), "boxes")


class _Node:
    __slots__ = ("children", "convs", "depth", "ends", "least", "leaves", "saved", "words")

    def __init__(self, depth: int, words: int):
        self.depth, self.words = depth, words
        self.convs = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = None

    def count(self, convs: int, least: int) -> None:
        self.convs += convs
        self.least = least if self.least is None else min(self.least, least)


class _Sweep:
    """Nodes of one container from its sorted sequences."""

    def __init__(self, box: tuple):
        self.box = box
        self.path: list[_Node] = []
        self.ids: list[bytes] = []
        # conv_id, depth, n_convs, n_children, n_leaves, saved_tokens, ends, place of the parent.
        self.rows: list[list] = []
        self.waiting: list[list[int]] = []

    def add(self, ids: list[bytes], words: list[int], convs: int, least: int, ends: str) -> None:
        top = self.box[1]
        same = top
        while self.path and same < min(len(ids), len(self.ids)) and ids[same] == self.ids[same]:
            same += 1
        self.close(same)
        first = top + len(self.path)
        for depth in range(first, len(ids) + 1):
            self.path.append(_Node(depth, words[depth - 1] if depth else 0))
            self.waiting.append([])
        self.ids = ids
        node = self.path[-1]
        node.count(convs, least)
        if node.ends is None:
            node.ends = hashlib.sha256(ends.encode())
        else:
            node.ends.update(b"," + ends.encode())

    def close(self, depth: int) -> None:
        """Finish the nodes deeper than ``depth``."""
        while self.path and self.path[-1].depth > depth:
            node, below = self.path.pop(), self.waiting.pop()
            node.leaves += not node.children
            node.saved += (node.convs - 1) * node.words
            for place in below:
                self.rows[place][-1] = node.least
            ends = node.ends.hexdigest() if node.ends else NOTHING
            self.rows.append(
                [node.least, node.depth, node.convs, node.children, node.leaves, node.saved, ends, None]
            )
            if self.path:
                above = self.path[-1]
                above.count(node.convs, node.least)
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
                self.waiting[-1].append(len(self.rows) - 1)


_NODE = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, parent_conv_id long"
_SWEPT = f"{_NODE}, _box binary, _head binary, _tail boolean"


def swept(boxes: DataFrame) -> DataFrame:
    """The nodes of all containers. The top node of a container (_box not null) does not know its
    parent; neither does a _tail, which stands for the sequences that end at a head."""
    kinds = [pa.int64()] * 6 + [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
    names = [part.split()[0] for part in _SWEPT.split(", ")]

    def finished(sweep: _Sweep) -> list[tuple]:
        sweep.close(-1)
        box, _, head, tail = sweep.box
        # The top node closes last.
        return [(*row, None, None, None) for row in sweep.rows[:-1]] + [(*sweep.rows[-1], box, head, tail)]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], names=names)

    def sweep_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for box, depth, head, tail, ids, words, convs, least, ends in zip(*columns, strict=True):
                key = (box, depth, head, tail)
                if now is None or now.box != key:
                    if now is not None:
                        out += finished(now)
                    now = _Sweep(key)
                    if len(out) > 4096:
                        yield packed(out)
                        out = []
                now.add(ids, words, convs, least, ends)
        if now is not None:
            out += finished(now)
        yield packed(out)

    order = boxes.repartition("_box").sortWithinPartitions("_box", "_tail", "_ids", "_piece")
    return order.select("_box", "_depth", "_head", "_tail", "_ids", "_words", "_n", "_least", "_ends").mapInArrow(
        sweep_all, _SWEPT
    )


def _chain(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes of heads (_box, _depth, _reach, _words, _head) from the top nodes and tails below."""
    child = ~F.col("_tail")
    sums = tops.groupBy(F.col("_head").alias("_box")).agg(
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.sum(F.when(child, 1).otherwise(0)).alias("_children"),
        F.sum(F.when(child, F.col("n_leaves"))).alias("_leaves"),
        F.sum(F.when(child, F.col("saved_tokens")).otherwise(0)).alias("_saved"),
        F.max(F.when(~child, F.col("ends_sha256"))).alias("_ends"),
    )
    each = heads.join(sums, "_box").withColumn("depth", F.explode(F.sequence("_depth", "_reach")))
    own = F.expr("aggregate(slice(_words, greatest(depth, 1), _reach - greatest(depth, 1) + 1), 0L, (s, w) -> s + w)")
    last, first = F.col("depth") == F.col("_reach"), F.col("depth") == F.col("_depth")
    return each.select(
        "conv_id",
        F.col("depth").cast("bigint").alias("depth"),
        "n_convs",
        F.when(last, F.col("_children")).otherwise(1).cast("bigint").alias("n_children"),
        F.coalesce("_leaves", F.lit(1)).cast("bigint").alias("n_leaves"),
        (F.col("_saved") + (F.col("n_convs") - 1) * own).alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("_ends")), F.lit(NOTHING)).alias("ends_sha256"),
        # All nodes of the chain have the same members.
        F.when(~first, F.col("conv_id")).alias("parent_conv_id"),
        F.when(first, F.col("_box")).alias("_box"),
        F.when(first, F.col("_head")).alias("_head"),
        F.when(first, F.lit(False)).alias("_tail"),
    )


def trie(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = rows.sparkSession
    C.prepare(spark)
    own = C.stored(sequences(rows), "conversations")
    boxes, rounds = burst(C.stored(folded(rebuilt(own)), "sequences"), capacity)
    nodes = C.stored(swept(boxes), "swept")
    root = spark.range(1).select(
        digest(F.lit("")).alias("_box"), F.lit(0).alias("_depth"), F.lit(None).cast("binary").alias("_head"),
        F.lit(0).alias("_reach"), F.array().cast("array<bigint>").alias("_words"),
    )
    chains: list[DataFrame] = []
    for heads in [*reversed(rounds), root]:
        # Deeper heads are among the nodes by now, so their tops count as children here.
        chains.append(C.stored(_chain(heads, nodes.where("_head IS NOT NULL")), "heads"))
        nodes = nodes.unionByName(chains[-1])
    # A head's chain and its first node have the same members. Heads are few: each stands for a
    # container over capacity.
    above = reduce(DataFrame.unionByName, chains).where("_box IS NOT NULL")
    above = above.select(F.col("_box").alias("_head"), F.col("conv_id").alias("_parent"))
    # Tails are no nodes of their own; tops take their parent from the head above them.
    tops = nodes.where("_head IS NOT NULL AND NOT _tail").join(above, "_head").withColumn("parent_conv_id", F.col("_parent"))
    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return tops.select(columns).unionByName(nodes.where("_head IS NULL").select(columns))
