"""Ranked lexical search of many items at once, with common term sets evaluated once.

Items are taken in blocks of bounded size. Inside a block, sets of terms that several items share are
mined: terms held by exactly the same items form one set, then the pair of sets that most items hold
together is joined, again and again, until no pair is shared. What is left is a directed graph: terms
below, shared sets above them, items on top. Documents are parsed once per block into the block's
terms; a document's partial score of a shared set is accumulated once, and every item that uses the
set adds it. Scores are integers, so the order of additions does not matter.

Each task keeps the best documents of every item only (``top`` per item), and the window that picks
the best overall reads those. What is broadcast is a block's graph, bounded by ``BLOCK_BYTES`` of item
text (one longer item makes a block of its own).

Nulls and edge cases: a null or empty text has no terms, finds nothing and is never found; rows that
repeat doc_id are documents of their own, and rows that repeat item_id are ranked apart; null
doc_ids come before all others among equal scores; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlake.llm import common as C

TOP = 50
BLOCK_ITEMS = 1024
BLOCK_BYTES = 1 << 22
# Sets of one item that are searched for shared pairs together; a longer item is searched in parts,
# which changes what is shared and never a score.
PAIR_SETS = 256
# Partial scores held at a time, over documents and shared sets.
CELLS = 1 << 21
# Every ASCII character but letters and digits parts terms; A-Z become lower case.
FOLD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(FOLD).split()


@dataclass(frozen=True)
class Graph:
    """``leaves`` are terms; ``sets`` are tuples of nodes, numbered after the leaves, each after its
    parts; ``items`` are pairs of item_id and the nodes whose scores add up to the item's."""

    leaves: list[bytes]
    sets: list[tuple[int, ...]]
    items: list[tuple[int | None, tuple[int, ...]]]


def mine(ids: list[int | None], texts: list[bytes]) -> Graph:
    """The graph of shared term sets of some items."""
    held = [sorted(set(terms(text))) for text in texts]
    holders: dict[bytes, list[int]] = defaultdict(list)
    for item, own in enumerate(held):
        for term in own:
            holders[term].append(item)
    leaves = sorted(holders)
    alike: dict[tuple[int, ...], list[int]] = defaultdict(list)
    for leaf, term in enumerate(leaves):
        alike[tuple(holders[term])].append(leaf)
    sets: list[tuple[int, ...]] = []
    private: list[list[int]] = [[] for _ in held]
    shared: list[list[int]] = [[] for _ in held]
    for items, group in alike.items():
        node = group
        if len(items) > 1 and len(group) > 1:
            sets.append(tuple(group))
            node = [len(leaves) + len(sets) - 1]
        for item in items:
            (shared if len(items) > 1 else private)[item].extend(node)
    rows, owner = [], []
    for item, nodes in enumerate(shared):
        for first in range(0, len(nodes), PAIR_SETS):
            rows.append(set(nodes[first : first + PAIR_SETS]))
            owner.append(item)
    _join_pairs(rows, sets, len(leaves))
    for row, item in zip(rows, owner, strict=True):
        private[item].extend(sorted(row))
    return Graph(leaves, sets, [(i, tuple(nodes)) for i, nodes in zip(ids, private, strict=True)])


def _join_pairs(rows: list[set[int]], sets: list[tuple[int, ...]], leaves: int) -> None:
    """Replace the pair of nodes that most rows hold by a set of both, until no pair is shared."""
    users: dict[int, set[int]] = defaultdict(set)
    for at, row in enumerate(rows):
        for node in row:
            users[node].add(at)
    many = Counter((a, b) for row in rows for a in row for b in row if a < b)
    heap = [(-n, pair) for pair, n in many.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        count, (a, b) = heapq.heappop(heap)
        both = users[a] & users[b]
        if len(both) < 2:
            continue
        if len(both) < -count:
            # Counted before other pairs took some of its rows.
            heapq.heappush(heap, (-len(both), (a, b)))
            continue
        sets.append((a, b))
        new = leaves + len(sets) - 1
        beside: Counter[int] = Counter()
        for at in both:
            rows[at] -= {a, b}
            beside.update(rows[at])
            rows[at].add(new)
        users[a] -= both
        users[b] -= both
        users[new] = both
        for node, n in beside.items():
            if n > 1:
                heapq.heappush(heap, (-n, (node, new)))


def graphs(benchmark: DataFrame, items: int = BLOCK_ITEMS, size: int = BLOCK_BYTES) -> DataFrame:
    """A row per block of items: _block and the pickled graph of its items."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for item, text in zip(batch.column("_item").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                text = text.encode()
                if ids and (len(ids) == items or held + len(text) > size):
                    yield _packed(ids, texts)
                    ids, texts, held = [], [], 0
                ids.append(item)
                texts.append(text)
                held += len(text)
        if ids:
            yield _packed(ids, texts)

    rows = benchmark.select(
        F.col("item_id").cast("bigint").alias("_item"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    )
    parts = max(1, math.ceil(rows.count() / items))
    found = rows.repartition(parts).mapInArrow(blocks, "_graph binary")
    return C.stored(found.withColumn("_block", F.monotonically_increasing_id()), "graphs")


def _packed(ids: list[int | None], texts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(mine(ids, texts))], pa.binary())], names=["_graph"])


def postings(docs: DataFrame, graph: Graph) -> DataFrame:
    """Every document that has terms: _k, _n (terms with repeats), and of the graph's terms that it
    holds the numbers (_terms) and the occurrences (_tf)."""
    vocabulary = {term: leaf for leaf, term in enumerate(graph.leaves)}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            data, offsets = C.string_bytes(batch.column("_text"))
            rows, sizes, found, many, ends = [], [], [], [], [0]
            for row in range(batch.num_rows):
                counts = Counter(terms(data[offsets[row] : offsets[row + 1]].tobytes()))
                if not counts:
                    continue
                rows.append(row)
                sizes.append(counts.total())
                own = known & counts.keys()
                found += [vocabulary[term] for term in own]
                many += [counts[term] for term in own]
                ends.append(len(found))
            cuts = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_k").take(pa.array(rows, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(cuts, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(many, pa.int32())),
                ],
                names=["_k", "_n", "_terms", "_tf"],
            )

    return C.texts(docs).mapInArrow(parse, "_k long, _n long, _terms array<int>, _tf array<int>")


class Best:
    """The best documents of each item so far: highest score first, equal scores by key."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.keys = [np.empty(0, np.int64)] * items
        self.scores = [np.empty(0, np.int64)] * items

    def add(self, item: int, keys: np.ndarray, scores: np.ndarray) -> None:
        least = self.scores[item][-1] if len(self.scores[item]) == self.top else 1
        at = np.flatnonzero(scores >= least)
        if not len(at):
            return
        keys, scores = np.r_[self.keys[item], keys[at]], np.r_[self.scores[item], scores[at]]
        order = np.lexsort((keys, -scores))[: self.top]
        self.keys[item], self.scores[item] = keys[order], scores[order]


def accumulate(graph: Graph, keys: np.ndarray, term: np.ndarray, doc: np.ndarray, part: np.ndarray, best: Best) -> None:
    """Add some documents to ``best``. ``part`` is what a term of a document adds to its score; a
    shared set's scores are summed once, whatever the number of items that use them."""
    order = np.argsort(term, kind="stable")
    doc, part = doc[order], part[order]
    cuts = np.searchsorted(term[order], np.arange(len(graph.leaves) + 1)).tolist()
    sums: list[np.ndarray | None] = []

    def total(nodes: tuple[int, ...]) -> np.ndarray | None:
        out = None
        for node in nodes:
            if node >= len(graph.leaves):
                more = sums[node - len(graph.leaves)]
                if more is not None:
                    out = more.copy() if out is None else np.add(out, more, out)
            elif cuts[node] < cuts[node + 1]:
                if out is None:
                    out = np.zeros(len(keys), np.int64)
                # A document holds a term once here.
                out[doc[cuts[node] : cuts[node + 1]]] += part[cuts[node] : cuts[node + 1]]
        return out

    for nodes in graph.sets:
        sums.append(total(nodes))
    for item, (_, nodes) in enumerate(graph.items):
        scores = total(nodes)
        if scores is not None:
            best.add(item, keys, scores)


def ranked(docs: DataFrame, graph: Graph, top: int = TOP) -> DataFrame:
    """The ``top`` documents of each of the graph's items: item_id, rank, doc_id, score."""
    held = C.stored(postings(docs, graph), "postings")
    sums = held.agg(F.count(F.lit(1)).alias("n"), F.sum("_n").alias("l")).first()
    n_docs, n_terms = sums["n"], sums["l"] or 0
    # At most one row per term of the block.
    counted = held.select(F.explode("_terms").alias("_t")).groupBy("_t").agg(F.count(F.lit(1)).alias("_df")).toArrow()
    weights = np.zeros(len(graph.leaves), np.int64)
    for leaf, df in zip(counted.column("_t").to_pylist(), counted.column("_df").to_pylist(), strict=True):
        weights[leaf] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    width = max(16, CELLS // (len(graph.sets) + 1))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(graph.items), top)
        for batch in batches:
            for first in range(0, batch.num_rows, width):
                part = batch.slice(first, width)
                length = 100 - 50 + (50 * part.column("_n").to_numpy() * n_docs) // n_terms
                found = part.column("_terms")
                doc = np.repeat(np.arange(part.num_rows), found.value_lengths().to_numpy())
                term, tf = found.flatten().to_numpy(), part.column("_tf").flatten().to_numpy().astype(np.int64)
                score = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * length[doc]))
                accumulate(graph, part.column("_k").to_numpy(), term, doc, score, best)
        many = [len(keys) for keys in best.keys]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(many)), many), pa.int32()),
                pa.array(np.concatenate([np.empty(0, np.int64), *best.keys])),
                pa.array(np.concatenate([np.empty(0, np.int64), *best.scores])),
            ],
            names=["_place", "_k", "score"],
        )

    best_first = Window.partitionBy("_place").orderBy(F.desc("score"), "_k")
    # At most a row per item of the block.
    names = docs.sparkSession.createDataFrame(
        [(place, item) for place, (item, _) in enumerate(graph.items)], "_place int, item_id long"
    )
    return (
        held.mapInArrow(search, "_place int, _k long, score long")
        .withColumn("rank", F.row_number().over(best_first))
        .where(F.col("rank") <= top)
        .join(F.broadcast(names), "_place")
        .select("item_id", "rank", C.document_id().alias("doc_id"), "score")
    )


def search(docs: DataFrame, benchmark: DataFrame, top: int = TOP, items: int = BLOCK_ITEMS) -> DataFrame:
    """The ``top`` documents with a score above 0 for every item: item_id, rank, doc_id, score."""
    C.prepare(docs.sparkSession)
    blocks = graphs(benchmark, items)
    # One number per block; their graphs are read one at a time.
    numbers = [row["_block"] for row in blocks.select("_block").orderBy("_block").collect()]
    if not numbers:
        return ranked(docs.limit(0), Graph([], [], []), top)
    answers = []
    for number in numbers:
        graph = pickle.loads(blocks.where(F.col("_block") == number).first()["_graph"])
        answer = ranked(docs, graph, top)
        answers.append(answer if len(numbers) == 1 else C.stored(answer, "ranks"))
    return reduce(DataFrame.unionByName, answers)
