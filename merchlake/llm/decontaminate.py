"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are lower-cased words. A document meets an item where they share a
seed of five words. Each such pair is tiled: running Karp-Rabin hashes find the longest stretches of
words that are not yet marked in either text, these are marked, and the search length falls until
no stretch of five words is left. Tiles may stand in any order, so reordered passages count as
well. A document is contaminated if tiles cover at least half of an item's words.

The benchmark is a stated query set: it is read in blocks of bounded size, and a task holds one block
while whole documents stream past. A benchmark of several blocks takes a pass over the documents for
each; what a pass finds is stored by text and merged. No document is shuffled to be judged, and
nothing is emitted per shared seed, so a passage that a third of all documents hold costs no more than
others.

Nulls and edge cases: null and empty texts are clean; items without words are left out; an item with
fewer than five words counts when its whole sequence occurs; ties between items go to the smaller
item_id; repeated rows get equal answers; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import words as W

SEED_WORDS = 5
COVERAGE = 0.5
# Bytes of benchmark text that a task holds at a time.
BLOCK_BYTES = 16 << 20
# Pairs of equal places that one step of the tiling looks at.
PAIRS = 1 << 20
FOUND = "coverage double, item_id bigint, matched_items int"


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Whether the stretch of ``size`` words from each place has no marked word."""
    seen = np.zeros(len(marked) + 1, np.int64)
    np.cumsum(marked, out=seen[1:])
    return seen[size:] == seen[: len(seen) - size]


def _common(
    text: np.ndarray, item: np.ndarray, size: int, in_text: np.ndarray, in_item: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unmarked equal stretches of at least ``size`` words, each as long as it gets: lengths, places
    in the item, places in the text."""
    nothing = np.empty(0, np.int64)
    if min(len(text), len(item)) < size:
        return nothing, nothing, nothing
    there, here = W.gram_hash(W.prefix_sums(text), size), W.gram_hash(W.prefix_sums(item), size)
    there_at, here_at = np.flatnonzero(_free(in_text, size)), np.flatnonzero(_free(in_item, size))
    there_at = there_at[np.isin(there[there_at], here[here_at])]
    here_at = here_at[np.isin(here[here_at], there[there_at])]
    if not len(there_at):
        return nothing, nothing, nothing
    names, row = np.unique(here[here_at]), len(text) + 1
    held = np.sort(np.searchsorted(names, there[there_at]) * row + there_at)
    wanted = np.searchsorted(names, here[here_at]) * row
    found = []
    # Equal places lie on diagonals (place in the text less place in the item); a bounded number of
    # pairs is looked at together. Neighbours on a diagonal are one stretch.
    width = max(1, PAIRS // len(here_at))
    for low in range(-int(here_at[-1]), int(there_at[-1]) + 1, width):
        first = np.searchsorted(held, wanted + np.clip(here_at + low, 0, len(text)))
        count = np.searchsorted(held, wanted + np.clip(here_at + low + width, 0, len(text))) - first
        total = int(count.sum())
        if not total:
            continue
        step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        t = held[np.repeat(first, count) + step] % row
        diagonal = t - np.repeat(here_at, count)
        order = np.lexsort((t, diagonal))
        t, diagonal = t[order], diagonal[order]
        head = np.flatnonzero(np.r_[True, (diagonal[1:] != diagonal[:-1]) | (t[1:] != t[:-1] + 1)])
        lengths = np.diff(np.r_[head, total]) + size - 1
        found.append((lengths, t[head] - diagonal[head], t[head]))
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def tiles(text: np.ndarray, item: np.ndarray, least: int = SEED_WORDS) -> list[tuple[int, int, int]]:
    """Greedy tiling of two word-hash sequences: (length, place in item, place in text), longest
    first, none overlapping another in either sequence."""
    in_text, in_item = np.zeros(len(text), bool), np.zeros(len(item), bool)
    done, size = [], max(least, min(len(item), 32))
    while True:
        lengths, places, others = _common(text, item, size, in_text, in_item)
        longest = int(lengths.max(initial=0))
        if longest > 2 * size:
            size = longest
            continue
        order = np.lexsort((others, places, -lengths))
        for length, i, t in zip(lengths[order].tolist(), places[order].tolist(), others[order].tolist(), strict=True):
            if not in_item[i : i + length].any() and not in_text[t : t + length].any():
                in_text[t : t + length] = in_item[i : i + length] = True
                done.append((length, i, t))
                if in_item.all():
                    return done
        # What a longer tile cut short is looked for again before the search length falls.
        if len(lengths) and len(_common(text, item, size, in_text, in_item)[0]):
            continue
        if size == least:
            return done
        size = max(least, size // 2)


class Block:
    """A part of the benchmark as word hashes, with its seeds in sorted order."""

    def __init__(self, ids: list[int], texts: list[str], seed: int = SEED_WORDS):
        self.seed, self.ids, self.items = seed, ids, []
        data, offsets = C.string_bytes(pa.array(texts, pa.string()))
        hashes, _, _, places = W.word_hashes(data, offsets, lower=True)
        self.items = [hashes[a:b] for a, b in zip(places, places[1:])]
        # Per seed length: seeds in order, their items, and how often they occur there.
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        sizes = np.minimum(np.diff(places), seed)
        for size in np.unique(sizes[sizes > 0]).tolist():
            grams, owners, times = [], [], []
            for at in np.flatnonzero(sizes == size).tolist():
                gram, many = np.unique(W.gram_hash(W.prefix_sums(self.items[at]), size), return_counts=True)
                grams.append(gram)
                times.append(many)
                owners.append(np.full(len(gram), at))
            gram, owner, many = np.concatenate(grams), np.concatenate(owners), np.concatenate(times)
            order = np.argsort(gram, kind="stable")
            self.by_size[size] = gram[order], owner[order], many[order]

    def candidates(self, hashes: np.ndarray, places: np.ndarray, coverage: float) -> list[tuple[int, int]]:
        """Pairs of a text and an item that share enough seeds to reach the coverage."""
        pairs = []
        text = np.repeat(np.arange(len(places) - 1), np.diff(places))
        for size, (gram, owner, many) in self.by_size.items():
            if len(hashes) < size:
                continue
            seen = W.gram_hash(W.prefix_sums(hashes), size)
            inside = text[: len(seen)] == text[size - 1 :]
            left = np.searchsorted(gram, seen, "left")
            hit = np.flatnonzero(inside & (gram[np.minimum(left, len(gram) - 1)] == seen))
            if not len(hit):
                continue
            # A seed once per text, then every item that has it.
            where = text[hit]
            once = np.unique(np.stack([where, left[hit]]), axis=1)
            count = np.searchsorted(gram, gram[once[1]], "right") - once[1]
            start = np.repeat(once[1], count)
            step = np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
            key, pair = np.unique(
                np.stack([np.repeat(once[0], count), owner[start + step]]), axis=1, return_inverse=True
            )
            # Places in the item where a shared seed starts.
            hits = np.bincount(pair.reshape(-1), many[start + step], key.shape[1])
            words = np.array([len(self.items[i]) for i in key[1].tolist()])
            # Tiles of the least length hold the most words per seed.
            enough = hits * size >= np.ceil(words * coverage)
            pairs += list(zip(key[0][enough].tolist(), key[1][enough].tolist(), strict=True))
        return pairs

    def covered(self, text: np.ndarray, item: int) -> float:
        """The part of an item's words that tiles with the text cover."""
        words = self.items[item]
        return sum(t[0] for t in tiles(text, words, min(self.seed, len(words)))) / len(words)

    def judge(self, data: np.ndarray, offsets: np.ndarray, coverage: float) -> dict[int, tuple[float, int, int]]:
        """Per text with an item covered enough: coverage, item, number of such items."""
        hashes, _, _, places = W.word_hashes(data, offsets, lower=True)
        found: dict[int, tuple[float, int, int]] = {}
        for text, item in self.candidates(hashes, places, coverage):
            part = self.covered(hashes[places[text] : places[text + 1]], item)
            if part >= coverage:
                best, best_id, items = found.get(text, (-1.0, 0, 0))
                mine = self.ids[item]
                if (part, -mine) > (best, -best_id):
                    best, best_id = part, mine
                found[text] = best, best_id, items + 1
        return found


def block_count(benchmark: DataFrame, block_bytes: int) -> int:
    """In how many blocks of about ``block_bytes`` the benchmark is read."""
    size = _items(benchmark).agg(F.sum(F.octet_length("_text"))).first()[0]
    return 0 if size is None else max(1, -(-size // block_bytes))


def read_block(benchmark: DataFrame, number: int, count: int) -> Block:
    """A block of the benchmark; equal ids stay together."""
    mine = _items(benchmark).where(F.pmod(F.xxhash64("_i"), F.lit(count)) == number)
    rows = mine.orderBy("_i", "_text").collect()
    return Block([r["_i"] for r in rows], [r["_text"] for r in rows])


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("item_id").cast("bigint").alias("_i"), F.col("text").cast("string").alias("_text")
    )


def matcher(block: Block, coverage: float) -> Column:
    """A column function from text to the best covered item of a block."""

    @F.arrow_udf(FOUND)
    def match(texts: pa.Array) -> pa.Array:
        data, offsets = C.string_bytes(texts)
        part, item, items = np.zeros(len(texts)), [None] * len(texts), np.zeros(len(texts), np.int32)
        for first, last in C.runs_of(offsets, C.CHUNK_BYTES):
            chunk = data[offsets[first] : offsets[last]]
            for at, (best, best_id, n) in block.judge(chunk, offsets[first : last + 1] - offsets[first], coverage).items():
                part[first + at], item[first + at], items[first + at] = best, best_id, n
        return pa.StructArray.from_arrays(
            [pa.array(part), pa.array(item, pa.int64()), pa.array(items)],
            names=["coverage", "item_id", "matched_items"],
        )

    return match


def _found(match: Column) -> Column:
    """A match in an order of its own: the larger, the better covered, then the smaller item."""
    return F.struct(match["coverage"].alias("c"), (-match["item_id"]).alias("i"), match["matched_items"].alias("n"))


def _hits(docs: DataFrame, benchmark: DataFrame, count: int, coverage: float) -> DataFrame:
    """Texts (_sha) that an item covers, with their match (_match): one pass over the documents per
    block, so that the driver and each task hold one block at a time."""
    texts = docs.select(F.col("text").cast("string").alias("_text"))
    passes = []
    for number in range(count):
        match = matcher(read_block(benchmark, number, count), coverage)
        hit = texts.withColumn("_m", match(F.col("_text"))).where("_m.item_id IS NOT NULL")
        # Copies of a text have one answer.
        hit = hit.select(F.sha2("_text", 256).alias("_sha"), _found(F.col("_m")).alias("_one"))
        passes.append(C.stored(hit.groupBy("_sha").agg(F.max("_one").alias("_one")), "hits"))
    hits = reduce(DataFrame.unionByName, passes)
    best = F.max(F.struct("_one.c", "_one.i")).alias("_best")
    merged = hits.groupBy("_sha").agg(best, F.sum("_one.n").cast("int").alias("_n"))
    # Checkpointed, so that the join can split a text that very many documents share.
    return merged.select(
        "_sha", F.struct("_best.c", "_best.i", F.col("_n").alias("n")).alias("_match")
    ).checkpoint()


def judged(
    docs: DataFrame, benchmark: DataFrame, name: str, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents with a struct column ``name``: coverage (c), minus item_id (i) and number of
    covered items (n)."""
    C.prepare(docs.sparkSession)
    nothing = F.struct(F.lit(0.0).alias("c"), F.lit(None).cast("bigint").alias("i"), F.lit(0).alias("n"))
    count = block_count(benchmark, block_bytes)
    if not count:
        return docs.withColumn(name, nothing)
    if count == 1:
        part = C.fresh_name("part")
        match = matcher(read_block(benchmark, 0, 1), coverage)(F.col("text").cast("string"))
        return docs.withColumn(part, match).withColumn(name, _found(F.col(part))).drop(part)
    key, held = C.fresh_name("sha"), C.fresh_name("held")
    hits = _hits(docs, benchmark, count, coverage).select(F.col("_sha").alias(key), F.col("_match").alias(held))
    return (
        docs.withColumn(key, F.sha2(F.col("text").cast("string"), 256))
        .join(hits, key, "left")
        .withColumn(name, F.coalesce(held, nothing))
        .select(*[F.col(f"`{c}`") for c in docs.columns], name)
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per document: doc_id, contaminated, coverage and item_id of the best covered item,
    matched_items."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return judged(rows, benchmark, "_match", coverage, block_bytes).select(
        "doc_id",
        (F.col("_match.c") >= coverage).alias("contaminated"),
        F.col("_match.c").alias("coverage"),
        (-F.col("_match.i")).alias("item_id"),
        F.col("_match.n").cast("bigint").alias("matched_items"),
    )


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The documents that no benchmark item is covered by, all columns kept."""
    name = C.fresh_name("match")
    return judged(docs, benchmark, name, coverage, block_bytes).where(F.col(f"{name}.c") < coverage).drop(name)
