"""Results that cuts and bounds once changed, against plain Python."""

from __future__ import annotations

import dataclasses
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_brute_force import partners_of, removed_bytes, removed_words, without_aligned

from merchlake.llm import (
    common,
    decontaminate,
    exact_dedup,
    line_dedup,
    minhash,
    repeats,
    suffix_dedup,
    superkmer,
)


def test_blocks_whose_lines_occur_earlier_elsewhere(spark):
    """A block that two documents share goes whole, though its single lines occur in others."""
    texts = {1: "p\nzz", 2: "q\nyy\nq", 3: "r\nvv", 4: "a4\np\nq\nr\nq\np\nb4", 5: "a5\np\nq\nr\nq\np\nb5"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in line_dedup.remove_aligned(frame).collect()}
    assert kept[5] == "a5\nb5"


def test_frequent_lines_beside_rare_ones(spark):
    """A passage that 40 documents hold goes from those too that share a rarer line with another."""
    passage = "shared by all\nand this too\n"
    texts = {k: f"{passage}own {k}\npair {k // 2}" for k in range(40)}
    texts |= {100 + k: f"pair {k}\nnew {k}\n{passage}end {k}" for k in range(5)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = line_dedup.remove_aligned(frame).collect()
    found = {r.doc_id: (r.n_lines, r.n_removed, r.n_partners, hashlib.sha256(r.kept.encode()).hexdigest()) for r in rows}
    lines = {k: t.split("\n") for k, t in texts.items()}
    assert found == without_aligned(lines, partners_of(lines))
    kept = {r.doc_id: r.kept for r in rows}
    assert not [k for k in kept if k and "shared by all" in kept[k]]


def test_passage_in_many_surroundings(spark, monkeypatch):
    """A passage in 60 documents with different surroundings: no group of one task gets more than
    ``most_stretches`` stretches, and what repeats goes."""
    rng = np.random.default_rng(7)
    passage = " ".join(f"p{i}" for i in range(12))
    texts = {}
    for key in range(60):
        before, after = (" ".join(f"{rng.integers(10**6)}" for _ in range(9)) for _ in range(2))
        texts[key] = f"{before} {passage} {after}".encode()
    texts[60] = texts[1] + b" x " + texts[2]
    frame = spark.createDataFrame([(k, t.decode()) for k, t in texts.items()], "doc_id long, text string")
    largest, resolved = [], repeats.resolved

    def watched(met, *others):
        largest.append(max((r["count"] for r in met.groupBy("_route").count().collect()), default=0))
        return resolved(met, *others)

    monkeypatch.setattr(repeats, "resolved", watched)
    spec = dataclasses.replace(suffix_dedup.WINDOWS, length=20, gram=6, block=3, most_stretches=8)
    found = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
        for r in suffix_dedup.remove_repeats(frame, spec).collect()
    }
    assert found == removed_bytes(texts, 20)
    words = dataclasses.replace(superkmer.WINDOWS, length=6, gram=2, block=2, most_stretches=8)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in superkmer.remove_later(frame, words).collect()}
    assert found == removed_words(texts, 6)
    assert len(largest) == 2 and max(largest) <= 8


def test_item_of_one_repeated_word(spark):
    """A verbatim copy of an item with one distinct seed is contaminated."""
    refrain = " ".join(["la"] * 12)
    docs = spark.createDataFrame([(1, f"so {refrain} end"), (2, "la la la la la no"), (3, "none")], "doc_id long, text string")
    items = spark.createDataFrame([(7, refrain)], "item_id long, text string")
    rows = {r.doc_id: (r.contaminated, r.coverage, r.item_id) for r in decontaminate.contamination(docs, items).collect()}
    assert rows == {1: (True, 1.0, 7), 2: (False, 0.0, None), 3: (False, 0.0, None)}


def test_components_out_of_rounds(spark):
    """A path that one round does not label is an error, not a split component."""
    common.prepare(spark)
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "_a long, _b long")
    with pytest.raises(RuntimeError):
        common.components(edges, rounds=1)
    assert {r._root for r in common.components(edges).collect()} == {0}


def test_a_stored_slot_map_is_edited(spark, tmp_path):
    from merchlake.llm import sharding

    docs = spark.createDataFrame([(i, "x" * (i * 37 % 101)) for i in range(50)], "doc_id long, text string")
    path = str(tmp_path / "map")
    for run in (1, 2, 3):
        rows = sharding.shard(docs, 4, 64, path).collect()
        assert len(rows) == 50 and {r.map_version for r in rows} == {run}
    before = {r.doc_id: r.shard for r in rows}
    more = docs.unionByName(spark.createDataFrame([(100, "y" * 4000)], docs.schema))
    after = {r.doc_id: r.shard for r in sharding.shard(more, 4, 64, path).collect()}
    assert len(after) == 51 and sum(after[k] != before[k] for k in before) < 40
    assert {r.shard for r in sharding.shard(more, 5, 64, path).collect()} == set(range(5))
    with pytest.raises(ValueError):
        sharding.shard(more, 4, 64, path)
    with pytest.raises(ValueError):
        sharding.shard(more, 5, 32, path)


def test_very_long_chat_text(spark):
    from pyspark.sql import functions as F

    from merchlake.llm import chat

    rows = spark.range(2).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.repeat(F.lit("abcd [INST] "), F.lit(1_800_000)).alias("text"), F.lit("x").alias("layout"),
    )
    row = chat.digests(rows).first()
    assert (row.n_turns, row.loss_chars) == (2, 12 * 1_800_000)
    record = spark.range(1).select(
        F.lit(2).cast("long").alias("conv_id"),
        F.to_json(F.struct(F.lit("hi").alias("prompt"), F.repeat(F.lit("z"), F.lit(21_000_000)).alias("completion"))).alias(chat.RECORD),
    )
    assert chat.digests(rows.limit(0), record).first().loss_chars == 21_000_000


def thue_morse(bits):
    """A word and its mirror image, which collide in every polynomial hash modulo 2^64."""
    signs = [0]
    for _ in range(bits):
        signs += [1 - s for s in signs]
    return ("".join("ab"[s] for s in signs), "".join("ba"[s] for s in signs))


@pytest.mark.parametrize("bits", [10, 12])
def test_mirrored_words_differ(spark, bits):
    """Texts that differ in one such word only are different to every operator."""
    one, other = thue_morse(bits)
    few = [f"w{i}" for i in range(12)]
    long_a, long_b = (" ".join([*few, word, *few]) for word in (one, other))
    frame = spark.createDataFrame([(1, long_a), (2, long_b)], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in superkmer.remove_later(frame).collect()} == {1: 0, 2: 0}
    sets = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame, size=25).collect()}
    assert sets == {1: 1, 2: 2}
    items = spark.createDataFrame([(7, f"{one} {one} {one} {one} {one}")], "item_id long, text string")
    repeated = spark.createDataFrame(
        [(1, " ".join([one] * 5)), (2, " ".join([other] * 5))], "doc_id long, text string"
    )
    found = {r.doc_id: r.contaminated for r in decontaminate.contamination(repeated, items).collect()}
    assert found == {1: True, 2: False}
    lines = spark.createDataFrame([(1, f"{one}\nx"), (2, f"{other}\ny")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup.remove_aligned(lines).collect()} == {1: 0, 2: 0}


def test_window_ranks_are_exact():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["a", "b", "ab"], rng.integers(0, 30))).encode() for _ in range(20)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    ranks, places = superkmer.window_ranks(data, offsets, 5)
    by_rank, by_words = {}, {}
    for text, first in zip(texts, places, strict=False):
        words = text.split()
        for at in range(len(words) - 4):
            window, rank = tuple(words[at : at + 5]), int(ranks[first + at])
            assert by_rank.setdefault(rank, window) == window and by_words.setdefault(window, rank) == rank


def test_near_copies_with_repeated_and_missing_ids(spark):
    words = [f"w{i}" for i in range(60)]
    near, copy = " ".join(words), " ".join([*words, "more"])
    far, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "xy")
    rows = [
        (3, near),
        (5, copy),
        (5, far),
        (None, other),
        (None, other + " end"),
        (None, far + " end"),
        (None, "alone here"),
        (6, None),
        (6, "alone too"),
        (6, "alone too"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text) for r in minhash.keep_one(frame).collect()]
    one_of_others = [row for row in kept if row in rows[3:5]]
    assert len(one_of_others) == 1
    # A null id comes before all others, so of (5, far) and its near copy the one without an id stays.
    expected = [(3, near), (None, far + " end"), (None, "alone here"), (6, None), (6, "alone too")]
    assert sorted(map(str, kept)) == sorted(map(str, expected + one_of_others))
    found = {(r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame).collect()}
    assert {(3, 56, 3), (5, 57, 3), (5, 56, None), (6, 1, 6)} <= found


@pytest.mark.parametrize("block_bytes", [200])
def test_benchmark_in_passes(spark, block_bytes):
    """Blocks far smaller than the benchmark give what one block gives."""
    rng = np.random.default_rng(9)
    items = [(i, " ".join(rng.choice([f"w{j}" for j in range(40)], 12))) for i in range(25)]
    items += [(30, items[4][1]), (31, None), (None, "a b c d e"), (32, "")]
    rows = [(k, f"some words before {items[k][1]} and after") for k in range(12)]
    rows += [(12, " ".join((items[2][1], items[3][1]))), (12, None), (None, items[5][1]), (13, "clean"), (13, "clean")]
    rows += [(14, items[5][1])] * 3
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held", F.lit("x"))
    bench = spark.createDataFrame(items, "item_id long, text string")

    def found(size):
        return sorted(map(str, decontaminate.contamination(frame, bench, block_bytes=size).collect()))

    assert decontaminate.block_count(bench, block_bytes) > 5
    whole = found(1 << 20)
    assert found(block_bytes) == whole and len(whole) == len(rows)
    kept = decontaminate.keep_clean(frame, bench, block_bytes=block_bytes)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["12", "13", "13"]


def test_tiles_of_long_repetitive_texts():
    """A text of one word, and one of two words in turn, cost no more than their diagonals."""
    text, item = np.zeros(200_000, np.uint64), np.zeros(500, np.uint64)
    assert decontaminate.tiles(text, item) == [(500, 0, 0)]
    text[1::2] = 1
    item[:250:2] = 1
    done = decontaminate.tiles(text, item)
    assert done[0][0] == 250 and sum(t[0] for t in done) <= 500


def test_many_copies_of_one_row(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "COPIES_LISTED", 3)
    frame = spark.createDataFrame([(1, "a")] * 10 + [(2, "a")] * 3 + [(None, "b")] * 7, "doc_id long, text string")
    rows = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in exact_dedup.exact_duplicates(frame).collect())
    expected = [("1", "2", 13, False)] * 10 + [("2", "2", 13, False)] * 2 + [("2", "2", 13, True)]
    expected += [("None", "None", 7, False)] * 6 + [("None", "None", 7, True)]
    assert rows == sorted(expected)


def test_hot_grams_move_their_stretches_only(spark, monkeypatch):
    """Whole texts are joined once, however many grams are hot, and what repeats still goes."""
    rng = np.random.default_rng(11)
    texts = {}
    for key in range(30):
        before, after = (" ".join(f"{rng.integers(10**6)}" for _ in range(40)) for _ in range(2))
        texts[key] = f"{before} to be or not to be that is {after}".encode()
    # A copy, and a copy whose id is smaller.
    texts[30], texts[-1] = texts[2], texts[5]
    texts = dict(sorted(texts.items()))
    frame = spark.createDataFrame([(k, t.decode()) for k, t in texts.items()], "doc_id long, text string")
    joined, with_texts = [], repeats._with_texts
    monkeypatch.setattr(repeats, "_with_texts", lambda *given: joined.append(1) or with_texts(*given))
    words = dataclasses.replace(superkmer.WINDOWS, length=6, gram=2, block=2, most_stretches=8)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in superkmer.remove_later(frame, words).collect()}
    assert found == removed_words(texts, 6)
    assert len(joined) == 1
