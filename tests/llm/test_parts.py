"""Pure parts of the operators."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchlake.llm import chat, common, exact_dedup, line_dedup, minhash, packing, sharding, suffix_dedup
from merchlake.llm import words as W

# The first call of a numpy or Spark path is slow.
settings.register_profile("llm", deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
settings.load_profile("llm")

TEXTS = st.lists(st.text(alphabet="aB é\n\t日.", max_size=12), max_size=6)


@given(TEXTS)
def test_words_match_the_pattern(texts):
    data, offsets = common.string_bytes(pa.array(texts, pa.string()))
    hashes, starts, ends, places = W.word_hashes(data, offsets)
    found = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    assert found == [w for ws in expected for w in ws]
    assert np.diff(places).tolist() == [len(ws) for ws in expected]
    assert len(set(found)) == len(set(hashes.tolist()))


@given(TEXTS, st.integers(1, 4))
def test_shingles(texts, size):
    data, offsets = common.string_bytes(pa.array(texts, pa.string()))
    hashes, _, _, places = W.word_hashes(data, offsets)
    found, where = W.shingles(hashes, places, size)
    named = {}
    for i, text in enumerate(texts):
        words = text.split()
        expected = [tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1))] if words else []
        own = found[where[i] : where[i + 1]].tolist()
        assert len(own) == len(expected)
        for key, value in zip(expected, own, strict=True):
            assert named.setdefault(key, value) == value


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=60), st.integers(8, 16))
def test_quotient_filter_round_trip(values, bits):
    prints, counts = np.unique(np.array(values * 2, np.uint64), return_counts=True)
    segments = (prints >> np.uint64(64 - bits)).astype(np.int64)
    for segment in np.unique(segments).tolist():
        own = segments == segment
        payload = exact_dedup.encode(prints[own], counts[own], bits)
        back, times = exact_dedup.decode(segment, payload, bits)
        assert back.tolist() == prints[own].tolist() and times.tolist() == counts[own].tolist()
    merged, times = exact_dedup.merge(np.concatenate([prints, prints]), np.concatenate([counts, counts]))
    assert merged.tolist() == prints.tolist() and times.tolist() == (2 * counts).tolist()


@given(st.lists(st.text(alphabet="ab", max_size=30), min_size=1, max_size=5), st.sampled_from([4, 7, 8]))
def test_refinement(texts, length):
    data, offsets = common.string_bytes(pa.array(texts, pa.string()))
    ids = suffix_dedup.refine(data, offsets, length, first=2)
    strings = {
        int(offsets[i]) + p: t[p : p + length] for i, t in enumerate(texts) for p in range(len(t) - length + 1)
    }
    many = Counter(strings.values())
    for at in range(len(data)):
        assert (ids[at] >= 0) == (at in strings and many[strings[at]] > 1)
    by_bucket = {}
    for at, text in strings.items():
        if ids[at] >= 0:
            assert by_bucket.setdefault(ids[at], text) == text


@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_patience_aligns_equal_lines_in_order(a, b):
    found = sorted(line_dedup.patience(a, b))
    assert all(a[i] == b[j] for i, j in found)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def test_patience_takes_unique_lines_first():
    a, b = [1, 2, 9, 3, 9, 4], [9, 1, 2, 3, 4, 9]
    assert {(0, 1), (1, 2), (3, 3), (5, 4)} <= set(line_dedup.patience(a, b))
    assert line_dedup.patience([1, 2], [3]) == [] and line_dedup.patience([], []) == []


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_plan_packs_every_piece_once(lengths):
    counts = np.bincount(lengths, minlength=65) if lengths else np.zeros(65, np.int64)
    bins = packing.plan(counts, 64)
    used = Counter()
    for times, content in bins:
        assert times > 0 and sum(length * many for length, many in content.items()) <= 64
        for length, many in content.items():
            used[length] += times * many
    assert used == Counter(lengths)
    for length, first, end, *_ in packing.places(bins):
        assert 0 <= first < end <= counts[length]


def test_two_documents_replace_the_smallest():
    # Greedy takes 50 and 30, leaving 20; 25 and 24 fill the place of 30 better.
    counts = np.zeros(101, np.int64)
    counts[[50, 30, 25, 24]] = 1
    assert packing.plan(counts, 100)[0] == (1, {50: 1, 25: 1, 24: 1})


def test_plan_grows_with_lengths_only():
    rng = np.random.default_rng(1)
    few = packing.plan(rng.integers(1, 50, 2049) * (np.arange(2049) > 0))
    many = packing.plan(rng.integers(10**6, 10**7, 2049) * (np.arange(2049) > 0))
    assert len(many) < 40 * 2048 and len(few) < 12 * 2048


ENCODER = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))


@settings(deadline=None)
@given(st.text(alphabet="aAbB'stredlvm .,\t\n\x0b\x1c\x85\xa0éÉßªµº²½1 9%&́　İΣςﬁ日🙂<|>​Å", max_size=20))
def test_word_ids_are_the_tokenizers(text):
    expected = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == expected


@pytest.mark.parametrize("text", ["<|endoftext|>", "a <|EndOfText|>b", "it's IT'S 'RE ''s .'s", "x<|startoftext|>"])
def test_special_texts(text):
    expected = ENCODER.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == expected


def test_rebalancing_and_growth():
    rng = np.random.default_rng(2)
    sizes = rng.pareto(1.5, 512) * 1000
    start = sharding.SlotMap.dealt(8, 512)
    even = start.rebalanced(sizes)
    loads = even.loads(sizes)
    assert even.version == 1 and loads.max() <= max(1.01 * loads.min(), sizes.max() * 1.01)
    assert set(np.flatnonzero(even.owner != start.owner)) <= set(even.moved)
    grown = even.grown(sizes)
    moved = np.flatnonzero(grown.owner != even.owner)
    assert grown.shards == 9 and set(grown.owner[moved]) == {8} and sorted(moved) == sorted(grown.moved)
    assert abs(grown.loads(sizes)[8] - sizes.sum() / 9) < 0.05 * sizes.sum() / 9


def test_map_versions_are_kept(spark, folder):
    path = f"{folder}/map"
    first = sharding.SlotMap.dealt(2, 4)
    first.save(spark, path)
    first.rebalanced(np.array([9.0, 1, 1, 1])).save(spark, path)
    assert spark.read.parquet(path).groupBy("version").count().count() == 2
    assert {r.version for r in sharding.latest(spark, path).collect()} == {1}


def test_estimate_follows_similarity():
    rng = np.random.default_rng(4)
    for shared in (0, 300, 800, 1000):
        common_part = rng.integers(0, 2**63, shared).astype(np.uint64)
        sets = [np.concatenate([common_part, rng.integers(0, 2**63, 1000 - shared).astype(np.uint64)]) for _ in "ab"]
        least = minhash.minima(np.concatenate(sets), np.array([0, 1000, 2000]))
        low = minhash.packed(least)
        x = low[0] ^ low[1]
        equal = sum(((int(v) >> 4 * i) & 15) == 0 for v in x for i in range(16))
        chance = 1 / 16
        estimate = (equal / minhash.MINIMA - chance) / (1 - chance)
        assert abs(estimate - shared / (2000 - shared)) < 0.16


def test_matches_in_spark_equal_matches_in_numpy(spark):
    rng = np.random.default_rng(6)
    low = rng.integers(-(2**63), 2**63 - 1, (2, minhash.LONGS))
    low[1, :5] = low[0, :5]
    row = spark.createDataFrame(
        [tuple(int(v) for v in np.concatenate([low[0], low[1]]))],
        ", ".join(f"{side}{i} long" for side in "ab" for i in range(minhash.LONGS)),
    )
    sides = [
        F.struct(*[F.col(f"{side}{i}").alias(name) for i, name in enumerate(minhash.SIGNATURE)]).alias(side)
        for side in "ab"
    ]
    found = row.select(*sides).select(minhash.matches("a", "b")).first()[0]
    equal = sum(((int(v) >> 4 * i) & 15) == 0 for v in low[0] ^ low[1] for i in range(16))
    assert found == equal


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 201), (5, 5)]
    frame = spark.createDataFrame(edges, "_a long, _b long")
    common.prepare(spark)
    found = {r._node: r._root for r in common.components(frame).collect()}
    assert {found[i] for i in range(1, 41)} == {0} and {found[i] for i in range(101, 130)} == {100}
    assert found[201] == 200 and 0 not in found and 5 in found


CONTROLS = ["</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "\\", "\n", " ", "</s>\n", "x", "😀"]


@settings(deadline=None, max_examples=15)
@given(st.lists(st.lists(st.lists(st.sampled_from(CONTROLS), max_size=5).map("".join), max_size=3), min_size=1, max_size=6))
def test_chat_round_trip(spark, conversations):
    rows = [
        (c, t, "assistant" if t % 2 else "user", text) for c, texts in enumerate(conversations) for t, text in enumerate(texts)
    ]
    rows.append((-1, 0, "</s>odd [INST]\nrole", "x"))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    back = chat.read_back(chat.formatted(chat.records_from_rows(frame))).collect()
    for row in back:
        own = [(r[2], r[3]) for r in rows if r[0] == row.conv_id]
        assert [(t.role, t.text) for t in row.read_turns] == own == [(t.role, t.text) for t in row.turns]
        assert row.loss_text == "".join(text for role, text in own if role == "assistant")
        assert len(chat.BEGIN) + sum(m.turn_chars for m in row.loss_mask) == len(row.formatted)


def test_layouts_by_fingerprint(spark):
    records = {
        "messages": '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}],"id":7}',
        "dialogue": '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
        "prompt": '{"prompt":"q","completion":"a","meta":{"x":1}}',
        "response": '{"response":"a","prompt":"q"}',
        "instruction": '{"instruction":"q","output":"a"}',
        "instruction with input": '{"instruction":"q","input":"","output":"a"}',
    }
    rows = [(i, r) for i, r in enumerate(records.values())] + [(90, '{"what":1}'), (91, "no json"), (92, None)]
    found = {r.conv_id: r for r in chat.formatted(spark.createDataFrame(rows, "conv_id long, record string")).collect()}
    for i, name in enumerate(records):
        assert found[i].layout == name
        assert [(t.role, t.text) for t in found[i].turns] == [("user", "q"), ("assistant", "a")]
    assert all(found[i].layout is None and found[i].turns is None for i in (90, 91, 92))


def test_conversations_with_nulls(spark):
    rows = [(1, 0, None, None), (1, 0, "user", "b"), (1, 0, "user", "a"), (None, 1, "assistant", "c")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.digests(frame).collect()}
    assert found[1].n_turns == 3 and found[1].loss_chars == 0
    assert found[None].n_turns == 1 and found[None].loss_chars == 1
    assert chat.digests(frame.limit(0)).count() == 0
