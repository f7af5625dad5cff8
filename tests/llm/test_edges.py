"""Every operator over nulls, empty texts, repeated rows, clashing columns and empty tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from merchlake.llm import (
    decontaminate,
    exact_dedup,
    line_dedup,
    minhash,
    packing,
    sharding,
    suffix_dedup,
    superkmer,
    toxicity,
)

LONG = " ".join(f"word{i}" for i in range(300))
# Columns named like the operators' own and like their results.
EXTRA = ("_k", "_text", "_row", "_n", "kept", "score", "coverage", "slot", "length")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, LONG, "en"),
        (2, LONG, None),
        (2, LONG, None),
        (3, None, None),
        (4, "", "de"),
        (None, "a null id", "fr"),
        (None, None, None),
        (5, " \n\t ", None),
        (6, "é" * 50 + " 😀 ok", "fr"),
        (7, LONG + " tail", "en"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in EXTRA:
        frame = frame.withColumn(name, F.lit(name))
    return frame


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, "word10 word11 word12 word13 word14 word15 word16"), (2, None), (None, "x y"), (3, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0), (7, None), (None, 1), (99, 1)], "doc_id long, toxic int")


OPERATORS = {
    "sharding": lambda d, b, t: sharding.shard(d, 3, 64),
    "suffix": lambda d, b, t: suffix_dedup.remove_repeats(d),
    "lines": lambda d, b, t: line_dedup.remove_aligned(d),
    "minhash": lambda d, b, t: minhash.near_duplicates(d),
    "decontamination": lambda d, b, t: decontaminate.contamination(d, b),
    "toxicity": lambda d, b, t: toxicity.scores(d, t),
    "exact": lambda d, b, t: exact_dedup.exact_duplicates(d),
    "superkmer": lambda d, b, t: superkmer.remove_later(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(docs, benchmark, labels, name):
    ids = [r.doc_id for r in OPERATORS[name](docs, benchmark, labels).collect()]
    expected = [r.doc_id for r in docs.collect()]
    assert sorted(map(str, ids)) == sorted(map(str, expected))


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(docs, benchmark, labels, name):
    assert OPERATORS[name](docs.limit(0), benchmark.limit(0), labels.limit(0)).count() == 0


def test_exact_groups(docs):
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(docs).collect()}
    assert {r for r in rows if r[0] in (1, 2)} == {(1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, False)}
    # Null text, empty text and a null text with a null id are one group.
    assert {r for r in rows if r[2] == 3 and r[0] in (3, 4, None)} == {
        (3, 4, 3, False), (4, 4, 3, True), (None, 4, 3, False)
    }
    assert (None, None, 1, True) in rows


def test_near_duplicates_of_short_texts(docs):
    rows = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert {(1, 296, 1, True), (2, 296, 1, False), (7, 297, 1, False)} <= rows
    # Empty sets are linked with nothing.
    assert {(3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True)} <= rows


def test_filters_keep_all_columns(docs, benchmark, labels):
    for kept in (
        exact_dedup.keep_one(docs),
        minhash.keep_one(docs),
        decontaminate.keep_clean(docs, benchmark),
        toxicity.keep_clean(docs, labels),
    ):
        assert kept.columns == docs.columns
        row = kept.where("doc_id = 6").first()
        assert row["lang"] == "fr" and all(row[name] == name for name in EXTRA)


def test_filters_decide(docs, benchmark, labels):
    def ids(frame):
        return sorted(str(r.doc_id) for r in frame.collect())

    assert ids(exact_dedup.keep_one(docs)) == ["2", "4", "5", "6", "7", "None"]
    assert ids(minhash.keep_one(docs)) == ["1", "3", "4", "5", "6", "None", "None"]
    assert ids(decontaminate.keep_clean(docs, benchmark)) == ["3", "4", "5", "6", "None", "None"]
    # Nothing to learn from: nothing is dropped.
    assert toxicity.keep_clean(docs, labels.limit(0)).count() == docs.count()


def test_repeats_of_repeated_rows(docs):
    bytes_gone = {(r.doc_id, r.n_removed) for r in suffix_dedup.remove_repeats(docs).collect()}
    whole = len(LONG.encode())
    assert {(1, whole), (2, whole), (7, whole)} <= bytes_gone and (6, 0) in bytes_gone
    words_gone = {(r.doc_id, r.n_removed) for r in superkmer.remove_later(docs).collect()}
    # The first holder keeps its words; a repeated row is the same document.
    assert {(1, 0), (2, 300), (7, 300), (3, 0), (5, 0)} <= words_gone


def test_packing_edges(docs):
    packed = packing.pack(docs).collect()
    assert len(packed) == docs.count()
    by_id = {r.doc_id: r.length for r in packed}
    assert by_id[3] == by_id[4] == by_id[5] == 1
    assert packing.pack(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    text = " ".join(f"w{i * 7919 % 130003}" for i in range(120_000))
    frame = spark.createDataFrame([(1, text), (2, "x " + text), (3, text[:5000])], "doc_id long, text string")
    words = {r.doc_id: (r.n_words, r.n_removed) for r in superkmer.remove_later(frame).collect()}
    assert words[1] == (120_000, 0) and words[2] == (120_001, 120_000)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    removed = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(frame).collect()}
    assert removed[1] == len(text) and removed[2] == len(text) and removed[3] == 5000
