"""The registered queries against plain Python over the same tables, and against their SQL."""

from __future__ import annotations

import binascii
import dataclasses
import hashlib
import itertools
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from merchlake.llm import decontaminate, line_dedup, minhash, suffix_dedup, superkmer
from merchlake.llm.queries import ORACLE, QUERIES

TESTDATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall())


def answers(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def removed_bytes(texts, length):
    seen = Counter(t[p : p + length] for t in texts.values() for p in range(len(t) - length + 1))
    out = {}
    for key, text in texts.items():
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            if seen[text[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        out[key] = len(text), int(gone.sum()), runs, kept
    return out


def removed_words(texts, length):
    seen, out = set(), {}
    for key, text in texts.items():
        words = text.split()
        gone = np.zeros(len(words), bool)
        for p in range(len(words) - length + 1):
            window = tuple(words[p : p + length])
            if window in seen:
                gone[p : p + length] = True
            seen.add(window)
        out[key] = len(words), int(gone.sum()), b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
    return out


def shingle_sets(texts, size):
    found = {}
    for key, text in texts.items():
        words = WORD.findall(text.translate(LOWER))
        count = max(1, len(words) - size + 1) if words else 0
        found[key] = {tuple(words[i : i + size]) for i in range(count)}
    return found


def brute_components(sets):
    root = {k: k for k in sets}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    holders = defaultdict(set)
    for key, found in sets.items():
        for shingle in found:
            holders[shingle].add(key)
    for key in sets:
        others = {o for s in sets[key] for o in holders[s] if o < key}
        for other in others:
            shared = len(sets[key] & sets[other])
            if 100 * shared >= 80 * (len(sets[key]) + len(sets[other]) - shared):
                a, b = sorted((top(key), top(other)))
                root[b] = a
    return {k: top(k) for k in sets}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, duck, name):
    answer = QUERIES[name](spark, TESTDATA)
    columns = ", ".join(f'"{c}"' for c in answer.columns)
    expected = duck.execute(f"SELECT {columns} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, answer.collect()), key=str) == sorted(expected, key=str)


def test_op1(spark, texts):
    rows = QUERIES["op1_slot_sharding"](spark, TESTDATA).collect()
    assert {r.doc_id for r in rows} == set(texts)
    shards = defaultdict(list)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, binascii.crc32(raw), "bytes", None)
        shards[r.shard].append(r)
    assert set(shards) == set(range(8))
    for held in shards.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    sizes = [sum(r.size for r in held) for held in shards.values()]
    assert max(sizes) <= 1.02 * min(sizes)


def test_op2(spark, texts):
    expected = removed_bytes({k: t.encode() for k, t in texts.items()}, 200)
    expected = {k: (n, gone, runs, hashlib.sha256(kept).hexdigest()) for k, (n, gone, runs, kept) in expected.items()}
    assert answers(QUERIES["op2_bucket_pointer_refinement"](spark, TESTDATA)) == expected


def partners_of(lines):
    """For every document the earlier ones it is aligned with: by each of its lines, all holders
    while these are few, else the first and the one before."""
    holders = defaultdict(list)
    for key in sorted(lines):
        for line in set(lines[key]) - {""}:
            holders[line].append(key)
    found = defaultdict(set)
    for held in holders.values():
        for at, key in enumerate(held[1:], 1):
            found[key].update(held[:at] if len(held) <= line_dedup.RARE else (held[0], held[at - 1]))
    return found


def without_aligned(lines, found):
    out = {}
    for key, own in lines.items():
        gone = {b for h in found[key] for _, b in line_dedup.patience(lines[h], own)}
        kept = "\n".join(line for at, line in enumerate(own) if at not in gone)
        out[key] = len(own), len(gone), len(found[key]), hashlib.sha256(kept.encode()).hexdigest()
    return out


def test_op3(spark, texts):
    lines = {k: t.split("\n") for k, t in texts.items()}
    found = partners_of(lines)
    result = answers(QUERIES["op3_patience_lines"](spark, TESTDATA))
    assert result == without_aligned(lines, found)
    # Against every earlier document that shares any line.
    every = {k: {h for h in lines if h < k and set(lines[h]) & set(own) - {""}} for k, own in lines.items()}
    whole = without_aligned(lines, every)
    assert sum(r[1] for r in result.values()) >= 0.99 * sum(r[1] for r in whole.values())


def test_op4(spark, texts):
    sets = shingle_sets(texts, 4)
    roots = brute_components(sets)
    expected = {k: (len(sets[k]), roots[k], roots[k] == k) for k in texts}
    assert answers(QUERIES["op4_bbit_minhash"](spark, TESTDATA)) == expected


def test_op5(spark, duck, texts):
    items = dict(duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    rows = answers(QUERIES["op5_greedy_tiling"](spark, TESTDATA))
    for key, text in texts.items():
        words = WORD.findall(text.translate(LOWER))
        best = (0.0, None, 0)
        for item in sorted(items):
            wanted = WORD.findall(items[item].translate(LOWER))
            part = sum(t[0] for t in brute_tiles(words, wanted, 5)) / len(wanted)
            if part >= 0.5:
                better = part > best[0]
                best = (part if better else best[0], item if better else best[1], best[2] + 1)
        assert rows[key] == (best[1] is not None, best[0], best[1], best[2])


def brute_tiles(text, item, least):
    """Greedy tiling by its definition: mark the longest unmarked match until none is long enough."""
    grams = {tuple(item[i : i + least]) for i in range(len(item) - least + 1)}
    if not any(tuple(text[t : t + least]) in grams for t in range(len(text) - least + 1)):
        return []
    in_text, in_item, done = [False] * len(text), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while (
                    i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n]
                    and not in_item[i + n] and not in_text[t + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        if best[0] < least:
            return done
        n, i, t = best
        in_item[i : i + n] = in_text[t : t + n] = [True] * n
        done.append(best)


def test_tiles_of_reordered_passages():
    rng = np.random.default_rng(5)
    for _ in range(200):
        item = rng.integers(0, 12, 30).astype(np.uint64)
        text = np.concatenate([item[15:], rng.integers(0, 12, 9).astype(np.uint64), item[:15]])
        for size in (3, 5):
            ours = decontaminate.tiles(text, item, size)
            theirs = brute_tiles(text.tolist(), item.tolist(), size)
            assert sum(t[0] for t in ours) == sum(t[0] for t in theirs)
        assert sum(t[0] for t in decontaminate.tiles(text, item, 5)) == 30


def test_op7(spark, duck):
    rows = answers(QUERIES["op7_ftrl_toxicity"](spark, TESTDATA.replace("0.001", "0.01")))
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{TESTDATA.replace('0.001', '0.01')}/labels.parquet'").fetchall()
    held = [(rows[k][1], toxic) for k, toxic in labels if toxic is not None and rows[k][0]]
    assert all(rows[k][0] == (binascii.crc32(str(k).encode()) % 5 == 0) for k in rows)
    assert all(r[2] == int(r[1] >= 0.5) and 0 <= r[1] <= 1 for r in rows.values())
    good, bad = [s for s, t in held if not t], [s for s, t in held if t]
    assert np.mean([[b > g for g in good] for b in bad]) > 0.85


def test_op9(spark, texts):
    expected = removed_words({k: t.encode() for k, t in texts.items()}, 20)
    expected = {k: (n, gone, hashlib.sha256(kept).hexdigest()) for k, (n, gone, kept) in expected.items()}
    assert answers(QUERIES["op9_super_kmers"](spark, TESTDATA)) == expected


def check_packing(rows, texts, capacity=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    total = 0
    for key, parts in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[key], add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        for number, part in enumerate(sorted(parts, key=lambda r: r.piece)):
            own = ids[number * capacity : (number + 1) * capacity]
            assert (part.piece, part.start, part.length) == (number, number * capacity, len(own))
            assert part.ids_crc32 == binascii.crc32(own.tobytes())
        assert len(parts) == -(-len(ids) // capacity)
    for parts in by_sequence.values():
        at = 0
        for part in sorted(parts, key=lambda r: r.offset):
            assert part.offset == at
            at += part.length
        assert at <= capacity
    # No worse than a hundredth above the least number of sequences, and two.
    assert len(by_sequence) <= -(-total // capacity) * 1.01 + 2


def test_op10(spark, texts):
    check_packing(QUERIES["op10_best_two_fit"](spark, TESTDATA).collect(), texts)


def test_pipeline(spark, duck, texts):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    columns, left = docs.columns, dict(texts)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "near dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, TESTDATA)
        assert docs.columns == columns
        kept = {r.doc_id for r in docs.collect()}
        assert kept <= set(left)
        if name == "toxicity":
            toxic = dict(duck.execute("SELECT doc_id, toxic FROM labels").fetchall())
            assert not [k for k in set(left) - kept if toxic.get(k) == 0]
        elif name == "exact dedup":
            last = {}
            for key in sorted(left):
                last[left[key]] = key
            assert kept == set(last.values())
        elif name == "near dedup":
            roots = brute_components(shingle_sets(left, 5))
            assert kept == {k for k in left if roots[k] == k}
        else:
            items = duck.execute("SELECT text FROM benchmark").fetchall()
            wanted = [WORD.findall(t.translate(LOWER)) for (t,) in items]
            for key in left:
                words = WORD.findall(left[key].translate(LOWER))
                hit = any(sum(t[0] for t in brute_tiles(words, w, 5)) >= len(w) / 2 for w in wanted)
                assert (key in kept) != hit
        left = {k: left[k] for k in kept}
    check_packing(stages["packing"](spark, docs, TESTDATA).collect(), left)


@pytest.mark.parametrize("most", [1, 4096])
def test_small_windows_with_hot_grams(spark, most):
    """Few symbols, so that every gram is hot and most windows repeat."""
    rng = np.random.default_rng(3)
    texts = {}
    for key in range(40):
        base = rng.choice(list("ab "), rng.integers(0, 120), p=[0.45, 0.45, 0.1])
        texts[key] = "".join(base).encode()
    texts[40] = texts[1] + b" x " + texts[2]
    frame = spark.createDataFrame([(k, t.decode()) for k, t in texts.items()], "doc_id long, text string")
    spec = dataclasses.replace(suffix_dedup.WINDOWS, length=14, gram=4, block=3, most_stretches=most)
    found = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
        for r in suffix_dedup.remove_repeats(frame, spec).collect()
    }
    assert found == removed_bytes(texts, 14)
    words = dataclasses.replace(superkmer.WINDOWS, length=4, gram=2, block=2, most_stretches=most)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept.encode()) for r in superkmer.remove_later(frame, words).collect()}
    assert found == removed_words(texts, 4)


@pytest.mark.parametrize(("block", "entries"), [(minhash.BLOCK, minhash.SET_ENTRIES), (16, 1 << 22), (64, 900)])
def test_near_copies_in_one_large_group(spark, monkeypatch, block, entries):
    """Copies with many edits: most pairs of the group are no links, so components need the search
    across components; with small blocks the largest component has blocks of its own."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SET_ENTRIES", entries)
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for key in range(150):
        words = list(base)
        for at in rng.choice(120, rng.integers(0, 9), replace=False):
            words[at] = f"x{rng.integers(10**6)}"
        texts[key] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    roots = brute_components(shingle_sets(texts, 5))
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(frame).collect()} == roots
    assert 1 < len(set(roots.values())) < 150


def test_pairs_inside_the_largest_component_do_not_meet(spark, monkeypatch):
    """Every pair across components meets in exactly one group; rows of the largest component go to
    the blocks of the others only."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    placed = spark.createDataFrame(
        [(7, c, 0 if c < 100 else c) for c in range(112)] + [(9, c, c % 2) for c in range(5)] + [(11, 1, 0), (11, 2, 0)],
        "_band long, _c long, _r long",
    )
    dealt = minhash._mixed(placed, F.lit(1 / 8))
    groups = minhash._pairs_of_blocks(dealt).agg(F.collect_list(F.struct("_c", "_r", "_block")).alias("all")).collect()
    assert {g["_band"] for g in groups} == {7, 9}
    met = Counter()
    for g in groups:
        for a, b in itertools.combinations(sorted(g["all"]), 2):
            if a["_r"] != b["_r"] and (g["_i"] == g["_j"] or a["_block"] != b["_block"]):
                met[g["_band"], a["_c"], b["_c"]] += 1
    rows = placed.where("_band <> 11").collect()
    pairs = {(a[0], a[1], b[1]) for a, b in itertools.combinations(rows, 2) if a[0] == b[0] and a[2] != b[2]}
    assert met == Counter(pairs)
    # 12 others in 2 blocks, 100 in 13 of their own.
    assert sum(len(g["all"]) for g in groups if g["_band"] == 7) == 12 * 15 + 100 * 2
