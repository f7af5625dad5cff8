"""Nearest neighbours, the prefix trie and ranked search against plain Python, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from merchlake.llm import lexical, nn_descent, prefix_trie
from merchlake.llm.queries import ORACLE, QUERIES

TESTDATA = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("name", ["op12_burst_trie", "op13_shared_terms"])
def test_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    answer = duck.execute(ORACLE[name])
    columns = [c[0] for c in answer.description]
    expected = sorted(map(str, answer.fetchall()))
    assert sorted(str(tuple(r)) for r in QUERIES[name](spark, TESTDATA).select(columns).collect()) == expected


# -- ranked search ---------------------------------------------------------------------------------


def searched(docs, items, top=50):
    found = [(key, Counter(TERM.findall((text or "").translate(FOLD)))) for key, text in docs]
    found = [(key, c) for key, c in found if c]
    n, total = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        asked = set(TERM.findall((text or "").translate(FOLD)))
        scores = []
        for key, c in found:
            m = 50 + (50 * sum(c.values()) * n) // total
            score = 0
            for t in asked & c.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scores.append((-score, -math.inf if key is None else key, key))
        for rank, (score, _, key) in enumerate(sorted(scores, key=lambda x: x[:2])[:top], 1):
            out.append((item, rank, key, -score))
    return sorted(out, key=str)


def random_texts(rng, many):
    words = [f"w{i}" for i in range(12)] + ["Été", "ÉTÉ", "naïve", "Ab", "aB", "10", "x-y", "中文", "\x85", "a b"]
    return ["" if rng.random() < 0.1 else None if rng.random() < 0.05 else " ".join(rng.choices(words, k=rng.randint(1, 15))) for _ in range(many)]


@pytest.mark.parametrize("seed, block", [(1, 1024), (2, 3)])
def test_search_brute_force(spark, seed, block):
    rng = random.Random(seed)
    docs = [(i, t) for i, t in enumerate(random_texts(rng, 80))] + [(None, "w1 w2 w3"), (5, "w1 w1"), (5, "w1 w1")]
    items = [(i, t) for i, t in enumerate(random_texts(rng, 12))] + [(3, "w1 w4"), (None, "w2")]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, _k string, score int")
    asked = spark.createDataFrame([(k, t, 2) for k, t in items], "item_id long, text string, rank int")
    got = lexical.search(frame.repartition(5), asked, top=9, items=block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == searched(docs, items, 9)


def test_search_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs, spark.createDataFrame([(1, None)], "item_id long, text string")).count() == 0


def test_search_long_text(spark):
    long = " ".join(f"t{i}" for i in range(100_000))
    docs = spark.createDataFrame([(1, long + " goal"), (2, "goal"), (3, "t7")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "goal"), (2, long)], "item_id long, text string")
    got = {(r.item_id, r["rank"]): r.doc_id for r in lexical.search(docs, items).collect()}
    assert got == {(1, 1): 2, (1, 2): 1, (2, 1): 1, (2, 2): 3}


def test_shared_sets_are_shared():
    texts = [b"a b c d x%d" % i for i in range(5)] + [b"a b y", b"z"]
    graph = lexical.mine(list(range(7)), texts)
    assert graph.sets

    def leaves(node):
        if node < len(graph.leaves):
            return [graph.leaves[node]]
        return [leaf for part in graph.sets[node - len(graph.leaves)] for leaf in leaves(part)]

    for (_, nodes), text in zip(graph.items, texts, strict=True):
        assert sorted(leaf for node in nodes for leaf in leaves(node)) == sorted(set(text.split()))
    # Five items and the sixth use the set of a and b, the five that of all four.
    assert all(len(nodes) <= 2 for _, nodes in graph.items)


# -- prefix trie -----------------------------------------------------------------------------------


def plain_trie(rows):
    def digest(role, text):
        return hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).digest()[:16]

    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, ts in rebuilt.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    children = defaultdict(list)
    for path in nodes:
        if path:
            children[path[:-1]].append(path)

    def below(path):
        leaves, saved = (0 if children[path] else 1), (len(nodes[path]) - 1) * (len(WORD.findall(path[-1][1])) if path else 0)
        for child in children[path]:
            a, b = below(child)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for path, convs in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(path)))
        leaves, saved = below(path)
        out.append((
            min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), len(children[path]), leaves, saved,
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


TURNS = "conv_id long, turn long, role string, text string, _c string, depth string"


@pytest.mark.parametrize("capacity", [1, 5, 1 << 13])
def test_trie_brute_force(spark, capacity):
    rng = random.Random(7)
    rows = []
    for conv in [*range(-25, 90), 5000, 5001, 9000]:
        for turn in range(rng.randint(1, 6)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["a b", "a b", "c", "", None, "d  e\tf"])))
    # Copies, a chain that splits late, a repeated row, null turns, ties and a null conversation.
    rows += [(c, t, "user", "same text") for c in range(200, 230) for t in range(4)]
    rows += [(c, t, "user", f"deep {t}" if t < 5 else f"{c % 3}") for c in range(300, 312) for t in range(7)]
    rows += [(400, 0, "user", "x"), (400, 0, "user", "x"), (400, None, None, None), (401, 1, "b", "y"), (401, 1, "a", "y")]
    rows += [(None, 0, "user", "lost")]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "c", "d") for r in rows], TURNS)
    got = sorted((tuple(r) for r in prefix_trie.trie(frame, capacity).collect()), key=str)
    assert got == plain_trie(rows)


def test_trie_edges(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x" * 200_000, "", "")], TURNS)
    assert prefix_trie.trie(frame.limit(0)).count() == 0
    assert prefix_trie.trie(frame).count() in (1, 2)


# -- nearest neighbours ----------------------------------------------------------------------------


def plain_nearest(ids, vectors, every=20, top=20):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = vectors @ vectors[i]
        order = [j for j in np.lexsort((ids, -scores)) if j != i][:top]
        out[int(ids[i])] = [(int(ids[j]), float(scores[j])) for j in order]
    return out


def answers(frame):
    out = defaultdict(list)
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_nearest_small_table_is_exact(spark):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-3, 4, (45, 6)).astype(np.float32)
    vectors[vectors.any(axis=1) == 0] = 1
    ids = np.arange(45) * 4
    # Copies of one vector, more of them than are asked for.
    vectors[10:40] = vectors[10]
    bad = [(None, [1.0] * 6), (1001, None), (1002, [0.0] * 6), (1003, []), (1004, [1.0, None] * 3), (1005, [float("nan")] * 6)]
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)] + bad + [(1006, [float("inf")] * 6)]
    rows += rows[:3]
    frame = spark.createDataFrame([(*r, "a", 1.0) for r in rows], "vec_id long, embedding array<float>, _v string, score double")
    got = answers(nn_descent.nearest(frame))
    expected = plain_nearest(ids, vectors.astype(float))
    assert got.keys() == expected.keys()
    for query, found in expected.items():
        assert [x[0] for x in got[query]] == [x[0] for x in found]
        assert np.allclose([x[1] for x in got[query]], [x[1] for x in found], rtol=1e-12)


def test_nearest_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    table = rows.orderBy("vec_id").toArrow()
    ids, vectors = table.column("vec_id").to_numpy(), np.stack(table.column("embedding").to_pylist()).astype(float)
    expected = plain_nearest(ids, vectors)
    got = answers(QUERIES["op11_nn_descent"](spark, "/root/testdata/sf0.01"))
    hits = sum(len({x[0] for x in got[q]} & {x[0] for x in found}) for q, found in expected.items())
    assert hits >= 0.95 * sum(map(len, expected.values()))
    scores = {(q, v): s for q, found in got.items() for v, s in found}
    place = {int(i): n for n, i in enumerate(ids)}
    assert all(abs(s - vectors[place[q]] @ vectors[place[v]]) < 1e-12 for (q, v), s in scores.items())


def test_nearest_edges(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (20, [3.0]), (7, [-1.0, 0.5])], "vec_id long, embedding array<double>")
    assert nn_descent.nearest(frame.limit(0)).count() == 0
    # A shorter vector counts as padded.
    assert answers(nn_descent.nearest(frame)) == {0: [(20, 3.0), (7, 0.0)], 20: [(0, 3.0), (7, -3.0)]}
    assert nn_descent.nearest(frame.where("vec_id = 20")).count() == 0


def test_nearest_blocks():
    asks, held = 1 + nn_descent.NEIGHBOURS + nn_descent.REVERSE, nn_descent.HELD // 200
    # Five times the nodes: five times the vectors sent, as long as a block can hold all.
    assert {nn_descent.block_count(n, asks, n, 200) for n in (20_000, 51_300, 256_500, held)} == {nn_descent.TASKS}
    assert nn_descent.block_count(0, asks, 0, 200) == nn_descent.block_count(500, asks, 500, 200) == 1
    rng = np.random.default_rng(4)
    for n in (800_000, 1_500_000):
        rows = math.ceil(n / nn_descent.block_count(n, asks, n, 200))
        assert 0.95 * held < len(np.unique(rng.integers(0, n, rows * asks))) < 1.01 * held
    # The longer the vectors, the fewer are held.
    assert nn_descent.block_count(n, asks, n, 1000) > 4 * nn_descent.block_count(n, asks, n, 200)


def test_nearest_copies_of_vectors(spark, monkeypatch):
    """The rows in which vectors travel to blocks in the first round, at two sizes."""
    made, compared = {}, nn_descent.compared

    def counted(graph, met, nodes, *rest):
        made[nodes.count()] = met.select("_block", F.explode("_w")).distinct().count()
        return compared(graph, met, nodes, *rest)

    monkeypatch.setattr(nn_descent, "compared", counted)
    rng = np.random.default_rng(5)
    for n in (8_000, 40_000):
        rows = pa.table({"vec_id": np.arange(n), "embedding": list(rng.standard_normal((n, 8)).astype(np.float32))})
        nn_descent.build(nn_descent.node_table(nn_descent.members(spark.createDataFrame(rows))[1]), 1.0)
    assert made[40_000] <= 8 * 40_000
    assert made[40_000] <= 12 * made[8_000]


@pytest.mark.parametrize("held", [1 << 27, 200_000])
def test_nearest_recall_by_blocks(spark, monkeypatch, held):
    """One block holds few vectors or many: the neighbours found are as near."""
    monkeypatch.setattr(nn_descent, "HELD", held)
    rng = np.random.default_rng(6)
    ids, vectors = np.arange(3000) * 2, rng.standard_normal((3000, 24)).astype(np.float32)
    frame = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": list(vectors)}))
    expected, got = plain_nearest(ids, vectors.astype(float)), answers(nn_descent.nearest(frame))
    hits = sum(len({x[0] for x in got[q]} & {x[0] for x in found}) for q, found in expected.items())
    assert hits >= 0.95 * sum(map(len, expected.values()))


def test_nearest_known_pairs():
    lists = pa.array([[7, 9], [], [7]], pa.list_(pa.int16()))
    batch = pa.table(
        {
            "_v": [10, 20, 30], "_q": [b"\x01\xff", b"\x02", b"\x03\x7f"], "_name": pa.array([5, 7, 9], pa.int16()), "_near": lists,
            "_scale": pa.array([1.0] * 3, pa.float32()), "_worst": pa.array([0.0] * 3, pa.float32()),
        }
    ).to_batches()[0]
    # A slice, as blocks are cut from batches, and a second batch.
    known = nn_descent._Vectors([batch.slice(0, 1), batch.slice(1)])
    assert known.q.tolist() == [[1, -1], [2, 0], [3, 127]]
    v, w = np.repeat(np.arange(3), 3), np.tile(np.arange(3), 3)
    assert known.pairs(v, w).reshape(3, 3).tolist() == [[False, True, True], [False] * 3, [False, True, False]]
