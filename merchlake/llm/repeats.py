"""Repeated windows of a fixed length across all documents, with memory and shuffles in bounds.

A document is a sequence of symbols (bytes or words). Every window of ``length`` symbols picks one of
its grams by hash, the same one wherever the window stands. Consecutive windows that pick the same
gram travel together as one stretch. What is shuffled:

1. per stretch the gram's hash, the document, the place and a hash of the stretch; stretches whose
   gram occurs once in the corpus end here;
2. equal stretches fold to one row each, map-side first;
3. the symbols of one copy of every distinct stretch whose gram has several of them; these meet by
   gram and are compared exactly, window by window.

Where a gram has very many distinct stretches, no group of them is made. They are cut into blocks of
windows at the same distance from the gram; blocks whose common symbols occur in one stretch only
end here, and the windows of the others are counted by their hashes, map-side first. Documents are
read by all steps whole; only doc_id joins move their texts, of those grams only the stretches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.llm import words as W

# Distinct stretches of a gram that still meet in one group.
MOST_STRETCHES = 4096
POOL_BYTES = 1 << 20
_PLACE = 1 << 32


@dataclass(frozen=True)
class Parsed:
    """A chunk of texts as symbols. ``cut`` gives the bytes of a stretch of symbols."""

    symbols: np.ndarray
    places: np.ndarray
    cut: Callable[[int, int], bytes]


def parse_bytes(data: np.ndarray, offsets: np.ndarray) -> Parsed:
    return Parsed(data, offsets, lambda a, b: data[a:b].tobytes())


def parse_words(data: np.ndarray, offsets: np.ndarray) -> Parsed:
    hashes, starts, ends, places = W.word_hashes(data, offsets)
    return Parsed(hashes, places, lambda a, b: data[starts[a] : ends[b - 1]].tobytes())


@dataclass(frozen=True)
class Windows:
    """Windows of ``length`` symbols that pick among grams of ``gram`` symbols; stretches of hot grams
    are cut into blocks of ``block`` windows. A window has at most 256 grams."""

    parse: Callable[[np.ndarray, np.ndarray], Parsed]
    length: int
    gram: int
    block: int
    most_stretches: int = MOST_STRETCHES


def stretches(parsed: Parsed, spec: Windows) -> tuple[np.ndarray, ...]:
    """Runs of windows that pick the same gram: text, first window in the text, windows, distance of
    the gram from the first window, gram hash, hash of the whole stretch."""
    size = int(parsed.places[-1])
    windows = size - spec.length + 1
    if windows <= 0:
        return tuple(np.empty(0, np.int64) for _ in range(4)) + tuple(np.empty(0, np.uint64) for _ in range(2))
    sums = W.prefix_sums(parsed.symbols)
    grams = W.gram_hash(sums, spec.gram)
    # The smallest hash wins, and of equal ones the leftmost, as the low half is the place.
    low = np.uint64(0xFFFFFFFF)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    span, have = spec.length - spec.gram + 1, 1
    while have < span:
        step = min(have, span - have)
        key = np.minimum(key[: len(key) - step], key[step:])
        have += step
    picked = (key & low).astype(np.int64)
    owner = np.repeat(np.arange(len(parsed.places) - 1, dtype=np.int32), np.diff(parsed.places))
    inside = owner[:windows] == owner[spec.length - 1 :]
    same = inside[1:] & inside[:-1] & (picked[1:] == picked[:-1])
    first = np.flatnonzero(inside & ~np.r_[False, same])
    last = np.flatnonzero(inside & ~np.r_[same, False])
    text = owner[first].astype(np.int64)
    return (
        text,
        first - parsed.places[text],
        last - first + 1,
        picked[first] - first,
        grams[picked[first]],
        W.span_hash(sums, first, last + spec.length),
    )


def occurrences(docs: DataFrame, spec: Windows) -> DataFrame:
    """A row per stretch: gram hash (_g), stretch hash (_s), document (_k), and place, windows and
    gram distance in one number (_at)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_k").to_numpy()
            for start, end, data, offsets in C.text_chunks(batch):
                text, first, many, lead, gram, whole = stretches(spec.parse(data, offsets), spec)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(keys[start:end][text]),
                        pa.array(first << 16 | (many - 1) << 8 | lead),
                    ],
                    names=["_g", "_s", "_k", "_at"],
                )

    return C.texts(docs).mapInArrow(emit, "_g long, _s long, _k long, _at long")


def _occurrence() -> Column:
    """Document and place as one number that orders by document, then place."""
    place = F.shiftright("_at", 16).cast("decimal(20,0)")
    return (F.col("_k").cast("decimal(20,0)") * F.lit(_PLACE).cast("decimal(10,0)") + place).cast("decimal(38,0)")


def shared(docs: DataFrame, spec: Windows) -> DataFrame:
    """The stretches whose gram occurs more than once in the corpus."""
    found = occurrences(docs, spec)
    again = found.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_g")
    # Checkpointed, so that the join reads two plain exchanges and adaptive execution can split a
    # gram that a third of all documents hold.
    return C.stored(found.join(again.checkpoint(), "_g"), "stretches")


def distinct_stretches(found: DataFrame) -> DataFrame:
    """One row per distinct stretch with its first and last occurrence."""
    folded = (
        found.select("_g", "_s", F.col("_at").bitwiseAND(0xFFFF).alias("_shape"), _occurrence().alias("_o"))
        .groupBy("_g", "_s", "_shape")
        .agg(F.min("_o").alias("_first"), F.max("_o").alias("_last"))
    )
    return C.stored(folded, "distinct")


def _several(distinct: DataFrame) -> DataFrame:
    """Grams with several distinct stretches (_g) and how many (_stretches)."""
    return distinct.groupBy("_g").agg(F.count(F.lit(1)).alias("_stretches")).where("_stretches > 1").checkpoint()


def _with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents that hold the first occurrences of ``wanted`` stretches, with these as a list."""
    place = F.pmod("_first", F.lit(_PLACE).cast("decimal(38,0)"))
    per_doc = (
        wanted.select(
            ((F.col("_first") - place) / F.lit(_PLACE)).cast("bigint").alias("_k"),
            F.struct(
                "_g", "_s", place.cast("bigint").alias("_place"), "_shape", (F.col("_first") != F.col("_last")).alias("_again")
            ).alias("_one"),
        )
        # At most as many as the document has stretches.
        .groupBy("_k")
        .agg(F.collect_list("_one").alias("_wanted"))
    )
    return C.texts(docs).join(per_doc, "_k")


def _found_again(
    batches: Iterator[pa.RecordBatch], spec: Windows
) -> Iterator[list[tuple[int, dict, Parsed, np.ndarray, int, int]]]:
    """Per chunk of texts its wanted stretches: document, stretch, chunk, prefix sums, first and end
    symbol."""
    for batch in batches:
        keys = batch.column("_k").to_pylist()
        for start, end, data, offsets in C.text_chunks(batch):
            parsed = spec.parse(data, offsets)
            sums = W.prefix_sums(parsed.symbols)
            out = []
            for text, wanted in enumerate(batch.column("_wanted").slice(start, end - start).to_pylist()):
                first = int(parsed.places[text]) + np.array([one["_place"] for one in wanted], np.int64)
                last = first + (np.array([one["_shape"] for one in wanted], np.int64) >> 8) + spec.length
                # Rows that repeat doc_id may have other texts.
                inside = np.flatnonzero(last <= parsed.places[text + 1])
                own = W.span_hash(sums, first[inside], last[inside]).view(np.int64)
                for at, hashed in zip(inside.tolist(), own.tolist(), strict=True):
                    if hashed == wanted[at]["_s"]:
                        out.append((keys[start + text], wanted[at], parsed, sums, int(first[at]), int(last[at])))
            yield out


def contested(docs: DataFrame, distinct: DataFrame, several: DataFrame, spec: Windows) -> DataFrame:
    """The symbols of one copy of each stretch whose gram has several distinct ones, but not very
    many: _route, where they meet, _k, _place of the first window, _again (whether the stretch occurs
    again), _text."""
    some = several.where(F.col("_stretches") <= spec.most_stretches).select("_g")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _found_again(batches, spec):
            out = [
                (one["_g"], key, one["_place"], one["_again"], parsed.cut(first, end))
                for key, one, parsed, _, first, end in found
            ]
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)],
                names=["_route", "_k", "_place", "_again", "_text"],
            )

    return _with_texts(docs, distinct.join(some, "_g")).mapInArrow(
        emit, "_route long, _k long, _place long, _again boolean, _text binary"
    )


def _hot_stretches(docs: DataFrame, grams: np.ndarray, spec: Windows) -> DataFrame:
    """``occurrences`` of the stretches of some grams, with their symbols (_text)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("_k").to_numpy()
            for start, end, data, offsets in C.text_chunks(batch):
                parsed = spec.parse(data, offsets)
                text, first, many, lead, gram, whole = stretches(parsed, spec)
                hot = np.flatnonzero(np.isin(gram.view(np.int64), grams))
                text, first, many, lead, gram, whole = (x[hot] for x in (text, first, many, lead, gram, whole))
                begin = parsed.places[text] + first
                cut = [parsed.cut(a, b) for a, b in zip(begin.tolist(), (begin + many - 1 + spec.length).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram.view(np.int64)),
                        pa.array(whole.view(np.int64)),
                        pa.array(keys[start:end][text]),
                        pa.array(first << 16 | (many - 1) << 8 | lead),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["_g", "_s", "_k", "_at", "_text"],
                )

    return C.texts(docs).mapInArrow(emit, "_g long, _s long, _k long, _at long, _text binary")


def _up_to(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` numbers from 0: its row, and the number."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)


def hot_windows(docs: DataFrame, distinct: DataFrame, several: DataFrame, spec: Windows) -> DataFrame | None:
    """The windows of one copy of each stretch whose gram has very many distinct ones, in the columns
    of ``occurrences`` as stretches of one window; None if no gram has. Left out are windows of blocks
    whose common symbols occur in one stretch only. Only the stretches of these grams leave their
    documents."""
    many = several.where(F.col("_stretches") > spec.most_stretches).select("_g")
    # At most one for every ``most_stretches`` distinct stretches.
    grams = np.array([row["_g"] for row in many.collect()], np.int64)
    if not len(grams):
        return None

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _binary(batch.column("_text").cast(pa.large_binary()))
            for start, end in C.runs_of(offsets, C.CHUNK_BYTES):
                part = batch.slice(start, end - start)
                gram, key, at = (part.column(c).to_numpy() for c in ("_g", "_k", "_at"))
                windows, lead = (at >> 8 & 0xFF) + 1, at & 0xFF
                parsed = spec.parse(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start])
                sums, first = W.prefix_sums(parsed.symbols), parsed.places[:-1]
                nearest = (lead - windows + 1) // spec.block
                row, block = _up_to(lead // spec.block + 1 - nearest)
                block += nearest[row]
                low = np.maximum(0, lead[row] - (block + 1) * spec.block + 1)
                high = np.minimum(windows[row] - 1, lead[row] - block * spec.block)
                # The symbols that all windows of a block share.
                core = (first + lead)[row] - block * spec.block
                shared_by = W.span_hash(sums, core, core - spec.block + 1 + spec.length)
                route = W.mix(shared_by + gram.view(np.uint64)[row] + block.astype(np.uint64))
                of, each = _up_to(high - low + 1)
                each += (first[row] + low)[of]
                ends = np.r_[0, np.cumsum(high - low + 1)].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(route.view(np.int64)),
                        pa.array(key[row]),
                        pa.array((at >> 16)[row] + low),
                        pa.ListArray.from_arrays(
                            pa.array(ends), pa.array(W.span_hash(sums, each, each + spec.length).view(np.int64))
                        ),
                    ],
                    names=["_g", "_k", "_place", "_windows"],
                )

    place = F.pmod("_first", F.lit(_PLACE).cast("decimal(38,0)"))
    firsts = distinct.join(F.broadcast(many), "_g").select(
        "_s",
        ((F.col("_first") - place) / F.lit(_PLACE)).cast("bigint").alias("_k"),
        (F.shiftleft(place.cast("bigint"), 16) + F.col("_shape")).alias("_at"),
    )
    copies = _hot_stretches(docs, grams, spec).join(firsts, ["_k", "_at", "_s"], "left_semi")
    blocks = C.stored(
        copies.select("_g", "_k", "_at", "_text").mapInArrow(
            emit, "_g long, _k long, _place long, _windows array<long>"
        ),
        "blocks",
    )
    met = blocks.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_g").checkpoint()
    each = blocks.join(met, "_g").select("_g", "_k", "_place", F.posexplode("_windows").alias("_i", "_s"))
    return C.stored(
        each.select("_g", "_s", "_k", F.shiftleft(F.col("_place") + F.col("_i"), 16).alias("_at")), "windows"
    )


@dataclass(frozen=True)
class Pool:
    """Stretches of some routes side by side."""

    route: np.ndarray
    doc: np.ndarray
    place: np.ndarray
    again: np.ndarray
    data: np.ndarray
    offsets: np.ndarray


def resolved(met: DataFrame, judge: Callable[[Pool], tuple[np.ndarray, np.ndarray]], length: int) -> DataFrame:
    """Spans (_k, _start, _end) of windows that ``judge`` names: it gets pools of whole routes and
    returns stretches and windows in them."""

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[Pool]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size < POOL_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            route = table.column("_route").to_numpy()
            # The last route may go on in the next batch.
            whole = int(np.searchsorted(route, route[-1]))
            if whole:
                yield from _pools(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                size = sum(b.nbytes for b in held)
        if held:
            yield from _pools(pa.Table.from_batches(held))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pool in pooled(batches):
            stretch, window = judge(pool)
            start = pool.place[stretch] + window
            # Neighbouring windows make one span.
            cut = np.flatnonzero(np.r_[True, (stretch[1:] != stretch[:-1]) | (window[1:] != window[:-1] + 1)]) if len(
                stretch
            ) else np.empty(0, np.int64)
            end = np.r_[cut[1:], len(stretch)][: len(cut)] - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(pool.doc[stretch[cut]]),
                    pa.array(start[cut]),
                    pa.array(start[end] + length if len(cut) else start[cut]),
                ],
                names=["_k", "_start", "_end"],
            )

    sorted_routes = met.repartition("_route").sortWithinPartitions("_route")
    return sorted_routes.mapInArrow(judged, "_k long, _start long, _end long")


def _pools(table: pa.Table) -> Iterator[Pool]:
    # 64-bit offsets, so that texts of more than 2 GiB stay in one piece.
    at = table.schema.get_field_index("_text")
    wide = table.set_column(at, "_text", table.column("_text").cast(pa.large_binary()))
    (batch,) = wide.combine_chunks().to_batches()
    data, offsets = _binary(batch.column("_text"))
    yield Pool(
        batch.column("_route").to_numpy(),
        batch.column("_k").to_numpy(),
        batch.column("_place").to_numpy(),
        batch.column("_again").to_numpy(zero_copy_only=False),
        data,
        offsets,
    )


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans_of(found: DataFrame, distinct: DataFrame, which: Column, length: int) -> DataFrame:
    """Spans of whole stretches: those occurrences (_o) of distinct stretches that ``which`` names."""
    many = F.shiftright("_at", 8).bitwiseAND(0xFF) + 1
    place = F.shiftright("_at", 16)
    return (
        found.withColumn("_o", _occurrence())
        .join(distinct.where("_first <> _last").select("_g", "_s", "_first"), ["_g", "_s"])
        .where(which)
        .select("_k", place.alias("_start"), (place + many + length - 1).alias("_end"))
    )


def repeated(
    docs: DataFrame, spec: Windows, judge: Callable[[Pool], tuple[np.ndarray, np.ndarray]], which: Column
) -> DataFrame:
    """Spans (_k, _start, _end) of repeated windows: ``which`` names occurrences (_o) of stretches or
    windows by the first of their kind (_first), ``judge`` compares different stretches of a gram."""
    found = shared(docs, spec)
    distinct = distinct_stretches(found)
    several = _several(distinct)
    spans = spans_of(found, distinct, which, spec.length).unionByName(
        resolved(contested(docs, distinct, several, spec), judge, spec.length)
    )
    windows = hot_windows(docs, distinct, several, spec)
    if windows is None:
        return spans
    return spans.unionByName(spans_of(windows, distinct_stretches(windows), which, spec.length))


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Every document with its spans as a list of start * 2^32 + end."""
    # At most as many as the document has windows.
    per_doc = (
        spans.select("_k", (F.shiftleft("_start", 32) + F.col("_end")).alias("_span"))
        .groupBy("_k")
        .agg(F.collect_list("_span").alias("_spans"))
    )
    return C.texts(docs).join(per_doc, "_k", "left")


def covered(size: int, spans: list[int] | None) -> np.ndarray:
    """Which of ``size`` symbols the spans cover."""
    edge = np.zeros(size + 1, np.int64)
    if spans is not None and len(spans):
        packed = np.asarray(spans, np.int64)
        np.add.at(edge, np.minimum(packed >> 32, size), 1)
        np.add.at(edge, np.minimum(packed & 0xFFFFFFFF, size), -1)
    return np.cumsum(edge[:-1]) > 0
