"""Best-two-fit packing of tokenised documents into sequences of bounded length.

Documents are tokenised and cut on the executors; what is packed are the lengths of the pieces. A
histogram of lengths, at most one number per possible length, is packed on the driver: a bin opens
with the longest piece left, is filled greedily with the longest piece that fits, and then its
smallest piece gives way to the two unpacked pieces that fill the widened gap most tightly, if they
fill it better. Equal bins are made in one step, as many as the counts allow; every step leaves some
length with less than half of its count, so there are at most lengths times log2(rows) steps. Pieces
then find their place by their rank among pieces of equal length, which is counted in buckets, so
that no length meets in one task.

Nulls and edge cases: a null text is empty, and an empty text is one token, the closing id; repeated
rows are packed as often as they occur; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from merchlake.llm import common as C

CAPACITY = 2048
CLOSING_ID = 0
# Words that a Python worker remembers the ids of.
CACHED_WORDS = 400_000
PIECE = "_k long, piece int, start long, length long, ids_crc32 long"

# The pattern and the byte alphabet of the tokenizer's vocabulary file.
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
# White space for str.split that is none for the tokenizer, and what may start a special token.
_ODD = re.compile(r"[\x1c-\x1f]|<\|")
# Runs of Latin-1 characters that are neither letters, numbers, white space nor apostrophes.
_MARKS = re.compile("([^\\sa-zªµºß-öø-ÿ0-9²³¹¼½¾']+)")


def _alphabet() -> dict[int, str]:
    others = [b for b in range(256) if b not in set(_PLAIN)]
    return {**{b: chr(b) for b in _PLAIN}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class Encoder(dict):
    """Ids of words as little-endian bytes, each distinct word tokenised once.

    The tokenizer drops white space and never joins what it parts, so a text's ids are those of its
    words one after another. Words of Latin-1 characters go straight to the vocabulary's merges; any
    other word, and a text with something special in it, goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model.tokenize
        self.alphabet = _alphabet()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            ids = [token.id for token in self.merges(word.lower())]
        elif max(word) <= "\xff" and unicodedata.is_normalized("NFC", word):
            ids = [
                token.id
                for piece in _PIECES.findall(word.lower())
                for token in self.merges(piece.encode().decode("latin-1").translate(self.alphabet))
            ]
        else:
            found = self[word] = self._whole(word)
            return found
        found = self[word] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def ids(self, text: str) -> bytes:
        if _ODD.search(text):
            return self._whole(text)
        if len(self) > CACHED_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, self._parted(text)))

    @staticmethod
    def _parted(text: str) -> list[str]:
        """Words, with punctuation apart where that is plain: fewer distinct ones to remember.
        Apostrophes join with letters in ways that only the pattern knows."""
        if "'" not in text:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return text.split()
            return _MARKS.sub(r" \1 ", text.lower()).split()
        return text.split()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def pieces(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Documents as token pieces of at most ``capacity``: _k, piece, start, length, ids_crc32, and
    the ids as little-endian bytes on request."""
    C.prepare(docs.sparkSession)
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch.column("_k").to_pylist(), batch.column("_text"), strict=True):
                ids = memoryview(words.ids(text.as_py()) + closing)
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((key, number, at // 4, len(part) // 4, zlib.crc32(part), bytes(part) if with_ids else b""))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
            names = ["_k", "piece", "start", "length", "ids_crc32", "ids"]
            size = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays(arrays[:size], names=names[:size])

    return C.texts(docs).mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """Bins for ``counts[length]`` pieces of each length: (how many equal bins, {length: pieces in
    one bin})."""
    left = counts.astype(np.int64).copy()
    lengths = np.arange(capacity + 1)
    bins = []
    while left.any():
        free = left.copy()
        content: dict[int, int] = {}
        room = capacity
        # The longest length available up to each length.
        fitting = np.maximum.accumulate(np.where(free > 0, lengths, 0))
        while room and (pick := int(fitting[room])):
            many = min(int(free[pick]), room // pick)
            free[pick] -= many
            content[pick] = content.get(pick, 0) + many
            room -= many * pick
            if not free[pick]:
                fitting = np.maximum.accumulate(np.where(free > 0, lengths, 0))
        if room and sum(content.values()) > 1:
            smallest = min(content)
            gap = room + smallest
            first = lengths[1 : gap + 1][free[1 : gap + 1] > 0]
            # The best partner of each length; a length with one piece left is no partner of itself.
            rest = np.minimum(gap - first, first)
            second = fitting[rest]
            single = (second == first) & (free[first] < 2)
            second = np.where(single, fitting[np.maximum(rest - 1, 0)], second)
            both = np.where(second > 0, first + second, 0)
            if len(both) and both.max() > smallest:
                at = int(np.argmax(both))
                content[smallest] -= 1
                for length in (int(first[at]), int(second[at])):
                    content[length] = content.get(length, 0) + 1
                content = {k: v for k, v in content.items() if v}
        times = min(int(left[length]) // many for length, many in content.items())
        for length, many in content.items():
            left[length] -= many * times
        bins.append((times, content))
    return bins


def places(bins: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """For every length the ranks that each kind of bin takes: (length, first rank, rank after the
    last, first sequence, pieces in one bin, offset of the first)."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, content in bins:
        offset = 0
        for length in sorted(content, reverse=True):
            many, rank = content[length], taken.get(length, 0)
            rows.append((length, rank, rank + many * times, sequence, many, offset))
            taken[length] = rank + many * times
            offset += many * length
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    # Written once: tokenising is the dear part, and ranks must not change between two readings.
    cut = C.stored(pieces(docs, tokenizer, capacity), "pieces")
    # At most one row per length.
    tally = cut.groupBy("length").agg(F.count(F.lit(1)).alias("_rows")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in tally:
        counts[row["length"]] = row["_rows"]
    table = spark.createDataFrame(
        pa.table(
            dict(
                zip(
                    ("length", "_from", "_to", "_sequence", "_many", "_offset"),
                    np.array(places(plan(counts, capacity)), np.int64).reshape(-1, 6).T,
                    strict=True,
                )
            )
        )
    )
    by_length = table.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("_from", "_to", "_sequence", "_many", "_offset"))).alias("_bins")
    )
    buckets = max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = cut.withColumn("_bucket", F.pmod(F.xxhash64("_k", "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        rows.groupBy("length", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("length", "_bucket").orderBy("_k", "piece", "ids_crc32")
    ranked = (
        rows.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(earlier, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        # Bounded by the number of lengths and kinds of bins, whatever the input's size.
        .join(F.broadcast(by_length), "length")
        .withColumn("_bin", F.expr("filter(_bins, b -> _rank >= b._from AND _rank < b._to)[0]"))
        .withColumn("_nth", F.col("_rank") - F.col("_bin._from"))
    )
    return ranked.select(
        C.document_id().alias("doc_id"),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_bin._sequence") + F.floor(F.col("_nth") / F.col("_bin._many"))).cast("bigint").alias("sequence_id"),
        (F.col("_bin._offset") + F.pmod("_nth", "_bin._many") * F.col("length")).cast("bigint").alias("offset"),
    )


def sequences(docs: DataFrame, packed: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids as little-endian bytes."""
    ids = pieces(docs, tokenizer, capacity, with_ids=True).select("_k", "piece", "ids_crc32", "ids")
    where = packed.select(C.doc_key().alias("_k"), "piece", "ids_crc32", "sequence_id", "offset")
    # A sequence holds at most ``capacity`` ids.
    return (
        where.join(ids.dropDuplicates(["_k", "piece", "ids_crc32"]), ["_k", "piece", "ids_crc32"])
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("_parts"))
        .select("sequence_id", F.expr("aggregate(_parts, X'', (whole, p) -> concat(whole, p.ids))").alias("ids"))
    )
