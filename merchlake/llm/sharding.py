"""Sharding by fixed virtual slots.

A record's hash names one of a fixed number of slots. Bytes are added up per slot, and a small
versioned table maps slots to shards. Version 0 deals the slots round; rebalancing edits the map
by moving or swapping single slots, and adding a shard moves slots to the new one only. A run that
finds a stored map edits its latest version and appends the next; it deals anew only where none is
stored. Only the map, one row per slot, ever reaches the driver; records follow it by a join with
that table.

Nulls and edge cases: a null text has size 1 and checksum 0; records with a null doc_id are hashed
by their checksum; equal rows share a slot; an empty table gives an empty result and the map of
version 0 unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchlake.llm import common as C
from merchlake.session import scratch_path

SLOTS = 4096
_STORED = "version int, slot int, shard int"


@dataclass
class SlotMap:
    """Shard of each slot, with a version that every edit raises."""

    shards: int
    owner: np.ndarray
    version: int = 0
    moved: list[int] = field(default_factory=list)

    @classmethod
    def dealt(cls, shards: int, slots: int = SLOTS) -> SlotMap:
        return cls(shards, np.arange(slots) % shards)

    def loads(self, sizes: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=sizes, minlength=self.shards)

    def rebalanced(self, sizes: np.ndarray) -> SlotMap:
        """The map after moving or swapping slots between the fullest and the emptiest shard until
        neither brings them closer."""
        owner, moved = self.owner.copy(), []
        loads = self.loads(sizes)
        # Shards whose slots are too large to give one away; the others still even out. Every edit
        # brings two loads of whole bytes closer, so this ends.
        stuck = np.zeros(self.shards, bool)
        while not stuck.all():
            full, low = int(np.argmax(np.where(stuck, -1, loads))), int(np.argmin(loads))
            gap = loads[full] - loads[low]
            give = np.flatnonzero((owner == full) & (sizes > 0))
            take = np.flatnonzero(owner == low)
            # What changes hands: a slot against none or against a smaller one.
            against = np.unique(np.r_[0, sizes[take]])
            wanted = sizes[give] - gap / 2
            near = np.clip(np.searchsorted(against, wanted), 1, max(1, len(against) - 1)) if len(give) else wanted
            best, change = np.inf, None
            for offset in (-1, 0):
                if not len(give) or len(against) + offset < 1:
                    continue
                other = against[np.minimum(near.astype(int) + offset, len(against) - 1)]
                miss = np.abs(wanted - other)
                at = int(np.argmin(miss))
                if miss[at] < best:
                    best, change = miss[at], (int(give[at]), float(other[at]))
            if change is None or not 0 < sizes[change[0]] - change[1] < gap:
                stuck[full] = True
                continue
            slot, back = change
            owner[slot] = low
            moved.append(slot)
            if back:
                swapped = int(take[np.flatnonzero(sizes[take] == back)[0]])
                owner[swapped] = full
                moved.append(swapped)
            passed = sizes[slot] - back
            loads[full] -= passed
            loads[low] += passed
        return SlotMap(self.shards, owner, self.version + 1, moved)

    def grown(self, sizes: np.ndarray) -> SlotMap:
        """The map with one more shard, which takes slots from the fullest shards until it holds
        its share. No other slot moves."""
        owner, loads = self.owner.copy(), self.loads(sizes)
        share, got, moved = sizes.sum() / (self.shards + 1), 0.0, []
        order = np.argsort(-sizes, kind="stable")
        while got < share:
            # The fullest shard that has a slot to give.
            by_load = np.argsort(-loads, kind="stable")
            fits = next(
                (f for full in by_load if (f := [s for s in order if owner[s] == full and 0 < sizes[s] <= share - got])), []
            )
            if not fits:
                break
            full = int(owner[fits[0]])
            owner[fits[0]] = self.shards
            loads[full] -= sizes[fits[0]]
            got += sizes[fits[0]]
            moved.append(int(fits[0]))
        return SlotMap(self.shards + 1, owner, self.version + 1, moved)

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the stored map."""
        rows = [(self.version, slot, int(shard)) for slot, shard in enumerate(self.owner)]
        frame = spark.createDataFrame(rows, _STORED)
        frame.coalesce(1).write.mode("append").parquet(path)


    @classmethod
    def stored(cls, spark: SparkSession, path: str) -> SlotMap | None:
        """The latest version kept at ``path``, if there is one."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        # One row per slot.
        rows = latest(spark, path).orderBy("slot").collect()
        if not rows:
            return None
        owner = np.array([row["shard"] for row in rows])
        return cls(int(owner.max()) + 1, owner, rows[0]["version"])

    def fitted(self, shards: int, slots: int, sizes: np.ndarray) -> SlotMap:
        """The map grown to ``shards``. Slots are fixed for good, and shards are only added."""
        if len(self.owner) != slots or self.shards > shards:
            raise ValueError(f"the stored map has {len(self.owner)} slots and {self.shards} shards")
        found = self
        while found.shards < shards:
            found = found.grown(sizes)
        return found


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last stored version: version, slot, shard."""
    stored = spark.read.schema(_STORED).parquet(path)
    return stored.where(F.col("version") == stored.agg(F.max("version")).scalar())


def records(docs: DataFrame, slots: int) -> DataFrame:
    """Size, checksum and virtual slot of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        docs.select(C.doc_key().alias("_k"), F.octet_length(text).cast("bigint").alias("_bytes"), text.alias("_text"))
        .select("_k", (F.col("_bytes") + 1).alias("_size"), F.crc32(F.encode("_text", "UTF-8")).alias("_crc"))
        .withColumn("_slot", F.pmod(F.xxhash64("_k", "_crc"), F.lit(slots)).cast("int"))
    )


def shard(docs: DataFrame, shards: int = 8, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """Every document with its shard, balanced by bytes, and its place there (``slot``, gapless
    from 0). The map's versions are kept at ``map_path``, by default in the shared folder."""
    spark = docs.sparkSession
    C.prepare(spark)
    rows = records(docs, slots)
    # At most one row per slot.
    tally = rows.groupBy("_slot").agg(F.sum("_size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect()
    sizes, counts = np.zeros(slots), np.zeros(slots, np.int64)
    for row in tally:
        sizes[row["_slot"]], counts[row["_slot"]] = row["bytes"], row["rows"]
    path = map_path or scratch_path(spark, "slot-map")
    found = SlotMap.stored(spark, path)
    if found is None:
        found = SlotMap.dealt(shards, slots)
        found.save(spark, path)
    if tally:
        edited = found.fitted(shards, slots, sizes).rebalanced(sizes)
        edited.version = found.version + 1
        edited.save(spark, path)
    current = latest(spark, path)
    tallied = spark.createDataFrame([(s, int(n)) for s, n in enumerate(counts)], "_slot int, _rows long")
    # Places in a shard: its slots one after another, each slot's records by id. One row per slot.
    before = Window.partitionBy("shard").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    owners = (
        current.withColumnRenamed("slot", "_slot")
        .join(tallied, "_slot")
        .select("_slot", "shard", "version", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_slot").orderBy("_k", "_crc", "_size")
    return (
        rows.join(F.broadcast(owners), "_slot")
        .withColumn("_place", F.row_number().over(inside))
        .select(
            C.document_id().alias("doc_id"),
            F.col("_size").alias("size"),
            F.col("_crc").alias("text_crc32"),
            F.lit("bytes").alias("law"),
            F.col("shard"),
            (F.col("_before") + F.col("_place") - 1).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            F.col("_slot").alias("virtual_slot"),
            F.col("version").alias("map_version"),
        )
    )
