"""Versioned Parquet tables under one root, and the JDBC sink."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlake import schemas as S
from merchlake.session import folder_bytes, freed_shuffles, scratch_path

# Tables whose single days grow with the data. The other metric tables hold a row per day and
# channel, province or category; a directory per day would hold next to nothing.
BY_DAY = (
    "ods_order_detail",
    "dwd_staged",
    "dwd_order_detail",
    "dwd_clean_reject",
    "ads_product_stat",
    "dws_order_key",
    "dws_user_key",
)
# Columns that a table is laid out by without declaring them.
LOAD_DAY = "load_day"
_DAY_COLUMN = {"ods_order_detail": LOAD_DAY, "dwd_clean_reject": LOAD_DAY}
# Inside a day, files are sorted by these, so that their row groups can be skipped.
_SORTED = {"dwd_order_detail": ("order_time",), "dws_order_key": ("order_id",), "dws_user_key": ("user_id",)}

# Files of tables and scratch tables.
CODEC = "zstd"
# Wide exchanges of larger tables are made part by part, so that their shuffle files do not all lie on
# disk at once: a part for as many bytes of stored rows, and as many parts at most.
PART_BYTES, MOST_PARTS = 512_000_000, 8


def write_parquet(df: DataFrame, folder: str, mode: str = "errorifexists", by: tuple[str, ...] = ()) -> None:
    """Write ``df``; its shuffle files go when it is written."""
    writer = df.write.mode(mode).option("compression", CODEC)
    with freed_shuffles(df.sparkSession):
        (writer.partitionBy(*by) if by else writer).parquet(folder)


def parts_of(size: int) -> int:
    return max(1, min(MOST_PARTS, -(-size // PART_BYTES)))


def in_parts(df: DataFrame, number: Column, parts: int) -> list[DataFrame]:
    """``df`` as several frames: rows of equal ``number``, an integer that may be null, stay together."""
    if parts == 1:
        return [df]
    place = F.pmod(F.coalesce(number, F.lit(0)), F.lit(parts))
    return [df.where(place == part) for part in range(parts)]


def day_parts(df: DataFrame, day: str, parts: int) -> list[DataFrame]:
    """``df`` as several frames of whole days, rows of no day in one of them."""
    return in_parts(df, F.unix_date(F.col(day)), parts)


class Scratch:
    """An intermediate table in the shared folder, written at once or part by part, and dropped when it
    is not read any more, at the latest when the application ends."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.path, self._schema = spark, scratch_path(spark, label), None

    def add(self, df: DataFrame, by: tuple[str, ...] = ()) -> Scratch:
        write_parquet(df, self.path, "append", by)
        self._schema = self._schema or df.schema
        return self

    def read(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self.path)

    def bytes(self) -> int:
        return folder_bytes(self.spark, self.path)

    def drop(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored_once(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a scratch table and read back."""
    return Scratch(df.sparkSession, label).add(df).read()


@dataclass(frozen=True)
class Cover:
    """The rows of earlier versions that a version stands for: everything, ranges of days (first and
    last, as text), rows without a day, or nothing (an addition)."""

    everything: bool = False
    ranges: tuple[tuple[str, str], ...] = ()
    loose: bool = False

    @classmethod
    def of_days(cls, days: Iterable[str], loose: bool = False) -> Cover:
        """Single days; those that follow each other make one range."""
        ranges: list[list[dt.date]] = []
        for day in sorted(map(dt.date.fromisoformat, days)):
            if ranges and day - ranges[-1][1] <= dt.timedelta(days=1):
                ranges[-1][1] = day
            else:
                ranges.append([day, day])
        return cls(ranges=tuple((str(first), str(last)) for first, last in ranges), loose=loose)

    def rows(self, day: str | None) -> Column:
        if self.everything or day is None:
            return F.lit(self.everything)
        parts = [f"{day} BETWEEN DATE'{first}' AND DATE'{last}'" for first, last in self.ranges if first != last]
        # Single days as one set, which stays a short expression however many there are.
        single = [f"DATE'{first}'" for first, last in self.ranges if first == last]
        if single:
            parts.append(f"{day} IN ({', '.join(single)})")
        if self.loose:
            parts.append(f"{day} IS NULL")
        return F.expr(f"coalesce({' OR '.join(parts)}, false)") if parts else F.lit(False)

    def contains(self, other: Cover) -> bool:
        """Whether nothing that ``other`` stands for outlives this version."""
        if self.everything:
            return True
        if other.everything or (other.loose and not self.loose) or other == Cover():
            return False
        return all(any(a <= first and last <= b for a, b in self.ranges) for first, last in other.ranges)


@dataclass(frozen=True)
class Warehouse:
    """The declared tables, each a folder of versions and manifests.

    A write fills a version folder of its own, ``version=NUMBER-ID``, laid out by day for the tables
    in ``by_day``. It is published by one small file in ``_manifest`` that lists the live versions in
    order with the days each of them replaced; the file appears under its number by a rename. Readers
    take the newest manifest and leave out rows that a later version covers, which prunes day
    folders. So readers see a table as it was before or after a write and never in between, a write
    that fails leaves nothing but an unnamed folder, a plan made before a write can still run, and
    replacing some days writes these days only. ``vacuum`` deletes what is no longer named.

    A rename that must not replace a file is exclusive on HDFS; elsewhere one writer per table at a
    time is assumed.
    """

    spark: SparkSession
    root: str
    by_day: tuple[str, ...] = BY_DAY

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    # --- reading ------------------------------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        return self._live(table).select(*S.table_columns(table))

    def rows(self, table: str) -> int:
        """Row count of the live versions. Counting what was written, rather than adding up task
        metrics, stays exact when tasks are run again after a lost executor."""
        return self.read(table).count()

    def bytes(self, table: str) -> int:
        """Size of the live versions' files."""
        return sum(folder_bytes(self.spark, self._folder(table, version)) for version in self.versions(table))

    def versions(self, table: str) -> list[str]:
        """The versions that readers see, oldest first."""
        return [version for version, _ in self._entries(table)]

    def read_dated(self, table: str) -> DataFrame:
        """The table with the column it is laid out by, declared or not."""
        return self._live(table).select(*self._columns(table))

    def _live(self, table: str) -> DataFrame:
        entries = self._entries(table)
        if not entries:
            raise FileNotFoundError(f"table {table} has no version under {self.path(table)}")
        schema = T.StructType([*self._schema(table).fields, T.StructField("version", T.StringType())])
        reader = self.spark.read.schema(schema).option("basePath", self.path(table))
        rows = reader.parquet(*[self._folder(table, version) for version, _ in entries])
        day = self._day(table)
        for place, (version, _) in enumerate(entries):
            later = [cover.rows(day) for _, cover in entries[place + 1 :] if cover != Cover()]
            if later:
                rows = rows.where((F.col("version") != version) | ~reduce(lambda a, b: a | b, later))
        return rows

    # --- writing ------------------------------------------------------------------------------

    def overwrite(self, table: str, df: DataFrame | Iterable[DataFrame]) -> None:
        """Replace the whole table; running it twice leaves one copy. Here and in ``replace``, several
        frames are written one after the other and published as one version."""
        self._write(table, df, Cover(everything=True))

    def replace_days(self, table: str, df: DataFrame, start: str, end: str, loose: bool = False) -> None:
        """Replace all rows of a range of days, inclusive, and with ``loose`` those without a day, by
        ``df``, whose rows lie there. Days that ``df`` does not hold end up empty."""
        self._write(table, df, Cover(ranges=((start, end),), loose=loose))

    def replace(self, table: str, df: DataFrame | Iterable[DataFrame], cover: Cover) -> None:
        """Replace the rows that ``cover`` names by ``df``, whose rows lie there."""
        self._write(table, df, cover)

    def append(self, table: str, df: DataFrame) -> None:
        self._write(table, df, Cover())

    def vacuum(self, table: str, manifests: int = 2) -> None:
        """Delete versions that none of the newest ``manifests`` manifests names, the rest of failed
        writes included, and older manifests. Plans made from those can no longer run."""
        numbers = self._numbers(table)
        keep = numbers[-manifests:]
        live = {version for number in keep for version, _ in self._manifest(table, number)}
        system, path = self._files(self.path(table))
        for entry in system.listStatus(path):
            name = entry.getPath().getName()
            version = name.removeprefix("version=")
            # A folder of the number to come may be a write under way.
            if name.startswith("version=") and version not in live and keep and int(version.split("-")[0]) <= keep[-1]:
                system.delete(entry.getPath(), True)
        for number in numbers[:-manifests]:
            system.delete(self._files(self._manifest_path(table, number))[1], False)

    def _write(self, table: str, df: DataFrame | Iterable[DataFrame], cover: Cover) -> None:
        numbers = self._numbers(table)
        number = numbers[-1] + 1 if numbers else 1
        version = f"{number:08d}-{uuid.uuid4().hex[:8]}"
        day = self._day(table)
        for part in [df] if isinstance(df, DataFrame) else df:
            rows = part if day is None or day in part.columns else part.withColumn(day, F.lit(None).cast("date"))
            rows = rows.select(*self._columns(table))
            if table in self.by_day:
                # Rows of a day meet in few tasks, so few files; adaptive execution splits a hot
                # day over several tasks and merges small ones.
                rows = rows.hint("rebalance", day)
                if table in _SORTED:
                    rows = rows.sortWithinPartitions(day, *_SORTED[table])
            by = (day,) if table in self.by_day else ()
            write_parquet(rows, self._folder(table, version), "append", by)
        before = [] if cover.everything else self._entries(table)
        self._publish(table, number, [*[e for e in before if not cover.contains(e[1])], (version, cover)])

    # --- manifests ----------------------------------------------------------------------------

    def _publish(self, table: str, number: int, entries: list[tuple[str, Cover]]) -> None:
        text = json.dumps([{"version": version, **vars(cover)} for version, cover in entries])
        target = self._manifest_path(table, number)
        system, path = self._files(target)
        system.mkdirs(path.getParent())
        _, draft = self._files(f"{self.path(table)}/_manifest/_draft-{uuid.uuid4().hex}")
        stream = system.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        if system.exists(path) or not system.rename(draft, path):
            system.delete(draft, False)
            raise RuntimeError(f"another writer published version {number} of {table} first")

    def _entries(self, table: str) -> list[tuple[str, Cover]]:
        numbers = self._numbers(table)
        return self._manifest(table, numbers[-1]) if numbers else []

    def _manifest(self, table: str, number: int) -> list[tuple[str, Cover]]:
        system, path = self._files(self._manifest_path(table, number))
        stream = system.open(path)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        entries = []
        for entry in json.loads(text):
            version = entry.pop("version")
            entries.append((version, Cover(**{**entry, "ranges": tuple(map(tuple, entry["ranges"]))})))
        return entries

    def _numbers(self, table: str) -> list[int]:
        system, path = self._files(f"{self.path(table)}/_manifest")
        if not system.exists(path):
            return []
        names = [entry.getPath().getName() for entry in system.listStatus(path)]
        return sorted(int(name) for name in names if name.isdigit())

    def _manifest_path(self, table: str, number: int) -> str:
        return f"{self.path(table)}/_manifest/{number:08d}"

    def _folder(self, table: str, version: str) -> str:
        return f"{self.path(table)}/version={version}"

    def _files(self, path: str):
        """The file system of a path, and the path as its own kind of object."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    # --- columns ------------------------------------------------------------------------------

    def _day(self, table: str) -> str | None:
        return _DAY_COLUMN.get(table, "stat_date" if "stat_date" in S.table_columns(table) else None)

    def _columns(self, table: str) -> list[str]:
        declared = S.table_columns(table)
        day = self._day(table)
        return declared if day is None or day in declared else [*declared, day]

    def _schema(self, table: str) -> T.StructType:
        declared = S.TABLES[table]
        schema = T.StructType.fromDDL(declared) if isinstance(declared, str) else T.StructType(list(declared.fields))
        return schema.add(LOAD_DAY, "date") if table in _DAY_COLUMN else schema


def jdbc_writer(df: DataFrame, batch_size: int = 2000) -> DataFrameWriter:
    return (
        df.write.mode("append")
        .option("batchsize", batch_size)
        .option("isolationLevel", "READ_COMMITTED")
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    connections: int | None = None,
    batch_size: int = 2000,
) -> None:
    """Append to a relational table in batches, straight from the executors.

    ``connections`` limits how many tasks write at once.
    """
    # A repartition leaves the stages before it as wide as they are; only the writing is limited.
    out = df.repartition(connections) if connections else df
    jdbc_writer(out, batch_size).jdbc(url, table, properties=properties)
