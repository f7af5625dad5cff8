"""What the operators share: session set-up, row keys, Arrow batches of texts, connected components.

Every operator takes the columns it names and leaves the caller's other columns alone: its own
working columns start with an underscore and are made from a narrow projection, so extra columns
with clashing names never meet them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlake.session import ensure_checkpoint_dir, scratch_path

# Documents per Arrow batch. Long texts make a row count a poor bound on memory; this one keeps a
# batch of 100 KB texts at 50 MB.
ARROW_ROWS = 500
# Bytes of text that one vectorised step works on at a time.
CHUNK_BYTES = 1 << 19
# Stands for a null doc_id in joins; it sorts before every other id.
NULL_ID = -(1 << 63)


def prepare(spark: SparkSession) -> None:
    """Settings that the operators' plans rely on; called by each of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ensure_checkpoint_dir(spark)


def doc_key() -> Column:
    """doc_id as a join key that is never null, so null ids neither vanish nor need special joins."""
    return F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID).cast("bigint"))


def document_id(key: str = "_k") -> Column:
    """The doc_id behind a key made by ``doc_key``."""
    return F.when(F.col(key) != F.lit(NULL_ID).cast("bigint"), F.col(key))


def texts(docs: DataFrame) -> DataFrame:
    """``_k`` and ``_text`` (null: empty) of every document."""
    return docs.select(
        doc_key().alias("_k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the cluster's shared folder and read back: cuts the lineage, survives
    lost executors, and later steps read only the columns they need."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table made by ``stored`` that nothing will read again."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_name(prefix: str) -> str:
    """A column name that no input has."""
    return f"_{prefix}_{uuid.uuid4().hex[:12]}"


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and the offsets of its values, without a copy. Nulls are empty."""
    column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of values of at most ``most`` bytes together; a longer value stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def text_chunks(
    batch: pa.RecordBatch, column: str = "_text", most: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A batch's texts in pieces of bounded size: first row, last row, bytes, offsets."""
    data, offsets = string_bytes(batch.column(column))
    for first, last in runs_of(offsets, most):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (_a, _b): every node (_node) with its component's smallest
    node (_root).

    Neighbours' smallest labels are taken over alternately from larger and smaller neighbours
    (large star, small star), which halves the depth of trees in each round; both keep every
    component connected. A node with many neighbours is pre-aggregated map-side, and no row holds a
    neighbour list. Each round is checkpointed. Labels that are not final after ``rounds`` are an
    error.
    """
    links = edges.where("_a <> _b").select(F.greatest("_a", "_b").alias("_v"), F.least("_a", "_b").alias("_u"))
    links = links.distinct().checkpoint()
    for _ in range(rounds):
        # Large star: a node's larger neighbours hang on its smallest neighbour (or itself).
        both = links.select("_v", "_u").union(links.select(F.col("_u").alias("_v"), F.col("_v").alias("_u")))
        least = both.groupBy("_v").agg(F.min("_u").alias("_m"))
        # Checkpointed, so that the join can split a node that very many links share.
        least = least.select("_v", F.least("_v", "_m").alias("_m")).checkpoint()
        large = (
            links.select(F.col("_u").alias("_n"), F.col("_v").alias("_w"))
            .join(least.withColumnRenamed("_v", "_n"), "_n")
            .select(F.col("_w").alias("_v"), F.col("_m").alias("_u"))
            .distinct()
            .checkpoint()
        )
        # Small star: a node and its smaller neighbours hang on the smallest of them.
        least = large.groupBy("_v").agg(F.min("_u").alias("_m"))
        joined = large.join(least, "_v")
        small = (
            joined.select(F.explode(F.array("_v", "_u")).alias("_v"), F.col("_m").alias("_u"))
            .where("_v <> _u")
            .distinct()
            .checkpoint()
        )
        # Stable once every node hangs on one node and no root hangs on another.
        again = small.groupBy("_v").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
        roots = small.select(F.col("_u").alias("_v")).join(small.select("_v"), "_v", "left_semi")
        links = small
        if again.select("_v").unionAll(roots.select("_v")).isEmpty():
            break
    else:
        raise RuntimeError(f"components are not final after {rounds} rounds")
    return links.select(F.col("_v").alias("_node"), F.col("_u").alias("_root"))
