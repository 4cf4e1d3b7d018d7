"""Shared by the operators: the shared folder, staged tables, Arrow batches, document columns."""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.sources.shared import drop_path, new_path, shared_dir

#: Bytes in one Arrow batch handed to Python, so that long texts do not pile up.
BATCH_BYTES = 4 << 20
_LIBC = ctypes.CDLL("libc.so.6") if sys.platform == "linux" else None
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, codec: str = "zstd", file_rows: int = 0) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost
    executor takes nothing with it. Shuffle files of the writing query are removed at its end. file_rows: most
    rows in a file, for large rows that readers should take few of at once, and in one piece."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        writer = df.write.option("compression", codec).option("maxRecordsPerFile", file_rows)
        # a file of few rows is one row group, which no two readers share
        (writer.option("parquet.block.size", 1 << 30) if file_rows else writer).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


#: Fewer than so many keys are dealt to several tasks each; a key with fewer rows than this many never is.
HOT_KEYS, HOT_ROWS = 1000, 10_000


def spread(rows: DataFrame, column: str, table: DataFrame, how: str = "inner", rows_of: DataFrame | None = None) -> DataFrame:
    """rows joined with a table that is unique by the column. Keys that more than a thousandth of the rows have (no more than
    HOT_KEYS of them, so the driver lists them) are dealt to many tasks, and so are rows without a key. rows should be a
    staged table, or rows_of a staged one with as many rows and the same keys."""
    counted = rows if rows_of is None else rows_of
    n = counted.count()
    most = max(n // HOT_KEYS, HOT_ROWS)
    if n <= most:
        return rows.join(table, column, how)
    # no more than HOT_KEYS rows, whatever the table is; mostly none, and then the plan stays a plain join
    hot = counted.groupBy(F.col(column).alias("__key")).agg(F.count("*").alias("__n")).where(F.col("__n") > most).collect()
    if not hot:
        return rows.join(table, column, how)
    listed = [(r["__key"], -(-r["__n"] // most)) for r in hot if r["__key"] is not None]
    hot = F.broadcast(rows.sparkSession.createDataFrame(listed, f"__key {counted.schema[column].dataType.simpleString()}, __parts int"))
    parts = F.coalesce("__parts", F.lit(1))
    # rows without a key find nothing, and are dealt out too
    dealt = F.when(F.col(column).isNull(), HOT_KEYS).otherwise(parts)
    left = rows.join(hot, F.col(column) == F.col("__key"), "left").withColumn("__salt", F.pmod(F.monotonically_increasing_id(), dealt).cast("int")).drop("__key", "__parts")
    right = table.join(hot, F.col(column) == F.col("__key"), "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__key", "__parts")
    return left.join(right, [column, "__salt"], how).drop("__salt")


def bound_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Limit the session's Arrow batches to so many bytes, unless they are smaller already; whole rows always stay
    whole. The limit stays, as the frames that operators return are run later."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    given = spark.conf.get(name, None)
    if not (given and given.isdigit() and 0 < int(given) <= size):
        spark.conf.set(name, str(size))


def beside(keep: list[str], outputs: list[str]) -> list[str]:
    """The columns to keep that no output replaces: an output goes before a kept column of its name, in any case."""
    taken = {c.lower() for c in outputs}
    return [c for c in dict.fromkeys(keep) if c.lower() not in taken]


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as decimal text, modulo n; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null"))) % n


def release() -> None:
    """Give freed memory back to the system, so that workers which wait do not hold it."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


#: What operators keep in a Python process for later tasks: a name, and how to drop it. Processes are used again by other
#: operators' tasks, which need the memory.
KEPT: dict = {}


def drop_kept(but: str) -> None:
    """In this process. (Functions sent to it would take a copy of KEPT along, but call this one by its name.)"""
    for name in [k for k in KEPT if k != but]:
        KEPT.pop(name)()


def trimmed(run, own: str = ""):
    """A function over Arrow batches that drops what other operators keep in this process, and gives memory back after
    each batch and at its end."""

    def wrapped(batches):
        drop_kept(own)
        for batch in run(batches):
            yield batch
            release()
        release()

    return wrapped


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column and the n + 1 offsets into them; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]
