"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A local temporary folder is used only where the setting is absent, as in
    tests on one machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="fraudflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and a table that is used several times is made once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing reads any more."""
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def text_keys(text: Column) -> list[Column]:
    """Two halves of 128 bits of its SHA-256 digest, which identify a text."""
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name) for name, at in (("k1", 1), ("k2", 17))]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the row offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    held = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


def batches(rows, most_bytes: int, column: str):
    """Slices of the record batches in ``rows`` with about ``most_bytes`` of ``column``.

    A row is never split, so a slice can exceed the bound by one text.
    """
    for batch in rows:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(batch.schema.get_field_index(column)))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(at, at[begin] + most_bytes, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
