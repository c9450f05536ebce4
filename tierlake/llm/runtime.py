"""What the operators of this subpackage share: worker settings, shared scratch tables, row texts."""

import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that one Arrow batch may hold; they bound what a Python worker sees at once.
BATCH_ROWS = 512
BATCH_BYTES = 4 * 1024**2

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches and let Python workers import this package from the driver's path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.sparkContext.environment.setdefault("PYTHONPATH", PACKAGE_ROOT)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share.

    That is ``spark.checkpoint.dir``. Only where it is unset on a single machine, as in tests, a
    temporary folder takes its place; a cluster has to name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tierlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tierlake/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to shared scratch and read back: lineage ends there, lost executors or not."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column end to end, and the offsets of its rows (nulls are empty)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def slices(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Consecutive byte ranges of a buffer as an Arrow array; ``starts`` also holds the end."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(starts, np.int64)), pa.py_buffer(data)],
    )


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``[start, start + length)``, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)
