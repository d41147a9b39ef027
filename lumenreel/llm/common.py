"""Helpers shared by the operators: shared scratch tables, Arrow maps."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Setting that names the folder which driver and executors share.
CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Where shared_dir keeps the folder that it makes for a local session.
LOCAL_CONF = "lumenreel.local.dir"
#: Bytes of an Arrow batch.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the session's own setting. Only where that is unset (tests in one
    process) a fresh local folder is made; it is kept under a name of our own, as Spark lets nobody set
    its setting in a running session."""
    found = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if found:
        return found
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
    found = spark.conf.get(LOCAL_CONF, None)
    if not found:
        found = tempfile.mkdtemp(prefix="lumenreel-")
        spark.conf.set(LOCAL_CONF, found)
    return found


def bounded(spark: SparkSession) -> None:
    """Lowers what the session puts into one Arrow batch to BATCH_BYTES: rows here are whole texts, and a
    batch is held several times over by a task and its Python workers."""
    now = spark.conf.get(BATCH_CONF).rstrip("b")
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: it cuts the lineage, and
    a lost executor costs nothing that was already written."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what stored() wrote; nothing may read it afterwards."""
    for df in tables:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        at = jvm.org.apache.hadoop.fs.Path(df._stored_at)
        at.getFileSystem(conf).delete(at, True)


def lean(run: Callable) -> Callable:
    """A function over batches that gives its memory back at its end: workers are used again, and
    what allocators keep for later adds up."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``size`` bytes in ``column``; a longer row is alone or last."""
    n = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero(np.diff(np.cumsum(n, dtype=np.int64) // size)) + 1
    at = [0, *edges.tolist(), batch.num_rows]
    for lo, hi in zip(at, at[1:], strict=False):
        if hi > lo:
            yield batch.slice(lo, hi - lo)
