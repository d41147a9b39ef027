"""A manifest kept up to date from a stream of scans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.manifests import rescanned
from ..sources import buckets


def kept_up(scans: DataFrame, path: str, key: str, kept: list[str], carried: list[str] = (), segments: str | None = None, stream: str = "scans") -> DataStreamWriter:
    """A writer that merges each batch of ``scans`` (of a row's versions in a batch the greatest) into the
    table of buckets at ``path`` (see sources.buckets), which has to exist: rows that people filled in keep what they
    have. Only the buckets of a batch's keys are rewritten, and a batch that comes again, after a failure, writes nothing: its
    number is in the table's log, under the name ``stream``."""

    def merge(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy(key).agg(F.max(F.struct(*[c for c in batch.columns if c != key])).alias("r")).select(key, "r.*")
        buckets.merge(newest, path, number, stream, lambda old, new: rescanned(old, new, key, kept, carried, segments))

    return scans.writeStream.foreachBatch(merge).outputMode("append").trigger(availableNow=True)
