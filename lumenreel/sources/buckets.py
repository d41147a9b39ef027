"""Tables in hash buckets with a log of commits, for merges that touch few rows and may come twice.

A table is a folder with ``data`` (Parquet, a folder for each bucket that a commit wrote) and ``log``, whose numbered files say
for each bucket which folder holds it, and for each stream the last batch that is in. A merge rewrites the
buckets that its rows fall into and no other; it counts when its log file is there, which is made by a rename that fails
if another writer was first. A batch that is in already writes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Commits that stay readable; older ones' data goes.
KEEP = 3
_BUCKET = "_bucket"


class Conflict(RuntimeError):
    """Another writer committed in between."""


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _versions(spark: SparkSession, path: str) -> list[int]:
    at, fs = _at(spark, f"{path}/log")
    if not fs.exists(at):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(at))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _state(spark: SparkSession, path: str, version: int) -> dict:
    at, fs = _at(spark, f"{path}/log/{version:020d}.json")
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def _committed(spark: SparkSession, path: str, version: int, state: dict) -> None:
    """The log file is written aside, then renamed to a name that must be free."""
    draft, fs = _at(spark, f"{path}/log/.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(state).encode("utf-8")))
    out.close()
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf)
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, _at(spark, f"{path}/log/{version:020d}.json")[0], none)
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e) or "already exists" in str(e):
            raise Conflict(f"{path} has a version {version} already") from e
        raise


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _written(df: DataFrame, path: str, key: str, n: int) -> dict[str, str]:
    """Where each bucket is that the rows fall into; each is one file or more in a folder of its own."""
    commit = uuid.uuid4().hex
    df.withColumn(_BUCKET, _bucket(F.col(key), n)).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/data/{commit}")
    at, fs = _at(df.sparkSession, f"{path}/data/{commit}")
    names = (s.getPath().getName() for s in fs.listStatus(at))
    return {x.split("=")[1]: f"{commit}/{x}" for x in names if x.startswith(f"{_BUCKET}=")}


def create(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """A new table of ``df`` (one row a key) at ``path``."""
    spark, path = df.sparkSession, path.rstrip("/")
    if _versions(spark, path):
        raise Conflict(f"{path} is a table already")
    state = {"key": key, "buckets": buckets, "schema": df.schema.jsonValue(), "at": _written(df, path, key, buckets), "streams": {}}
    _committed(spark, path, 0, state)


def _rows(spark: SparkSession, path: str, state: dict, only: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    folders = [f"{path}/data/{folder}" for b, folder in sorted(state["at"].items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table's rows, of its last version or of one of the KEEP last."""
    path = path.rstrip("/")
    return _rows(spark, path, _state(spark, path, _versions(spark, path)[-1] if version is None else version))


def merge(new: DataFrame, path: str, batch: int, stream: str = "default", merged: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> bool:
    """Merges ``new`` (one row a key) as ``batch`` of ``stream``: ``merged`` makes of a bucket's rows and the new ones its new rows;
    by default the new ones take the place of those of the same key. False if the batch is in already: nothing is written then. Rows
    with a null key are one key."""
    spark, path = new.sparkSession, path.rstrip("/")
    versions = _versions(spark, path)
    state = _state(spark, path, versions[-1])
    if batch <= state["streams"].get(stream, -1):
        return False
    key, n, schema = state["key"], state["buckets"], T.StructType.fromJson(state["schema"])
    # as many numbers as there are buckets, at most
    touched = [str(r[0]) for r in new.select(_bucket(F.col(key), n).alias("b")).distinct().collect()]
    at = dict(state["at"])
    if touched:
        old = _rows(spark, path, state, touched)

        def replaced(before: DataFrame, rows: DataFrame) -> DataFrame:
            stay = before.alias("o").join(rows.select(key).alias("n"), F.col(f"o.{key}").eqNullSafe(F.col(f"n.{key}")), "left_anti")
            return stay.unionByName(rows.select(*schema.names))

        rows = (merged or replaced)(old, new).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        found = _written(rows, path, key, n)
        at = {b: folder for b, folder in at.items() if b not in touched} | found
    _committed(spark, path, versions[-1] + 1, state | {"at": at, "streams": state["streams"] | {stream: batch}})
    _forget(spark, path)
    return True


def _forget(spark: SparkSession, path: str) -> None:
    """Deletes what none of the last KEEP versions refers to, but for folders that a write may still be filling: a commit's folder goes only
    if an older version had it."""
    versions = _versions(spark, path)
    old, kept = versions[:-KEEP], versions[-KEEP:]
    live = {folder for v in kept for folder in _state(spark, path, v)["at"].values()}
    for v in old:
        for folder in set(_state(spark, path, v)["at"].values()) - live:
            at, fs = _at(spark, f"{path}/data/{folder}")
            fs.delete(at, True)
        at, fs = _at(spark, f"{path}/log/{v:020d}.json")
        fs.delete(at, False)
