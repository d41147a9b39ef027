"""Sinks: subtitle text, CSV, archives' contents, reports, and tables replaced whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import srt_time, two_lines

BOM = "\ufeff"
#: The file that names the version of a table which readers see.
CURRENT = "CURRENT"


def srt(segments: DataFrame, key: str = "clip_id", text: Column | str = "text") -> DataFrame:
    """key, srt: numbered blocks of the segments (start, end, text) in order, texts in two lines; blank texts
    are skipped and leave no gap in the numbers."""
    said = F.col(text) if isinstance(text, str) else text
    s = segments.withColumn("_said", said).where(F.coalesce("_said", F.lit("")) != "").withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("start", "end", "_said")))
    block = F.concat(F.col("n").cast("string"), F.lit("\n"), srt_time(F.col("start")), F.lit(" --> "), srt_time(F.col("end")), F.lit("\n"), two_lines(F.col("_said")), F.lit("\n"))
    return s.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", block.alias("b")))), lambda x: x["b"]), "\n").alias("srt"))


def translated(segments: Column, original: Column) -> Column:
    """The translation (a map's value, or null where the key is absent), even an empty one, else the original."""
    return F.coalesce(segments, original)


def csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """A CSV of fixed columns (missing ones are empty) with a header and a byte-order mark."""
    out = df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns])
    out.toDF(BOM + columns[0], *columns[1:]).write.mode("overwrite").option("header", True).csv(path)


def archive(files: DataFrame, path: str = "path", name: str = "name", job: str = "job", order: tuple[str, ...] = ("job", "pos")) -> DataFrame:
    """What goes into an archive: path and arcname, the name; of equal names the first in order keeps it,
    the others get their job in front. (Packing bytes is a file system's work.)"""
    first = F.row_number().over(Window.partitionBy(name).orderBy(*order)) == 1
    return files.select(path, F.when(first, F.col(name)).otherwise(F.concat(F.col(job).cast("string"), F.lit("_"), F.col(name))).alias("arcname"))


def campaign_report(ads: DataFrame, campaign: str = "campaign", adset: str = "adset", targets: Column | None = None) -> DataFrame:
    """One row, ``report``: campaigns (those that begin with BGM first, then by name) with their number
    of ads and targets, and their ad sets, the largest first. As long as there are ad sets."""
    sets = ads.groupBy(campaign, adset).agg(F.count(F.lit(1)).alias("n"))
    aim = targets if targets is not None else F.regexp_replace(F.col(campaign), "^VOICED_", "")
    line = F.concat(F.lit("    "), F.rpad(F.col(adset), 18, " "), F.lit(" "), F.col("n").cast("string"))
    by = sets.groupBy(campaign).agg(F.sum("n").alias("total"), F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(adset).alias("a"), line.alias("l")))), lambda x: x["l"]).alias("lines"))
    head = F.concat(F.lit("["), F.col(campaign), F.lit("]  ("), F.col("total").cast("string"), F.lit(" ads)  ->  "), aim)
    block = F.concat(head, F.lit("\n"), F.array_join("lines", "\n"), F.lit("\n"))
    blocks = by.agg(F.array_sort(F.collect_list(F.struct((~F.col(campaign).startswith("BGM")).alias("late"), F.col(campaign).alias("c"), block.alias("b")))).alias("all"))
    return blocks.select(F.array_join(F.transform("all", lambda x: x["b"]), "\n").alias("report"))


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _over(spark: SparkSession, source: str, target: str) -> None:
    """One rename over what is there."""
    at, _ = _fs(spark, source)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    context.rename(at, _fs(spark, target)[0], over)


def document(df: DataFrame, path: str, rows: str = "videos", order: list[str] | None = None) -> None:
    """``df`` as one JSON document, an object with the array ``rows``, a row a line; null fields are left out. It is written aside by one task, which
    streams the rows (in ``order``, if given), and takes the place of the file at ``path`` by one rename: readers see the
    old document or the new one."""
    spark, aside = df.sparkSession, f"{path}.{uuid.uuid4().hex}"
    lines = (df.orderBy(*order) if order else df).select(F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1)

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = '{"' + rows + '": ['
        for batch in batches:
            out = []
            for line in batch["value"].to_pylist():
                out.append(before + line)
                before = ","
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        if before == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]}"])], names=["value"])

    lines.mapInArrow(framed, "value string").write.text(aside)
    at, fs = _fs(spark, aside)
    parts = [s.getPath().toString() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-") and s.getLen()]
    try:
        if not parts:  # no rows: Spark ran no task, or one that had nothing to say
            parts = [f"{aside}/empty"]
            out = fs.create(_fs(spark, parts[0])[0], True)
            out.writeBytes('{"' + rows + '": []}')
            out.close()
        _over(spark, parts[0], path)
    finally:
        fs.delete(at, True)


def replaced(df: DataFrame, path: str, keep: int = 2) -> None:
    """``df`` as the new version of the table at ``path``: written to a folder of its own, then named by
    the file CURRENT, which is replaced by one rename over the old one. Readers see the old version or
    the new one, also after a crash. The last ``keep`` versions stay."""
    spark = df.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    df.write.parquet(f"{path.rstrip('/')}/{version}")
    new, fs = _fs(spark, f"{path.rstrip('/')}/.{version}")
    out = fs.create(new, True)
    out.writeBytes(version)
    out.close()
    _over(spark, new.toString(), f"{path.rstrip('/')}/{CURRENT}")
    old = [s for s in fs.listStatus(_fs(spark, path)[0]) if s.getPath().getName().startswith("v-") and s.getPath().getName() != version]
    for s in sorted(old, key=lambda s: s.getModificationTime())[: max(0, len(old) - keep + 1)]:
        fs.delete(s.getPath(), True)


def current(spark: SparkSession, path: str) -> DataFrame:
    """The table that replaced() wrote last."""
    return spark.read.parquet(f"{path.rstrip('/')}/{spark.read.text(f'{path.rstrip("/")}/{CURRENT}').first()[0]}")
