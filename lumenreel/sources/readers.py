"""Readers of manifests, logs and sidecar files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: What isn't media: partial downloads, leftovers of renders, sound tracks.
JUNK = r"(\.part|\.temp\.mp4|\.m4a)$"


def media_files(spark: SparkSession, root: str, glob: str = "*.mp4", levels: int | None = 1, skip_private: bool = True, outside: str | None = None) -> DataFrame:
    """path, relative, folder (the first one below ``root``, or ''), name, size, mtime and junk of files, ordered
    by path. ``levels``: how many folders deep, all if null. Folders that start with ``_`` are skipped on
    request, and what lies below the folder ``outside``. For junk to be seen the glob has to let it through;
    hidden files (a dot in front) are never listed here, but by the format ``media_walk`` (sources.files)."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    base = fs.makeQualified(top).toString().rstrip("/")
    roots = [base]
    if not skip_private:
        # Spark passes over names that start with an underscore, unless they are asked for
        depth, below = 0, True
        while below and (levels is None or depth <= levels):
            found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(base + "/*" * depth + "/_*"))
            roots += [x.getPath().toString() for x in found or ()]
            depth += 1
            below = any(x.isDirectory() for x in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(base + "/*" * depth)) or ())
    f = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(roots).drop("content").dropDuplicates(["path"])
    bare = lambda c: F.regexp_replace(c, "^[a-z]+:/+", "/")
    relative = F.expr(f"substring(p, {len(re.sub('^[a-z]+:/+', '/', base)) + 2})")
    f = f.withColumn("p", bare(F.col("path"))).withColumn("relative", relative).withColumn("parts", F.split("relative", "/"))
    folder = F.when(F.size("parts") > 1, F.element_at("parts", 1)).otherwise(F.lit(""))
    f = f.select("path", "relative", "parts", folder.alias("folder"), F.element_at("parts", -1).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    f = f.withColumn("junk", F.col("name").rlike(JUNK))
    if levels is not None:
        f = f.where(F.size("parts") <= levels + 1)
    if skip_private:
        f = f.where(~F.exists(F.slice("parts", F.lit(1), F.size("parts") - 1), lambda x: x.startswith("_")))
    if outside:
        f = f.where(~F.col("relative").startswith(outside.rstrip("/") + "/"))
    return f.drop("parts").orderBy("path")


def manifest(spark: SparkSession, path: str, schema: T.StructType, rows: str = "videos", default: list | None = None) -> DataFrame:
    """The rows of a JSON document that holds them in the array ``rows``. If there is no such file, or it is broken, those of
    ``default``, where one is given."""
    if default is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at):
            return spark.createDataFrame(default, schema)
        whole = T.StructType([T.StructField(rows, T.ArrayType(schema)), T.StructField("_corrupt", T.StringType())])
        read = spark.read.schema(whole).option("columnNameOfCorruptRecord", "_corrupt").json(path, multiLine=True).cache()
        if not read.where(F.col("_corrupt").isNull() & F.col(rows).isNotNull()).isEmpty():
            return read.select(F.explode(rows).alias("r")).select("r.*")
        return spark.createDataFrame(default, schema)
    return spark.read.schema(T.StructType([T.StructField(rows, T.ArrayType(schema))])).json(path, multiLine=True).select(F.explode(rows).alias("r")).select("r.*")


def json_lines(spark: SparkSession, path: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """Rows of JSON lines without blank and corrupt ones; of a key the last line counts, if asked for."""
    df = spark.read.schema(schema).json(path, mode="DROPMALFORMED").withColumn("_n", F.monotonically_increasing_id())
    if key:
        df = df.groupBy(key).agg(F.max_by(F.struct(*schema.names), "_n").alias("r")).select("r.*")
        return df
    return df.drop("_n")


def csv_map(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """key, value of a CSV with a header; a byte-order mark is dropped, and rows with an empty value."""
    df = spark.read.csv(path, header=True)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.select(key, value).where(F.trim(F.coalesce(value, F.lit(""))) != "")


def env_pairs(lines: DataFrame, column: str = "value") -> DataFrame:
    """name, value of an env file: comments skipped, split at the first ``=``, the first definition counts."""
    p = lines.withColumn("_n", F.monotonically_increasing_id()).where(~F.trim(column).startswith("#") & F.col(column).contains("="))
    p = p.select(F.trim(F.split(column, "=", 2)[0]).alias("name"), F.trim(F.split(column, "=", 2)[1]).alias("value"), "_n")
    return p.groupBy("name").agg(F.min_by("value", "_n").alias("value"))


# Lines of a sidecar that are no copy.
STOP_LINES = ["this ad has multiple versions", "eu transparency", "open dropdown", "quality", "hd", "sd", "0:01", "0:15"]


def sections(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, primary, headline of sidecar texts: a line that begins with PRIMARY TEXT, or with HEADLINE or
    CTA, in any case, opens its section; the lines of a section that are neither blank nor on the stop
    list are joined by `` / `` in order. Keys without a section have empty texts."""
    lines = rows.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("n", "line")).withColumn("line", F.regexp_replace("line", r"^\s+|\s+$", ""))
    up = F.upper("line")
    head = F.when(up.startswith("PRIMARY TEXT"), "primary").when(up.startswith("HEADLINE") | up.startswith("CTA"), "headline")
    w = Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    r = lines.withColumn("_h", head).withColumn("section", F.last("_h", ignorenulls=True).over(w))
    good = F.col("_h").isNull() & (F.col("line") != "") & ~F.lower("line").isin(STOP_LINES)
    part = lambda name: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(good & (F.col("section") == name), F.struct("n", "line")))), lambda x: x["line"]), " / ").alias(name)
    return r.groupBy(key).agg(part("primary"), part("headline"))


def gpu_line(line: Column) -> Column:
    """A six-field line as a struct; null if the number of fields or a number is wrong."""
    p = F.split(line, ",")
    text = lambda k: F.trim(F.get(p, F.lit(k)))
    n = lambda k: text(k).try_cast("double")
    ok = (F.size(p) == 6) & n(2).isNotNull() & n(3).isNotNull() & n(4).isNotNull() & n(5).isNotNull()
    return F.when(ok, F.struct(text(0).alias("index"), text(1).alias("name"), n(2).alias("used"), n(3).alias("total"), n(4).alias("util"), n(5).alias("temp")))
