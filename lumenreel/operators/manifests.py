"""Manifests: merges that keep what people filled in, incremental work sets, ledgers, bundles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _truthy(c: Column, kind: str) -> Column:
    """Whether a value counts as filled in: not null, empty, 0 or false."""
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if kind == "string":
        return F.coalesce(c != "", F.lit(False))
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    return F.coalesce(c != 0, F.lit(False)) if kind in ("int", "bigint", "double", "float", "smallint") else c.isNotNull()


def rescanned(previous: DataFrame, scanned: DataFrame, key: str, kept: list[str], carried: list[str] = (), segments: str | None = None) -> DataFrame:
    """``previous`` with the rows of ``scanned`` in place of those of the same key, and new ones added.

    Of a row that is replaced the ``kept`` columns stay where they are filled in; the ``carried`` ones stay
    where the new row has none; all others are the new row's. In the array ``segments`` a segment without
    ``translations`` gets those of the earlier one with its ``id``. Columns that ``scanned`` lacks are null
    in new rows. Keys are compared null-safely."""
    kinds = {f.name: f.dataType.simpleString() for f in previous.schema.fields}
    new = scanned.select(*[F.col(c) if c in scanned.columns else F.lit(None).cast(kinds[c]).alias(c) for c in previous.columns], F.lit(True).alias("_new"))
    both = previous.alias("p").join(new.alias("n"), F.col(f"p.{key}").eqNullSafe(F.col(f"n.{key}")), "full")
    replaced = F.col("n._new").isNotNull()

    def value(c: str) -> Column:
        old, now = F.col(f"p.{c}"), F.col(f"n.{c}")
        if c in kept:
            now = F.when(_truthy(old, kinds[c]), old).otherwise(now)
        elif c in carried:
            now = F.when(_truthy(now, kinds[c]) | ~_truthy(old, kinds[c]), now).otherwise(old)
        elif c == segments:
            before = F.map_from_entries(F.transform(F.coalesce(old, F.array().cast(kinds[c])), lambda s: F.struct(s["id"], s["translations"])))
            now = F.transform(now, lambda s: s.withField("translations", F.when(F.coalesce(F.size(s["translations"]) > 0, F.lit(False)), s["translations"]).otherwise(F.coalesce(F.try_element_at(before, s["id"]), s["translations"]))))
        return F.when(replaced, now).otherwise(old).alias(c)

    return both.select(*[value(c) for c in previous.columns])


def todo(files: DataFrame, manifest: DataFrame, key: str, done: Column) -> DataFrame:
    """The files that aren't done in the manifest: new ones, and those whose row says so."""
    return files.join(manifest.where(done).select(key), key, "left_anti")


def ledger(writes: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key, value: the last write of each key; ``true`` and ``false`` are told from texts by ``flag``."""
    last = writes.groupBy(key).agg(F.max_by(value, order).alias(value))
    return last.withColumn("flag", F.when(F.col(value).isin("true", "false"), F.col(value) == "true"))


def bundle(jobs: DataFrame, lang: str | None = None, kind: str | None = None) -> DataFrame:
    """The files (column ``files``) of finished jobs in one language, or of one kind: exactly one of them."""
    if bool(lang) == bool(kind):
        raise ValueError("give either a language or a kind")
    name, wanted = ("lang", lang) if lang else ("kind", kind)
    f = jobs.where(F.col("status") == "done").withColumn("_f", F.explode("files")).drop("files")
    return f.where(F.col(f"_f.{name}") == wanted).select(*[c for c in f.columns if c != "_f"], "_f.*")


def last_status(log: DataFrame, job: str, status: str, time: str, order: str) -> DataFrame:
    """The last status of each job by its log."""
    return log.groupBy(job).agg(F.max_by(status, F.struct(time, order)).alias(status), F.max(time).alias(time))


def expired(jobs: DataFrame, status: str, time: str, now: Column, seconds: int) -> DataFrame:
    """Jobs older than a limit; never those that wait or run."""
    return jobs.where(~F.col(status).isin("queued", "running") & (F.unix_seconds(time) < F.unix_seconds(now) - seconds))


def folder_merge(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """Names moved from one folder to another, and those that stay since they are there: name, moved."""
    there = target.select(name).distinct().withColumn("_there", F.lit(True))
    return source.join(there, name, "left").withColumn("moved", F.col("_there").isNull()).drop("_there")


def zipped(segments: DataFrame, arrays: DataFrame, key: str, order: str, items: str) -> DataFrame:
    """Segments with the item of their position in the key's array, '' where it is too short, and
    ``matched``: whether the lengths agree."""
    w = Window.partitionBy(key)
    s = segments.withColumns({"_i": F.row_number().over(w.orderBy(order)) - 1, "_n": F.count(F.lit(1)).over(w)})
    s = s.join(arrays.select(key, F.col(items).alias("_a")), key, "left")
    a = F.coalesce("_a", F.array().cast(arrays.schema[items].dataType))
    return s.withColumns({"item": F.coalesce(F.get(a, F.col("_i")), F.lit("")), "matched": F.size(a) == F.col("_n")}).drop("_i", "_n", "_a")


def keys_of(plural: Column, single: Column) -> Column:
    """Keys of a provider: the items of its list, else its single one."""
    items = F.filter(F.transform(F.split(F.coalesce(plural, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    one = F.filter(F.array(F.trim(F.coalesce(single, F.lit("")))), lambda x: x != "")
    return F.when(F.size(items) > 0, items).otherwise(one)


def all_keys(*providers: Column) -> Column:
    """The keys of providers one after the other; an error if there are none."""
    keys = F.concat(*providers)
    return F.when(F.size(keys) > 0, keys).otherwise(F.raise_error(F.lit("no keys are set")).cast("array<string>"))


def fan_out(videos: DataFrame, key: str, targets: list[str], source: Column, complete: Column, existing: DataFrame, least_bytes: int = 100_000) -> DataFrame:
    """key, target, state of each video and target language: ``source`` (recorded, nothing to do),
    ``untranslated`` (left out for now), ``exists`` (an output of more than ``least_bytes`` is recorded) or
    ``queued``. ``complete``: a map of languages to whether all is translated; ``existing``: key, target, size."""
    v = videos.select(key, source.alias("_source"), complete.alias("_complete"), F.explode(F.array(*map(F.lit, targets))).alias("target"))
    done = existing.where(F.col("size") > least_bytes).select(key, "target").distinct().withColumn("_done", F.lit(True))
    ready = F.coalesce(F.try_element_at("_complete", F.col("target")), F.lit(False))
    state = F.when(F.col("target").eqNullSafe(F.col("_source")), "source").when(~ready, "untranslated").when(F.col("_done"), "exists").otherwise("queued")
    return v.join(done, [key, "target"], "left").select(key, "target", state.alias("state"))
