"""Data sources of folders: all files at any depth, and a file for each clip or none."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenreel.sources import files, readers, writers


@pytest.fixture(scope="module")
def sources(spark):
    files.register(spark)
    return spark


def test_a_walk_finds_hidden_and_deep_files(sources, tmp_path):
    made = ["a.mp4", ".DS_Store", "x/b.mp4", "x/_old/c.mp4", "x/.git/d", "x/1/2/3/4/5/6/7/e.mp4.part", "y/f.M4A", "y/_deep/_er/.g.temp.mp4"]
    for name in made:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * len(name))
    (tmp_path / "empty").mkdir()
    df = sources.read.format("media_walk").option("root", str(tmp_path)).load()
    got = {r["relative"]: r for r in df.collect()}
    assert set(got) == set(made) and all(r["size"] == len(k) for k, r in got.items()) and df.rdd.getNumPartitions() == 4
    assert {k for k, r in got.items() if r["junk"]} == {".DS_Store", "x/1/2/3/4/5/6/7/e.mp4.part", "y/f.M4A", "y/_deep/_er/.g.temp.mp4"}
    assert {k for k, r in got.items() if r["private"]} == {"x/_old/c.mp4", "x/.git/d", "y/_deep/_er/.g.temp.mp4"}
    assert got["x/1/2/3/4/5/6/7/e.mp4.part"]["depth"] == 8 and got["a.mp4"]["folder"] == "" and got["y/f.M4A"]["mtime"] is not None
    assert {r["relative"] for r in readers.media_files(sources, str(tmp_path), "*.mp4", None, skip_private=False).collect()} == {"a.mp4", "x/b.mp4", "x/_old/c.mp4"}
    (tmp_path / "x/1/2/3/4/5/6/7/_private").mkdir()
    (tmp_path / "x/1/2/3/4/5/6/7/_private/z.mp4").write_text("z")
    assert "x/1/2/3/4/5/6/7/_private/z.mp4" in {r["relative"] for r in readers.media_files(sources, str(tmp_path), "*.mp4", None, skip_private=False).collect()}


def test_a_subtitle_file_for_each_clip(sources, tmp_path):
    rows = [("a", 0.0, 1.5, "Hello"), ("a", 2.0, 3.0, "there"), ("b/c", 0.0, 1.0, "Été"), ("none", 0.0, 1.0, "")]
    made = writers.srt(sources.createDataFrame(rows, "clip_id string, start double, end double, text string"))
    out = tmp_path / "out"
    made.write.format("srt_clips").mode("append").save(str(out))
    assert sorted(p.name for p in out.iterdir()) == ["a.srt", "b_c.srt"]
    want = {r["clip_id"]: r["srt"] for r in made.collect()}
    assert (out / "a.srt").read_text() == want["a"] and (out / "b_c.srt").read_text() == want["b/c"]
    made.where("clip_id = 'a'").write.format("srt_clips").mode("overwrite").save(str(out))
    assert [p.name for p in out.iterdir()] == ["a.srt"]


def test_a_write_that_fails_leaves_nothing(sources, tmp_path):
    out = tmp_path / "out"
    broken = sources.range(0, 200, 1, 4).select(F.concat(F.lit("c"), "id").alias("clip_id"), F.when(F.col("id") == 199, F.raise_error(F.lit("boom"))).otherwise("1").cast("string").alias("srt"))
    with pytest.raises(Exception, match="boom"):
        broken.write.format("srt_clips").mode("append").save(str(out))
    assert not out.exists() or not [p for p in out.rglob("*") if p.is_file()]


def test_a_manifest_that_is_not_there(spark, tmp_path):
    shape = T.StructType([T.StructField("id", T.StringType())])
    path = str(tmp_path / "m.json")
    assert [r["id"] for r in readers.manifest(spark, path, shape, default=[("d",)]).collect()] == ["d"]
    for text, want in (('{"videos": [{"id": "x"}]}', ["x"]), ('{"videos": [', ["d"]), ("[]", ["d"])):
        (tmp_path / "m.json").write_text(text)
        spark.catalog.clearCache()
        assert [r["id"] for r in readers.manifest(spark, path, shape, default=[("d",)]).collect()] == want


def test_a_document_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "m.json")
    shape = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])
    for rows in ([("b", 2), ("a", None), ('q"', 3)], [("x", 1)], []):
        writers.document(spark.createDataFrame(rows, shape).repartition(3), path, order=["id"])
        read = json.loads((tmp_path / "m.json").read_text())
        assert [(r["id"], r.get("n")) for r in read["videos"]] == sorted(rows) and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["m.json"]
        assert sorted(map(tuple, readers.manifest(spark, path, shape).collect())) == sorted(rows)
