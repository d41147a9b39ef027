"""Tables in buckets: merges that touch few rows, that come twice, and that meet."""

import random
from pathlib import Path

import pytest

from lumenreel.sources import buckets
from lumenreel.streaming import manifests

SHAPE = "id string, name string, angle string"


def files(path):
    return {p.relative_to(path) for p in Path(path).glob("data/*/*/*.parquet")}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(f"k{i}", f"n{i}", None) for i in range(200)] + [(None, "none", "x")]
    buckets.create(spark.createDataFrame(old, SHAPE), path, "id", 16)
    before = files(path)
    assert len(before) == 16 and rows(buckets.read(spark, path)) == sorted(old, key=str)
    new = [("k3", "other", "a"), ("new", "n", None), (None, "now", None)]
    assert buckets.merge(spark.createDataFrame(new, SHAPE), path, 0)
    want = [r for r in old if r[0] not in ("k3", None)] + new
    assert rows(buckets.read(spark, path)) == sorted(want, key=str)
    added = files(path) - before
    assert before <= files(path) and 1 <= len({p.parts[2] for p in added}) <= 3
    # the same batch again, and an empty one
    kept = files(path)
    assert not buckets.merge(spark.createDataFrame([("k5", "never", None)], SHAPE), path, 0) and files(path) == kept
    assert buckets.merge(spark.createDataFrame([], SHAPE), path, 1) and files(path) == kept
    assert buckets.merge(spark.createDataFrame([("k5", "other stream", None)], SHAPE), path, 0, "other")
    assert rows(buckets.read(spark, path)) == sorted([r for r in want if r[0] != "k5"] + [("k5", "other stream", None)], key=str)


def test_many_merges_equal_a_dictionary(spark, tmp_path):
    rnd, path, held = random.Random(2), str(tmp_path / "t"), {}
    buckets.create(spark.createDataFrame([], SHAPE), path, "id", 4)
    for batch in range(7):
        new = {f"k{rnd.randrange(30)}": f"v{batch}" for _ in range(6)}
        held |= new
        buckets.merge(spark.createDataFrame([(k, v, None) for k, v in new.items()], SHAPE), path, batch)
        assert rows(buckets.read(spark, path)) == sorted((k, v, None) for k, v in held.items())
    logs = sorted(p.name for p in Path(path, "log").glob("*.json"))
    assert len(logs) == buckets.KEEP and len(files(path)) <= 4 * buckets.KEEP
    assert len(rows(buckets.read(spark, path, int(logs[0][:-5])))) > 0


def test_two_writers_meet(spark, tmp_path):
    path = str(tmp_path / "t")
    buckets.create(spark.createDataFrame([("a", "1", None)], SHAPE), path, "id", 2)

    def slow(old, new):  # another one commits while this merge is on its way
        buckets.merge(spark.createDataFrame([("b", "2", None)], SHAPE), path, 0, "quick")
        return old.unionByName(new)

    with pytest.raises(buckets.Conflict):
        buckets.merge(spark.createDataFrame([("c", "3", None)], SHAPE), path, 0, "slow", slow)
    assert rows(buckets.read(spark, path)) == [("a", "1", None), ("b", "2", None)]
    assert buckets.merge(spark.createDataFrame([("c", "3", None)], SHAPE), path, 0, "slow")
    with pytest.raises(buckets.Conflict):
        buckets.create(spark.createDataFrame([], SHAPE), path, "id")


def test_a_manifest_kept_up_from_a_stream(spark, tmp_path):
    path = str(tmp_path / "manifest")
    buckets.create(spark.createDataFrame([("a", "old", "mine"), ("b", "old", None)], SHAPE), path, "id", 8)
    spark.createDataFrame([("a", "new", None), ("c", "new", "x"), ("c", "newer", "x")], SHAPE).coalesce(1).write.parquet(str(tmp_path / "scans"))
    seen = []
    for k in range(2):  # without its checkpoint the stream begins anew: its batches are in already
        scans = spark.readStream.schema(SHAPE).parquet(str(tmp_path / "scans"))
        manifests.kept_up(scans, path, "id", ["angle"]).option("checkpointLocation", str(tmp_path / f"c{k}")).start().awaitTermination()
        assert rows(buckets.read(spark, path)) == [("a", "new", "mine"), ("b", "old", None), ("c", "newer", "x")]
        seen.append(files(path))
    assert seen[0] == seen[1]
