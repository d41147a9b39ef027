"""Streams with state against batch, and against models that walk through time."""

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lumenreel.operators import alerts as batch
from lumenreel.streaming import alerts, watchdog

T0 = pd.Timestamp("2024-03-09 20:00:00")


@pytest.fixture(scope="module")
def states(spark):
    before = spark.conf.get(alerts.PROVIDER_CONF)
    spark.conf.set(alerts.PROVIDER_CONF, alerts.STATE_STORE)
    yield spark
    spark.conf.set(alerts.PROVIDER_CONF, before)


def played(spark, folder, parts, schema, made, name):
    """The rows of a query over the parts as files, one to a batch."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    files = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    q = made(files).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(folder / "state")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    q.stop()
    return [tuple(r) for r in spark.table(name).collect()]


def requests(seed):
    """Bursts of over 500 requests a minute, calm spells, and rows that come up to three minutes late."""
    rnd, rows, t = random.Random(seed), [], 0.0
    for _ in range(6):
        for _ in range(rnd.randrange(700, 1100)):
            t += rnd.random() * 0.12
            rows.append((rnd.choice("kkq"), t))
        t += rnd.choice([30, 200, 900])
    rows.sort(key=lambda r: r[1] + (rnd.random() * 180 if rnd.random() < 0.2 else 0))
    rows = [(k, (T0 + pd.Timedelta(microseconds=int(s * 1e6))).to_pydatetime()) for k, s in rows]
    third = len(rows) // 3
    parts = [rows[:third], rows[third : 2 * third], rows[2 * third :]]
    # one row long after the others lets the watermark pass them
    return rows, [*parts, [("end", (T0 + pd.Timedelta(days=3)).to_pydatetime())]]


SHAPE = "api_key string, ts timestamp"


@pytest.mark.parametrize("per_key, limit", [(False, 600), (True, 300)])
def test_spikes_equal_batch_above_500(states, tmp_path, per_key, limit):
    rows, parts = requests(3)
    got = played(states, tmp_path, parts, SHAPE, lambda s: alerts.spikes(s, limit, per_key=per_key, late="5 minutes"), f"spikes_{per_key}")
    want = [tuple(r) for r in batch.sliced_spikes(states.createDataFrame(rows, SHAPE), limit, per_key=per_key).collect()]
    assert sorted(got) == sorted(want) and len(got) >= 3 and max(r[2] for r in got) >= limit


def test_sliced_spikes_are_those_of_a_walk(spark):
    rows, _ = requests(4)
    second = 1_000_000
    n = {}
    for _, ts in rows:
        at = int((pd.Timestamp(ts) - pd.Timestamp(0)).value // 1000) // second * second
        n[at] = n.get(at, 0) + 1
    want, last = [], None
    for at in sorted(n):
        total = sum(c for t, c in n.items() if at - 60 * second < t <= at)
        if total >= 600 and (last is None or at - last >= 120 * second):
            last = at
            want.append(("all", at, total))
    assert sorted(map(tuple, batch.sliced_spikes(spark.createDataFrame(rows, SHAPE), 600).collect())) == want and len(want) > 2


def test_crossings_equal_batch(states, tmp_path):
    """Over midnight in California, for limits whose shares are equal too."""
    rows, parts = requests(5)
    for limit in (1500, 3):
        got = played(states, tmp_path / str(limit), parts, SHAPE, lambda s, n=limit: alerts.crossings(s, n, late="5 minutes"), f"crossings_{limit}")
        df = states.createDataFrame(rows, SHAPE).withColumn("id", F.monotonically_increasing_id())
        hits = batch.crossings(df, "api_key", "ts", "id", F.lit(limit)).select("api_key", (F.floor(F.unix_micros("ts") / 1_000_000) * 1_000_000).alias("at"), F.col("n").cast("long"), "kind")
        assert sorted(got) == sorted(map(tuple, hits.collect())) and len(got) >= 3


def test_cooled_alerts_of_a_stream(states, tmp_path):
    rnd = random.Random(1)
    rows, t = [], 0
    for k in range(200):
        t += rnd.randrange(0, 90) * 1_000_000
        rows.append((rnd.choice(["spike", "quota_warn"]), t, f"k{k}"))
    got = played(states, tmp_path, [rows[:90], rows[90:]], "kind string, ts long, api_key string", alerts.cooled, "cooled")
    last, want = {}, []
    for kind, at, key in sorted(rows, key=lambda r: (r[1], r[2])):
        if kind not in last or at - last[kind] >= 120_000_000:
            last[kind] = at
            want.append((kind, at, key))
    assert sorted(got) == sorted(want)


def ticked(signals, idle, park, answer, until):
    """The watchdog second by second: at each, what time has brought about comes before the signals."""
    out = []
    for m in sorted({s[0] for s in signals}):
        first = active = beat = asked = None
        running = over = False
        for now in range(until + 1):
            if first is not None and not over:
                if asked is not None and now >= asked + answer:
                    out.append((m, now, "alarm"))
                    asked, first, active = None, now, now
                quiet = now - max(active, beat if beat is not None else active) >= idle and not running
                if asked is None and (quiet or now - first >= park):
                    asked = now
                    out.append((m, now, "stop"))
            for _, _, kind in sorted((s for s in signals if s[0] == m and s[1] == now), key=lambda s: s[2]):
                if first is None:
                    first = active = now
                if kind == "stopped":
                    out += [] if over else [(m, now, "stopped")]
                    asked, over = None, True
                    continue
                if over:
                    out.append((m, now, "started"))
                    first = active = now
                    beat, asked, over, running = None, None, False, False
                if kind == "refused":
                    if asked is not None:
                        out.append((m, now, "resumed"))
                        asked, first, active = None, now, now
                elif kind == "heartbeat":
                    beat = now
                else:
                    active, running = now, {"batch_started": True, "batch_done": False}.get(kind, running)
    return sorted(out)


def test_a_watched_replay_with_silence(states, tmp_path):
    """Machines that fall silent are stopped by the timer, while others go on."""
    rnd = random.Random(7)
    signals = [("clock", t, "heartbeat") for t in range(0, 3000, 20)]
    for m in range(12):
        t = rnd.randrange(50)
        while t < 2400:
            signals.append((f"m{m}", t, rnd.choice(["activity", "heartbeat", "batch_started", "batch_done", "stopped", "refused"])))
            t += rnd.choice([5, 30, 90, 290, 300, 301, 700])
    signals += [("silent", 10, "activity"), ("busy", 5, "batch_started")]
    signals.sort(key=lambda s: s[1])
    parts = [[(m, (T0 + pd.Timedelta(seconds=t)).to_pydatetime(), k) for m, t, k in signals if lo <= t < lo + 600] for lo in range(0, 3000, 600)]
    got = played(states, tmp_path, parts, "machine string, ts timestamp, kind string", lambda s: watchdog.watched(s, 300, 1500, 60, "1 second"), "watched")
    base = int((T0 - pd.Timestamp(0)).total_seconds())
    got = sorted((m, at // 1000 - base, event) for m, at, event, _ in got)
    seen = max(s[1] for s in signals) - 1  # the watermark
    want = [r for r in ticked(signals, 300, 1500, 60, 3000) if r[1] <= seen]
    got, want = ([r for r in rows if r[1] < seen - 1] for rows in (got, want))
    assert got == want
    assert ("silent", 310, "stop") in got and ("silent", 370, "alarm") in got and ("busy", 1505, "stop") in got


def test_a_timer_fires_without_input(states, tmp_path):
    """By the clock: one signal, then nothing."""
    path = str(tmp_path / "in")
    states.createDataFrame([("m", T0.to_pydatetime(), "activity")], "machine string, ts timestamp, kind string").coalesce(1).write.parquet(path)
    files = states.readStream.schema("machine string, ts timestamp, kind string").parquet(path)
    q = watchdog.watched(files, 2, 3600, 3600, None).writeStream.format("memory").queryName("clocked").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="500 milliseconds").start()
    try:
        until = time.time() + 60
        while time.time() < until and not states.table("clocked").count():
            time.sleep(0.5)
        assert [(r["machine"], r["event"], r["reason"]) for r in states.table("clocked").collect()] == [("m", "stop", "idle")]
    finally:
        q.stop()


def test_the_state_store_is_asked_for(spark):
    with pytest.raises(ValueError, match="RocksDB"):
        alerts.needs_rocksdb(spark.newSession().range(1))
