"""Sessions of clicks by gaps, ends and lengths.

Clients are hashed, and the clicks dealt by ranges of (hash of the client, client, time) into groups
of about ROWS rows: a group is whole clients, and a client with more clicks than that goes on in the
next group. In each group an embedded duckdb finds the hard breaks (windows), the cuts by length
(a recursive CTE over each click's first click beyond the length) and the sessions of late clicks
(ASOF JOIN).

What a group can't decide alone is the beginning of its first client (`front` rows, up to its first
hard break) and the last session of its last client (`open`). The fronts are then worked on by the
same SQL, each behind the open session of the group before. That is one round; a group that is front
throughout (one client, not one hard break in ROWS clicks) passes its open session on to the next
round, so a run of k such groups takes k rounds, each click being read in one of them. Pieces of
a session are put together at the end by its id. No more than a group's rows are ever in one task,
but for the clicks of one session, whose digest needs them in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, lean, partitions, stored

#: Rows of a group, about.
ROWS = 200_000
MINUTE = 60_000_000
GAP, LENGTH, LATE = 5 * MINUTE, 120 * MINUTE, 60 * MINUTE
FINAL_KIND, FINAL_VALUE = "purchase", 60

_PIECE = "slice int, kind string, client_id long, session_id long, start_us long, end_us long, n_clicks long, n_late long, value_cents long, closed_by string, path string, final boolean"
_ROW = "slice int, client_id long, us long, late boolean, final boolean, cents long, click_id long, entry boolean, begun long"

#: ``t``: key (client or group), us, late, final, cents, click_id, entry (the open session of the group before, as a first
#: row), begun (its start). Gives the sessions of each key, in order; ``why`` is why the next one began, null for the last.
_SESSIONS = f"""
CREATE TEMP TABLE k AS
WITH timely AS (SELECT *, lag(us) OVER w AS pu, lag(final) OVER w AS pf, row_number() OVER w AS rn
    FROM t WHERE NOT late WINDOW w AS (PARTITION BY key ORDER BY entry DESC, us, click_id)),
  broken AS (SELECT *, CASE WHEN pu IS NULL THEN NULL WHEN pf THEN 'end' WHEN us - pu >= {GAP} THEN 'gap' END AS why FROM timely)
SELECT *, sum((why IS NOT NULL)::INT) OVER (PARTITION BY key ORDER BY rn) AS run FROM broken;

CREATE TEMP TABLE far AS
WITH long_runs AS (SELECT key, run FROM k GROUP BY ALL HAVING max(us) - min(begun) > {LENGTH}),
  rows AS (SELECT k.* FROM k JOIN long_runs USING (key, run)), times AS (SELECT key, run, us, min(rn) AS rn FROM rows GROUP BY ALL)
SELECT a.key, a.rn, b.rn AS beyond FROM rows a ASOF JOIN times b ON a.key = b.key AND a.run = b.run AND a.begun + {LENGTH} < b.us;

CREATE TEMP TABLE starts AS
WITH RECURSIVE cut(key, rn) AS (
  SELECT key, min(rn) FROM k GROUP BY key, run
  UNION ALL SELECT far.key, far.beyond FROM cut JOIN far ON far.key = cut.key AND far.rn = cut.rn)
SELECT k.key, k.rn, k.begun AS us, CASE WHEN k.rn > 1 THEN coalesce(k.why, 'length') END AS why, row_number() OVER (PARTITION BY k.key ORDER BY k.rn) AS session,
  lead(k.rn) OVER (PARTITION BY k.key ORDER BY k.rn) AS upto FROM cut JOIN k USING (key, rn);

CREATE TEMP TABLE lates AS
WITH last_at AS (SELECT key, us, max(session) AS session FROM starts GROUP BY ALL)
SELECT s.key, s.session, count(*) AS n FROM (SELECT key, us FROM t WHERE late) l ASOF JOIN last_at s ON l.key = s.key AND l.us >= s.us GROUP BY ALL;

CREATE TEMP TABLE found AS
WITH dealt AS (SELECT k.*, s.session FROM k ASOF JOIN starts s ON k.key = s.key AND k.rn >= s.rn),
  summed AS (SELECT key, session, arg_min(client_id, rn) AS client_id, arg_min(click_id, rn) AS session_id, min(begun) AS start_us, max(us) AS end_us, count(*) FILTER (NOT entry) AS n_clicks,
    sum(cents)::BIGINT AS value_cents, string_agg(click_id, ',' ORDER BY rn) FILTER (NOT entry) AS path, arg_max(final, rn) AS final FROM dealt GROUP BY ALL)
SELECT a.*, coalesce(l.n, 0) AS n_late, n.why FROM summed a LEFT JOIN lates l USING (key, session) LEFT JOIN starts n ON n.key = a.key AND n.session = a.session + 1;
"""


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 UTC; a time without a zone counts as UTC."""
    c = F.col(name)
    if df.schema[name].dataType.simpleString() != "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    clock = F.hour(c).cast("long") * 60 * MINUTE + F.minute(c).cast("long") * MINUTE + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    return F.unix_date(c.cast("date")).cast("long") * (24 * 60 * MINUTE) + clock


def _taken(clicks: DataFrame) -> DataFrame:
    """client_id, us, late, final, cents, click_id: one row per click."""
    value = F.when(~F.isnan("value") & (F.abs("value") < 9e16), F.col("value"))
    rows = clicks.select(
        F.col("client_id").cast("long").alias("client_id"), micros(clicks, "ts").alias("us"), F.coalesce(micros(clicks, "arrived_at") - micros(clicks, "ts") > LATE, F.lit(False)).alias("late"),
        F.coalesce((F.col("kind") == FINAL_KIND) & (value >= FINAL_VALUE), F.lit(False)).alias("final"), F.coalesce(F.floor(100 * value + 0.5).cast("long"), F.lit(0)).alias("cents"), F.col("click_id").cast("long").alias("click_id"),
    ).where("client_id IS NOT NULL AND us IS NOT NULL AND click_id IS NOT NULL")
    # the partial aggregates take copies away before the shuffle
    return rows.groupBy("click_id").agg(F.min(F.struct("us", "client_id", "late", "final", "cents")).alias("r")).select("r.*", "click_id")


def _connected(rows: pa.Table) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect(config={"threads": 1, "memory_limit": "1GB"})
    c.register("rows_in", rows)
    return c


def _duck(rows: pa.Table, made: str) -> duckdb.DuckDBPyConnection:
    """A connection with the sessions of ``rows``; ``made``: the query of ``t`` over them."""
    c = _connected(rows)
    c.execute(f"CREATE TEMP TABLE t AS {made}")
    c.execute(_SESSIONS)
    return c


#: Sessions that are over, with the digest of their clicks, and the last client's last one with the clicks themselves.
_WITHIN = """SELECT {slice}::INT AS slice, CASE WHEN why IS NULL AND client_id = {last} THEN 'open' ELSE 'done' END AS kind, client_id, session_id, start_us, end_us, n_clicks, n_late, value_cents,
  CASE WHEN why IS NULL AND client_id = {last} THEN NULL ELSE coalesce(why, CASE WHEN final THEN 'end' ELSE 'none' END) END AS closed_by,
  CASE WHEN why IS NULL AND client_id = {last} THEN path ELSE sha256(path) END AS path, final FROM found"""


def _group(rows: pa.Table, slice_: int) -> pa.Table:
    """The pieces of a group. Kinds: `done`, `open` (above), `front` (a click before the first hard
    break of the first client; its fields stand in start_us (time), n_late (1 if late), value_cents and session_id)
    and `edge` (client_id and session_id are the first and the last client; closed_by is why the
    front's last session ends: a reason, `own` if the client ends here, null if it stays open)."""
    first, last = rows["client_id"][0].as_py(), rows["client_id"][-1].as_py()
    # the first break of the first client: rows of it from there on are sure
    with _connected(rows) as c:
        at = c.execute(f"""WITH p AS (SELECT us, click_id, lag(us) OVER w AS pu, lag(final) OVER w AS pf FROM rows_in WHERE client_id = $first AND NOT late WINDOW w AS (ORDER BY us, click_id))
          SELECT us, click_id, CASE WHEN pf THEN 'end' ELSE 'gap' END FROM p WHERE pf OR us - pu >= {GAP} ORDER BY us, click_id LIMIT 1""", {"first": first}).fetchone()  # fmt: skip
    us, click, why = at or (None, None, None)
    sure = f"client_id <> {first}" if at is None else f"(client_id <> {first} OR us > {us} OR us = {us} AND (late OR click_id >= {click}))"
    c = _duck(rows, f"SELECT client_id AS key, *, false AS entry, us AS begun FROM rows_in WHERE {sure}")
    try:
        found = c.sql(_WITHIN.format(slice=slice_, last=last)).to_arrow_table()
        front = c.sql(f"""SELECT {slice_}::INT AS slice, 'front' AS kind, client_id, click_id AS session_id, us AS start_us, NULL::BIGINT AS end_us, NULL::BIGINT AS n_clicks, late::BIGINT AS n_late, cents AS value_cents,
          NULL::VARCHAR AS closed_by, NULL::VARCHAR AS path, final FROM rows_in WHERE NOT ({sure})""").to_arrow_table()  # fmt: skip
    finally:
        c.close()
    edge = pa.Table.from_pylist([{"slice": slice_, "kind": "edge", "client_id": first, "session_id": last, "closed_by": why or ("own" if first != last else None)}], found.schema)
    return pa.concat_tables([found, front.cast(found.schema), edge])


def _pieces(taken: DataFrame, groups: int) -> DataFrame:
    """The clicks in groups, and what each group finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from _group(pa.Table.from_batches(held), TaskContext.get().partitionId()).to_batches(max_chunksize=20_000)

    order = ["h", "client_id", "us", "late", "click_id"]
    dealt = taken.withColumn("h", F.xxhash64("client_id")).repartitionByRange(groups, *order).sortWithinPartitions(*order)
    return dealt.select("client_id", "us", "late", "final", "cents", "click_id").mapInArrow(lean(run), _PIECE)


def _fronts(rows: DataFrame) -> DataFrame:
    """The sessions of the fronts in ``rows`` (as _ROW; an ``entry`` row first, where there is one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        c = _duck(pa.Table.from_batches(held), "SELECT slice AS key, * FROM rows_in")
        try:
            out = c.sql("SELECT key AS slice, 'piece' AS kind, client_id, session_id, start_us, end_us, n_clicks, n_late, value_cents, why AS closed_by, path, final FROM found").to_arrow_table()
        finally:
            c.close()
        yield from out.to_batches(max_chunksize=20_000)

    return rows.repartition("slice").mapInArrow(lean(run), _PIECE)


def _stitched(pieces: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """All pieces of the sessions that a group alone did not decide, and the tables that they are in."""
    edges = pieces.where("kind = 'edge'").select("slice", F.col("client_id").alias("first"), F.col("session_id").alias("last"), F.col("closed_by").alias("ends"))
    n, top = edges.agg(F.count(F.lit(1)), F.max("slice")).first()
    if n and n != top + 1:
        raise RuntimeError(f"{n} groups have rows, but the last is number {top}")
    before = edges.select((F.col("slice") + 1).alias("slice"), (F.col("ends").isNull()).alias("waits"), F.col("last").alias("had"))
    todo = edges.join(before, "slice", "left").withColumn("goes_on", F.coalesce(F.col("had") == F.col("first"), F.lit(False)))
    todo = stored(todo.select("slice", "ends", "goes_on", (F.col("goes_on") & F.col("waits")).alias("waits")), "edges")
    rows = pieces.where("kind = 'front'").select("slice", "client_id", F.col("start_us").alias("us"), (F.col("n_late") > 0).alias("late"), "final", F.col("value_cents").alias("cents"), F.col("session_id").alias("click_id"), F.lit(False).alias("entry"), F.col("start_us").alias("begun"))
    tails, tables, parts = pieces.where("kind = 'open'").select("slice", "client_id", "session_id", "start_us", "end_us", "final"), [todo], []
    ready = todo.where(~F.col("waits"))
    while not ready.isEmpty():
        entry = tails.select((F.col("slice") + 1).alias("slice"), "client_id", F.col("end_us").alias("us"), F.lit(False).alias("late"), "final", F.lit(0).cast("long").alias("cents"), F.col("session_id").alias("click_id"), F.lit(True).alias("entry"), F.col("start_us").alias("begun"))
        entry = entry.join(ready.where("goes_on").select("slice"), "slice", "left_semi")
        done = _fronts(rows.join(ready.select("slice"), "slice", "left_semi").unionByName(entry)).join(ready.select("slice", "ends"), "slice")
        left_open = F.col("closed_by").isNull() & F.col("ends").isNull()
        own = F.when(F.col("final"), "end").otherwise("none")
        closed = F.coalesce("closed_by", F.when(F.col("ends") == "own", own).otherwise(F.col("ends")))
        part = stored(done.select("slice", "client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", closed.alias("closed_by"), "path", "final", left_open.alias("left_open")), "fronts")
        parts.append(part)
        tables.append(part)
        tails = part.where("left_open").select("slice", "client_id", "session_id", "start_us", "end_us", "final")
        # the groups behind those that were settled just now and that are front throughout
        ready = todo.where("waits").join(ready.where("ends IS NULL").select((F.col("slice") + 1).alias("slice")), "slice", "left_semi")
    names = ["slice", "client_id", "session_id", "start_us", "end_us", "n_clicks", "n_late", "value_cents", "closed_by", "path", "final"]
    out = pieces.where("kind = 'open'").select(*names)
    for part in parts:
        out = out.unionByName(part.select(*names))
    return out, tables


def sessions(clicks: DataFrame, rows: int = ROWS) -> DataFrame:
    """One row per session of clicks (click_id, ts, arrived_at, client_id, kind, value): client_id,
    session_id, start_us, end_us, n_clicks, n_late, value_cents, closed_by and path_sha256.

    Rows without click_id, client_id or ts are left out; of rows with one click_id that of the least
    time is taken (then client, and so on). A click without arrived_at is not late. A null, NaN or huge value (9e16 or more)
    counts 0 and ends no session; so does a null kind. Late clicks before a client's first session
    are in none; a client with late clicks only has no session. Ties go by click_id. An empty table gives no
    rows; other columns are not read."""
    n = max(partitions(clicks.sparkSession), -(-clicks.count() // rows))
    pieces = stored(_pieces(_taken(clicks), n), "pieces")
    parts, tables = _stitched(pieces)
    path = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("n_clicks") > 0, F.struct("slice", "path")))), lambda x: x["path"]), ",")
    joined = parts.groupBy("client_id", "session_id").agg(
        F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us"), F.sum("n_clicks").alias("n_clicks"), F.sum("n_late").alias("n_late"), F.sum("value_cents").alias("value_cents"),
        F.coalesce(F.max("closed_by"), F.when(F.max_by("final", "slice"), "end").otherwise("none")).alias("closed_by"), F.sha2(path, 256).alias("path_sha256"),
    )
    joined = stored(joined, "joined")
    discard(*tables)
    done = pieces.where("kind = 'done'").withColumnRenamed("path", "path_sha256").select(*joined.columns)
    return done.unionByName(joined)
