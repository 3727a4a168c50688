"""Sessionisation: ``fct_events`` -> ``fct_sessions`` by an inactivity gap.

A new session starts at a user's first event and at every event whose gap to
the previous event of the same user is strictly greater than the gap
(default 30 minutes). Sessions are numbered 1, 2, ... per user. Events
without a time come last: the first of them has an unknown gap and stays in
the session before it; for each further one the previous time is unknown,
which starts a session.

Scale notes
-----------
The textbook form is ``lag`` + running ``sum`` over ``Window.partitionBy(user)``,
which sorts *all* events of a user inside one task. Here all events are put in
one order (user, time, event id) and cut into ranges, so a heavy user, or a
single user-hour, spreads over as many tasks as its rows need. A task reads its
sorted range as a stream of Arrow batches and reduces it to session pieces; the
pieces (a few rows a session) are written, as the ranges must not be drawn a
second time. Sessions open at a border are stitched by a prefix pass over the
first and last event of every range: one row a range, on the driver. The rollup
then adds up the pieces of the sessions that a border of a range or of a batch
cuts; all others are one row already and pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from productlens import config
from productlens.functions.columns import epoch_seconds_rounded
from productlens.session import scratch_folder, ship_package

#: sessions of single events without time that one row is dealt out to at once
LOOSE_BLOCK = 4096


def _gap_us(gap_minutes: int) -> int:
    return int(gap_minutes) * 60 * 1_000_000


def _is(name: str, feature: str | None = None) -> Column:
    cond = F.col("event_name") == name
    if feature is not None:
        cond = cond & (F.col("feature_name") == feature)
    return cond.cast("int")


def session_counts(feature: str = config.FEATURE) -> dict[str, Column]:
    """W4 counts by output column; NULL names count as unknown, so a sum of none is NULL."""
    feats = ((config.EXPOSED, "exposed"), (config.VIEWED, "viewed"), (config.USED, "used"))
    return {**{alias: _is(name) for alias, name in config.SESSION_EVENT_COUNTS},
            **{f"{feature}_{suffix}": _is(name, feature) for name, suffix in feats}}


def _filled(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values with 0 for NULL, and which are NULL."""
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False), pc.is_null(column).to_numpy(zero_copy_only=False)


def range_pieces(batches: Iterator[pa.RecordBatch], part: int, gap_us: int, counts: list[str]) -> Iterator[pa.RecordBatch]:
    """Session pieces of one sorted range: of each session and batch the counts, and a row for each raw session id.

    ``seq`` numbers the sessions of a user within the range, whose first event counts as a start; ``at`` numbers the
    rows of the range. Only the first row of a piece carries counts. A piece that begins and ends inside the range and a
    batch is a ``whole`` session: one row, whose ``raw_ids`` counts the raw session ids.
    """
    user, time, no_time, seq, at = None, 0, True, -1, 0  # of the last event before the batch
    for b in batches:
        if not b.num_rows:
            continue
        users, (us, unknown) = b.column("user_id"), _filled(b.column("_us"))
        code = users.dictionary_encode(null_encoding="encode").indices.to_numpy()
        other = np.append(seq < 0 or users[0].as_py() != user, code[1:] != code[:-1])
        before, none_before = np.append(time, us[:-1]), np.append(no_time, unknown[:-1])
        starts = other | none_before | (~unknown & (us - before > gap_us))
        begun = np.cumsum(starts)
        base = np.maximum.accumulate(np.where(other, begun, -1))  # starts up to the user's first event
        number = np.where(base < 0, seq + begun, begun - base)
        head = np.flatnonzero(np.append(True, starts[1:]))
        tail = np.append(head[1:], b.num_rows) - 1
        piece = np.repeat(np.arange(len(head)), tail + 1 - head)
        raw = b.column("session_id").dictionary_encode()
        raw_code, no_raw = _filled(raw.indices)
        ids = max(1, len(raw.dictionary))
        pairs = np.unique(piece * (ids + 1) + np.where(no_raw, ids, raw_code))
        of, own = pairs // (ids + 1), pairs % (ids + 1)
        first = np.append(True, of[1:] != of[:-1])
        whole = starts[head]  # what goes before is known but at the range's first event; what follows the last piece is not
        whole[0] &= at > 0
        whole[-1] = False
        raw_ids = np.bincount(of[own < ids], minlength=len(head))
        keep = first | ((own < ids) & ~whole[of])  # a piece's NULL id is its last pair, and needed only where it is the first
        of, own, first = of[keep], own[keep], first[keep]

        def ints(values, null=None):
            return pa.array(values, pa.int64(), mask=null)

        columns = {"part": pa.array(np.full(len(of), part, np.int32)), "at": ints(at + np.arange(len(of))),
                   "user_id": users.take(pa.array(head[of])), "seq": ints(number[head][of]),
                   "head_us": ints(us[head][of], unknown[head][of]), "tail_us": ints(us[tail][of], unknown[tail][of])}
        latest = np.maximum.reduceat(np.where(unknown, np.iinfo(np.int64).min, us), head)
        columns["first_us"] = columns["head_us"]  # events without time come last
        columns["last_us"] = ints(latest[of], unknown[head][of])
        columns["whole"] = pa.array(whole[of])
        columns["raw_ids"] = ints(raw_ids[of])
        columns["raw_id"] = raw.dictionary.take(pa.array(np.minimum(own, ids - 1), mask=own == ids))
        columns["event_count"] = ints((tail + 1 - head)[of], ~first)
        for name in counts:
            value, null = _filled(b.column(name))
            some = np.add.reduceat((~null).astype(np.int64), head)
            columns[name] = ints(np.add.reduceat(value.astype(np.int64), head)[of], ~first | (some[of] == 0))
        yield pa.RecordBatch.from_pydict(columns)
        user, time, no_time, seq, at = users[-1].as_py(), us[-1], unknown[-1], int(number[-1]), at + len(of)


def session_pieces(events: DataFrame, gap_minutes: int = config.SESSION_GAP_MINUTES,
                   feature: str = config.FEATURE) -> DataFrame:
    """Session pieces of ranges of the events in the order (user, time, event id), written to the shared folder."""
    spark = events.sparkSession
    ship_package(spark)
    counts = session_counts(feature)
    order = ["user_id", F.col("_us").isNull(), "_us", "event_id"]
    ev = events.select("user_id", "event_id", F.unix_micros("event_time_final").alias("_us"), "session_id",
                       *[c.alias(name) for name, c in counts.items()])
    gap_us, names = _gap_us(gap_minutes), list(counts)

    def run(batches):
        return range_pieces(batches, TaskContext.get().partitionId(), gap_us, names)

    schema = ("part int, at long, user_id string, seq long, head_us long, tail_us long, first_us long, last_us long, "
              "whole boolean, raw_ids long, raw_id string, event_count long, " + ", ".join(f"{n} long" for n in names))
    pieces = (ev.repartitionByRange(*order).sortWithinPartitions(*order)
              .select("user_id", "_us", "session_id", *names).mapInArrow(run, schema))
    path = scratch_folder(spark, "session-pieces")
    pieces.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def stitch(ends: list, gap_us: int) -> list[tuple[int, str, int]]:
    """(range, its first user, sessions of that user that began before it and don't reach into it), from the ranges' ends."""
    out, user, tail, sessions = [], None, None, 0
    for e in ends:
        same = sessions > 0 and e.first.user_id == user
        base = 0
        if same:
            new = tail is None or (e.first.head_us is not None and e.first.head_us - tail > gap_us)
            base = sessions if new else sessions - 1
            if base:
                out.append((e.part, user, base))
        sessions = e.last.seq + 1 + (base if e.first.user_id == e.last.user_id else 0)
        user, tail = e.last.user_id, e.last.tail_us
    return out


def number_pieces(pieces: DataFrame, gap_minutes: int = config.SESSION_GAP_MINUTES) -> DataFrame:
    """Attach ``session_number`` to every piece."""
    spark = pieces.sparkSession
    edge = F.struct("user_id", "seq", "head_us", "tail_us")
    ends = (pieces.groupBy("part").agg(F.min_by(edge, "at").alias("first"), F.max_by(edge, "at").alias("last"))
            .orderBy("part").collect())  # one row a range
    carried = spark.createDataFrame(stitch(ends, _gap_us(gap_minutes)), "_part int, _user string, _base long")
    here = (F.col("part") == F.col("_part")) & F.col("user_id").eqNullSafe(F.col("_user"))
    return pieces.join(F.broadcast(carried), here, "left").select(  # one row a range at most
        "user_id", (F.coalesce("_base", F.lit(0)) + F.col("seq") + 1).alias("session_number"),
        F.timestamp_micros("first_us").alias("first_at"), F.timestamp_micros("last_us").alias("last_at"),
        *pieces.columns[pieces.columns.index("whole"):])


def rollup_pieces(numbered: DataFrame, feature: str = config.FEATURE) -> DataFrame:
    """Per (user, session_number) rollup and derived columns."""
    sums = ["event_count", *session_counts(feature)]
    cut = numbered.where(~F.col("whole")).groupBy("user_id", "session_number").agg(
        F.min("first_at").alias("session_start_at"), F.max("last_at").alias("session_end_at"),
        *[F.sum(c).alias(c) for c in sums], F.count_distinct("raw_id").alias("raw_session_id_count"))
    s = numbered.where("whole").select(
        "user_id", "session_number", F.col("first_at").alias("session_start_at"), F.col("last_at").alias("session_end_at"),
        *sums, F.col("raw_ids").alias("raw_session_id_count")).union(cut)
    used = f"{feature}_used"
    return s.select(
        "user_id",
        F.concat_ws("", "user_id", F.lit("_s"), F.lpad(F.col("session_number").cast("string"), 6, "0"))
        .alias("session_key"),
        "session_number", "session_start_at", "session_end_at",
        epoch_seconds_rounded("session_end_at", "session_start_at").alias("session_duration_seconds"),
        *sums,
        (F.col(used) > 0).alias(f"used_{feature}_in_session"),
        "raw_session_id_count",
    )


def sessionize(events: DataFrame, gap_minutes: int = config.SESSION_GAP_MINUTES,
               feature: str = config.FEATURE) -> DataFrame:
    """Composite W: ``fct_events`` -> ``fct_sessions``."""
    return rollup_pieces(number_pieces(session_pieces(events, gap_minutes, feature), gap_minutes), feature)


def session_windows(events: DataFrame, gap_minutes: int = config.SESSION_GAP_MINUTES) -> DataFrame:
    """Start, end and size of the sessions of all events, by Spark's ``session_window``.

    A second method beside ``sessionize``. A window ends at its last event plus the gap, so the end is the last event's time.
    Events without time have no window: the first of a user joins the last window, or makes the only session; each further
    one is a session. They are only counted, as such sessions differ in nothing.
    """
    ev = events.select("user_id", F.col("event_time_final").alias("ts"))
    none = F.lit(None).cast("timestamp")
    windows = (ev.where(F.col("ts").isNotNull())
               .groupBy("user_id", F.session_window("ts", f"{int(gap_minutes)} minutes").alias("w"))
               .agg(F.min("ts").alias("session_start_at"), F.max("ts").alias("session_end_at"),
                    F.count(F.lit(1)).alias("event_count"))
               .select("user_id", "session_start_at", "session_end_at", "event_count", F.lit(0).cast("long").alias("_loose")))
    loose = (ev.where(F.col("ts").isNull()).groupBy("user_id").agg(F.count(F.lit(1)).alias("_loose"))
             .select("user_id", none.alias("session_start_at"), none.alias("session_end_at"), F.lit(0).cast("long").alias("event_count"),
                     "_loose"))
    user = Window.partitionBy("user_id")  # a user's windows lie more than the gap apart, so they are few
    rows = windows.unionByName(loose).withColumns({"_last": F.max("session_start_at").over(user), "_more": F.max("_loose").over(user)})
    joined = (F.col("session_start_at") == F.col("_last")) & (F.col("_more") > 0)
    timed = F.col("session_start_at").isNotNull()
    size = F.when(timed, F.col("event_count") + F.when(joined, 1).otherwise(0)).otherwise(F.lit(1)).cast("long")
    times = F.when(timed, F.lit(1)).otherwise(F.col("_loose") - F.when(F.col("_last").isNotNull(), 1).otherwise(0))
    # dealt out in blocks, so that no array grows with a user's events
    blocks = F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / F.lit(LOOSE_BLOCK)).cast("long"))
    block = F.least(F.lit(LOOSE_BLOCK).cast("long"), F.col("_times") - F.col("_block") * F.lit(LOOSE_BLOCK))
    return (rows.select("user_id", "session_start_at", "session_end_at", size.alias("event_count"), times.cast("long").alias("_times"))
            .where(F.col("_times") > 0).withColumn("_block", F.explode(blocks))
            .withColumn("_each", F.explode(F.sequence(F.lit(1).cast("long"), block)))
            .select("user_id", "session_start_at", "session_end_at", "event_count"))
