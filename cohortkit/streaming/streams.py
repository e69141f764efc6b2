"""Structured Streaming forms of the log operators."""

from __future__ import annotations

import bisect
import datetime
import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cohortkit.functions.scale import count_if, seconds_between
from cohortkit.operators.events import KINDS, REVEAL_EVENTS, kind_of
from cohortkit.session import scratch_path
from cohortkit.streaming.incremental import read_if_exists

USER = ["course_id", "username"]


def daily_activity_stream(log: DataFrame, delay: str = "1 day") -> DataFrame:
    """Event counters per (course, user, day); a day closes ``delay`` after the latest event time."""
    et = F.col("event_type")
    kept = log.filter((F.col("username") != "") & ~et.contains("/xblock/")).withWatermark("time", delay)
    return kept.groupBy(*USER, F.window("time", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("nevents"), count_if(et == "play_video").alias("nvideo"),
        count_if(et == "problem_check").alias("nproblem_check"), count_if(et.isin(REVEAL_EVENTS)).alias("nshow_answer"),
        F.min("time").alias("first_event"), F.max("time").alias("last_event"),
    ).withColumn("date", F.to_date("w.start")).drop("w")


def session_stream(log: DataFrame, gap: str, delay: str = "1 day") -> DataFrame:
    """Sessions per (course, user) with a gap of silence between them; the time on task is last minus first event."""
    kept = log.filter(F.col("username") != "").withWatermark("time", delay)
    return kept.groupBy(*USER, F.session_window("time", gap).alias("w")).agg(
        F.min("time").alias("session_start"), F.max("time").alias("session_end"), F.count(F.lit(1)).alias("nevents")
    ).withColumn("seconds", seconds_between(F.col("session_end"), F.col("session_start"))).drop("w")


def run_to_table(stream: DataFrame, keys: list[str], mode: str = "update", label: str = "stream", folder: str | None = None, late: list | None = None) -> DataFrame:
    """Runs a stream over all available input and returns the latest row per key.

    Results and state are kept in ``folder`` (a fresh one below the shared folder if none is
    named): a later call with the same folder goes on where the last one, finished or not,
    has stopped. ``late`` receives the number of rows behind the watermark. Each epoch overwrites its own folder, so an epoch run twice after a failure
    is stored once.
    """
    spark = stream.sparkSession
    root = folder or scratch_path(spark, label)

    def store(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/epoch={epoch}")

    query = (stream.writeStream.outputMode(mode).foreachBatch(store)
             .option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start())
    query.awaitTermination()
    if late is not None:
        late.append(rows_behind_watermark(query))
    out = read_if_exists(spark, f"{root}/out")
    if out is None:
        return spark.createDataFrame([], stream.schema)
    if mode != "update":
        return out.drop("epoch")
    rest = [c for c in out.columns if c not in (*keys, "epoch")]
    latest = out.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("r"))
    return latest.select(*keys, "r.*")


def rows_behind_watermark(query: StreamingQuery) -> int:
    """Input rows, or partial aggregates of them, that a query's state operators dropped as too late, from its progress reports."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


class OpenDays(StatefulProcessor):
    """Time on task of one (course, user): what may still change, and nothing else.

    The state holds the sums of the days that the watermark has not left behind, the times of
    the last events that it has passed (any, of some kind, of each kind), and the events that
    it has not passed. An event out of order takes its place among these. A timer after the
    user's last day and the longest gap removes the state.
    """

    def __init__(self, short: int, long: int):
        self.short, self.long = short * 60_000_000, long * 60_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "data string")

    def add(self, days: dict, last: list, at: int, date: str, bits: int) -> None:
        """Counts one event, the next in order of time."""
        sums = days.setdefault(date, [0] * (3 + 3 * len(KINDS)))

        def gap(i: int, limit: int) -> int:
            return at - last[i] if last[i] is not None and at - last[i] < limit else 0

        sums[0] += 1
        sums[1] += gap(0, self.short)
        sums[2] += gap(0, self.long)
        serial = gap(1, self.long)
        for k in range(len(KINDS)):
            if bits >> k & 1:
                sums[3 + 3 * k] += gap(2 + k, self.short)
                sums[4 + 3 * k] += gap(2 + k, self.long)
                sums[5 + 3 * k] += serial
                last[2 + k] = at
        last[0] = at
        if bits:
            last[1] = at

    def handleInputRows(self, key, rows, timerValues):
        state = json.loads(self.state.get()[0]) if self.state.exists() else {"days": {}, "last": [None] * (2 + len(KINDS)), "open": []}
        new = [[int(t), d, int(b)] for part in rows for t, d, b in zip(part["at"], part["date"], part["bits"])]
        passed = max(0, timerValues.getCurrentWatermarkInMs()) * 1000
        events = sorted(state["open"] + new)
        done = bisect.bisect_left(events, [passed])
        for event in events[:done]:
            self.add(state["days"], state["last"], *event)
        days, last = {d: list(v) for d, v in state["days"].items()}, list(state["last"])
        for event in events[done:]:
            self.add(days, last, *event)
        first = min(d for _, d, _ in new)
        today = str(datetime.datetime.fromtimestamp(passed / 1e6, datetime.timezone.utc).date())
        kept = {d: v for d, v in state["days"].items() if d >= today}
        self.state.update((json.dumps({"days": kept, "last": state["last"], "open": events[done:]}),))
        end = datetime.datetime.fromisoformat(events[-1][1] + "T00:00:00+00:00") + datetime.timedelta(days=1)
        for timer in self.handle.listTimers():
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(int(end.timestamp() * 1000) + self.long // 1000)
        yield pd.DataFrame([(*key, d, *v) for d, v in days.items() if d >= first], columns=OPEN_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.state.clear()
        yield pd.DataFrame([], columns=OPEN_COLUMNS)

    def close(self) -> None:
        pass


#: Columns of the sums that OpenDays keeps, in its order, after the number of events.
OPEN_SUMS = ["total_{short}", "total_{long}", *(f"{what}_{kind}_{limit}" for kind in KINDS for what, limit in (("total", "{short}"), ("total", "{long}"), ("serial", "{long}")))]
OPEN_COLUMNS = [*USER, "date", "n", *OPEN_SUMS]
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def time_on_task_stream(log: DataFrame, short: int = 5, long: int = 30, delay: str = "1 day", folder: str | None = None, late: list | None = None) -> DataFrame:
    """Time on task of a stream per (course, user, day), with the gaps over batch edges.

    Events may come out of order by up to ``delay``; later ones are dropped (``late`` receives
    their number). Results and state stay in ``folder``, so a stopped stream goes on there.
    Sums of 0 and of no gap are both null. The days are those of ``time_on_task`` over the
    events so far: a user's first day with a single event is left out. The session time zone is UTC.
    """
    spark: SparkSession = log.sparkSession
    kinds = kind_of(F.col("event_type"))
    bits = sum((F.when(kinds[k], 1 << i).otherwise(0) for i, k in enumerate(KINDS[1:], 1)), F.when(kinds[KINDS[0]], 1).otherwise(0))
    named = log.filter("username IS NOT NULL AND username != ''").filter(~F.col("event_type").contains("/xblock/")).withWatermark("time", delay)
    rows = named.select(*USER, "time", F.unix_micros("time").alias("at"), F.date_format("time", "yyyy-MM-dd").alias("date"), F.coalesce(bits, F.lit(0)).alias("bits"))
    schema = f"course_id string, username string, date string, n long, {', '.join(f'`{x}` long' for x in OPEN_SUMS)}"
    stream = rows.groupBy(*USER).transformWithStateInPandas(OpenDays(short, long), schema, "Update", "EventTime")
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)  # keyed state with timers needs this store
    try:
        out = run_to_table(stream, [*USER, "date"], label="time-on-task", folder=folder, late=late)
    finally:
        spark.conf.set(STORE, before)
    first = F.row_number().over(W.partitionBy(*USER).orderBy("date")) == 1
    out = out.withColumn("_first", first).filter("NOT (_first AND n = 1)")
    names = [x.replace("{short}", f"time_{short}").replace("{long}", f"time_{long}") for x in OPEN_SUMS]
    return out.select(*USER, F.to_date("date").alias("date"), *[F.nullif(F.round(F.col(f"`{x}`") / 1e6, 6), F.lit(0.0)).alias(n) for x, n in zip(OPEN_SUMS, names)])


STORE = "spark.sql.streaming.stateStore.providerClass"
