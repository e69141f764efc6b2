"""The stateful stream against the batch operator: several files, restarts, disorder and late rows."""

import datetime
import random

from pyspark.sql import functions as F

from cohortkit.operators.events import time_on_task
from cohortkit.session import scratch_path
from cohortkit.streaming import streams as S

SCHEMA = "course_id string, username string, time timestamp, event_type string"
KINDS = ["play_video", "problem_check", "edx.forum.thread.viewed", "page", "/wiki/x", "a/xblock/b"]


def events(count=700, days=6):
    rnd = random.Random(4)
    start = datetime.datetime(2024, 3, 1)
    rows = []
    for _ in range(count):
        at = start + datetime.timedelta(seconds=rnd.choice([rnd.randrange(86400 * days), rnd.randrange(86400 * days) // 7200 * 7200 + rnd.randrange(1500)]), microseconds=rnd.randrange(10**6))
        rows.append(("c", rnd.choice(["u1", "u2", "u3", "u4", "", None]), at, rnd.choice(KINDS)))
    return sorted(rows, key=lambda r: r[2])


def batch(spark, rows):
    out = time_on_task(spark.createDataFrame(rows, SCHEMA))
    keys = ["course_id", "username", "date"]
    return out.select(*keys, *[F.nullif(F.round(c, 6), F.lit(0.0)).alias(c) for c in out.columns if c not in keys])


def values(df):
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def feed(spark, path, folder, parts, **kw):
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    files = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return S.time_on_task_stream(files, folder=folder, **kw)


def test_files_restart_and_disorder(spark):
    rows = events()
    rnd = random.Random(8)
    shifted = sorted(rows, key=lambda r: r[2] + datetime.timedelta(hours=rnd.random() * 20))
    parts = [shifted[i:i + 100] for i in range(0, len(shifted), 100)]
    path, folder = scratch_path(spark, "t"), scratch_path(spark, "t")
    late: list = []
    feed(spark, path, folder, parts[:3], late=late)
    feed(spark, path, folder, parts[3:4], late=late)  # a new query on the same folder goes on
    out = feed(spark, path, folder, parts[4:], late=late)
    assert values(out) == values(batch(spark, rows)) and sum(late) == 0


def test_late_rows_are_counted_and_left_out(spark):
    rows = events(300)
    path, folder, late = scratch_path(spark, "t"), scratch_path(spark, "t"), []
    old = [("c", "u1", datetime.datetime(2024, 2, 1, 5, i), "page") for i in range(7)]
    out = feed(spark, path, folder, [rows], delay="1 hour", late=late)
    out = feed(spark, path, folder, [old], delay="1 hour", late=late)
    assert sum(late) == 7 and values(out) == values(batch(spark, rows))


def test_state_of_silent_users_goes(spark):
    path, folder = scratch_path(spark, "t"), scratch_path(spark, "t")
    day = lambda n, u: [("c", u, datetime.datetime(2024, 3, n, 9, m), "page") for m in (0, 1)]
    feed(spark, path, folder, [day(1, "silent"), day(5, "busy"), day(9, "busy"), day(12, "busy")], delay="1 hour")
    before = spark.conf.get(S.STORE)
    spark.conf.set(S.STORE, S.ROCKS)
    try:
        state = spark.read.format("statestore").option("stateVarName", "open").load(f"{folder}/state").select("key.username").distinct().collect()
    finally:
        spark.conf.set(S.STORE, before)
    assert [r.username for r in state] == ["busy"]


def test_empty_stream(spark):
    path, folder = scratch_path(spark, "t"), scratch_path(spark, "t")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    assert feed(spark, path, folder, []).collect() == []
