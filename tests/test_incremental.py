from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F, types as T

from cohortkit.operators.events import time_on_task
from cohortkit.schema import conform
from cohortkit.sources.dumps import load_checked, load_table
from cohortkit.sources.sinks import combine, export
from cohortkit.streaming import incremental as N, streams as S

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)
COLS = "course_id string, username string, time timestamp, event_type string"


def _rows(n=600):
    kinds = ["play_video", "problem_check", "edx.forum.x", "textbook.a", "other"]
    # 7 minute steps cross midnight with running gaps
    return [("c", f"u{i % 3}", T0 + timedelta(minutes=7 * i, seconds=i % 50), kinds[(i // 2) % 5]) for i in range(n)]


def _table(df):
    cols = sorted(df.columns)
    out = []
    for r in df.select(*cols).collect():
        # no gap and a sum of nothing read the same
        out.append(tuple(round(v, 5) if isinstance(v, float) and v else (None if v == 0 else v) for v in r))
    return sorted(out, key=repr)


def test_append_equals_full_run(spark, tmp_path):
    log = spark.createDataFrame(_rows(), COLS)
    target = str(tmp_path / "tot")
    assert N.incremental_append(spark, time_on_task, N.bound(log, end="2024-01-01"), target, carries_users=True) == 1
    assert N.incremental_append(spark, time_on_task, N.bound(log, end="2024-01-02"), target, carries_users=True) == 1
    N.incremental_append(spark, time_on_task, log, target, carries_users=True)
    assert N.incremental_append(spark, time_on_task, log, target, carries_users=True) == 0  # nothing new
    assert _table(spark.read.parquet(target)) == _table(time_on_task(log))


def test_stream_with_carry_equals_batch(spark, tmp_path):
    rows = _rows(240)
    src = str(tmp_path / "in")
    for i in range(3):  # three files, one per micro-batch, cut in the middle of running gaps
        spark.createDataFrame(rows[i * 80:(i + 1) * 80], COLS).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    full = time_on_task(spark.createDataFrame(rows, COLS))
    assert _table(S.time_on_task_stream(stream)) == _table(full)


def test_late_rows_are_dropped_by_the_watermark(spark, tmp_path):
    src = str(tmp_path / "late")
    make = lambda *days: spark.createDataFrame([("c", "u", T0 + timedelta(days=d), "play_video") for d in days], COLS)
    for batch in (make(0, 10), make(11), make(1)):
        batch.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(make(0).schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = S.run_to_table(S.daily_activity_stream(stream, "1 day"), ["course_id", "username", "date"])
    assert {str(r.date) for r in out.collect()} == {"2024-01-01", "2024-01-11", "2024-01-12"}


def test_sessions_gap_is_strict(spark):
    log = spark.createDataFrame([("c", "u", T0 + timedelta(seconds=s), "x") for s in (0, 1799, 3599, 3600, 9000)], COLS)
    got = sorted((r.nevents, r.seconds) for r in N.sessions(log, 1800, slot_s=600).collect())
    assert got == [(1, 0.0), (2, 1.0), (2, 1799.0)]


def test_stale_courses(spark):
    at = lambda d: T0 + timedelta(days=d)
    cols = "course_id string, updated_at timestamp"
    target = spark.createDataFrame([("a", at(5)), ("b", at(5))], cols)
    dep = spark.createDataFrame([("a", at(4)), ("b", at(6)), ("c", at(1))], cols)
    assert {r[0] for r in N.stale_courses(target, [dep]).collect()} == {"b", "c"}
    assert {r[0] for r in N.stale_courses(target, [dep], force=True).collect()} == {"a", "b", "c"}


def test_load_and_export(spark, tmp_path):
    bad = tmp_path / "x.json"
    bad.write_text('{"a": 1, "b": "x"}\n{"a": oops}\n')
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    assert load_table(spark, str(bad), schema, max_bad=1).count() == 1
    with pytest.raises(ValueError):
        load_table(spark, str(bad), schema)
    rows, rejects = load_checked(spark, str(bad), schema, max_bad=1, target=str(tmp_path / "loaded"))
    assert [tuple(r) for r in rows.collect()] == [(1, "x")] and rows.columns == ["a", "b"]
    assert [r.record for r in rejects.collect()] == ['{"a": oops}']
    (tmp_path / "none.json").write_text("")
    assert [x.count() for x in load_checked(spark, str(tmp_path / "none.json"), schema)] == [0, 0]
    df = spark.range(10).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b"))
    export(df, str(tmp_path / "csv"), "csv", gzip=True)
    assert load_table(spark, str(tmp_path / "csv"), schema, "csv").count() == 10
    assert combine({"x": df, "y": df}, add_course_id=True).count() == 20
    with pytest.raises(ValueError):
        combine({"x": df, "y": df.drop("b")})


def test_conform_nested(spark):
    df = spark.sql("SELECT struct('7' AS n, 'x' AS f) AS s, array('1', 'b') AS xs, 1 AS k UNION ALL SELECT struct('q', '0.5'), array('2'), 2")
    schema = T.StructType([
        T.StructField("k", T.LongType()), T.StructField("xs", T.ArrayType(T.LongType())),
        T.StructField("s", T.StructType([T.StructField("n", T.LongType()), T.StructField("f", T.DoubleType())]))])
    ok, rejects = conform(df, schema)
    assert ok.count() == 0 and sorted((r.k, tuple(r.bad_fields)) for r in rejects.collect()) == [(1, ("xs",)), (2, ("s",))]
    with pytest.raises(ValueError):
        conform(df.withColumn("new", F.lit(1)), schema)
