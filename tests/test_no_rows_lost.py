"""Rows and fields that loading and daily extension must not lose."""

import datetime
import json

from cohortkit.functions.text import repair_text
from cohortkit.operators.events import time_on_task
from cohortkit.sources import dumps as D, logs as L
from cohortkit.streaming import incremental as N

BASE = {"course_id": "O/C/R", "time": "2024-01-01T00:00:00Z", "username": "u", "event_type": "t"}


def _lines(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "value string")


def test_loosely_typed_fields_keep_their_row(spark):
    lines = _lines(
        spark, BASE | {"context": {"user_id": "", "path": "/a"}}, BASE | {"event_struct": {"currentTime": "12.5", "attempts": 1.0}},
        BASE | {"context": "", "page": "p"}, BASE | {"event": {"a": 1}, "context": {"user_id": "7"}}, '{"course_id": "a', "no json", "[1]", '"x"',
        '{"username": "a", "username": "b"}')
    rows = L.parse_log_lines(lines).collect()
    assert len(rows) == 5
    assert rows[0].context.user_id is None and rows[0].context.path == "/a" and rows[0].time == datetime.datetime(2024, 1, 1)
    assert rows[1].event_struct.currentTime == 12.5 and rows[1].event_struct.attempts == 1
    assert rows[2].course_id == "O/C/R" and rows[2].page == "p"
    assert rows[3].event == '{"a":1}' and rows[3].context.user_id == 7
    assert sorted(r.value for r in L.bad_log_lines(lines).collect()) == sorted(['{"course_id": "a', "no json", "[1]", '"x"'])


def test_a_repeated_key_does_not_end_the_job(spark):
    line = '{"event_type": "problem_check", "time": "2024-01-01T00:00:00Z", "context": {"label": "x", "label": "z", "user_id": "1"}, "event": %s}'
    rows = L.rephrase_events(_lines(spark, line % '{"k": 1, "k": 2, "a-b": 3, "a_b": 4}', line % '{"problem": "p"}')).collect()
    assert dict(rows[0].event_struct) == {"k": "2", "a_b": "4"} and dict(rows[1].event_struct) == {"problem": "p"}
    assert json.loads(rows[0].mongoid)["context.label"] == "z"


def test_rows_without_a_course_are_written_and_days_are_pruned(spark, tmp_path):
    rows = [("c", datetime.datetime(2024, 1, d, 12)) for d in (1, 2, 3)] + [(None, datetime.datetime(2024, 1, 2, 12))]
    path = str(tmp_path / "log")
    for _ in range(2):
        L.write_event_log(spark.createDataFrame(rows, "course_id string, time timestamp"), path)
    assert L.read_partitioned_log(spark, path).count() == 4
    some = L.read_partitioned_log(spark, path, "2024-01-02", "2024-01-02")
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]


def _log(spark, course, days):
    rows = [(course, "u", datetime.datetime(2024, 1, d, 10, m), "problem_check", "x", None, None) for d in days for m in (0, 1, 2)]
    return spark.createDataFrame(rows, "course_id string, username string, time timestamp, event_type string, event string, module_id string, page string")


def test_each_course_has_its_own_mark(spark, tmp_path):
    target = str(tmp_path / "tot")
    a, b = _log(spark, "A", [1, 2, 3]), _log(spark, "B", [1, 2])
    assert N.incremental_append(spark, time_on_task, a, target, carries_users=True) == 3
    assert N.incremental_append(spark, time_on_task, a.unionByName(b), target, carries_users=True) == 2
    assert N.incremental_append(spark, time_on_task, a.unionByName(b), target, carries_users=True) == 0
    got = spark.read.parquet(target)
    assert sorted((r.course_id, r.date.day) for r in got.collect()) == [("A", 1), ("A", 2), ("A", 3), ("B", 1), ("B", 2)]
    late = {r.course_id: (r.n_late, r.n_new) for r in N.late_rows(a.unionByName(b).unionByName(_log(spark, "B", [3])).unionByName(_log(spark, "C", [1])), got).collect()}
    assert late == {"A": (9, 0), "B": (6, 3), "C": (0, 3)}
    kept = N.drop_last_day(a.unionByName(b)).selectExpr("course_id", "day(time) AS d").distinct().collect()
    assert sorted(map(tuple, kept)) == [("A", 1), ("A", 2), ("B", 1)]


def test_text_is_repaired_at_any_depth(spark):
    plain = "naïve café déjà vu"
    rows, text = [], plain
    for _ in range(6):
        text = text.encode().decode("latin-1")
        rows.append((text,))
    assert {r.a for r in repair_text(spark.createDataFrame(rows, "a string"), ["a"]).collect()} == {plain}


def test_forum_dates_keep_seconds_and_zone(spark):
    lines = _lines(spark, {"_id": {"$oid": "a"}, "created_at": {"$date": "2014-01-02T05:06:07.25+02:00"}, "updated_at": {"$date": 1388628367000}})
    r, old = D.rephrase_forum(lines).first(), D.rephrase_forum(lines, compat=True).first()
    assert r.created_at == datetime.datetime(2014, 1, 2, 3, 6, 7, 250000) and r.updated_at == datetime.datetime(2014, 1, 2, 2, 6, 7)
    assert old.created_at == datetime.datetime(2014, 1, 2, 5, 6)
