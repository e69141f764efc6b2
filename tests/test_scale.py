"""Skew-safe building blocks against plain reckoning."""

import math
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta, timezone

from pyspark.sql import Window as W, functions as F

from cohortkit.functions.scale import group_quantiles, lag_by_slot, most_frequent, range_lookup, salted_lookup
from cohortkit.operators.events import person_course_day, time_on_asset, time_on_task

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_quantiles_match_sorting(spark):
    rng = random.Random(1)
    rows = [("hot", rng.choice([0.0, -1.5, 3.0, rng.random() * 1e6])) for _ in range(3000)]
    rows += [(f"g{i % 7}", None if i % 5 == 0 else rng.gauss(0, 10)) for i in range(300)] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    for mode in ("disc", "cont"):
        got = {r.g: r for r in group_quantiles(df, ["g"], {"q1": (F.col("v"), 0.1), "q5": (F.col("v"), 0.5), "q9": (F.col("v"), 0.95)}, mode).collect()}
        groups = defaultdict(list)
        for g, v in rows:
            if v is not None:
                groups[g].append(v)
        assert set(got) == set(groups)
        for g, vs in groups.items():
            vs.sort()
            for name, p in (("q1", 0.1), ("q5", 0.5), ("q9", 0.95)):
                if mode == "disc":
                    want = vs[max(math.ceil(p * len(vs) - 1e-9), 1) - 1]
                else:
                    at = p * (len(vs) - 1)
                    lo = vs[math.floor(at)]
                    want = lo + (vs[math.ceil(at)] - lo) * (at - math.floor(at))
                assert abs(got[g][name] - want) < 1e-9


def test_lag_by_slot_equals_plain_lag(spark):
    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.6 else f"u{i % 9}", T0 + timedelta(minutes=rng.randrange(60 * 24 * 9)), i) for i in range(800)]
    df = spark.createDataFrame(rows, "u string, t timestamp, v int")
    got = lag_by_slot(df, ["u"], ["t", "v"], {"v": "pv"}, F.to_date("t"))
    want = df.withColumn("w", F.lag("v").over(W.partitionBy("u").orderBy("t", "v")))
    assert got.join(want, ["u", "t", "v"]).filter("NOT (pv <=> w)").count() == 0 and got.count() == len(rows)


def test_most_frequent_breaks_ties_by_least_value(spark):
    df = spark.createDataFrame([("a", "y", 2), ("a", "x", 2), ("a", "xx", 2), ("a", "z", 1), ("b", "q", 5)], "k string, v string, n int")
    got = {r.k: (r.v, r.n, r.d) for r in most_frequent(df, ["k"], "v", F.col("n"), distinct_as="d").collect()}
    assert got == {"a": ("x", 2, 4), "b": ("q", 5, 1)}


def test_range_lookup_edges(spark):
    ranges = spark.createDataFrame([(10, 20, "a"), (21, 70000, "b"), (100000, 100000, "c")], "s long, e long, name string")
    points = spark.createDataFrame([(i,) for i in (9, 10, 20, 21, 65535, 65536, 70000, 70001, 100000)], "p long")
    got = {r.p: r.name for r in range_lookup(points, "p", ranges, "s", "e", 65536).collect()}
    assert got == {9: None, 10: "a", 20: "a", 21: "b", 65535: "b", 65536: "b", 70000: "b", 70001: None, 100000: "c"}


def test_salted_lookup_keeps_rows(spark):
    big = spark.createDataFrame([("hot", i) for i in range(500)] + [("x", 1), (None, 2)], "k string, i int")
    small = spark.createDataFrame([("hot", "h")], "k string, v string")
    got = Counter(r.v for r in salted_lookup(big, small, ["k"]).collect())
    assert got == {"h": 500, None: 2}


def _log(spark, rows):
    data = [("c", u, T0 + timedelta(seconds=s), e, m) for u, s, e, m in rows]
    return spark.createDataFrame(data, "course_id string, username string, time timestamp, event_type string, module_id string")


def test_gap_edges(spark):
    # exactly 300 s counts for the daily gaps but not for time on task; the same at 1800 s for the long cut-off
    log = _log(spark, [("u", 3500, "play_video", "m"), ("u", 3800, "play_video", "m"), ("u", 5600, "play_video", "m"), ("v", 3500, "problem_check", "m"),
                       ("v", 3700, "problem_show", "n"), ("", 3600, "play_video", "m"), ("w", 10, "a/xblock/b", "m"), ("lone", 50, "play_video", "m")])
    day = {r.username: r for r in person_course_day(log).collect()}
    assert set(day) == {"u", "v", "lone"} and day["u"].n_dt == 1 and day["u"].sum_dt == 300.0 and day["v"].sum_dt == 200.0 and day["lone"].avg_dt is None
    tot = {r.username: r for r in time_on_task(log).collect()}
    assert set(tot) == {"u", "v"}
    assert tot["u"].total_time_5 is None and tot["u"].total_time_30 == 300.0 and tot["u"].total_video_time_30 == 300.0
    assert tot["v"].total_problem_time_5 == 200.0 and tot["v"].serial_problem_time_30 == 200.0
    asset = {(r.username, r.module_id): r for r in time_on_asset(log).collect()}
    assert asset[("u", "m")].time_umid5 is None and asset[("u", "m")].time_umid30 == 300.0


def test_interleaved_kinds(spark):
    log = _log(spark, [("u", 0, "play_video", None), ("u", 100, "problem_check", None), ("u", 200, "pause_video", None), ("u", 260, "other", None), ("u", 300, "problem_show", None)])
    r = time_on_task(log).first()
    assert (r.total_time_30, r.total_video_time_30, r.serial_video_time_30, r.total_problem_time_30, r.serial_problem_time_30) == (300.0, 200.0, 100.0, 200.0, 200.0)


def test_lookup_copies_count_in_the_plan(spark):
    """Copies of a table are not broadcast because one of them would be small, and facts about items are not copied."""
    big, small = spark.range(1000).withColumn("k", F.col("id") % 7), spark.range(300_000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    for salts in (16, 1):
        out = salted_lookup(big, small, ["k"], "left", salt_by=["id"], salts=salts)
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
        assert ("_salt" in plan) == (salts > 1)
        assert out.count() == 1000
