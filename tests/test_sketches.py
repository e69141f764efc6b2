import random
from collections import defaultdict

from pyspark.sql import functions as F

from cohortkit.functions import sketches as S
from cohortkit.functions.scale import safe_corr
from cohortkit.operators import items as I


def log(spark, rows):
    return spark.createDataFrame(rows, "course string, day string, user string").withColumn("day", F.to_date("day"))


def test_rolling_distinct_against_sets(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "a", "a", "b", None]), f"2024-01-{rnd.randint(1, 28):02d}", rnd.choice([None, *map(str, range(60))])) for _ in range(900)]
    rows += [("hot", f"2024-02-{i % 9 + 1:02d}", f"u{i % 700}") for i in range(4000)] + [("null", "2024-01-05", None), ("none", None, "x")]
    sets, want = defaultdict(set), {}
    for k, d, u in rows:
        if d:
            sets[k, d].add(u)
    for k, d in sets:
        year, month, day = d.split("-")
        near = {x for x in range(int(day) - 4, int(day) + 1)}
        want[k, d] = len(set().union(*[v for (k2, d2), v in sets.items() if k2 == k and d2[:7] == d[:7] and int(d2[8:]) in near]) - {None})
    got = {(r.course, str(r.day)): r.n for r in S.rolling_distinct(log(spark, rows), ["course"], "day", "user", 5).collect()}
    # windows of the first days of February may reach January, where "hot" has no rows
    assert got == want


def test_empty_log(spark):
    none = log(spark, [])
    assert S.rolling_distinct(none, ["course"], "day", "user", 7).count() == 0
    assert S.merge_distinct(S.distinct_sketches(none, ["course", "day"], "user"), ["course"]).count() == 0


def test_daily_sketches_merge_to_the_whole(spark):
    rows = log(spark, [("a", f"2024-01-{i % 20 + 1:02d}", f"u{i * 7919 % 9000}") for i in range(30_000)])
    daily = S.distinct_sketches(rows, ["course", "day"], "user")
    merged = S.merge_distinct(daily, ["course"]).select(S.distinct_estimate()).first()[0]
    assert merged == S.distinct_sketches(rows, ["course"], "user").select(S.distinct_estimate()).first()[0]
    assert abs(merged - 9000) <= 5 * S.hll_error() * 9000


def test_quantile_sketches_merge_within_their_rank_error(spark):
    rows = spark.range(50_000).select(F.lit("a").alias("course"), (F.col("id") % 11).alias("day"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    daily = S.quantile_sketches(rows, ["course", "day"], {"v": F.col("v")})
    merged = S.merge_quantiles(daily, ["course"], ["v"])
    for share in (0.1, 0.5, 0.95):
        assert abs(merged.select(S.quantile_of("v", share)).first()[0] / 50_000 - share) <= 2 * S.KLL_RANK_ERROR
    nothing = S.quantile_sketches(rows.withColumn("v", F.lit(None).cast("long")), ["course"], {"v": F.col("v")})
    assert nothing.select(S.quantile_of("v", 0.5)).first()[0] is None


def test_reliability_with_zeros_has_no_grid(spark):
    rnd = random.Random(6)
    rows = [("c", u, p, rnd.choice([0.0, 0.5, 1.0])) for u in range(80) for p in range(6) if rnd.random() < 0.6]
    rows += [("alone", u, 1, float(u % 2)) for u in range(5)] + [("flat", u, p, 1.0) for u in range(4) for p in range(2)]
    scores = spark.createDataFrame(rows, "course_id string, user_id long, problem_nid long, y double")
    result = I.item_reliability(scores, "zero")
    assert "collect_list" not in result._jdf.queryExecution().analyzed().toString()
    users = {(c, u) for c, u, _, _ in rows if c != "flat"}
    values = {(c, u, p): y for c, u, p, y in rows}
    grid = spark.createDataFrame([(c, u, p, values.get((c, u, p), 0.0), sum(values.get((c, u, q), 0.0) for q in range(6))) for c, u in users for p in ([1] if c == "alone" else range(6))],
                                 "course_id string, user_id long, problem_nid long, y double, total double")
    want = grid.groupBy("course_id", "problem_nid").agg(F.count("y").alias("nobs"), F.avg("y").alias("mean"), safe_corr("y", "total").alias("t"),
                                                        safe_corr("y", F.col("total") - F.col("y")).alias("r"))
    near = lambda x: None if x is None else round(x, 9)
    got = {(r.course_id, r.problem_nid): (r.nobs, near(r.mean), near(r.itemtestcorr), near(r.itemrestcorr)) for r in result.collect()}
    assert got == {(r.course_id, r.problem_nid): (r.nobs, near(r["mean"]), near(r.t), near(r.r)) for r in want.collect()}


def test_rolling_bitmaps_are_as_large_as_a_key_needs(spark):
    """Users of a course are numbered in sequence: a few whole numbers per day, not a bitmap of 4 KB for each user."""
    rows = [(f"c{i % 50}", "2024-01-05", f"u{i}") for i in range(1500)]
    out = S.rolling_distinct(log(spark, rows), ["course"], "day", "user", 7)
    assert "bitmap_construct_agg" not in out._jdf.queryExecution().analyzed().toString()
    assert {(r.course, r.n) for r in out.collect()} == {(f"c{k}", 30) for k in range(50)}
