"""Registered queries over mergeable counts and quantiles, beside the exact figures they stand for."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit.functions import sketches as S
from cohortkit.functions.scale import group_quantiles
from cohortkit.plans.registry import query
from cohortkit.session import stage
from cohortkit.sources import testdata as T
from cohortkit.sources.testdata import sql

c = F.col


@query("X15_distinct_users_merged", sql("log", """SELECT course_id, count(DISTINCT username) AS n_users, count(DISTINCT time::DATE) AS n_days, true AS merged_equals_whole, true AS within_bound
 FROM log GROUP BY 1"""))
def distinct_users_merged(spark, d):
    """Users of a course from the sketches of its days: equal to one sketch over all rows, within five standard errors of the exact count."""
    log = T.tracking_log(spark, d).select("course_id", c("time").cast("date").alias("date"), "username")
    daily = stage(S.distinct_sketches(log, ["course_id", "date"], "username"), "daily-users")
    merged = S.merge_distinct(daily, ["course_id"]).select("course_id", S.distinct_estimate().alias("merged"))
    whole = log.groupBy("course_id").agg(
        F.countDistinct("username").alias("n_users"), F.countDistinct("date").alias("n_days"), F.hll_sketch_estimate(F.hll_sketch_agg("username", F.lit(S.HLL_LOG2))).alias("one"))
    bound = F.greatest(5 * S.hll_error() * c("n_users"), F.lit(1.0))
    return whole.join(merged, "course_id").select(
        "course_id", "n_users", "n_days", (c("merged") == c("one")).alias("merged_equals_whole"), (F.abs(c("merged") - c("n_users")) <= bound).alias("within_bound"))


SHARES = (0.25, 0.5, 0.9)
_HOUR = "hour(time)*3600+minute(time)*60+second(time)"


@query("X16_time_of_day_quantiles_merged", sql("log", f"""SELECT course_id, count(*) AS n, {', '.join(f'quantile_disc({_HOUR},{p})::DOUBLE AS q{round(100*p)}' for p in SHARES)},
 {', '.join(f'true AS within_{round(100*p)}' for p in SHARES)} FROM log WHERE time IS NOT NULL GROUP BY 1"""))
def time_of_day_quantiles_merged(spark, d):
    """Quantiles of the second of the day from daily sketches; the share of rows at or below each is within the sketch's rank error (twice the stated one)."""
    second = F.hour("time") * 3600 + F.minute("time") * 60 + F.second("time")
    log = T.tracking_log(spark, d).filter("time IS NOT NULL").select("course_id", c("time").cast("date").alias("date"), second.alias("second"))
    daily = stage(S.quantile_sketches(log, ["course_id", "date"], {"sketch": c("second")}), "daily-seconds")
    merged = S.merge_quantiles(daily, ["course_id"], ["sketch"])
    estimates = stage(merged.select("course_id", *[S.quantile_of("sketch", p).alias(f"e{round(100 * p)}") for p in SHARES]), "second-quantiles")
    exact = group_quantiles(log, ["course_id"], {f"q{round(100 * p)}": (c("second"), p) for p in SHARES})
    counted = log.groupBy("course_id", "second").agg(F.count(F.lit(1)).alias("k")).join(estimates, "course_id")
    below = [F.sum(F.when(c("second") < c(f"e{round(100 * p)}"), c("k")).otherwise(0)).alias(f"lt{round(100 * p)}") for p in SHARES]
    upto = [F.sum(F.when(c("second") <= c(f"e{round(100 * p)}"), c("k")).otherwise(0)).alias(f"le{round(100 * p)}") for p in SHARES]
    ranks = counted.groupBy("course_id").agg(F.sum("k").alias("n"), *below, *upto)
    slack = 2 * S.KLL_RANK_ERROR
    inside = [((c(f"lt{q}") <= (p + slack) * c("n")) & (c(f"le{q}") >= (p - slack) * c("n"))).alias(f"within_{q}") for p in SHARES for q in [round(100 * p)]]
    return exact.join(ranks, "course_id").select("course_id", "n", *[f"q{round(100 * p)}" for p in SHARES], *inside)


@query("X22_active_users_of_week", sql("log", """SELECT a.course_id, strftime(a.d,'%Y-%m-%d') AS date, count(DISTINCT b.username) AS n FROM (SELECT DISTINCT course_id, time::DATE AS d FROM log) a
 JOIN (SELECT DISTINCT course_id, time::DATE AS d, username FROM log) b ON a.course_id IS NOT DISTINCT FROM b.course_id AND b.d BETWEEN a.d - 6 AND a.d GROUP BY 1, 2"""))
def active_users_of_week(spark, d):
    """Distinct users of the last seven days, per course and day, by united bitmaps."""
    return S.rolling_distinct(T.tracking_log(spark, d), ["course_id"], "time", "username", 7).withColumnRenamed("time", "date")
