"""Cross-course reports over person-course."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortkit.functions.scale import count_if, group_quantiles, most_frequent, ratio
from cohortkit.operators.people import modal_ip, strict_union

BACHELOR_PLUS = ["b", "m", "p", "p_oth", "p_se"]  # fixed values
BELOW_BACHELOR = ["a", "el", "hs", "jhs", "none"]  # fixed values
COHORTS = {
    "viewed": "viewed", "explored": "explored AND viewed",
    "certified": "certified AND viewed", "verified": "mode = 'verified' AND viewed",
}
MEDIAN_COLUMNS = [
    "nplay_video", "ndays_act", "nchapters", "nevents", "nforum_posts", "grade", "nforum_votes", "nforum_endorsed",
    "nforum_threads", "nforum_comments", "nprogcheck", "nshow_answer", "npause_video", "avg_dt", "sum_dt",
]


def students(pc: DataFrame) -> DataFrame:
    """Rows without a staff role in the forum."""
    return pc.filter("forumRoles_isStudent = 1 OR forumRoles_isStudent IS NULL")


def broad_stats(pc: DataFrame) -> DataFrame:
    """Registration, demographic, verified and activity totals per course."""
    c = F.col
    viewed, explored, certified = c("viewed"), c("explored"), c("certified")
    verified, male, female = c("mode") == "verified", c("gender") == "m", c("gender") == "f"
    high, low = c("LoE").isin(BACHELOR_PLUS), c("LoE").isin(BELOW_BACHELOR)
    counts: dict[str, Column] = {
        "viewed_sum": viewed, "explored_sum": explored & viewed, "certified_sum": certified & viewed,
        "certified_and_explored_sum": certified & explored & viewed,
        "certified_or_explored_sum": (certified | explored) & viewed,
        "n_male": male, "n_female": female, "n_usa_and_viewed": (c("cc_by_ip") == "US") & viewed,
        "n_bachplus_in_reg": high, "n_bachplus_in_viewed": viewed & high,
        "n_not_bachplus_in_reg": low, "n_not_bachplus_in_viewed": viewed & low,
        "n_male_viewed": viewed & male, "n_female_viewed": viewed & female,
        "n_verified_id": verified, "verified_viewed": viewed & verified, "verified_explored": explored & verified,
        "verified_certified": certified & verified, "verified_n_male": male & verified, "verified_n_female": female & verified,
        "n_reg_nonzero_grade": c("grade") > 0, "n_viewed_nonzero_grade": (c("grade") > 0) & viewed,
        "n_explored_nonzero_grade": (c("grade") > 0) & viewed & explored,
        "n_have_ip": c("ip").isNotNull(), "n_missing_cc": c("ip").isNotNull() & c("cc_by_ip").isNull(),
    }
    sums = {
        "nplay_video_sum": "nplay_video", "ndays_act_sum": "ndays_act", "nevents_sum": "nevents",
        "nforum_posts_sum": "nforum_posts", "nforum_votes_sum": "nforum_votes", "nforum_endorsed_sum": "nforum_endorsed",
        "nforum_threads_sum": "nforum_threads", "nforum_commments_sum": "nforum_comments",
        "nforum_pinned_sum": "nforum_pinned", "nshow_answer_sum": "nshow_answer", "nseq_goto_sum": "nseq_goto",
        "npause_video_sum": "npause_video",
    }
    means = {
        "verified_avg_grade": F.when(verified, c("grade")), "nchapters_avg": c("nchapters"),
        "nprogcheck_avg": F.when(viewed, c("nprogcheck")), "certified_nprogcheck": F.when(certified, c("nprogcheck")),
        "verified_nprogcheck": F.when(verified, c("nprogcheck")), "avg_of_avg_dt": c("avg_dt"), "avg_of_sum_dt": c("sum_dt"),
        "certified_avg_dt": F.when(certified, c("avg_dt")), "certified_sum_dt": F.when(certified, c("sum_dt")),
    }
    return students(pc).groupBy("course_id").agg(
        F.count(F.lit(1)).alias("registered_sum"), *[count_if(x).alias(n) for n, x in counts.items()],
        *[F.sum(x).alias(n) for n, x in sums.items()], *[F.avg(x).alias(n) for n, x in means.items()],
        F.min(F.when(certified, c("grade"))).alias("min_gade_certified"), F.min("start_time").alias("min_start_time"),
        F.max("last_event").alias("max_last_event"), F.max("nchapters").alias("max_nchapters"),
    )


def median_stats(pc: DataFrame, cohort: str) -> DataFrame:
    """Medians of 16 measures and non-zero shares per course, within one cohort."""
    rows = students(pc).filter(COHORTS[cohort])
    wanted = {f"{m}_median": (F.col(m), 0.5) for m in MEDIAN_COLUMNS}
    wanted["age_in_2014_median"] = (F.lit(2014) - F.col("YoB"), 0.5)
    nonzero = {"play_video": ("nplay_video", "sum_n_nonzero_play_video"), "grade": ("grade", "sum_n_nonzero_grade"),
               "forum_posts": ("nforum_posts", "sum_n_nonzeo_nforum_posts")}
    aggs = [F.count(F.lit(1)).alias("n_records")]
    for name, (col, sum_name) in nonzero.items():
        n = count_if(F.col(col) > 0)
        aggs += [ratio(n, F.count(F.lit(1))).alias(f"frac_nonzero_{name}"), n.alias(sum_name)]
    return rows.groupBy("course_id").agg(*aggs).join(group_quantiles(rows, ["course_id"], wanted), "course_id", "left")


def tot_stats(tot: DataFrame, pc: DataFrame, kind: str = "total") -> DataFrame:
    """Hours on task per course: sums and medians for all, viewed, certified and verified learners.

    ``kind`` is ``total`` or ``serial`` and picks the per-kind columns.
    """
    tag = "hours" if kind == "total" else "serial_hours"
    hours = {"total": F.col("total_time_30"), **{k: F.col(f"{kind}_{k}_time_30") for k in ("problem", "video", "forum")}}
    rows = tot.join(students(pc).select("course_id", "username", "viewed", "certified", "mode"), ["course_id", "username"], "inner")
    rows = rows.select("course_id", "viewed", "certified", (F.col("mode") == "verified").alias("verified"),
                       *[(h / 3600.0).alias(k) for k, h in hours.items()])
    sums, wanted = [], {}
    for suffix in ("", "_viewed", "_certified", "_verified"):
        for k in hours:
            value = F.when(F.col(suffix[1:]), F.col(k)) if suffix else F.col(k)
            sums.append(F.sum(value).alias(f"sum_{k}_{tag}{suffix}"))
            wanted[f"median_{k}_{tag}{suffix}"] = (value, 0.5)
    return rows.groupBy("course_id").agg(*sums).join(group_quantiles(rows, ["course_id"], wanted), "course_id", "left")


def union_courses(tables: list[DataFrame]) -> DataFrame:
    """The same table of many courses as one."""
    return strict_union(tables)


def emails(uic: DataFrame, by_org: bool = False) -> DataFrame:
    """Courses per (username, email), optionally per institution."""
    keys = ["username", "email"]
    rows = uic.filter("username IS NOT NULL")
    if by_org:
        rows, keys = rows.withColumn("org", F.substring_index("course_id", "/", 1)), ["org", *keys]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("ncourses"))


def global_modal_ip(ip_counts: DataFrame) -> DataFrame:
    """Most used address per user over all courses."""
    return modal_ip(ip_counts, ["username"])


def global_modal_lang(lang_counts: DataFrame) -> DataFrame:
    """Most used transcript language per user over all courses."""
    top = most_frequent(lang_counts, ["username"], "resource_event_data", F.col("langcount"),
                        distinct_as="n_different_lang", count_as="langcount")
    return top.withColumnRenamed("resource_event_data", "modal_language")


def enrollment_by_day(pc: DataFrame) -> DataFrame:
    """Registrations and un-registrations per course and day, with running totals."""
    verified = count_if(F.col("mode") == "verified")
    zero = F.lit(0).cast("long")
    left = students(pc).filter("is_active = 0 AND last_event IS NOT NULL").groupBy(
        "course_id", F.to_date("last_event").alias("date")).agg(
        zero.alias("reg"), F.count(F.lit(1)).alias("unreg"), zero.alias("ver"), verified.alias("ver_un"))
    came = students(pc).filter("start_time IS NOT NULL").groupBy("course_id", F.to_date("start_time").alias("date")).agg(
        F.count(F.lit(1)).alias("reg"), zero.alias("unreg"), verified.alias("ver"), zero.alias("ver_un"))
    days = left.unionByName(came).groupBy("course_id", "date").agg(
        F.sum("reg").alias("nregistered_ever"), F.sum("unreg").alias("n_unregistered"),
        (F.sum("reg") - F.sum("unreg")).alias("nregistered_net"), F.sum("ver").alias("nverified_ever"),
        F.sum("ver_un").alias("nverified_un_registered"), (F.sum("ver") - F.sum("ver_un")).alias("nverified_net"))
    w = W.partitionBy("course_id").orderBy("date").rowsBetween(W.unboundedPreceding, W.currentRow)
    names = ["nregistered_ever", "nregistered_net", "nverified_ever", "nverified_net"]
    return days.select("*", *[F.sum(n).over(w).alias(f"{n}_cum") for n in names])


def populations(pc: DataFrame) -> DataFrame:
    """Learner counts per course."""
    c = F.col
    return students(pc).groupBy("course_id").agg(
        F.count(F.lit(1)).alias("registered_sum"), count_if(c("viewed")).alias("viewed_sum"),
        count_if(c("explored")).alias("explored_sum"), count_if(c("certified")).alias("certified_sum"),
        count_if(c("ip").isNotNull()).alias("n_have_ip"),
        count_if(c("ip").isNotNull() & c("cc_by_ip").isNull()).alias("n_missing_cc"))


def multi_registrations(pc: DataFrame) -> DataFrame:
    """Number of courses per user."""
    return pc.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_courses_registered"))


def geographic(pc: DataFrame) -> DataFrame:
    """Learner counts per country."""
    c, verified = F.col, F.col("mode") == "verified"
    return students(pc).groupBy(c("cc_by_ip").alias("cc"), "countryLabel").agg(
        count_if(c("certified")).alias("ncertified"), count_if(c("registered")).alias("nregistered"),
        count_if(c("viewed")).alias("nviewed"), count_if(c("explored")).alias("nexplored"),
        count_if(verified).alias("nverified"), count_if(verified & c("certified")).alias("ncert_verified"),
        F.avg(F.when(c("certified"), c("avg_dt"))).alias("avg_certified_dt"))


def overall(broad: DataFrame, multi: DataFrame) -> DataFrame:
    """One row of totals over all courses; the two inputs meet in one aggregate, not in a cross join."""
    totals = {"registered": "registered_sum", "viewed": "viewed_sum", "explored": "explored_sum", "certified": "certified_sum",
              "verified_id": "n_verified_id", "verified_viewed": "verified_viewed", "verified_explored": "verified_explored",
              "verified_certified": "verified_certified", "n_missing_cc": "n_missing_cc"}
    left = broad.select(*[F.col(s).alias(n) for n, s in totals.items()],
                        ratio(F.col("certified_nprogcheck"), F.col("nprogcheck_avg")).alias("r"))
    right = multi.select("n_courses_registered")
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(
        *[F.sum(n).alias(n) for n in totals],
        (ratio(F.sum("verified_certified"), F.sum("verified_id")) * 100.0).alias("verified_certification_pct"),
        F.avg("r").alias("avg_nprogcheck_ratio_cert_vs_all"),
        F.count("n_courses_registered").alias("n_unique_registrants"), F.sum("n_courses_registered").alias("course_registrations"))
