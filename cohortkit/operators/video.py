"""Video tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.functions.scale import count_if, ratio, salted_lookup

# Seconds per ISO-8601 unit (fixed values): a month has 4 weeks, a year 12 months.
MINUTE, HOUR, DAY = 60, 3600, 86400
WEEK = 7 * DAY
MONTH = 4 * WEEK
YEAR = 12 * MONTH


def iso_seconds(col: Column) -> Column:
    """Seconds of an ISO-8601 duration such as ``P1DT2H3M4S``; null when it is not one."""
    date = F.regexp_extract(col, r"^P([^T]*)", 1)
    clock = F.regexp_extract(col, r"T(.*)$", 1)

    def unit(text: Column, letter: str, seconds: int) -> Column:
        n = F.regexp_extract(text, rf"(\d+){letter}", 1).try_cast("long")
        return F.coalesce(n, F.lit(0)) * seconds

    total = (
        unit(date, "Y", YEAR) + unit(date, "M", MONTH) + unit(date, "W", WEEK) + unit(date, "D", DAY)
        + unit(clock, "H", HOUR) + unit(clock, "M", MINUTE) + unit(clock, "S", 1)
    )
    return F.when(col.rlike(r"^P[0-9YMWDTHS]+$"), total)


def video_axis(axis: DataFrame, durations: DataFrame) -> DataFrame:
    """Videos of the course axis with their chapter and length in seconds.

    ``durations`` has (youtube_id, duration) with ISO-8601 durations.
    """
    c = F.col
    videos = axis.filter("category = 'video'").select(
        "course_id", c("index").alias("index_video"), "category", "name", "chapter_mid",
        F.element_at(F.split(F.translate("module_id", ".", "_"), "/"), -1).alias("video_id"),
        F.regexp_extract(c("data.ytid"), r":(.*)", 1).alias("youtube_id"),
    )
    chapters = axis.filter("category = 'chapter'").select(
        "course_id", c("module_id").alias("chapter_mid"), c("index").alias("index_chapter"), c("name").alias("chapter_name"))
    length = durations.groupBy("youtube_id").agg(F.max(iso_seconds(c("duration"))).alias("video_length"))
    return (
        videos.join(chapters, ["course_id", "chapter_mid"], "left").join(length, "youtube_id", "left")
        .select("course_id", "index_chapter", "index_video", "category", "name", "video_id", "youtube_id", "chapter_name", "video_length")
    )


def video_stats(day: DataFrame, axis: DataFrame) -> DataFrame:
    """Per video: users who got past the start, and users who watched over 95 % of it."""
    seen = day.filter("video_id IS NOT NULL AND username IS NOT NULL").groupBy("course_id", "video_id", "username").agg(
        F.max("position").alias("position"))
    facts = axis.select("course_id", "video_id", "index_chapter", "index_video", "name", "chapter_name", "video_length")
    joined = salted_lookup(seen, facts, ["course_id", "video_id"], salt_by=["username"])
    return joined.groupBy("course_id", "video_id", "index_chapter", "index_video", "name", "chapter_name").agg(
        count_if(F.col("position") > 0).alias("videos_viewed"),
        count_if(F.col("position") > F.col("video_length") * 0.95).alias("videos_watched"),
    )


def person_video_watched(day: DataFrame, pc: DataFrame, axis: DataFrame) -> DataFrame:
    """Distinct videos per student and their share of the course's videos."""
    unique = day.select("course_id", "username", "video_id").distinct().groupBy("course_id", "username").agg(
        F.count(F.lit(1)).alias("n_unique_videos_watched"))
    totals = axis.groupBy("course_id").agg(F.count(F.lit(1)).alias("n_total_videos"))
    who = pc.filter("roles = 'Student' OR roles IS NULL").select(
        "course_id", "username", "user_id", "certified", "viewed", (F.col("mode") == "verified").alias("verified"))
    df = salted_lookup(unique.join(who, ["course_id", "username"], "inner"), totals, ["course_id"], "inner", salt_by=["user_id"])
    return df.select("course_id", "user_id", "n_unique_videos_watched",
                     ratio(F.col("n_unique_videos_watched"), F.col("n_total_videos")).alias("fract_total_videos_watched"),
                     "viewed", "certified", "verified")
