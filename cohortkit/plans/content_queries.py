"""Registered queries over videos, the forum and course content."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit.operators import content as C, events as E, forum as FO, people as P, reports as R, video as V
from cohortkit.plans.event_queries import FEV, VDAY, ts
from cohortkit.plans.people_queries import BROAD, STU
from cohortkit.plans.registry import query
from cohortkit.sources import testdata as T
from cohortkit.sources.testdata import rounded, sql

c = F.col


def durations(spark, d):
    """A duration for every part that is not divisible by 3."""
    k = c("p_partkey")
    return T.load(spark, d, "part").filter(k % 3 != 0).select(
        F.concat(F.lit("yt"), k.cast("string")).alias("youtube_id"),
        F.concat(F.lit("PT"), F.when(k % 2 == 0, F.lit("1M")).otherwise(F.lit("")), (k % 60).cast("string"), F.lit("S")).alias("duration"))


def video_axis_of(spark, d):
    return V.video_axis(T.course_axis(spark, d), durations(spark, d))


VAX = """vax AS (SELECT v.course_id, ch.index AS index_chapter, v.index AS index_video, v.category, v.name, split_part(v.module_id,'/',4) AS video_id,
 v.ytid[6:] AS youtube_id, ch.name AS chapter_name, CASE WHEN k%3<>0 THEN CASE WHEN k%2=0 THEN 60 ELSE 0 END + k%60 END AS video_length
 FROM (SELECT *, CAST(ytid[8:] AS BIGINT) AS k FROM axis WHERE category='video') v LEFT JOIN axis ch ON v.course_id=ch.course_id AND v.chapter_mid=ch.module_id)"""


@query("V1_video_axis", sql("axis", "SELECT * FROM vax", VAX))
def video_axis(spark, d):
    return video_axis_of(spark, d)


@query("V2_video_stats", sql("log axis", """SELECT course_id, video_id, index_chapter, index_video, name, chapter_name, count(*) FILTER (p>0) AS videos_viewed,
 count(*) FILTER (p>video_length*0.95) AS videos_watched FROM (SELECT course_id, video_id, username, max(position) AS p FROM vday GROUP BY 1,2,3)
 LEFT JOIN vax USING (course_id, video_id) GROUP BY 1,2,3,4,5,6""", f"{VDAY}, {VAX}"))
def video_stats(spark, d):
    return V.video_stats(E.video_stats_day(T.tracking_log(spark, d)), video_axis_of(spark, d))


@query("V3_person_course_video_watched", sql("log axis pc", rounded("""SELECT course_id, user_id, n AS n_unique_videos_watched, n/nv AS fract_total_videos_watched, viewed, certified,
 mode='verified' AS verified FROM (SELECT course_id, username, count(DISTINCT video_id) AS n FROM vday GROUP BY 1,2) JOIN pc USING (course_id, username)
 JOIN (SELECT course_id, count(*) AS nv FROM vax GROUP BY 1) USING (course_id) WHERE roles='Student'""", "fract_total_videos_watched"), f"{VDAY}, {VAX}"))
def person_video_watched(spark, d):
    return V.person_video_watched(E.video_stats_day(T.tracking_log(spark, d)), T.person_course(spark, d), video_axis_of(spark, d))


POSTS = """posts AS (SELECT f.course_id, f.author_username AS username, f.mongoid AS slug_id,
 CASE WHEN f._type='CommentThread' THEN 'initial_post' WHEN f.parent_id IS NOT NULL THEN 'comment' ELSE 'response_post' END AS slug_type,
 f.comment_thread_id AS thread_id, f.parent_id, t.author_username AS original_poster, r.author_username AS responded_to,
 coalesce(f.title, t.title) AS title, f.created_at AS first_time, substr(f.body,1,100) AS body_preview
 FROM forum f LEFT JOIN forum t ON f.comment_thread_id=t.mongoid AND f.course_id=t.course_id LEFT JOIN forum r ON f.parent_id=r.mongoid AND f.course_id=r.course_id)"""


@query("F1_forum_posts", sql("forum", f"SELECT * REPLACE ({ts('first_time')}) FROM posts", POSTS))
def forum_posts(spark, d):
    return FO.forum_posts(T.forum(spark, d))


@query("F2_forum_person", sql("forum log", f"""SELECT course_id, username, slug_id, slug_type, thread_id, parent_id, original_poster, responded_to, title, wrote, "read", pinned,
 upvoted, unvoted, followed, {ts('first_time')}, {ts('last_time')} FROM (
 SELECT coalesce(p.course_id,e.course_id) AS course_id, coalesce(p.username,e.username) AS username, coalesce(p.slug_id,e.slug_id) AS slug_id,
 coalesce(p.slug_type,e.slug_type) AS slug_type, CASE WHEN p.slug_id IS NOT NULL THEN p.thread_id ELSE e.thread_id END AS thread_id,
 CASE WHEN p.slug_id IS NOT NULL THEN p.parent_id ELSE e.parent_id END AS parent_id, coalesce(p.original_poster,e.original_poster) AS original_poster,
 coalesce(p.responded_to,e.responded_to) AS responded_to, coalesce(p.title,e.title) AS title, CASE WHEN p.slug_id IS NOT NULL THEN 1 ELSE 0 END AS wrote,
 e.r AS "read", e.pn AS pinned, e.up AS upvoted, e.un AS unvoted, e.fo AS followed,
 CASE WHEN p.first_time<=e.l THEN p.first_time WHEN p.first_time IS NOT NULL AND e.l IS NULL THEN p.first_time ELSE coalesce(e.f,e.l) END AS first_time,
 CASE WHEN p.first_time>=e.l THEN p.first_time WHEN p.first_time IS NOT NULL AND e.l IS NULL THEN p.first_time ELSE coalesce(e.l,e.f) END AS last_time
 FROM posts p FULL JOIN (SELECT o.course_id, v.username, o.slug_id, o.slug_type, o.thread_id, o.parent_id, o.original_poster, o.responded_to, o.title,
  min(v.time) AS f, max(v.time) AS l, count(*) FILTER (forum_action='read') AS r, count(*) FILTER (forum_action='pin') AS pn,
  count(*) FILTER (forum_action='upvote') AS up, count(*) FILTER (forum_action='unvote') AS un, count(*) FILTER (forum_action='follow_thread') AS fo
  FROM fev v JOIN posts o ON v.course_id=o.course_id AND v.thread_id=o.thread_id WHERE forum_action IN ('read','upvote','follow_thread') AND v.username<>'' GROUP BY ALL) e
 ON p.course_id=e.course_id AND p.username=e.username AND p.slug_id=e.slug_id)""", f"{FEV}, {POSTS}"))
def forum_person(spark, d):
    return FO.forum_person(FO.forum_posts(T.forum(spark, d)), E.forum_events(T.tracking_log(spark, d)))


def elements(spark, d):
    """Element table of every course: the axis rows below one root per course."""
    ax = T.course_axis(spark, d)
    none = F.lit(None).cast("string")
    iso = lambda x: F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    k = F.length("name")
    body = ax.select(
        "course_id", c("url_name").alias("element_id"), F.coalesce("parent", F.lit("root")).alias("parent_id"), c("index").alias("position"),
        c("category").alias("tag"), "url_name", c("name").alias("display_name"),
        F.when(c("category") == "chapter", F.when(k % 2 == 0, "1998-02-01T00:00:00Z").otherwise("January 15, 1998"))
        .when(c("category") == "sequential", "1998-01-20T00:00").otherwise(none).alias("start"),
        F.when(c("category") == "sequential", iso(F.to_timestamp(F.lit("1998-06-01")))).otherwise(iso(c("due"))).alias("due"),
        c("gformat").alias("format"), "graded", F.when((c("category") == "chapter") & (k == 11), "true").alias("hide_from_toc"),
        c("data.ytid").alias("youtube"), none.alias("youtube_id_1_0"), F.when(k % 3 == 0, "never").otherwise(none).alias("showanswer"),
        (k % 4 == 0).alias("random_script"))
    root = ax.select("course_id").distinct().select(
        "course_id", F.lit("root").alias("element_id"), none.alias("parent_id"), F.lit(0).cast("long").alias("position"), F.lit("course").alias("tag"),
        F.lit("root").alias("url_name"), F.lit("root").alias("display_name"), F.lit("1998-01-01").alias("start"), none.alias("due"), none.alias("format"),
        none.alias("graded"), none.alias("hide_from_toc"), none.alias("youtube"), none.alias("youtube_id_1_0"), none.alias("showanswer"),
        F.lit(False).alias("random_script"))
    return root.unionByName(body)


# children of a hidden chapter inherit its flag; the chapter itself stays
TREE = """hid AS (SELECT course_id, url_name AS ch FROM axis WHERE category='chapter' AND length(name)=11),
 vis AS (SELECT a.*, length(name) AS k, split_part(path,'/',2) AS chn, CASE WHEN category IN ('problem','video') THEN split_part(path,'/',3) END AS sq FROM axis a
  WHERE category='chapter' OR NOT EXISTS (SELECT 1 FROM hid h WHERE h.course_id=a.course_id AND h.ch=split_part(a.path,'/',2))),
 cst AS (SELECT course_id, url_name AS chn, CASE WHEN length(name)%2=0 THEN TIMESTAMP '1998-02-01' ELSE TIMESTAMP '1998-01-15' END AS cs FROM axis WHERE category='chapter'),
 sib AS (SELECT *, row_number() OVER (PARTITION BY course_id, parent ORDER BY index) AS sn FROM vis)"""


@query("C1_course_axis", sql("axis", f"""SELECT course_id, row_number() OVER (PARTITION BY course_id ORDER BY index) AS index, url_name, category, gformat, {ts('start')}, {ts('due')}, name, path,
 module_id, chapter_mid, graded, parent, false AS is_split, CAST(NULL AS VARCHAR) AS split_url_name, ytid FROM (
 SELECT s.course_id, s.index, url_name, category, gformat, CASE WHEN category='chapter' THEN cs ELSE greatest(cs, TIMESTAMP '1998-01-20') END AS start,
  CASE WHEN category='chapter' THEN NULL WHEN category='sequential' THEN TIMESTAMP '1998-06-01' ELSE coalesce(due, TIMESTAMP '1998-06-01') END AS due, name,
  CASE WHEN category IN ('problem','video') THEN '/'||s.chn||'/'||sq||'/'||sn ELSE path END AS path, module_id, chapter_mid, graded, coalesce(parent,'root') AS parent, ytid
  FROM sib s JOIN cst USING (course_id, chn)
 UNION ALL SELECT DISTINCT course_id, -1, 'root', 'course', NULL, NULL, NULL, 'root', '/1', split_part(course_id,'/',1)||'/'||split_part(course_id,'/',2)||'/course/root', NULL, NULL, NULL, NULL FROM axis)""", TREE))
def course_axis(spark, d):
    out = C.course_axis(elements(spark, d))
    return out.withColumn("ytid", c("data.ytid")).drop("data")


def problem_parts(spark, d):
    """Response, solution and image elements inside problems."""
    ax = T.course_axis(spark, d).filter("category = 'problem'")
    k = F.length("name")
    inner = F.array(
        F.struct(c("data.itype").alias("tag"), F.lit("").alias("text")),
        F.struct(F.when(k % 3 == 0, F.lit("numericalresponse")).otherwise(c("data.itype")).alias("tag"), F.lit("").alias("text")),
        F.struct(F.lit("solution").alias("tag"), F.repeat("name", 5).alias("text")),
        F.struct(F.when(k % 2 == 0, "img").otherwise("p").alias("tag"), F.lit("").alias("text")))
    return ax.select("course_id", c("url_name").alias("problem_id"), c("data.weight").cast("string").alias("weight"), F.inline(inner))


@query("C2_problem_meta", sql("axis", """SELECT course_id, url_name AS problem_id, CASE WHEN length(name)%3=0 AND itype<>'numericalresponse' THEN 'mixed' ELSE itype END AS itype,
 2 AS num_items, length(name)%2=0 AS has_image, length(name)*5>65 AS has_solution, weight FROM axis WHERE category='problem'"""))
def problem_meta(spark, d):
    return C.problem_meta(problem_parts(spark, d))


@query("C3_dedupe_url_names", sql("axis", """SELECT course_id, index, category, CASE WHEN category='vertical' AND n>1 THEN url_name||'_vertical' ELSE url_name END AS url_name FROM (
 SELECT *, count(*) OVER (PARTITION BY course_id, url_name) AS n FROM (SELECT course_id, index, CASE WHEN category='sequential' THEN 'vertical' ELSE category END AS category,
 CASE WHEN category='chapter' THEN 'sq'||url_name[3:] ELSE url_name END AS url_name FROM axis))"""))
def dedupe_url_names(spark, d):
    ax = T.course_axis(spark, d).select(
        "course_id", "index", F.when(c("category") == "sequential", "vertical").otherwise(c("category")).alias("category"),
        F.when(c("category") == "chapter", F.concat(F.lit("sq"), F.substring("url_name", 3, 9))).otherwise(c("url_name")).alias("url_name"))
    return C.dedupe_url_names(ax)


@query("C4_parse_course_date", sql("axis", f"""SELECT o_orderkey, {ts('parsed')} FROM (SELECT o_orderkey, CASE o_orderkey%5 WHEN 4 THEN NULL ELSE o_orderdate END AS parsed FROM orders)"""))
def parse_course_date(spark, d):
    o = T.load(spark, d, "orders")
    day, k = c("o_orderdate"), c("o_orderkey") % 5
    text = (F.when(k == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, F.date_format(day, "MMMM d, yyyy"))
            .when(k == 2, F.concat(F.lit('"'), F.date_format(day, "MMMM d yyyy, HH:mm"), F.lit('"')))
            .when(k == 3, F.date_format(day, "yyyy-MM-dd'T'HH:mm")).otherwise(F.lit("not a date")))
    return o.select("o_orderkey", C.parse_course_date(text).alias("parsed"))


def module_records(spark, d):
    """One learner record per answered item."""
    a = T.answers(spark, d)
    return a.select("course_id", F.lit("problem").alias("module_type"), c("problem_url_name").alias("module_id"))


@query("C5_stats_module_usage", sql("ans", "SELECT course_id, 'problem' AS module_type, problem_url_name AS module_id, count(*) AS ncount FROM ans GROUP BY 1,3"))
def module_usage(spark, d):
    return C.module_usage(module_records(spark, d))


def usage_of(spark, d):
    """View counts by tag and name: a sequential has as many as its name is long."""
    ax = T.course_axis(spark, d)
    return ax.filter("category IN ('problem', 'sequential')").select(
        "course_id", c("category").alias("tag"), "url_name", (F.length("name") * 2 - F.when(c("category") == "problem", 0).otherwise(2)).alias("ncount"))


def listings_of(spark, d):
    """Launch and wrap dates per course."""
    ax = T.course_axis(spark, d).groupBy("course_id").agg(F.sum(F.length("name")).alias("n"))
    return ax.select("course_id", F.to_date(F.lit("1998-01-01")).alias("launch"),
                     F.date_add(F.to_date(F.lit("1998-03-01")), (c("n") % 60).cast("int")).alias("wrap"))


LST = "lst AS (SELECT course_id, 59 + sum(length(name))%60 AS days FROM axis GROUP BY 1)"
CST = f"""{LST}, us AS (SELECT course_id, url_name, CASE category WHEN 'problem' THEN length(name)*2 ELSE length(name)*2-2 END AS n FROM axis WHERE category IN ('problem','sequential')),
 el AS (SELECT a.*, u.n, ps.n AS pn, pa.name AS pname, pc2.name AS cname FROM axis a LEFT JOIN us u USING (course_id, url_name)
  LEFT JOIN us ps ON a.course_id=ps.course_id AND a.parent=ps.url_name LEFT JOIN axis pa ON a.course_id=pa.course_id AND a.parent=pa.url_name
  LEFT JOIN axis pc2 ON a.course_id=pc2.course_id AND pc2.url_name=split_part(a.path,'/',2)),
 live AS (SELECT *, coalesce(n<20,false) AS rare,
  coalesce(CASE WHEN length(name)%3=0 THEN 'never' END, CASE WHEN length(pname)%3=0 THEN 'never' END, CASE WHEN length(cname)%3=0 THEN 'never' END) AS sa,
  length(name)%4=0 AS rnd FROM el WHERE category IN ('chapter','sequential') OR coalesce(pn>=20,true)),
 kept AS (SELECT * FROM live WHERE NOT rare), pr AS (SELECT * FROM kept WHERE category='problem'),
 tl AS (SELECT course_id, 'count_'||category AS key, count(*)::DOUBLE AS value FROM kept GROUP BY 1,2
  UNION ALL SELECT course_id, 'nexcluded_sub_20_'||category, count(*) FROM live WHERE rare GROUP BY 1,2
  UNION ALL SELECT course_id, 'problem_stat_n_capa_problems', count(*) FROM pr GROUP BY 1,2
  UNION ALL SELECT course_id, 'problem_stat_n_'||CASE WHEN sa IS NULL THEN 'shownanswer_finished' ELSE 'showanswer_'||sa END, count(*) FROM pr GROUP BY 1,2
  UNION ALL SELECT course_id, 'problem_stat_n_random_script', count(*) FILTER (rnd) FROM pr GROUP BY 1,2
  UNION ALL SELECT course_id, 'problem_stat_n_capa_problems_graded', count(*) FROM pr WHERE graded='true' GROUP BY 1,2
  UNION ALL SELECT course_id, 'problem_stat_n_graded_random_script', count(*) FILTER (rnd) FROM pr WHERE graded='true' GROUP BY 1,2
  UNION ALL SELECT course_id, 'problem_stat_n_graded_'||CASE WHEN sa IS NULL THEN 'shownanswer_finished' ELSE 'showanswer_'||sa END, count(*) FROM pr WHERE graded='true' GROUP BY 1,2
  UNION ALL SELECT course_id, k, v FROM (SELECT course_id, unnest(['course_length_days','nweeks','nqual_per_week','nquant_per_week','total_assessments_per_week']) AS k,
   unnest([days::DOUBLE, days/7.0, 0, 0, 0]) AS v FROM lst))"""


@query("C6_content_stats", sql("axis", rounded("SELECT * FROM tl", "value"), CST))
def content_stats(spark, d):
    return C.content_stats(elements(spark, d), usage_of(spark, d), listings_of(spark, d))


def metainfo_parts(spark, d):
    """Listing dates and chapter counts as key/value rows."""
    lst = listings_of(spark, d)
    rows = lst.select("course_id", F.inline(F.array(
        F.struct(F.lit("listings_Course Wrap").alias("key"), F.date_format("wrap", "M/d/yyyy").alias("value")),
        F.struct(F.lit("listings_Course Launch").alias("key"), F.date_format("launch", "MM/dd/yyyy").alias("value")),
        F.struct(F.lit("listings_Empirical Course Wrap").alias("key"), F.date_format(F.date_add("wrap", 30), "M/d/yyyy").alias("value")),
        F.struct(F.lit("nweeks").alias("key"), F.round(F.datediff("wrap", "launch") / 7.0, 4).cast("string").alias("value")),
        F.struct(F.lit("count_chapter").alias("key"), F.lit("4").alias("value")))))
    return rows


def override_rows(spark, d):
    """Overrides: three chapters in a third of the courses, and a new key."""
    lst = listings_of(spark, d).filter(c("course_id").startswith("Org0"))
    return lst.select("course_id", F.inline(F.array(
        F.struct(F.lit("count_chapter").alias("key"), F.lit("3").alias("value")), F.struct(F.lit("note").alias("key"), F.lit("x").alias("value")))))


META = f"""{LST}, dts AS (SELECT course_id, DATE '1998-01-01' AS launch, DATE '1998-01-01' + days::INTEGER AS wrap FROM lst),
 mi0 AS (SELECT course_id, 'listings_Course Wrap' AS key, strftime(wrap,'%-m/%-d/%Y') AS value FROM dts UNION ALL SELECT course_id, 'listings_Course Launch', '01/01/1998' FROM dts
  UNION ALL SELECT course_id, 'listings_Empirical Course Wrap', strftime(wrap+30,'%-m/%-d/%Y') FROM dts),
 mi AS (SELECT * FROM mi0 UNION ALL SELECT course_id, 'count_chapter', CASE WHEN course_id LIKE 'Org0%' THEN '3' ELSE '4' END FROM dts
  UNION ALL SELECT course_id, 'note', 'x' FROM dts WHERE course_id LIKE 'Org0%')"""


@query("C7_course_metainfo", sql("axis", "SELECT * FROM mi", META))
def course_metainfo(spark, d):
    parts = metainfo_parts(spark, d).filter("key != 'nweeks'")
    return C.course_metainfo(parts, override_rows(spark, d))


@query("C7_course_listing_and_metainfo", sql("axis", """SELECT course_id, max(value) FILTER (key='count_chapter') AS count_chapter, max(value) FILTER (key='note') AS note,
 max(value) FILTER (key='listings_Course Wrap') AS listings_Course_Wrap FROM mi GROUP BY 1""", META))
def metainfo_wide(spark, d):
    return C.metainfo_wide(C.course_metainfo(metainfo_parts(spark, d), override_rows(spark, d)), ["count_chapter", "note", "listings_Course Wrap"])


def pc_certs(spark, d):
    """Person-course with certificate dates."""
    return T.person_course(spark, d).withColumn("cert_created_date", F.when(c("certified"), c("start_time") + F.expr("INTERVAL 900 DAYS")))


RATE = f"""{META}, pd AS (SELECT pc.*, wrap + INTERVAL '23:59:59' HOUR TO SECOND AS w, launch::TIMESTAMP AS l, wrap+30 + INTERVAL '23:59:59' HOUR TO SECOND AS e,
  CASE WHEN certified THEN start_time + INTERVAL 900 DAY END AS cd FROM pc LEFT JOIN dts USING (course_id)),
 rt AS (SELECT course_id, w AS wrap_date, count(*) AS nregistered, count(*) FILTER (certified) AS ncertified, count(*) FILTER (cd<e AND certified AND viewed) AS ncertified_by_ewrap,
  count(*) FILTER (viewed) AS nviewed, count(*) FILTER (start_time<w) AS nregistered_by_wrap, count(*) FILTER (start_time<w AND viewed) AS nviewed_by_wrap,
  count(*) FILTER (start_time<e AND viewed) AS nviewed_by_ewrap, count(*) FILTER (start_time<l) AS nregistered_before_launch,
  count(*) FILTER (start_time<l AND certified) AS ncertified_and_registered_before_launch, count(*) FILTER (start_time>=l AND start_time<w) AS nregistered_during_course,
  count(*) FILTER (start_time>=l AND start_time<w AND certified) AS ncertified_and_registered_during_course FROM pd GROUP BY 1,2)""".replace(
      "INTERVAL '23:59:59' HOUR TO SECOND", "INTERVAL 86399 SECOND")


@query("C8_nregistered_by_wrap", sql("axis pc", f"""SELECT course_id, {ts('wrap_date')}, nregistered, nregistered_by_wrap,
 round(nregistered_by_wrap/nregistered*100,6) AS nregistered_by_wrap_pct FROM rt""", RATE))
def registered_by_wrap(spark, d):
    return C.registered_by_wrap(T.person_course(spark, d), metainfo_parts(spark, d))


_PCT = {"nregistered_by_wrap_pct": ("nregistered_by_wrap", "nregistered"), "pct_certified_of_reg": ("ncertified", "nregistered"),
        "pct_certified_reg_before_launch": ("ncertified_and_registered_before_launch", "nregistered_before_launch"),
        "pct_certified_reg_during_course": ("ncertified_and_registered_during_course", "nregistered_during_course"),
        "pct_certified_of_reg_by_wrap": ("ncertified", "nregistered_by_wrap"), "pct_certified_of_viewed": ("ncertified", "nviewed"),
        "pct_certified_of_viewed_by_wrap": ("ncertified", "nviewed_by_wrap"), "pct_certified_of_viewed_by_ewrap": ("ncertified_by_ewrap", "nviewed_by_ewrap")}


@query("C9_cert_rates_by_registration", sql("axis pc", f"SELECT * REPLACE ({ts('wrap_date')}), " + ", ".join(
    f"round({a}/nullif({b},0)*100,6) AS {n}" for n, (a, b) in _PCT.items()) + " FROM rt", RATE))
def cert_rates(spark, d):
    return C.cert_rates(pc_certs(spark, d), metainfo_parts(spark, d))


@query("C10_course_summary_stats", sql("axis pc", f"""SELECT b.course_id, registered_sum, rt.nregistered_by_wrap, round(n_female_viewed/(n_male_viewed+n_female_viewed),6) AS frac_female,
 round(certified_sum/nullif(rt.nregistered_by_wrap,0)*100,6) AS certified_of_nregistered_by_wrap_pct, rt.nviewed AS cbr_nviewed, m.med AS msbc_viewed_grade_median,
 CASE WHEN nforum_posts_sum>0 THEN round(nforum_posts_sum/round(days/7.0,4),4) END AS nforum_posts_per_week, CASE WHEN days IS NOT NULL THEN '4' END AS count_chapter
 FROM broad b LEFT JOIN rt USING (course_id) LEFT JOIN lst USING (course_id)
 LEFT JOIN (SELECT course_id, round(quantile_disc(grade,0.5),6) AS med FROM pc {STU.replace('WHERE ', 'WHERE viewed AND (')}) GROUP BY 1) m USING (course_id)""", f"{RATE}, {BROAD}"))
def course_summary(spark, d):
    pc, meta = pc_certs(spark, d), metainfo_parts(spark, d)
    out = C.course_summary(
        R.broad_stats(pc), {"viewed": R.median_stats(pc, "viewed")}, C.registered_by_wrap(pc, meta), C.cert_rates(pc, meta),
        metainfo=C.metainfo_wide(meta, ["nweeks", "count_chapter"]))
    return out.select("course_id", "registered_sum", "nregistered_by_wrap", "frac_female", "certified_of_nregistered_by_wrap_pct", "cbr_nviewed",
                      "msbc_viewed_grade_median", F.round("nforum_posts_per_week", 4).alias("nforum_posts_per_week"), "count_chapter")


@query("C11_recommend_pin_dates", sql("axis", f"""SELECT course_id, strftime(coalesce(min(dump) FILTER (dump>=wrap), max(dump) FILTER (dump<wrap)),'%Y-%m-%d') AS pin_date FROM dts LEFT JOIN
 (SELECT course_id, DATE '1998-01-20' + (index::INTEGER//3) AS dump FROM axis) USING (course_id) GROUP BY 1""", META))
def recommend_pin_dates(spark, d):
    lst = listings_of(spark, d).select("course_id", F.date_format("wrap", "MM/dd/yyyy").alias("Course Wrap"))
    dumps = T.course_axis(spark, d).select("course_id", F.date_add(F.to_date(F.lit("1998-01-20")), F.floor(c("index") / 3).cast("int")).alias("dump_date"))
    return C.recommend_pin_dates(lst, dumps)
