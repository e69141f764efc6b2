"""Registered queries over learners, person-course and cross-course reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit.operators import events as E, people as P, reports as R
from cohortkit.plans.event_queries import DAY, ENR, TOT, TOT_COLS, TRL, ts
from cohortkit.plans.registry import query
from cohortkit.sources import testdata as T
from cohortkit.sources.testdata import rounded, sql

c = F.col


def dumps(spark, d):
    """Learner dumps cut from person-course: users, profiles, enrolments, certificates and their supplements."""
    pc = T.person_course(spark, d)
    u = c("user_id")
    key = ["course_id", "user_id"]
    prof = [F.concat(F.lit("n"), u.cast("string")).alias("name"), "gender", c("YoB").alias("year_of_birth"),
            c("LoE").alias("level_of_education"), c("cc_by_ip").alias("country"), F.when(u % 2 == 0, "en").otherwise("fr").alias("language"),
            F.concat(F.lit("at "), u.cast("string")).alias("location"), F.concat(F.lit("street "), u.cast("string")).alias("mailing_address"),
            F.when(u % 9 == 0, "").otherwise(F.concat(F.lit("g"), u.cast("string"))).alias("goals"), (u % 2).cast("string").alias("allow_certificate"),
            F.concat(F.lit("c"), (u % 11).cast("string")).alias("city")]
    own = F.when(u % 17 == 0, F.lit("Other/X/T")).when(u % 2 == 1, F.concat(F.lit("course-v1:"), F.translate("course_id", "/", "+"))).otherwise(c("course_id"))
    enr = pc.select(*key, own.alias("row_course_id"), c("start_time").alias("created"), "is_active", "mode")
    return {
        "users": pc.filter(u % 13 != 0).select(*key, "username", "email"),
        "profiles": pc.filter(u % 4 != 0).select(*key, *prof),
        "enrollment": enr.filter(u % 6 != 0),
        "certificates": pc.filter("grade > 0.5").select(
            *key, own.alias("row_course_id"), "grade", F.when(c("grade") > 0.65, "downloadable").otherwise("notpassing").alias("status"),
            c("last_event").alias("created_date"), c("last_event").alias("modified_date"),
            F.concat(F.lit("https://x.org/"), u.cast("string")).alias("download_url"), F.md5(u.cast("string")).alias("key"),
            F.when(u % 10 == 0, "1").otherwise("0").alias("distinction"), F.concat(F.lit("n"), u.cast("string")).alias("name"), "mode",
            F.when(c("grade") <= 0.65, "low grade").alias("error_reason")),
        "id_map": pc.filter(u % 3 == 0).select(*key, F.md5("username").alias("hash_id")),
        "alt": {"users": pc.select(*key, "username", "email"), "profiles": pc.filter(u % 8 != 0).select(*key, *prof),
                "enrollment": enr},
        "grade_report": pc.filter(u % 5 == 0).select(
            *key, F.round(1 - c("grade"), 4).alias("Grade"),
            F.when(u % 2 == 0, "2001-01-01 00:00:00").otherwise("1999-01-01 00:00:00").alias("Grade_timestamp")),
        "cutoff": "1995-03-01 00:00:00",
    }


UIC = """u0 AS (SELECT course_id, user_id, username, email, mode, is_active, start_time, grade, last_event, gender, YoB, LoE, cc_by_ip,
  user_id%13<>0 OR user_id%4<>0 OR user_id%6<>0 AS known, user_id%13<>0 AS in_users,
  CASE WHEN user_id%17=0 THEN 'Other/X/T' ELSE course_id END AS own FROM pc),
 u1 AS (SELECT *, CASE WHEN in_users OR NOT known THEN true ELSE false END AS has_name, user_id%8<>0 AND user_id%4=0 AS filled, user_id%4<>0 OR user_id%8<>0 AS has_prof FROM u0),
 u2 AS (SELECT * FROM u1 WHERE NOT (user_id%6=0 AND filled AND start_time > TIMESTAMP '1995-03-01')),
 u3 AS (SELECT a.course_id, a.user_id, b.user_id IS NOT NULL AS kept, a.own, a.grade, a.last_event, CASE WHEN has_name THEN b.username END AS username,
  CASE WHEN has_name THEN b.email END AS email,
  CASE WHEN has_prof THEN 'n'||b.user_id END AS profile_name, CASE WHEN has_prof THEN b.gender END AS profile_gender,
  CASE WHEN has_prof THEN b.YoB END AS profile_year_of_birth, CASE WHEN has_prof THEN b.LoE END AS profile_level_of_education,
  CASE WHEN has_prof THEN b.cc_by_ip END AS profile_country, a.mode AS own_mode,
  CASE WHEN has_prof AND b.user_id IS NOT NULL THEN CASE WHEN b.user_id%2=0 THEN 'en' ELSE 'fr' END END AS profile_language,
  CASE WHEN has_prof THEN 'at '||b.user_id END AS profile_location, CASE WHEN has_prof THEN 'street '||b.user_id END AS profile_mailing_address,
  CASE WHEN has_prof AND b.user_id%9<>0 THEN 'g'||b.user_id WHEN has_prof AND b.user_id%4<>0 THEN '' END AS profile_goals,
  CASE WHEN has_prof THEN CAST(b.user_id%2 AS VARCHAR) END AS profile_allow_certificate, CASE WHEN has_prof THEN 'c'||(b.user_id%11) END AS profile_city,
  b.start_time AS enrollment_created, b.is_active AS enrollment_is_active,
  b.mode AS enrollment_mode, CASE WHEN filled AND b.user_id IS NOT NULL THEN 1 END AS y1_anomalous,
  CASE WHEN b.user_id IS NULL THEN a.course_id ELSE a.own END AS enrollment_course_id
  FROM u0 a LEFT JOIN u2 b ON a.course_id=b.course_id AND a.user_id=b.user_id
  WHERE b.user_id IS NOT NULL OR a.user_id%5=0 OR a.grade>0.5 OR a.user_id%3=0),
 uic AS (SELECT course_id, user_id, username, email, profile_name, profile_gender, profile_year_of_birth, profile_level_of_education,
  profile_country, profile_language, profile_location, NULL::VARCHAR AS profile_meta, NULL::VARCHAR AS profile_courseware, profile_mailing_address,
  profile_goals, profile_allow_certificate, profile_city, enrollment_created, enrollment_is_active, enrollment_mode, y1_anomalous, enrollment_course_id,
  CASE WHEN user_id%5=0 THEN round(1-grade,4) END AS edxinstructordash_Grade,
  CASE WHEN user_id%5=0 THEN CASE WHEN user_id%2=0 THEN '2001-01-01 00:00:00' ELSE '1999-01-01 00:00:00' END END AS edxinstructordash_Grade_timestamp,
  CASE WHEN grade>0.5 THEN own END AS certificate_course_id, CASE WHEN grade>0.5 THEN grade END AS certificate_grade,
  CASE WHEN grade>0.65 THEN 'downloadable' WHEN grade>0.5 THEN 'notpassing' END AS certificate_status,
  CASE WHEN grade>0.5 THEN last_event END AS certificate_created_date, CASE WHEN grade>0.5 THEN last_event END AS certificate_modified_date,
  CASE WHEN grade>0.5 THEN 'https://x.org/'||user_id END AS certificate_download_url, CASE WHEN grade>0.5 THEN md5(CAST(user_id AS VARCHAR)) END AS certificate_key,
  CASE WHEN grade>0.5 THEN CASE WHEN user_id%10=0 THEN '1' ELSE '0' END END AS certificate_distinction, NULL::VARCHAR AS certificate_verify_uuid,
  NULL::VARCHAR AS certificate_download_uuid, CASE WHEN grade>0.5 THEN 'n'||user_id END AS certificate_name,
  CASE WHEN grade>0.5 AND grade<=0.65 THEN 'low grade' END AS certificate_error_reason, CASE WHEN grade>0.5 THEN own_mode END AS certificate_mode,
  CASE WHEN user_id%3=0 THEN md5('u'||user_id) END AS id_map_hash_id FROM u3 WHERE enrollment_course_id=course_id)"""


def uic_of(spark, d):
    """The learner table built from the dumps."""
    return P.user_info_combo(**dumps(spark, d))


@query("D1_user_info_combo", sql("pc", f"""SELECT * REPLACE ({ts('enrollment_created')}, {ts('certificate_created_date')}, {ts('certificate_modified_date')}) FROM uic""", UIC))
def user_info_combo(spark, d):
    return uic_of(spark, d)


def role_rows(spark, d):
    """Course and forum roles derived from customers."""
    pc = T.person_course(spark, d)
    u = c("user_id")
    names = [*P.COURSE_ROLES, "unknown_role"]
    course = pc.filter(u % 9 == 0).select("course_id", "user_id", F.element_at(F.array(*[F.lit(x) for x in names]), (u % 8 + 1).cast("int")).alias("role"))
    forum = pc.filter(u % 7 != 0).select("course_id", "user_id", F.when(u % 31 == 0, "Moderator").when(u % 29 == 0, "Administrator").otherwise("Student").alias("name"))
    return course.union(course), forum


_CR = ", ".join(f"max(CASE WHEN rn={i} THEN 1 END) AS {v}" for i, v in enumerate(P.COURSE_ROLES.values()))
ROLES = f"""cr AS (SELECT course_id, user_id, {_CR} FROM (SELECT *, user_id%8 AS rn FROM pc WHERE user_id%9=0) GROUP BY 1,2),
 fr AS (SELECT course_id, user_id, CASE WHEN user_id%31<>0 AND user_id%29=0 THEN 1 END AS forumRoles_isAdmin, CAST(NULL AS INTEGER) AS forumRoles_isCommunityTA,
  CASE WHEN user_id%31=0 THEN 1 END AS forumRoles_isModerator, CASE WHEN user_id%31<>0 AND user_id%29<>0 THEN 1 END AS forumRoles_isStudent FROM pc WHERE user_id%7<>0),
 rl AS (SELECT *, CASE WHEN coalesce({', '.join([*P.COURSE_ROLES.values(), 'forumRoles_isAdmin', 'forumRoles_isCommunityTA', 'forumRoles_isModerator'])}) IS NOT NULL
  THEN 'Staff' ELSE 'Student' END AS roles FROM cr FULL JOIN fr USING (course_id, user_id))"""


@query("D2_roles", sql("pc", "SELECT * FROM rl", ROLES))
def roles(spark, d):
    return P.roles(*role_rows(spark, d))


def policy_of(spark, d):
    """One grading policy per course with two cutoffs."""
    return T.course_axis(spark, d).groupBy("course_id").agg(
        F.lit(0.9).alias("overall_cutoff_for_a"), F.lit(0.6).alias("overall_cutoff_for_pass"))


BASE = """pg AS (SELECT DISTINCT course_id, 0.6::DOUBLE AS passing_grade FROM axis),
 b0 AS (SELECT *, CASE WHEN edxinstructordash_Grade IS NOT NULL AND (certificate_grade IS NULL OR edxinstructordash_Grade_timestamp>'2000-01-01')
   THEN edxinstructordash_Grade ELSE certificate_grade END AS gr FROM uic LEFT JOIN pg USING (course_id)),
 base AS (SELECT course_id, user_id, username, profile_gender AS gender, profile_level_of_education AS LoE, profile_year_of_birth AS YoB, gr AS grade,
  enrollment_created AS start_time, enrollment_mode AS mode, enrollment_is_active AS is_active, certificate_created_date AS cert_created_date,
  certificate_modified_date AS cert_modified_date, certificate_status AS cert_status, profile_country, y1_anomalous, true AS registered, passing_grade,
  coalesce(certificate_status='downloadable', false) OR coalesce(gr>=passing_grade, false) AS completed,
  coalesce(certificate_status='downloadable', false) AS certified, split_part(email,'@',2) AS email_domain FROM b0)"""


def base_of(spark, d):
    """First-phase person-course over the dumps."""
    return P.pc_base(uic_of(spark, d), policy_of(spark, d), "2000-01-01")


@query("P1_pc_base", sql("pc axis", f"SELECT * REPLACE (round(grade,6) AS grade, {ts('start_time')}, {ts('cert_created_date')}, {ts('cert_modified_date')}) FROM base", f"{UIC}, {BASE}"))
def pc_base(spark, d):
    return base_of(spark, d)


def chapter_views(spark, d):
    """Module state rows: one chapter view per order."""
    return T.load(spark, d, "orders").select(
        T._course(T._div("o_custkey", 30)).alias("course_id"), c("o_custkey").alias("student_id"), F.lit("chapter").alias("module_type"),
        F.concat(F.lit("ch"), (c("o_orderkey") % 4).cast("string")).alias("module_id"))


def forum_with_authors(spark, d):
    """Posts with author number, votes and flags."""
    f = T.forum(spark, d)
    n = F.length("body")
    return f.withColumn("author_id", F.substring("author_username", 2, 9).cast("long")).withColumn("votes_count", n % 5).withColumn(
        "pinned", n % 7 == 0).withColumn("endorsed", n % 3 == 0)


NCH = """nch AS (SELECT 'Org'||((o_custkey//30)%3)||'/C'||(o_custkey//30)||'/T1' AS course_id, o_custkey AS user_id, count(DISTINCT o_orderkey%4) AS nchapters FROM orders GROUP BY 1,2),
 cch AS (SELECT course_id, count(*) FILTER (category='chapter') AS n FROM axis GROUP BY 1),
 fct AS (SELECT course_id, CAST(author_username[2:] AS BIGINT) AS user_id, count(*) AS nforum_posts, sum(length(body)%5) AS nforum_votes,
  count(*) FILTER (length(body)%7=0) AS nforum_pinned, count(*) FILTER (length(body)%3=0) AS nforum_endorsed,
  count(*) FILTER (_type='CommentThread') AS nforum_threads, count(*) FILTER (_type='Comment') AS nforum_comments FROM forum GROUP BY 1,2)"""


@query("P2_pc_nchapters", sql("axis forum", "SELECT * FROM nch", NCH))
def pc_nchapters(spark, d):
    return P.pc_nchapters(chapter_views(spark, d))


@query("P2_pc_forum", sql("axis forum", "SELECT * FROM fct", NCH))
def pc_forum(spark, d):
    return P.pc_forum(forum_with_authors(spark, d))


@query("P2_course_nchapters", sql("axis forum", "SELECT course_id, n AS course_nchapters FROM cch", NCH))
def pc_course_nchapters(spark, d):
    return P.pc_course_nchapters(T.course_axis(spark, d))


@query("P2_viewed_explored", sql("pc axis forum", """SELECT course_id, user_id, nchapters, nchapters IS NOT NULL AS viewed,
 CASE WHEN nchapters IS NOT NULL THEN coalesce(nchapters >= n//2, false) END AS explored FROM base LEFT JOIN nch USING (course_id, user_id) LEFT JOIN cch USING (course_id)""",
    f"{UIC}, {BASE}, {NCH}"))
def pc_viewing(spark, d):
    out = P.pc_viewing(base_of(spark, d), P.pc_nchapters(chapter_views(spark, d)), P.pc_course_nchapters(T.course_axis(spark, d)))
    return out.select("course_id", "user_id", "nchapters", "viewed", "explored")


PT = f"""pt AS (SELECT course_id, username, count(*) AS ndays_act, {', '.join(f'sum({x}) AS {x}' for x in P.TOTAL_COLUMNS)}, min(first_event) AS first_event,
 max(last_event) AS last_event, avg(avg_dt) AS avg_dt, sqrt(sum(sdv_dt*sdv_dt*n_dt)/nullif(sum(n_dt),0)) AS sdv_dt, max(max_dt) AS max_dt, sum(n_dt) AS n_dt,
 sum(sum_dt) AS sum_dt FROM dlog GROUP BY 1,2)"""


def totals_of(spark, d):
    """Day totals of the test log."""
    return P.pc_day_totals(E.person_course_day(T.tracking_log(spark, d)))


@query("P3_pc_day_totals", sql("log", rounded(f"SELECT * REPLACE ({ts('first_event')}, {ts('last_event')}) FROM pt", "avg_dt sdv_dt max_dt sum_dt", 4), f"{DAY}, {PT}"), digits=4)
def pc_day_totals(spark, d):
    return totals_of(spark, d)


IPS = """ipc AS (SELECT course_id, username, ip, count(*) AS n FROM log WHERE username<>'' GROUP BY 1,2,3),
 cip AS (SELECT * FROM (SELECT course_id, username, ip AS modal_ip, n AS ip_count, count(*) OVER (PARTITION BY course_id, username) AS n_different_ip,
  row_number() OVER (PARTITION BY course_id, username ORDER BY n DESC, ip) AS rn FROM ipc) WHERE rn=1),
 gip AS (SELECT * FROM (SELECT username, ip AS modal_ip, sum(n) AS ip_count, count(*) OVER (PARTITION BY username) AS n_different_ip,
  row_number() OVER (PARTITION BY username ORDER BY sum(n) DESC, ip) AS rn FROM ipc GROUP BY 1,2) WHERE rn=1)"""


@query("P4_course_modal_ip", sql("log", "SELECT course_id, username, modal_ip, ip_count, n_different_ip FROM cip", IPS))
def course_modal_ip(spark, d):
    return P.modal_ip(E.pcday_ip(T.tracking_log(spark, d)), ["course_id", "username"])


MIP = """mip AS (SELECT p.course_id, p.username, c.modal_ip AS course_modal_ip, c.ip_count AS course_ip_count, g.modal_ip AS global_modal_ip, g.ip_count AS global_ip_count,
 coalesce(c.modal_ip, g.modal_ip) AS modal_ip, CASE WHEN c.modal_ip IS NOT NULL THEN 'course' WHEN g.modal_ip IS NOT NULL THEN 'global' ELSE 'missing' END AS source
 FROM pc p LEFT JOIN cip c ON p.course_id=c.course_id AND p.username=c.username LEFT JOIN gip g ON p.username=g.username)"""


def modal_of(spark, d):
    """Modal address of every learner."""
    counts = E.pcday_ip(T.tracking_log(spark, d))
    return P.pc_modal_ip(T.person_course(spark, d), P.modal_ip(counts, ["course_id", "username"]), R.global_modal_ip(counts))


@query("P5_pc_modal_ip", sql("log pc", "SELECT * FROM mip", f"{IPS}, {MIP}"))
def pc_modal_ip(spark, d):
    return modal_of(spark, d)


LM = """lm0 AS (SELECT course_id, username, resource, resource_event_data, count(*) FILTER (resource_event_type='transcript_download') AS transcript_download,
 sum(langcount) AS n_events, max(last_time) AS last_time_used_lang FROM trl GROUP BY 1,2,3,4),
 lm AS (SELECT *, count(resource_event_data) OVER (PARTITION BY course_id, username) AS n_diff_lang,
  rank() OVER (PARTITION BY course_id, username ORDER BY n_events DESC) AS rank_num FROM lm0),
 ml AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY course_id, username ORDER BY last_time_used_lang DESC, resource_event_data) AS rn FROM lm WHERE rank_num=1) WHERE rn=1)"""


@query("P6_language_multi_transcripts", sql("log", f"SELECT * REPLACE ({ts('last_time_used_lang')}) FROM lm", f"{TRL}, {LM}"))
def lang_multi(spark, d):
    return P.lang_multi(E.pcday_trlang(T.tracking_log(spark, d)))


@query("P6_course_modal_language", sql("log", """SELECT course_id, username, resource, resource_event_data AS language, transcript_download AS language_download,
 n_events AS language_nevents, n_diff_lang AS language_ndiff FROM ml""", f"{TRL}, {LM}"))
def modal_language(spark, d):
    return P.modal_language(P.lang_multi(E.pcday_trlang(T.tracking_log(spark, d))))


GEO = """gj AS (SELECT mip.*, ipn AS ip_num, geo.* FROM (SELECT *, list_reduce(list_transform(string_split(modal_ip,'.'), lambda x: CAST(x AS BIGINT)), lambda a, b: a*256+b) AS ipn FROM mip WHERE modal_ip IS NOT NULL) mip
 JOIN geo ON ipn BETWEEN startIpNum AND endIpNum)"""


@query("P7_pc_geoip", sql("log pc geo", "SELECT * EXCLUDE (ipn) FROM gj", f"{IPS}, {MIP}, {GEO}"))
def pc_geoip(spark, d):
    return P.geoip_join(modal_of(spark, d), T.geo_ranges(spark, d))


def thin_pc(spark, d):
    """Person-course with the country missing for every fifth user."""
    pc = T.person_course(spark, d)
    gone = c("user_id") % 5 == 0
    return pc.select("course_id", "user_id", "ip", F.when(~gone, c("cc_by_ip")).alias("cc_by_ip"),
                     F.when(~gone & (c("user_id") % 2 == 0), c("countryLabel")).alias("countryLabel"), F.lit(None).cast("string").alias("continent"))


def geo_extras(spark, d):
    """Extra addresses with country and region attributes by country."""
    pc = T.person_course(spark, d)
    extra = pc.filter("user_id % 10 = 0").groupBy("ip").agg(
        F.min("cc_by_ip").alias("country"), F.min("countryLabel").alias("countryLabel"), F.min("continent").alias("continent"))
    nation = T.load(spark, d, "nation").join(T.load(spark, d, "region"), c("n_regionkey") == c("r_regionkey"))
    regions = nation.select(F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("cc"), c("n_name").alias("name"), c("r_name").alias("continent"),
                            c("r_name").alias("un_region"), F.concat(F.lit("g"), (c("n_nationkey") % 3).cast("string")).alias("econ_group"),
                            F.when(c("n_nationkey") % 2 == 0, "yes").otherwise("no").alias("developing_nation"))
    return extra, regions


_GONE = "user_id%5=0"


@query("P8_geo_fill", sql("pc", f"""SELECT course_id, user_id, ip, cc AS cc_by_ip, coalesce(lab, n_name) AS countryLabel, coalesce(con, r_name) AS continent,
 r_name AS un_major_region, CASE WHEN cc IS NOT NULL THEN 'g'||(n_nationkey%3) END AS un_economic_group, CASE WHEN cc IS NOT NULL THEN CASE WHEN n_nationkey%2=0 THEN 'yes' ELSE 'no' END END AS un_developing_nation
 FROM (SELECT course_id, user_id, pc.ip, CASE WHEN {_GONE} THEN x.country ELSE cc_by_ip END AS cc,
   CASE WHEN {_GONE} THEN x.l WHEN user_id%2=0 THEN countryLabel END AS lab, CASE WHEN {_GONE} THEN x.k END AS con
   FROM pc LEFT JOIN (SELECT ip, min(cc_by_ip) AS country, min(countryLabel) AS l, min(continent) AS k FROM pc WHERE user_id%10=0 GROUP BY 1) x ON pc.ip=x.ip)
 LEFT JOIN nation ON cc='N'||n_nationkey LEFT JOIN region ON n_regionkey=r_regionkey"""))
def geo_fill(spark, d):
    return P.geo_fill(thin_pc(spark, d), *geo_extras(spark, d))


@query("P8_ips_missing_country", sql("pc", f"SELECT ip, count(*) AS n FROM pc WHERE {_GONE} GROUP BY 1"))
def ips_missing_country(spark, d):
    return P.ips_missing_country(thin_pc(spark, d))


@query("P9_pc_roles_verified", sql("pc log", f"""SELECT p.course_id, p.user_id, {', '.join(f'rl.{x}' for x in [*P.COURSE_ROLES.values(), *P.FORUM_ROLES.values()])}, rl.roles,
 {ts('verified_enroll_time', 'v.a')}, CASE WHEN date_trunc('second',v.b)<>date_trunc('second',v.a) THEN strftime(v.b,'%Y-%m-%d %H:%M:%S.%f') END AS verified_unenroll_time
 FROM pc p LEFT JOIN rl ON p.course_id=rl.course_id AND p.user_id=rl.user_id LEFT JOIN (SELECT course_id, user_id, min(time) AS a, max(time) AS b FROM enr
 WHERE mode='verified' AND (deactivated OR (NOT activated AND mode_changed)) GROUP BY 1,2) v ON p.course_id=v.course_id AND p.user_id=v.user_id""", f"{ROLES}, {ENR}"))
def pc_roles_verified(spark, d):
    keys = T.person_course(spark, d).select("course_id", "user_id")
    verified = E.enrollment_verified(E.enrollment_events(T.tracking_log(spark, d)))
    return P.pc_verified(P.pc_roles(keys, P.roles(*role_rows(spark, d))), verified)


def assembled(spark, d, refresh="all", base=None):
    """Person-course from all its parts."""
    log = T.tracking_log(spark, d)
    extra, regions = geo_extras(spark, d)
    modal = modal_of(spark, d)
    return P.person_course(
        base if base is not None else base_of(spark, d), refresh, nchapters=P.pc_nchapters(chapter_views(spark, d)),
        course_nchapters=P.pc_course_nchapters(T.course_axis(spark, d)), forum_counts=P.pc_forum(forum_with_authors(spark, d)),
        day_totals=P.pc_day_totals(E.person_course_day(log)), modal=modal,
        language=P.modal_language(P.lang_multi(E.pcday_trlang(log))), geo=P.geoip_join(modal, T.geo_ranges(spark, d)),
        extra_geoip=extra, regions=regions, role_table=P.roles(*role_rows(spark, d)),
        verified=E.enrollment_verified(E.enrollment_events(log)))


P10_COLS = ["course_id", "user_id", "username", "grade", "completed", "certified", "nchapters", "viewed", "explored", "nforum_posts", "nevents",
            "nplay_video", "ndays_act", "sum_dt", "language", "ip", "cc_by_ip", "countryLabel", "un_economic_group", "roles", "roles_isStaff"]


@query("P10_person_course", sql("pc axis forum log geo", """SELECT b.course_id, b.user_id, b.username, round(b.grade,6) AS grade, completed, certified, nchapters, nchapters IS NOT NULL AS viewed,
 CASE WHEN nchapters IS NOT NULL THEN coalesce(nchapters >= cch.n//2, false) END AS explored, fct.nforum_posts, pt.nevents, pt.nvideo AS nplay_video, pt.ndays_act,
 round(pt.sum_dt,6) AS sum_dt, ml.resource_event_data AS language, mip.modal_ip AS ip, coalesce(gj.country, x.country) AS cc_by_ip,
 coalesce(gj.countryLabel, x.l) AS countryLabel, CASE WHEN coalesce(gj.country, x.country) IS NOT NULL THEN 'g'||(CAST(coalesce(gj.country, x.country)[2:] AS BIGINT)%3) END AS un_economic_group, rl.roles, rl.roles_isStaff
 FROM base b LEFT JOIN nch ON b.course_id=nch.course_id AND b.user_id=nch.user_id LEFT JOIN cch ON b.course_id=cch.course_id
 LEFT JOIN fct ON b.course_id=fct.course_id AND b.user_id=fct.user_id LEFT JOIN pt ON b.course_id=pt.course_id AND b.username=pt.username
 LEFT JOIN ml ON b.course_id=ml.course_id AND b.username=ml.username LEFT JOIN mip ON b.course_id=mip.course_id AND b.username=mip.username
 LEFT JOIN gj ON b.course_id=gj.course_id AND b.username=gj.username
 LEFT JOIN (SELECT ip, min(cc_by_ip) AS country, min(countryLabel) AS l FROM pc WHERE user_id%10=0 GROUP BY 1) x ON mip.modal_ip=x.ip
 LEFT JOIN rl ON b.course_id=rl.course_id AND b.user_id=rl.user_id""", f"{UIC}, {BASE}, {NCH}, {DAY}, {PT}, {TRL}, {LM}, {IPS}, {MIP}, {GEO}, {ROLES}"))
def person_course(spark, d):
    return assembled(spark, d).select(*P10_COLS)


@query("P10_person_course_nightly", sql("pc log", rounded("""SELECT p.course_id, p.user_id, p.grade, p.viewed, t.nevents, t.nvideo AS nplay_video, t.ndays_act, t.sum_dt,
 strftime(p.last_event,'%Y-%m-%d %H:%M:%S.%f') AS last_event, p.ip FROM pc p LEFT JOIN pt t ON p.course_id=t.course_id AND p.username=t.username""", "grade sum_dt"), f"{DAY}, {PT}"))
def person_course_nightly(spark, d):
    out = P.person_course(T.person_course(spark, d), "nightly", day_totals=totals_of(spark, d))
    return out.select("course_id", "user_id", "grade", "viewed", "nevents", "nplay_video", "ndays_act", "sum_dt", "last_event", "ip")


for _name, _cond in {"viewed": "viewed", "idv": "verified_enroll_time IS NOT NULL"}.items():
    @query(f"P11_person_course_{_name}", sql("pc", f"SELECT course_id, user_id, viewed, {ts('verified_enroll_time')} FROM pc WHERE {_cond}"))
    def combined(spark, d, _subset=_name):
        pc = T.person_course(spark, d)
        halves = [pc.filter(c("course_id").startswith("Org0")), pc.filter(~c("course_id").startswith("Org0"))]
        return P.combine_person_course(halves, _subset).select("course_id", "user_id", "viewed", "verified_enroll_time")


STU = "WHERE forumRoles_isStudent=1 OR forumRoles_isStudent IS NULL"
_HI = "LoE IN ('b','m','p','p_oth','p_se')"
_LO = "LoE IN ('a','el','hs','jhs','none')"
_BC = {"viewed_sum": "viewed", "explored_sum": "explored AND viewed", "certified_sum": "certified AND viewed",
       "certified_and_explored_sum": "certified AND explored AND viewed", "certified_or_explored_sum": "(certified OR explored) AND viewed",
       "n_male": "gender='m'", "n_female": "gender='f'", "n_usa_and_viewed": "cc_by_ip='US' AND viewed", "n_bachplus_in_reg": _HI,
       "n_bachplus_in_viewed": f"viewed AND {_HI}", "n_not_bachplus_in_reg": _LO, "n_not_bachplus_in_viewed": f"viewed AND {_LO}",
       "n_male_viewed": "viewed AND gender='m'", "n_female_viewed": "viewed AND gender='f'", "n_verified_id": "mode='verified'",
       "verified_viewed": "viewed AND mode='verified'", "verified_explored": "explored AND mode='verified'", "verified_certified": "certified AND mode='verified'",
       "verified_n_male": "gender='m' AND mode='verified'", "verified_n_female": "gender='f' AND mode='verified'", "n_reg_nonzero_grade": "grade>0",
       "n_viewed_nonzero_grade": "grade>0 AND viewed", "n_explored_nonzero_grade": "grade>0 AND viewed AND explored", "n_have_ip": "ip IS NOT NULL",
       "n_missing_cc": "ip IS NOT NULL AND cc_by_ip IS NULL"}
_BS = {"nplay_video_sum": "nplay_video", "ndays_act_sum": "ndays_act", "nevents_sum": "nevents", "nforum_posts_sum": "nforum_posts", "nforum_votes_sum": "nforum_votes",
       "nforum_endorsed_sum": "nforum_endorsed", "nforum_threads_sum": "nforum_threads", "nforum_commments_sum": "nforum_comments", "nforum_pinned_sum": "nforum_pinned",
       "nshow_answer_sum": "nshow_answer", "nseq_goto_sum": "nseq_goto", "npause_video_sum": "npause_video"}
_BA = {"verified_avg_grade": "CASE WHEN mode='verified' THEN grade END", "nchapters_avg": "nchapters", "nprogcheck_avg": "CASE WHEN viewed THEN nprogcheck END",
       "certified_nprogcheck": "CASE WHEN certified THEN nprogcheck END", "verified_nprogcheck": "CASE WHEN mode='verified' THEN nprogcheck END",
       "avg_of_avg_dt": "avg_dt", "avg_of_sum_dt": "sum_dt", "certified_avg_dt": "CASE WHEN certified THEN avg_dt END", "certified_sum_dt": "CASE WHEN certified THEN sum_dt END"}
BROAD = f"""broad AS (SELECT course_id, count(*) AS registered_sum, {', '.join(f'count(*) FILTER ({x}) AS {n}' for n, x in _BC.items())},
 {', '.join(f'sum({x}) AS {n}' for n, x in _BS.items())}, {', '.join(f'avg({x}) AS {n}' for n, x in _BA.items())},
 min(CASE WHEN certified THEN grade END) AS min_gade_certified, min(start_time) AS min_start_time, max(last_event) AS max_last_event, max(nchapters) AS max_nchapters
 FROM pc {STU} GROUP BY 1)"""


@query("R1_broad_stats_by_course", sql("pc", rounded(f"SELECT * REPLACE ({ts('min_start_time')}, {ts('max_last_event')}) FROM broad", " ".join([*_BA, "min_gade_certified"]), 7), BROAD), digits=7)
def broad_stats(spark, d):
    return R.broad_stats(T.person_course(spark, d))


for _cohort, _cond in R.COHORTS.items():
    _med = ", ".join(f"round(quantile_disc({m},0.5)::DOUBLE,6) AS {m}_median" for m in R.MEDIAN_COLUMNS)

    @query(f"R2_{_cohort}_median_stats", sql("pc", f"""SELECT course_id, count(*) AS n_records, {_med}, quantile_disc(2014-YoB,0.5)::DOUBLE AS age_in_2014_median,
     round(count(*) FILTER (nplay_video>0)/count(*),6) AS frac_nonzero_play_video, count(*) FILTER (nplay_video>0) AS sum_n_nonzero_play_video,
     round(count(*) FILTER (grade>0)/count(*),6) AS frac_nonzero_grade, count(*) FILTER (grade>0) AS sum_n_nonzero_grade,
     round(count(*) FILTER (nforum_posts>0)/count(*),6) AS frac_nonzero_forum_posts, count(*) FILTER (nforum_posts>0) AS sum_n_nonzeo_nforum_posts
     FROM pc WHERE (forumRoles_isStudent=1 OR forumRoles_isStudent IS NULL) AND {_cond} GROUP BY 1"""))
    def median_stats(spark, d, _cohort=_cohort):
        return R.median_stats(T.person_course(spark, d), _cohort)


def _tot_oracle(kind: str, tag: str) -> str:
    cols = {"total": "total_time_30", **{k: f"{kind}_{k}_time_30" for k in ("problem", "video", "forum")}}
    parts = []
    for suffix in ("", "_viewed", "_certified", "_verified"):
        cond = {"": "true", "_verified": "mode='verified'"}.get(suffix, suffix[1:])
        for k, col in cols.items():
            parts.append(f"round(sum({col}/3600.0) FILTER ({cond}),6) AS sum_{k}_{tag}{suffix}")
            parts.append(f"round(quantile_disc({col}/3600.0,0.5) FILTER ({cond}),6) AS median_{k}_{tag}{suffix}")
    sums = ", ".join(f"sum({x}) AS {x}" for x in TOT_COLS)
    return sql("log pc", f"""SELECT course_id, {', '.join(parts)} FROM tt JOIN pc USING (course_id, username) {STU} GROUP BY 1""",
               f"{TOT}, tt AS (SELECT course_id, username, {sums} FROM tot GROUP BY 1,2)")


for _kind, _tag in (("total", "hours"), ("serial", "serial_hours")):
    @query(f"R3_time_on_task_{_kind}_stats", _tot_oracle(_kind, _tag))
    def tot_stats(spark, d, _kind=_kind):
        totals = E.time_on_task_totals(E.time_on_task(T.tracking_log(spark, d)))
        return R.tot_stats(totals, T.person_course(spark, d), _kind)


@query("R4_union_courses", sql("axis", "SELECT course_id, index, module_id, category FROM axis"))
def union_courses(spark, d):
    axis = T.course_axis(spark, d).select("course_id", "index", "module_id", "category")
    return R.union_courses([axis.filter(c("course_id").startswith(f"Org{i}")) for i in range(3)])


@query("R5_email_addresses", sql("pc", "SELECT username, email, count(*) AS ncourses FROM pc GROUP BY 1,2"))
def emails(spark, d):
    return R.emails(T.person_course(spark, d))


@query("R5_email_addresses_by_org", sql("pc", "SELECT split_part(course_id,'/',1) AS org, username, email, count(*) AS ncourses FROM pc GROUP BY 1,2,3"))
def emails_by_org(spark, d):
    return R.emails(T.person_course(spark, d), by_org=True)


@query("R6_global_modal_ip", sql("log", "SELECT username, modal_ip, ip_count, n_different_ip FROM gip", IPS))
def global_modal_ip(spark, d):
    return R.global_modal_ip(E.pcday_ip(T.tracking_log(spark, d)))


@query("R7_global_modal_lang", sql("log", """SELECT username, resource_event_data AS modal_language, n AS langcount, nd AS n_different_lang FROM (
 SELECT username, resource_event_data, sum(langcount) AS n, count(*) OVER (PARTITION BY username) AS nd,
 row_number() OVER (PARTITION BY username ORDER BY sum(langcount) DESC, resource_event_data) AS rn FROM trl GROUP BY 1,2) WHERE rn=1""", TRL))
def global_modal_lang(spark, d):
    return R.global_modal_lang(E.pcday_trlang(T.tracking_log(spark, d)))


@query("R8_enrollment_by_day", sql("pc", """SELECT *, sum(nregistered_ever) OVER w AS nregistered_ever_cum, sum(nregistered_net) OVER w AS nregistered_net_cum,
 sum(nverified_ever) OVER w AS nverified_ever_cum, sum(nverified_net) OVER w AS nverified_net_cum FROM (
 SELECT course_id, date, sum(r) AS nregistered_ever, sum(u) AS n_unregistered, sum(r)-sum(u) AS nregistered_net, sum(v) AS nverified_ever,
 sum(vu) AS nverified_un_registered, sum(v)-sum(vu) AS nverified_net FROM (
  SELECT course_id, strftime(last_event,'%Y-%m-%d') AS date, 0 AS r, 1 AS u, 0 AS v, CASE WHEN mode='verified' THEN 1 ELSE 0 END AS vu FROM pc
  WHERE is_active=0 AND last_event IS NOT NULL AND (forumRoles_isStudent=1 OR forumRoles_isStudent IS NULL)
  UNION ALL SELECT course_id, strftime(start_time,'%Y-%m-%d'), 1, 0, CASE WHEN mode='verified' THEN 1 ELSE 0 END, 0 FROM pc
  WHERE start_time IS NOT NULL AND (forumRoles_isStudent=1 OR forumRoles_isStudent IS NULL)) GROUP BY 1,2)
 WINDOW w AS (PARTITION BY course_id ORDER BY date)"""))
def enrollment_by_day(spark, d):
    return R.enrollment_by_day(T.person_course(spark, d))


@query("R9_populations", sql("pc", "SELECT course_id, count(*) AS registered_sum, " + ", ".join(f"count(*) FILTER ({x}) AS {n}" for n, x in {
    "viewed_sum": "viewed", "explored_sum": "explored", "certified_sum": "certified", "n_have_ip": "ip IS NOT NULL",
    "n_missing_cc": "ip IS NOT NULL AND cc_by_ip IS NULL"}.items()) + f" FROM pc {STU} GROUP BY 1"))
def populations(spark, d):
    return R.populations(T.person_course(spark, d))


@query("R10_multi_registrations", sql("pc", "SELECT user_id, count(*) AS n_courses_registered FROM pc GROUP BY 1"))
def multi_registrations(spark, d):
    return R.multi_registrations(T.person_course(spark, d))


@query("R11_geographic", sql("pc", f"""SELECT cc_by_ip AS cc, countryLabel, count(*) FILTER (certified) AS ncertified, count(*) FILTER (registered) AS nregistered,
 count(*) FILTER (viewed) AS nviewed, count(*) FILTER (explored) AS nexplored, count(*) FILTER (mode='verified') AS nverified,
 count(*) FILTER (mode='verified' AND certified) AS ncert_verified, round(avg(avg_dt) FILTER (certified),4) AS avg_certified_dt FROM pc {STU} GROUP BY 1,2"""), digits=4)
def geographic(spark, d):
    return R.geographic(T.person_course(spark, d))


@query("R12_overall_stats", sql("pc", """SELECT sum(registered_sum) AS registered, sum(viewed_sum) AS viewed, sum(explored_sum) AS explored, sum(certified_sum) AS certified,
 sum(n_verified_id) AS verified_id, sum(verified_viewed) AS verified_viewed, sum(verified_explored) AS verified_explored, sum(verified_certified) AS verified_certified,
 sum(n_missing_cc) AS n_missing_cc, round(sum(verified_certified)/sum(n_verified_id)*100.0,6) AS verified_certification_pct,
 round(avg(certified_nprogcheck/nullif(nprogcheck_avg,0)),6) AS avg_nprogcheck_ratio_cert_vs_all, (SELECT count(DISTINCT user_id) FROM pc) AS n_unique_registrants,
 (SELECT count(*) FROM pc) AS course_registrations FROM broad""", BROAD))
def overall(spark, d):
    pc = T.person_course(spark, d)
    return R.overall(R.broad_stats(pc), R.multi_registrations(pc))
