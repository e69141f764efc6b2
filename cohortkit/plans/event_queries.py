"""Registered queries over the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortkit.operators import events as E
from cohortkit.plans.registry import query
from cohortkit.sources.testdata import course_axis, person_course, problem_analysis, rounded, sql, tracking_log

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"


def ts(name: str, expr: str | None = None) -> str:
    """A timestamp column as text in the checking SQL."""
    return f"strftime({expr or name}, '%Y-%m-%d %H:%M:%S.%f') AS {name}"


def stats_of(pc: DataFrame) -> DataFrame:
    """First registration per course, as the bound operators need it."""
    return pc.filter("forumRoles_isStudent = 1 OR forumRoles_isStudent IS NULL").groupBy("course_id").agg(
        F.min("start_time").alias("min_start_time"))


def uic_of(pc: DataFrame) -> DataFrame:
    """Certificate dates per learner."""
    return pc.select("course_id", "username", F.when(F.col("certified"), F.col("last_event")).alias("certificate_created_date"))


FLAGS = """CASE WHEN starts_with(event_type,'/courses/'||course_id||'/progress') THEN 1 ELSE 0 END AS bprog,
 CASE WHEN starts_with(event_type,'/courses/'||course_id||'/discussion/') THEN 1 ELSE 0 END AS bforum"""
DAY = f"""lg AS (SELECT *, {FLAGS}, (epoch_us(time)-epoch_us(lag(time) OVER (PARTITION BY course_id, username ORDER BY time)))/1e6 AS gap
 FROM log WHERE username<>'' AND NOT contains(event_type,'/xblock/')),
 g AS (SELECT *, CASE WHEN gap<=300 THEN gap END AS dt, CASE WHEN gap<=300 THEN CAST(round(gap*1e6) AS BIGINT) END AS us FROM lg),
 dlog AS (SELECT course_id, username, strftime(time,'%Y-%m-%d') AS date, count(*) AS nevents, sum(bprog) AS nprogcheck,
  count(*) FILTER (event_type IN ('show_answer','showanswer')) AS nshow_answer, count(*) FILTER (event_type='play_video') AS nvideo,
  count(*) FILTER (event_type='problem_check') AS nproblem_check, sum(bforum) AS nforum,
  count(*) FILTER (event_type='show_transcript') AS ntranscript, count(*) FILTER (event_type='seq_goto') AS nseq_goto,
  count(*) FILTER (event_type='seek_video') AS nseek_video, count(*) FILTER (event_type='pause_video') AS npause_video,
  min(time) AS first_event, max(time) AS last_event, sum(us)::DOUBLE/count(us)/1e6 AS avg_dt, round(stddev_samp(dt),6) AS sdv_dt, max(dt) AS max_dt,
  count(dt) AS n_dt, sum(us)/1e6 AS sum_dt FROM g GROUP BY 1,2,3)"""
VDAY = """vday AS (SELECT course_id, username, 'v'||vid AS video_id, strftime(time,'%Y-%m-%d') AS date,
 max(round(cur,2)*coalesce(speed,1)) AS position FROM log WHERE event_type IN ('play_video','pause_video','stop_video') GROUP BY 1,2,3,4)"""
FEV = """fev AS (SELECT course_id, time, username, CASE WHEN event_type LIKE '%/reply' THEN 'reply' WHEN event_type LIKE '%/upvote' THEN 'upvote'
 WHEN event_type LIKE '%/follow' THEN 'follow_thread' WHEN event_type LIKE '%/discussion/forum/%' THEN 'read'
 WHEN event_type='edx.forum.thread.created' THEN 'created_thread' ELSE event_type END AS forum_action,
 CASE WHEN event_type LIKE '/courses/%' THEN thread END AS thread_id,
 CASE WHEN event_type LIKE '%/discussion/forum/%' THEN 'gen' END AS subject FROM log
 WHERE event_type LIKE 'edx.forum.%' OR contains(event_type,'/discussion/forum') OR contains(event_type,'/discussion/threads'))"""
ZERO_P = ", ".join(f"0 AS nproblems_{s}" for s in ["answered", "attempted", *E.PROBLEM_TYPES.values(), "other"])


def _days(spark, d):
    return E.person_course_day(tracking_log(spark, d))


@query("E1_person_course_day", sql("log", rounded(
    f"SELECT course_id, username, date, nevents, nprogcheck, nshow_answer, nvideo, nproblem_check, nforum, ntranscript, nseq_goto, "
    f"nseek_video, npause_video, 0 AS nvideos_viewed, 0 AS nforum_reads, 0 AS nforum_posts, 0 AS nforum_threads, {ZERO_P}, "
    f"0.0 AS nvideos_watched_sec, {ts('first_event')}, {ts('last_event')}, avg_dt, sdv_dt, max_dt, n_dt, sum_dt FROM dlog",
    "avg_dt max_dt sum_dt", 9), DAY), digits=9)
def person_course_day(spark, d):
    return _days(spark, d).withColumn("sdv_dt", F.round("sdv_dt", 6))


def problem_days(spark, d):
    """Answered problems per day with their response type."""
    pa = problem_analysis(spark, d).select(
        "course_id", "user_id", "problem_url_name", F.col("attempts").alias("n_attempts"), F.col("created").alias("time"))
    types = course_axis(spark, d).filter("category = 'problem'").select(
        "course_id", F.col("url_name").alias("problem_url_name"), F.col("data.itype").alias("itype"))
    return pa.join(types, ["course_id", "problem_url_name"], "left").withColumn(
        "username", F.concat(F.lit("u"), F.col("user_id").cast("string"))).withColumnRenamed("problem_url_name", "problem_nid")


_PT = ", ".join(f"count(*) FILTER (itype='{t}') AS nproblems_{s}" for t, s in E.PROBLEM_TYPES.items())
_NT = ", ".join(f"'{t}'" for t in E.PROBLEM_TYPES)
_SUMS = ", ".join(f"coalesce(sum({c}),0) AS {c}" for c in [
    *E.DAY_COUNTERS, "nvideos_viewed", "nforum_reads", "nforum_posts", "nforum_threads", "nproblems_answered", "nproblems_attempted",
    *[f"nproblems_{s}" for s in [*E.PROBLEM_TYPES.values(), "other"]], "nvideos_watched_sec"])


@query("E1_person_course_day_all_sources", sql("log pa axis", rounded(
    f"""SELECT course_id, username, date, {_SUMS}, {ts('first_event', 'min(first_event)')}, {ts('last_event', 'max(last_event)')},
    max(avg_dt) AS avg_dt, max(sdv_dt) AS sdv_dt, max(max_dt) AS max_dt, coalesce(max(n_dt),0) AS n_dt, max(sum_dt) AS sum_dt
    FROM (SELECT * FROM dlog
      UNION ALL BY NAME SELECT course_id, username, date, count(DISTINCT video_id) AS nvideos_viewed, sum(position) AS nvideos_watched_sec,
        min(CAST(date AS TIMESTAMP)) AS first_event, max(CAST(date AS TIMESTAMP)) AS last_event FROM vday GROUP BY 1,2,3
      UNION ALL BY NAME SELECT course_id, username, strftime(time,'%Y-%m-%d') AS date, count(*) FILTER (forum_action='read') AS nforum_reads,
        count(*) FILTER (forum_action<>'read') AS nforum_posts, count(DISTINCT thread_id) AS nforum_threads,
        min(time) AS first_event, max(time) AS last_event FROM fev
        WHERE forum_action IN ('read','reply','created_thread') GROUP BY 1,2,3
      UNION ALL BY NAME SELECT p.course_id, 'u'||user_id AS username, strftime(created,'%Y-%m-%d') AS date,
        count(DISTINCT problem_url_name) AS nproblems_answered, sum(attempts) AS nproblems_attempted, {_PT},
        count(*) FILTER (itype IS NOT NULL AND itype NOT IN ({_NT})) AS nproblems_other, min(created) AS first_event, max(created) AS last_event
        FROM pa p LEFT JOIN axis a ON p.course_id=a.course_id AND p.problem_url_name=a.url_name GROUP BY 1,2,3)
    GROUP BY 1,2,3""", "avg_dt max_dt sum_dt nvideos_watched_sec", 9), f"{DAY}, {VDAY}, {FEV}"), digits=9)
def person_course_day_all(spark, d):
    log = tracking_log(spark, d)
    days = E.person_course_day(log, E.video_stats_day(log), E.forum_events(log), problem_days(spark, d))
    return days.withColumn("sdv_dt", F.round("sdv_dt", 6))


@query("E2_pcday_ip_counts", sql("log", """SELECT course_id, username, ip, strftime(time,'%Y-%m-%d') AS date, count(*) AS ipcount
 FROM log WHERE username<>'' GROUP BY 1,2,3,4"""))
def pcday_ip(spark, d):
    return E.pcday_ip(tracking_log(spark, d))


TRL = """tr0 AS (SELECT course_id, username, time, event_type, CASE WHEN d=9 THEN 'transcript_download' ELSE 'transcript_language' END AS ret,
 CASE WHEN d=8 THEN split_part(event_type,'/translation/',2) END AS lang FROM log WHERE t='view' AND d IN (8,9) AND username<>''),
 tr1 AS (SELECT *, lag(lang) OVER (PARTITION BY course_id, username ORDER BY time, event_type) AS pl FROM tr0),
 trl AS (SELECT course_id, username, strftime(time,'%Y-%m-%d') AS date, 'video' AS resource,
 CASE WHEN ret='transcript_download' THEN coalesce(pl,'en') ELSE lang END AS resource_event_data, ret AS resource_event_type,
 max(time) AS last_time, count(*) AS langcount FROM tr1 GROUP BY 1,2,3,4,5,6)"""


@query("E3_pcday_trlang_counts", sql("log", f"SELECT * REPLACE ({ts('last_time')}) FROM trl", TRL))
def pcday_trlang(spark, d):
    return E.pcday_trlang(tracking_log(spark, d))


@query("E4_problem_check", sql("log", f"""SELECT course_id, {ts('time')}, username, module_id, answers AS student_answers, attempts, success, grade
 FROM log WHERE event_type IN ('problem_check','save_problem_check') AND event_source='server'"""))
def problem_check(spark, d):
    return E.problem_check(tracking_log(spark, d))


@query("E5_show_answer", sql("log", f"""SELECT course_id, {ts('time')}, username, module_id FROM log
 WHERE event_type IN ('show_answer','showanswer')"""))
def show_answer(spark, d):
    return E.show_answer(tracking_log(spark, d))


@query("E6_problem_events", sql("log", f"""SELECT course_id, user_id, {ts('time')}, event_source, split_part(module_id,'/',4) AS problem_url,
 event_type, attempts, success, grade FROM log WHERE event_type LIKE '%problem\\__%' ESCAPE '\\' OR event_type='showanswer'"""))
def problem_events(spark, d):
    return E.problem_events(tracking_log(spark, d))


@query("E7_ora_events", sql("log", f"""SELECT course_id, {ts('time')}, username, event_type, event_source, split_part(event_type,'.',2) AS action,
 uuid AS submission_uuid, CASE WHEN d=8 THEN CAST(k%4 AS VARCHAR) END AS part1_points, CASE WHEN d=8 THEN 'ok' END AS part1_feedback,
 CASE WHEN d=7 THEN '1' END AS attempt_num, CASE WHEN d=7 THEN 't' END AS answer_text, m0 AS module_id_sometimes, m AS module_id,
 split_part(m,'/',6) AS problem_id
 FROM (SELECT *, max(m0) OVER (PARTITION BY course_id, uuid) AS m FROM (SELECT *, CASE WHEN d=7 THEN 's'||user_id ELSE 's'||(user_id%40) END AS uuid,
  CASE WHEN d=7 THEN 'i4x://Org/C/openassessment/o'||(user_id%5) END AS m0 FROM log WHERE event_type LIKE 'openassessment%'))"""))
def ora_events(spark, d):
    return E.ora_events(tracking_log(spark, d)).drop("event")


@query("E8_forum_events", sql("log", f"""SELECT course_id, {ts('time')}, username, forum_action, thread_id, subject,
 CAST(NULL AS VARCHAR) AS target_user_id, CAST(NULL AS VARCHAR) AS search_query, CAST(NULL AS VARCHAR) AS event_GET FROM fev""", FEV))
def forum_events(spark, d):
    return E.forum_events(tracking_log(spark, d))


@query("E9_video_stats_day", sql("log", rounded("SELECT * FROM vday", "position"), VDAY))
def video_stats_day(spark, d):
    return E.video_stats_day(tracking_log(spark, d))


BOUND = """st AS (SELECT course_id, min(start_time) AS began FROM pc WHERE forumRoles_isStudent=1 OR forumRoles_isStudent IS NULL GROUP BY 1),
 du AS (SELECT course_id, max(due) AS ld, min(due) AS fd FROM axis GROUP BY 1),
 ce AS (SELECT course_id, max(CASE WHEN certified THEN last_event END) AS lc FROM pc GROUP BY 1),
 bd AS (SELECT course_id, greatest(ld,lc)+INTERVAL 7 DAY AS e, greatest(fd,began) AS s FROM du FULL JOIN ce USING (course_id) FULL JOIN st USING (course_id)),
 bound AS (SELECT course_id, CASE WHEN e IS NULL OR e < s+INTERVAL 7 DAY THEN s+INTERVAL 1 YEAR ELSE e END AS last FROM bd)"""


def bound_of(spark, d):
    """Activity bound of every course in the test tables."""
    pc = person_course(spark, d)
    return E.activity_upper_bound(course_axis(spark, d), uic_of(pc), stats_of(pc))


@query("E10_problem_check_show_answer_ip", sql("log pc axis", f"""SELECT course_id, {ts('time')}, username, user_id, module_id,
 CASE WHEN event_type LIKE '%check' THEN 'problem_check' ELSE 'show_answer' END AS event_type, ip FROM log JOIN bound USING (course_id)
 WHERE t IN ('click','purchase') AND (event_type LIKE '%check' OR event_type LIKE 'show%') AND event_source='server'
 AND time::DATE <= (last + INTERVAL 23 YEAR)::DATE""", BOUND))
def problem_ip(spark, d):
    # the log is dated long after the learner tables, so the bound is shifted with it
    later = bound_of(spark, d).withColumn("last", F.col("last") + F.expr("INTERVAL 23 YEARS"))
    return E.problem_ip(tracking_log(spark, d), later)


@query("E11_activity_upper_bound", sql("pc axis", f"SELECT course_id, {ts('last')} FROM bound", BOUND))
def upper_bound(spark, d):
    return bound_of(spark, d)


@query("E12_started_after", sql("pc axis", """SELECT course_id, max(x) >= TIMESTAMP '1998-01-01' AS started_after FROM (
 SELECT course_id, min(due) AS x FROM axis GROUP BY 1 UNION ALL SELECT course_id, began FROM st) GROUP BY 1""", BOUND))
def started_after(spark, d):
    return E.started_after(course_axis(spark, d), stats_of(person_course(spark, d)), "1998-01-01")


@query("E12_n_certified", sql("pc", "SELECT course_id, count(*) FILTER (certified) AS n_certified FROM pc GROUP BY 1"))
def n_certified(spark, d):
    return E.n_certified(person_course(spark, d))


_K = {"video": "regexp_matches(event_type,'\\w+_video') OR regexp_matches(event_type,'\\w+_transcript')",
      "problem": "regexp_matches(event_type,'problem_\\w+')",
      "forum": "starts_with(event_type,'edx.forum.') OR contains(event_type,'/discussion/forum') OR contains(event_type,'/discussion/threads')",
      "text": "starts_with(event_type,'textbook.') OR contains(event_type,'/wiki/')"}
_FLAGS = ", ".join(f"({x}) AS is_{k}" for k, x in _K.items())
_LAGS = ", ".join(f"CASE WHEN is_{k} THEN (epoch_us(time)-epoch_us(lag(time) OVER (PARTITION BY course_id, username, is_{k} ORDER BY time)))/1e6 END AS d_{k}" for k in _K)
_TOT = ", ".join(f"sum(d_{k}) FILTER (d_{k}<300) AS total_{k}_time_5, sum(d_{k}) FILTER (d_{k}<1800) AS total_{k}_time_30, "
                 f"sum(dx) FILTER (is_{k} AND dx<1800) AS serial_{k}_time_30" for k in _K)
TOT = f"""k0 AS (SELECT course_id, username, time, {_FLAGS} FROM log WHERE username<>'' AND NOT contains(event_type,'/xblock/')),
 k1 AS (SELECT *, is_video OR is_problem OR is_forum OR is_text AS is_x FROM k0),
 k2 AS (SELECT *, (epoch_us(time)-epoch_us(lag(time) OVER (PARTITION BY course_id, username ORDER BY time)))/1e6 AS dt, {_LAGS},
  CASE WHEN is_x THEN (epoch_us(time)-epoch_us(lag(time) OVER (PARTITION BY course_id, username, is_x ORDER BY time)))/1e6 END AS dx FROM k1),
 tot AS (SELECT course_id, username, strftime(time,'%Y-%m-%d') AS date, sum(dt) FILTER (dt<300) AS total_time_5,
  sum(dt) FILTER (dt<1800) AS total_time_30, {_TOT} FROM k2 WHERE dt IS NOT NULL GROUP BY 1,2,3)"""
TOT_COLS = ["total_time_5", "total_time_30", *[c for k in _K for c in (f"total_{k}_time_5", f"total_{k}_time_30", f"serial_{k}_time_30")]]


@query("E13_time_on_task", sql("log", rounded("SELECT * FROM tot", " ".join(TOT_COLS)), TOT))
def time_on_task(spark, d):
    return E.time_on_task(tracking_log(spark, d))


@query("E14_time_on_task_totals", sql("log", "SELECT course_id, username, " + ", ".join(f"round(sum({c}),6) AS {c}" for c in TOT_COLS)
                                      + " FROM tot GROUP BY 1,2", TOT))
def time_on_task_totals(spark, d):
    return E.time_on_task_totals(E.time_on_task(tracking_log(spark, d)))


TOA = """a0 AS (SELECT course_id, username, module_id, time, (epoch_us(time)-epoch_us(lag(time) OVER (PARTITION BY course_id, username, module_id ORDER BY time)))/1e6 AS dt
 FROM log WHERE username<>'' AND module_id IS NOT NULL),
 toa AS (SELECT course_id, username, module_id, strftime(time,'%Y-%m-%d') AS date, sum(dt) FILTER (dt<300) AS time_umid5,
 sum(dt) FILTER (dt<1800) AS time_umid30 FROM a0 GROUP BY 1,2,3,4)"""


@query("E15_time_on_asset_daily", sql("log", rounded("SELECT * FROM toa", "time_umid5 time_umid30"), TOA))
def time_on_asset(spark, d):
    return E.time_on_asset(tracking_log(spark, d))


@query("E16_time_on_asset_totals", sql("log pc", """SELECT course_id, module_id, count(DISTINCT username) AS n_unique_users,
 count(DISTINCT CASE WHEN certified THEN username END) AS n_unique_certified, round(avg(t5),6) AS mean_tmid5, round(avg(c5),6) AS cert_mean_tmid5,
 round(avg(t30),6) AS mean_tmid30, round(avg(c30),6) AS cert_mean_tmid30, round(sum(t5),6) AS total_tmid5, round(sum(c5),6) AS cert_total_tmid5,
 round(sum(t30),6) AS total_tmid30, round(sum(c30),6) AS cert_total_tmid30, round(quantile_disc(t5,0.5),6) AS median_tmid5,
 round(quantile_disc(c5,0.5),6) AS cert_median_tmid5, round(quantile_disc(t30,0.5),6) AS median_tmid30, round(quantile_disc(c30,0.5),6) AS cert_median_tmid30
 FROM (SELECT *, CASE WHEN certified THEN t5 END AS c5, CASE WHEN certified THEN t30 END AS c30 FROM (
  SELECT x.course_id, module_id, x.username, certified, sum(time_umid5) AS t5, sum(time_umid30) AS t30 FROM toa x
  JOIN pc ON x.course_id=pc.course_id AND x.username=pc.username WHERE time_umid5 IS NOT NULL AND nproblem_check>0 GROUP BY 1,2,3,4)) GROUP BY 1,2""", TOA))
def time_on_asset_totals(spark, d):
    return E.time_on_asset_totals(E.time_on_asset(tracking_log(spark, d)), person_course(spark, d))


@query("E17_last_event", sql("log", f"""SELECT course_id, username, {ts('last_event', 'max(time)')}, count(*) AS nevents FROM log
 WHERE username<>'' AND time::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1,2"""))
def last_event(spark, d):
    return E.last_event(tracking_log(spark, d), "2024-01-05", "2024-01-20")


@query("E18_missing_days", sql("log", """SELECT course_id, strftime(day,'%Y-%m-%d') AS date FROM (SELECT DISTINCT course_id FROM log),
 (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS day)
 WHERE (course_id, day::DATE) NOT IN (SELECT course_id, time::DATE FROM log)"""))
def missing_days(spark, d):
    return E.missing_days(tracking_log(spark, d), "2024-01-01", "2024-02-05")


@query("E19_count_log_events", sql("log", "SELECT course_id, count(*) AS n_events FROM log WHERE time::DATE<=DATE '2024-01-20' GROUP BY 1"))
def count_log_events(spark, d):
    return E.count_log_events(tracking_log(spark, d), "2024-01-20")


ENR = """enr AS (SELECT course_id, time, coalesce(es_user_id,user_id) AS user_id, es_user_id, mode, event_type LIKE '%.activated' AS activated,
 event_type LIKE '%.deactivated' AS deactivated, event_type LIKE '%.mode_changed' AS mode_changed, event_type LIKE '%.succeeded' AS upgraded, event_type
 FROM log WHERE t='signup')"""


@query("D3_enrollment_events", sql("log", f"SELECT * EXCLUDE (es_user_id) REPLACE ({ts('time')}) FROM enr", ENR))
def enrollment_events(spark, d):
    return E.enrollment_events(tracking_log(spark, d))


def _delta(m: str) -> str:
    return f"CASE WHEN activated AND mode='{m}' THEN 1 WHEN deactivated AND mode='{m}' THEN -1 ELSE 0 END"


@query("D4_enrollment_deltas", sql("log", f"""SELECT course_id, {ts('time')}, es_user_id AS user_id, {_delta('honor')} AS diff_enrollment_honor,
 CASE WHEN mode_changed AND mode='verified' THEN 1 WHEN mode_changed AND mode='honor' THEN -1 ELSE {_delta('verified')} END AS diff_enrollment_verified,
 {_delta('audit')} AS diff_enrollment_audit FROM enr WHERE NOT upgraded""", ENR))
def enrollment_deltas(spark, d):
    return E.enrollment_deltas(tracking_log(spark, d))


@query("D5_person_enrollment_verified", sql("log", f"""SELECT course_id, user_id, {ts('verified_enroll_time', 'min(time)')},
 CASE WHEN date_trunc('second',max(time))<>date_trunc('second',min(time)) THEN strftime(max(time),'%Y-%m-%d %H:%M:%S.%f') END AS verified_unenroll_time
 FROM enr WHERE mode='verified' AND (deactivated OR (NOT activated AND mode_changed)) GROUP BY 1,2""", ENR))
def enrollment_verified(spark, d):
    return E.enrollment_verified(E.enrollment_events(tracking_log(spark, d)))
