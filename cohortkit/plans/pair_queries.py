"""Registered queries over account pairs and account groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit.operators import groups as G, items as I, pairs as A
from cohortkit.plans.event_queries import ts
from cohortkit.plans.item_queries import AC, REV, attempts_of
from cohortkit.plans.registry import query
from cohortkit.session import stage
from cohortkit.sources import testdata as T
from cohortkit.sources.testdata import rounded, sql

c = F.col


def line_events(spark, d):
    """Line items as problem activity inside a few weeks."""
    li = T.load(spark, d, "lineitem").join(T.load(spark, d, "orders").select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey"))
    return activity_of(li)


def staged_line_events(spark, d):
    """The same rows from lines joined with their orders once, for queries that read them several times."""
    li = T.load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    li = li.join(T.load(spark, d, "orders").select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey"))
    return activity_of(stage(li, "lines"))


def activity_of(li):
    u = c("o_custkey")
    days = F.datediff("l_shipdate", F.lit("1995-01-01"))
    at = F.lit(946684800) + days * 600 + c("l_linenumber") * 7 + c("l_partkey") % 300 + c("l_orderkey") % 50
    return li.select(
        T._course(T._div(u, 30)).alias("course_id"), F.concat(F.lit("u"), u.cast("string")).alias("username"),
        F.concat(T._org(T._div(u, 30)), F.lit("/problem/p"), T._two(c("l_partkey") % 20)).alias("module_id"), at.alias("at"),
        F.concat(F.lit("10."), (u % 5).cast("string"), F.lit("."), (c("l_orderkey") % 2).cast("string")).alias("ip"),
        "l_linenumber", "l_quantity", "l_suppkey")


def checks_of(spark, d, events=None):
    return (line_events(spark, d) if events is None else events).select(
        "course_id", "username", "module_id", F.timestamp_seconds("at").alias("time"), c("l_linenumber").alias("attempts"),
        F.when(c("l_quantity") > 20, "correct").otherwise("incorrect").alias("success"), c("l_quantity").alias("grade"), "ip")


def reveals_of(spark, d, events=None):
    return (line_events(spark, d) if events is None else events).filter("l_linenumber >= 3").select(
        "course_id", "username", "module_id", F.timestamp_seconds(c("at") - c("l_suppkey") % 20 * 3600).alias("time"), "ip")


def ips_of(spark, d, events=None):
    k, s = checks_of(spark, d, events), reveals_of(spark, d, events)
    cols = ["course_id", "username", "module_id", "time", "ip"]
    return k.select(*cols, F.lit("problem_check").alias("event_type")).unionByName(s.select(*cols, F.lit("show_answer").alias("event_type")))


def people_of(spark, d):
    pc = T.person_course(spark, d)
    u = c("user_id")
    return pc.withColumn("latitude", (u % 180 - 90).cast("double")).withColumn("longitude", (u % 360 - 180).cast("double"))


def responses_of(spark, d):
    a = T.answers(spark, d)
    # part of the answers become free text and blanks
    text = F.when(c("attempts") == 2, F.concat(F.lit("v"), F.substring("response", 8, 1))).when(c("attempts") == 3, '""').otherwise(c("response"))
    return A.most_common_response(a.withColumn("response", text), T.course_axis(spark, d), T.person_course(spark, d))


def inputs(spark, d):
    events = staged_line_events(spark, d)
    return reveals_of(spark, d, events).drop("ip"), checks_of(spark, d, events).drop("ip"), ips_of(spark, d, events)


EV = """le AS (SELECT 'Org'||((o_custkey//30)%3)||'/C'||(o_custkey//30)||'/T1' AS course_id, 'u'||o_custkey AS username,
 'Org'||((o_custkey//30)%3)||'/C'||(o_custkey//30)||'/problem/p'||lpad(CAST(l_partkey%20 AS VARCHAR),2,'0') AS module_id,
 946684800+date_diff('day', TIMESTAMP '1995-01-01', l_shipdate)*600+l_linenumber*7+l_partkey%300+l_orderkey%50 AS tat, '10.'||(o_custkey%5)||'.'||(l_orderkey%2) AS ip,
 l_linenumber, l_quantity, l_suppkey FROM lineitem JOIN orders ON l_orderkey=o_orderkey),
 chk AS (SELECT course_id, username, module_id, tat AS t, l_linenumber AS attempts, l_quantity>20 AS ok, l_quantity AS grade, min(ip) OVER (PARTITION BY course_id, username, module_id, tat) AS ip FROM le),
 rv AS (SELECT course_id, username, module_id, tat-l_suppkey%20*3600 AS t, min(ip) AS ip FROM le WHERE l_linenumber>=3 GROUP BY 1,2,3,4)"""
RESP = """rsp0 AS (SELECT a.course_id, a.user_id, CASE attempts WHEN 2 THEN 'v'||response[8:8] WHEN 3 THEN '""' ELSE response END AS response, itype FROM ans a
 LEFT JOIN axis x ON a.course_id=x.course_id AND a.problem_url_name=x.url_name),
 rsp1 AS (SELECT course_id, user_id, response, CASE WHEN contains(response,'choice_') OR contains(response,'option_') OR itype IN ('multiplechoiceresponse','choiceresponse') THEN 'm' ELSE 'f' END AS kind FROM rsp0),
 rsp2 AS (SELECT course_id, user_id, kind, response, count(*) AS n FROM rsp1 GROUP BY 1,2,3,4),
 rsp3 AS (SELECT *, row_number() OVER (PARTITION BY course_id, user_id, kind ORDER BY n DESC, response) AS rn FROM rsp2),
 rsp AS (SELECT p.course_id, username, b AS CH_nblank_fr_submissions, f AS CH_most_common_free_response, nf AS CH_mcfr_cnt, nf/tf*100 AS CH_mcfr_percent_of_users_free_responses,
  m AS CH_most_common_multiple_choice_answer, nm AS CH_mcmc_cnt, nm/tm*100 AS CH_mcmc_percent_of_users_multiple_choice FROM (
  SELECT course_id, user_id, coalesce(sum(n) FILTER (response IN ('""','null')),0) AS b, max(response) FILTER (kind='f' AND rn=1) AS f, max(n) FILTER (kind='f' AND rn=1) AS nf,
  max(response) FILTER (kind='m' AND rn=1) AS m, max(n) FILTER (kind='m' AND rn=1) AS nm, sum(n) FILTER (kind='f') AS tf, sum(n) FILTER (kind='m') AS tm FROM rsp3 GROUP BY 1,2) q
  JOIN pc p ON q.course_id=p.course_id AND q.user_id=p.user_id)"""


@query("A10_most_common_response", sql("ans axis pc", rounded("SELECT * FROM rsp", "CH_mcfr_percent_of_users_free_responses CH_mcmc_percent_of_users_multiple_choice"), RESP))
def most_common_response(spark, d):
    return responses_of(spark, d)


SIM = """list_max(list_transform(range(0, length(s)), lambda i: 1.0::DOUBLE - levenshtein(s[i+1:]||s[1:i], l)/greatest(length(s), length(l))))"""


@query("A9_name_similarity", sql("pc", f"""SELECT user_id, course_id, {ts('start_time')}, round({SIM},6) AS similarity FROM (SELECT *,
 CASE WHEN length(a)<length(b) THEN a ELSE b END AS s, CASE WHEN length(a)<length(b) THEN b ELSE a END AS l FROM (SELECT *, lower(split_part(email,'.',1)) AS a, lower(countryLabel||username) AS b FROM pc))"""))
def name_similarity(spark, d):
    pc = T.person_course(spark, d)
    return pc.select("user_id", "course_id", "start_time",
                     A.name_similarity(F.substring_index("email", ".", 1), F.concat("countryLabel", "username")).alias("similarity"))


_HAS = "FILTER (st<tat)"
_Q = ", ".join(f"quantile_cont({v},{p}) {_HAS} AS {n}_p{round(p * 100):02d}" for n, v in (("sa_dt", "sg"), ("ca_dt", "ag"), ("dt_dt", "dd")) for p in (0.05, 0.5, 0.9, 0.95))
_X = ", ".join(f"count(*) FILTER (dt<={s}) AS x{n}, count(*) FILTER (dt<={s} AND same) AS x{n}_same_ip" for n, s in A.SPANS.items())


def _features(extra_where: str) -> str:
    """Pair features by brute force over every pair, from ``sh`` (sources) and ``ma`` (answers)."""
    return f"""n0 AS (SELECT m.course_id, m.username AS master_candidate, h.username AS harvester_candidate, m.module_id, m.t AS tat, m.ip AS a_ip, m.grade AS a_grade, ncorrect, nattempts, t0,
   coalesce(max(h.t) FILTER (h.t<m.t), min(h.t)) AS st FROM ma m JOIN sh h ON m.course_id=h.course_id AND m.module_id=h.module_id AND m.username<>h.username GROUP BY ALL),
  n1 AS (SELECT n0.*, h.ip AS s_ip, h.grade AS s_grade FROM n0 JOIN (SELECT DISTINCT * FROM sh) h ON n0.course_id=h.course_id AND n0.harvester_candidate=h.username AND n0.module_id=h.module_id AND n0.st=h.t
   QUALIFY row_number() OVER (PARTITION BY n0.course_id, master_candidate, harvester_candidate, n0.module_id ORDER BY h.ip DESC, h.grade DESC)=1),
  n2 AS (SELECT *, CASE WHEN st<tat THEN (tat-st)::DOUBLE END AS dt, a_ip=s_ip AS same FROM n1 {extra_where}),
  n3 AS (SELECT *, CASE WHEN st<tat THEN st-lag(st) OVER (pr ORDER BY st, module_id) END AS sg, CASE WHEN st<tat THEN tat-lag(tat) OVER (pr ORDER BY tat, module_id) END AS ag,
   CASE WHEN st<tat THEN abs(dt-lag(dt) OVER (pr ORDER BY tat, module_id)) END AS dd FROM n2 WINDOW pr AS (PARTITION BY course_id, master_candidate, harvester_candidate, st<tat)),
  f0 AS (SELECT course_id, master_candidate, harvester_candidate, count(*) AS prob_in_common, count(*) {_HAS} AS show_ans_before, count(*) FILTER (same) AS nsame_ip,
   count(*) FILTER (same AND st<tat) AS nsame_ip_given_sab, avg(dt) AS avg_max_dt_seconds, stddev_samp(dt) AS dt_std_dev, corr(st-t0, tat-t0) AS norm_pearson_corr, corr(st-1262304000, tat-1262304000) AS unnormalized_pearson_corr,
   sum((ag-sg)*(ag-sg)/nullif(ag,0)) AS sa_ca_dt_chi_squared, corr(sg,ag) AS sa_ca_dt_correlation, max(ncorrect) AS ncorrect, max(ncorrect)/max(nattempts)*100 AS percent_attempts_correct,
   quantile_cont(dt,0.25) AS q25, quantile_cont(dt,0.5) AS median_max_dt_seconds, quantile_cont(dt,0.75) AS percentile75_dt_seconds, quantile_cont(dt,0.9) AS percentile90_dt_seconds, {_Q}, {_X}
   FROM n3 GROUP BY 1,2,3),
  f1 AS (SELECT *, show_ans_before/prob_in_common*100 AS percent_show_ans_before, nsame_ip/prob_in_common*100 AS percent_same_ip, nsame_ip_given_sab/nullif(show_ans_before,0)*100 AS percent_same_ip_given_sab,
   CASE WHEN sa_dt_p90>0 AND ca_dt_p90>0 THEN 1-abs(ln(sa_dt_p90/ca_dt_p90)) END AS gap_ratio_p90, CASE WHEN length(master_candidate)<length(harvester_candidate) THEN master_candidate ELSE harvester_candidate END AS s,
   CASE WHEN length(master_candidate)<length(harvester_candidate) THEN harvester_candidate ELSE master_candidate END AS l FROM f0),
  f2 AS (SELECT *, {SIM} AS name_similarity FROM f1)"""


_ORD = """o0 AS (SELECT k.course_id, k.username AS mc, h.username AS hc, k.module_id, max(h.t) FILTER (h.t<k.lt) AS st FROM (SELECT course_id, username, module_id, max(t) AS lt FROM oc GROUP BY 1,2,3) k
   JOIN os h ON k.course_id=h.course_id AND k.module_id=h.module_id AND k.username<>h.username WHERE h.t<k.lt GROUP BY 1,2,3,4),
  o1 AS (SELECT o0.*, oc.t AS tat, count(*) OVER (PARTITION BY o0.course_id, mc, hc) AS n FROM o0 JOIN oc ON o0.course_id=oc.course_id AND o0.mc=oc.username AND o0.module_id=oc.module_id),
  o2 AS (SELECT *, st-lag(st) OVER (PARTITION BY course_id, mc, hc ORDER BY st, tat, module_id) AS sg, tat-lag(tat) OVER (PARTITION BY course_id, mc, hc ORDER BY tat, st, module_id) AS ag FROM o1 WHERE n>=10),
  o3 AS (SELECT *, row_number() OVER (PARTITION BY course_id, mc, hc ORDER BY sg NULLS FIRST) AS rs, row_number() OVER (PARTITION BY course_id, mc, hc ORDER BY ag NULLS FIRST) AS ra FROM o2),
  ord AS (SELECT x.course_id, x.mc AS master_candidate, x.hc AS harvester_candidate, corr(x.sg, y.ag) AS sa_ca_dt_corr_ordered, sum((y.ag-x.sg)*(y.ag-x.sg)/nullif(y.ag,0)) AS sa_ca_dt_chi_sq_ordered
   FROM o3 x JOIN o3 y ON x.course_id=y.course_id AND x.mc=y.mc AND x.hc=y.hc AND x.rs=y.ra GROUP BY 1,2,3)"""
_LIK = """(1+name_similarity)*(1+percent_same_ip)*(1.00001+coalesce(norm_pearson_corr,0))*(1+nsame_ip_given_sab)*(1+x10m)*(1+percent_same_ip_given_sab)*(1+x01h_same_ip)*(1+x05m_same_ip)*percent_show_ans_before
  *(1.00001+coalesce(sa_ca_dt_corr_ordered,0))*(1+coalesce(CH_mcfr_cnt,0))*(1+coalesce(CH_nblank_fr_submissions,0))*(1+coalesce(CH_mcfr_percent_of_users_free_responses,0))/nullif(dt_std_dev*dt_dt_p95*median_max_dt_seconds,0)"""
_RANK = " OR ".join(
    f"rank() OVER (PARTITION BY course_id, master_candidate ORDER BY {col} {'DESC NULLS LAST' if down else 'ASC NULLS FIRST'}{', harvester_candidate' if own else ''}) <= {top}"
    for col, down, own, top in A.RANKS)
_KEEP = f"""lk AS (SELECT f2.*, sa_ca_dt_corr_ordered, sa_ca_dt_chi_sq_ordered, CH_mcfr_cnt, CH_nblank_fr_submissions, CH_mcfr_percent_of_users_free_responses, {_LIK} AS cheating_likelihood
   FROM f2 LEFT JOIN ord USING (course_id, master_candidate, harvester_candidate) LEFT JOIN rsp ON f2.course_id=rsp.course_id AND f2.harvester_candidate=rsp.username WHERE {{having}}),
  kp AS (SELECT * FROM lk QUALIFY {_RANK})"""
A6_COLS = ["course_id", "master_candidate", "harvester_candidate", "prob_in_common", "show_ans_before", "percent_show_ans_before", "nsame_ip", "percent_same_ip", "percent_same_ip_given_sab",
           "avg_max_dt_seconds", "dt_std_dev", "norm_pearson_corr", "unnormalized_pearson_corr", "sa_ca_dt_correlation", "ncorrect", "percent_attempts_correct", "median_max_dt_seconds",
           "percentile75_dt_seconds", "percentile90_dt_seconds", "sa_dt_p50", "sa_dt_p90", "ca_dt_p50", "ca_dt_p90", "dt_dt_p05", "dt_dt_p95", "x05m", "x01h", "x01h_same_ip", "x01d", "x05d",
           "gap_ratio_p90", "name_similarity", "sa_ca_dt_corr_ordered", "CH_mcfr_cnt", "CH_nblank_fr_submissions"]
_R6 = {"avg_max_dt_seconds", "dt_std_dev", "norm_pearson_corr", "unnormalized_pearson_corr", "sa_ca_dt_correlation", "percent_attempts_correct", "percent_show_ans_before", "percent_same_ip",
       "percent_same_ip_given_sab", "median_max_dt_seconds", "percentile75_dt_seconds", "percentile90_dt_seconds", "sa_dt_p50", "sa_dt_p90", "ca_dt_p50", "ca_dt_p90", "dt_dt_p05", "dt_dt_p95",
       "gap_ratio_p90", "name_similarity", "sa_ca_dt_corr_ordered"}
_SEL = ", ".join(f"round({x},5) AS {x}" if x in _R6 else x for x in A6_COLS)
_T0 = "t0s AS (SELECT course_id, module_id, min(t) AS t0 FROM chk GROUP BY 1,2), nat AS (SELECT course_id, username, count(DISTINCT (module_id, attempts)) AS nattempts FROM chk GROUP BY 1,2)"
SAB = f"""{EV}, {RESP}, {_T0},
 sh AS (SELECT rv.*, NULL::DOUBLE AS grade FROM rv JOIN pc USING (course_id, username) WHERE NOT certified AND (course_id, username) IN (SELECT (course_id, username) FROM rv GROUP BY course_id, username HAVING count(DISTINCT module_id)>=10)),
 ma AS (SELECT q.course_id, q.username, q.module_id, q.t, q.ip, q.grade, q.n AS ncorrect, nattempts, t0 FROM (SELECT *, count(*) OVER (PARTITION BY course_id, username) AS n FROM (SELECT * FROM chk WHERE ok
   QUALIFY row_number() OVER (PARTITION BY course_id, username, module_id ORDER BY t, ip, grade)=1)) q JOIN pc USING (course_id, username) JOIN nat USING (course_id, username) JOIN t0s USING (course_id, module_id) WHERE certified AND n>=10),
 {_features('')}, os AS (SELECT course_id, username, module_id, t FROM le0), oc AS (SELECT course_id, username, module_id, t FROM chk WHERE ok), {_ORD},
 {_KEEP.format(having='show_ans_before>=10 AND median_max_dt_seconds<=604800')}""".replace("le0", "(SELECT course_id, username, module_id, tat-l_suppkey%20*3600 AS t FROM le WHERE l_linenumber>=3)")


def sab_pairs(spark, d, keep=True):
    sa, pk, ips = inputs(spark, d)
    return A.pair_show_ans_before(sa, pk, ips, people_of(spark, d), responses_of(spark, d).select(
        "course_id", "username", "CH_mcfr_cnt", "CH_nblank_fr_submissions", "CH_mcfr_percent_of_users_free_responses"), keep=keep)


@query("A6_show_ans_before", sql("ans axis pc", f"SELECT {_SEL} FROM kp", SAB), digits=5)
def pair_show_ans_before(spark, d):
    return sab_pairs(spark, d).select(*A6_COLS)


COUP = f"""{EV}, {RESP}, gr AS (SELECT course_id, module_id FROM axis WHERE graded='true'), {_T0.replace('FROM chk', 'FROM gc')},
 sh AS (SELECT DISTINCT gc.course_id, gc.username, gc.module_id, gc.t, gc.ip, gc.grade FROM gc JOIN pc USING (course_id, username) WHERE NOT certified),
 ma AS (SELECT q.course_id, q.username, q.module_id, q.t, q.ip, q.grade, q.n AS ncorrect, nattempts, t0 FROM (SELECT *, count(*) OVER (PARTITION BY course_id, username) AS n FROM (SELECT * FROM gc
   QUALIFY row_number() OVER (PARTITION BY course_id, username, module_id ORDER BY t DESC, ip DESC, grade DESC)=1)) q JOIN pc USING (course_id, username) JOIN nat USING (course_id, username) JOIN t0s USING (course_id, module_id) WHERE certified),
 {_features('WHERE a_grade>=s_grade')}, os AS (SELECT course_id, username, module_id, t FROM gc), oc AS (SELECT course_id, username, module_id, t FROM gc), {_ORD},
 {_KEEP.format(having='median_max_dt_seconds<=604800')}""".replace("gr AS (SELECT course_id, module_id FROM axis WHERE graded='true'),",
    "gc AS (SELECT chk.* FROM chk JOIN axis a ON chk.course_id=a.course_id AND chk.module_id=a.module_id AND a.graded='true'),")


@query("A7_answer_coupling", sql("ans axis pc", f"SELECT {_SEL} FROM kp", COUP), digits=5)
def pair_answer_coupling(spark, d):
    _, pk, ips = inputs(spark, d)
    rsp = responses_of(spark, d).select("course_id", "username", "CH_mcfr_cnt", "CH_nblank_fr_submissions", "CH_mcfr_percent_of_users_free_responses")
    return A.pair_answer_coupling(pk, ips, people_of(spark, d), T.course_axis(spark, d), rsp).select(*A6_COLS)


HIGH = f"""{EV}, ix AS (SELECT course_id, module_id, index FROM axis WHERE category='problem'),
 rd AS (SELECT course_id, username, index, min(t) AS st FROM rv JOIN ix USING (course_id, module_id) GROUP BY 1,2,3),
 dn AS (SELECT course_id, username, index, max(t) AS tat, min(t) AS fc FROM chk JOIN ix USING (course_id, module_id) JOIN pc USING (course_id, username) WHERE ok AND certified GROUP BY 1,2,3),
 rr AS (SELECT rd.* FROM rd JOIN pc USING (course_id, username) WHERE NOT certified AND (course_id, username) IN (SELECT (r.course_id, r.username) FROM rd r JOIN
   (SELECT course_id, count(DISTINCT module_id)*2/5 AS lim FROM rv GROUP BY 1) q ON r.course_id=q.course_id GROUP BY r.course_id, r.username, lim HAVING count(*)>lim)),
 pp AS (SELECT a.course_id, a.username AS master_candidate, b.username AS harvester_candidate, tat, st, t0 FROM dn a JOIN rr b ON a.course_id=b.course_id AND a.index=b.index AND a.username<>b.username
   JOIN (SELECT course_id, index, min(fc) AS t0 FROM dn GROUP BY 1,2) z ON a.course_id=z.course_id AND a.index=z.index),
 pz AS (SELECT course_id, master_candidate, harvester_candidate, round(quantile_cont((tat-st)::DOUBLE,0.5) FILTER (st<tat),3) AS med, count(*) FILTER (st<tat) AS sab, round(count(*) FILTER (st<tat)/count(*),4)*100 AS psa,
   count(*) AS common, round(avg(tat-st) FILTER (st<tat),3) AS mean, round(corr(st-t0,tat-t0),8) AS nc, round(corr(st-1262304000,tat-1262304000),8) AS uc FROM pp GROUP BY 1,2,3 HAVING count(*) FILTER (st<tat)>10),
 sc AS (SELECT *, coalesce((psa-avg(psa) OVER w)/nullif(stddev_samp(psa) OVER w,0),0)+coalesce(0.5*(sab-avg(sab) OVER w)/nullif(stddev_samp(sab) OVER w,0),0)+coalesce((nc-avg(nc) OVER w)/nullif(stddev_samp(nc) OVER w,0),0)
   -2*(med-avg(med) OVER w)/nullif(stddev_samp(med) OVER w,0) AS score0, round(score0,9) AS score FROM pz WINDOW w AS (PARTITION BY course_id, master_candidate)),
 best AS (SELECT course_id, master_candidate, harvester_candidate, psa AS percent_show_ans_before, mean AS avg_max_dt_seconds, med AS median_max_dt_seconds, nc AS norm_pearson_corr, uc AS unnormalized_pearson_corr,
   sab AS show_ans_before, common AS prob_in_common, score AS best_score FROM sc WHERE score IS NOT NULL QUALIFY rank() OVER (PARTITION BY course_id, master_candidate ORDER BY score DESC)=1)"""


@query("A5_show_ans_before_high_score", sql("axis pc", rounded("SELECT * FROM best", "percent_show_ans_before avg_max_dt_seconds median_max_dt_seconds norm_pearson_corr unnormalized_pearson_corr best_score", 3), HIGH), digits=3)
def pair_high_score(spark, d):
    sa, pk, _ = inputs(spark, d)
    return A.pair_high_score(sa, pk, T.course_axis(spark, d), people_of(spark, d))


@query("A8_problems_for_pairs", sql("pc", """SELECT course_id, master_candidate, harvester_candidate, module_id,
 strftime(make_timestamp(tat*1000000),'%Y-%m-%d %H:%M:%S.%f') AS answer_time, strftime(make_timestamp(st*1000000),'%Y-%m-%d %H:%M:%S.%f') AS reveal_time, a_ip, s_ip, a_ip=s_ip AS same_ip, (tat-st)::DOUBLE AS dt FROM (
 SELECT l.*, k.module_id, k.t AS tat, k.ip AS a_ip, max(h.t) AS st, arg_max(h.ip, h.t) AS s_ip FROM ls l JOIN (SELECT * FROM chk WHERE ok QUALIFY row_number() OVER (PARTITION BY course_id, username, module_id ORDER BY t, ip, grade)=1) k
  ON l.course_id=k.course_id AND l.master_candidate=k.username JOIN rv h ON l.course_id=h.course_id AND l.harvester_candidate=h.username AND h.module_id=k.module_id AND h.t<k.t GROUP BY ALL)""",
    f"{EV}, ls AS (SELECT course_id, username AS master_candidate, 'u'||(user_id+1) AS harvester_candidate FROM pc WHERE user_id%3=0)"))
def problems_for_pairs(spark, d):
    sa, pk, ips = inputs(spark, d)
    listed = T.person_course(spark, d).filter("user_id % 3 = 0").select(
        "course_id", c("username").alias("master_candidate"), F.concat(F.lit("u"), (c("user_id") + 1).cast("string")).alias("harvester_candidate"))
    return A.problems_for_pairs(sa, pk, ips, listed)


def edges_of(spark, d):
    """Addresses seen in the log and in the profiles."""
    return T.tracking_log(spark, d).select("username", "ip").union(T.person_course(spark, d).select("username", "ip")).distinct()


GRP = """ug AS (SELECT DISTINCT username, ip FROM log WHERE username<>'' UNION SELECT username, ip FROM pc),
 grps AS (SELECT username, ip, min(username) OVER (PARTITION BY (CAST(username[2:] AS BIGINT)%40, CAST(username[2:] AS BIGINT)//160)) AS grp FROM ug)"""


@query("G1_account_groups", sql("log pc", "SELECT * FROM grps", GRP))
def account_groups(spark, d):
    return G.account_groups(edges_of(spark, d))


# accounts of one course seldom share an address, so the checks pair them by remainder
def shared_ip(spark, d):
    pc = T.person_course(spark, d)
    return pc.withColumn("ip", F.concat(F.lit("10.9."), (c("user_id") % 9).cast("string")))


def loose_ac(spark, d):
    return attempts_of(spark, d).withColumn("nshow_answer_unique_problems", c("nattempts") - 20)


LAC = "lac AS (SELECT * REPLACE (nattempts-20 AS nshow_answer_unique_problems, round(percent_correct,2) AS percent_correct) FROM ac)"


def _groups_sql(key: str, base: str) -> str:
    return f"""{LAC}, g0 AS ({base}), g1 AS (SELECT * FROM g0 WINDOW w AS (PARTITION BY course_id, {key}) QUALIFY count(*) FILTER (certified) OVER w>0 AND count(*) FILTER (NOT certified) OVER w>0 AND count(DISTINCT username) OVER w<8),
    g2 AS (SELECT * FROM g1 WHERE certified OR NOT (percent_correct>70 OR nshow_answer_unique_problems<=10 OR frac_complete=0)),
    g3 AS (SELECT * FROM g2 WINDOW w AS (PARTITION BY course_id, {key}) QUALIFY count(*) FILTER (certified) OVER w>0 AND count(*) FILTER (NOT certified) OVER w>0)"""


_PERSON = "p.course_id, p.user_id, p.username, '10.9.'||(p.user_id%9) AS ip, p.certified, a.nshow_answer_unique_problems, a.percent_correct, a.frac_complete"


@query("A1_ip_pair_groups", sql("pa pc", rounded("SELECT * FROM g3", "percent_correct frac_complete"), f"{REV}, {AC}, " + _groups_sql(
    "ip", f"SELECT {_PERSON} FROM pc p JOIN lac a ON p.course_id=a.course_id AND p.user_id=a.user_id")))
def ip_groups_v1(spark, d):
    return G.ip_groups_v1(shared_ip(spark, d), loose_ac(spark, d))


def ip_to_group(spark, d):
    """Groups over the shared addresses: user n also uses address n mod 9 plus 3 when n is a multiple of 9."""
    pc = shared_ip(spark, d)
    return G.account_groups(pc.select("username", F.concat("course_id", F.lit("|"), "ip").alias("ip")).distinct())


@query("A2_ip_pair_groups_v2", sql("pa pc", rounded("SELECT * FROM g3", "percent_correct frac_complete"), f"{REV}, {AC}, " + _groups_sql(
    "grp", "SELECT p.course_id, p.user_id, p.username, p.course_id||'|10.9.'||(p.user_id%9) AS ip, p.certified, gg.grp, a.nshow_answer_unique_problems, a.percent_correct, a.frac_complete "
           "FROM pc p JOIN lac a ON p.course_id=a.course_id AND p.user_id=a.user_id JOIN gg ON gg.username=p.username").replace(
    "g0 AS", """gg AS (SELECT username, min(root) AS grp FROM (SELECT u.username, v.username AS root FROM comp u JOIN comp v ON u.cmp=v.cmp) GROUP BY 1), g0 AS""").replace(
    "lac AS", "comp AS (SELECT DISTINCT username, user_id%9 AS cmp FROM pc), lac AS", 1)))
def ip_groups_v2(spark, d):
    pc = shared_ip(spark, d).withColumn("ip", F.concat("course_id", F.lit("|"), "ip"))
    return G.ip_groups_v2(pc, loose_ac(spark, d), ip_to_group(spark, d))


def group_table(spark, d):
    """Account groups of at most a few users per course: nine neighbours each."""
    pc = T.person_course(spark, d)
    return pc.select("username", "ip", F.floor(c("user_id") / 9).cast("string").alias("grp")).distinct()


_V3 = """gt AS (SELECT DISTINCT username, ip, CAST(user_id//9 AS VARCHAR) AS grp FROM pc),
 pe AS (SELECT p.course_id, p.user_id, p.username, p.ip, p.certified, mode='verified' AS verified, sum_dt/86400.0 AS time_active_in_days, countryLabel, start_time, last_event, nforum_posts, nprogcheck, nplay_video, grade, grp
  FROM pc p JOIN gt ON p.username=gt.username AND p.ip=gt.ip),
 ins AS (SELECT k.course_id, k.master_candidate, k.harvester_candidate, m.grp, k.show_ans_before, k.prob_in_common, k.percent_show_ans_before, k.median_max_dt_seconds/{div} AS median_max_dt_seconds, k.norm_pearson_corr FROM lk k
  JOIN (SELECT DISTINCT course_id, username, grp FROM pe) m ON k.course_id=m.course_id AND k.master_candidate=m.username JOIN (SELECT DISTINCT course_id, username, grp FROM pe) h ON k.course_id=h.course_id AND k.harvester_candidate=h.username AND m.grp=h.grp WHERE {ev}),
 rw AS (SELECT pe.*, i.harvester_candidate AS shadow, show_ans_before, prob_in_common, percent_show_ans_before, median_max_dt_seconds, norm_pearson_corr FROM pe JOIN ins i ON pe.course_id=i.course_id AND pe.grp=i.grp AND pe.username=i.master_candidate WHERE certified
  UNION ALL BY NAME SELECT * FROM pe WHERE NOT certified AND (course_id, grp, username) IN (SELECT (course_id, grp, harvester_candidate) FROM ins)),
 ra AS (SELECT rw.*, a.nshow_answer_unique_problems, round(a.percent_correct,2) AS percent_correct, a.frac_complete FROM rw JOIN ac a ON rw.course_id=a.course_id AND rw.user_id=a.user_id {cut}),
 rb AS (SELECT * FROM ra WINDOW w AS (PARTITION BY course_id, grp) QUALIFY {size} count(*) FILTER (certified) OVER w>0 AND count(*) FILTER (NOT certified) OVER w>0)"""
V3_COLS = ["course_id", "user_id", "username", "grp", "certified", "verified", "shadow", "show_ans_before", "prob_in_common", "percent_show_ans_before", "median_max_dt_seconds",
           "norm_pearson_corr", "percent_correct", "frac_complete", "time_active_in_days", "nforum_posts", "countryLabel"]
_V3R = "percent_show_ans_before median_max_dt_seconds norm_pearson_corr percent_correct frac_complete time_active_in_days"


@query("A3_ip_pair_groups_v3", sql("ans axis pc pa", rounded(f"SELECT {', '.join(V3_COLS)} FROM rb", _V3R, 5), f"{SAB}, {REV}, {AC}, " + _V3.format(
    ev="percent_show_ans_before>=20 AND k.median_max_dt_seconds/20<5e4 AND norm_pearson_corr>0", div="20.0::DOUBLE", cut="WHERE rw.certified OR a.percent_correct<70", size="count(DISTINCT username) OVER w<10 AND")), digits=5)
def ip_groups_v3(spark, d):
    # delays of the test rows are spread over weeks, so they are shortened to come under the limit
    pairs = sab_pairs(spark, d, keep=False).withColumn("median_max_dt_seconds", c("median_max_dt_seconds") / 20.0)
    return G.ip_groups_v3(T.person_course(spark, d), pairs, attempts_of(spark, d), group_table(spark, d)).select(*V3_COLS)


@query("A4_ip_pair_groups_v3_unfiltered", sql("ans axis pc pa", rounded(f"SELECT {', '.join(V3_COLS)}, show_ans_before/prob_in_common AS frac_show_ans_before, grade/mg AS frac_certified, "
    "count(DISTINCT username) OVER (PARTITION BY course_id, grp) AS ipcnt FROM rb JOIN (SELECT course_id, min(grade) FILTER (certified) AS mg FROM pc GROUP BY 1) USING (course_id)",
    _V3R + " frac_show_ans_before frac_certified", 5), f"{SAB}, {REV}, {AC}, " + _V3.format(ev="true", div="1", cut="", size="")), digits=5)
def ip_groups_v3_unfiltered(spark, d):
    pc = T.person_course(spark, d)
    info = pc.groupBy("course_id").agg(F.min(F.when(c("certified"), c("grade"))).alias("min_certifying_grade"))
    out = G.ip_groups_v3_unfiltered(pc, sab_pairs(spark, d, keep=False), attempts_of(spark, d), group_table(spark, d), info)
    return out.select(*V3_COLS, "frac_show_ans_before", "frac_certified", "ipcnt")


_GR = {"certified_cameo": "h AND certified", "certified_non_cameo": "NOT h AND certified", "non_certified_cameo_harvester": "h AND NOT certified", "non_certified_participant_non_harvester": "NOT h AND NOT certified"}
_TS = {"n": "true", "n_male": "gender='m'", "n_female": "gender='f'", "n_bachplus": "LoE IN ('b','m','p')", "n_sub_bachplus": "LoE='hs'", "n_in_US": "cc_by_ip='US'", "n_not_in_US": "cc_by_ip<>'US'", "n_id_verified": "mode='verified'"}


@query("A11_cohort_demographics", sql("pc", "SELECT course_id, " + ", ".join(f"count(*) FILTER ({g} AND {t}) AS {n}_{k}" for k, g in _GR.items() for n, t in _TS.items()) + ", "
    + ", ".join(f"quantile_disc(2015-YoB,0.5) FILTER ({g})::DOUBLE AS median_age_in_2015_{k}" for k, g in _GR.items())
    + ", count(*) FILTER (certified) AS n_certified, count(*) AS n_participants, count(*) FILTER (NOT certified) AS n_non_certified_participants FROM (SELECT *, user_id%4=1 AS h FROM pc WHERE viewed) GROUP BY 1"))
def cohort_demographics(spark, d):
    pc = T.person_course(spark, d)
    return A.cohort_demographics(pc, pc.filter("user_id % 4 = 1").select("username"))


FP = f"""fa AS (SELECT q.*, user_id, avg(ft) OVER (PARTITION BY course_id, index) AS m FROM (SELECT course_id, username, index, min(t) AS ft, max(t) AS lt FROM chk JOIN axis USING (course_id, module_id) WHERE ok GROUP BY 1,2,3) q
  JOIN pc USING (course_id, username) WHERE certified),
 fb AS (SELECT course_id, username, index, min(t) AS t, any_value(user_id) AS user_id, any_value(certified) AS certified FROM rv JOIN axis USING (course_id, module_id) JOIN pc USING (course_id, username) WHERE nshow_answer*4>10 GROUP BY 1,2,3)"""


def busy_pc(spark, d):
    pc = T.person_course(spark, d)
    return pc.withColumn("nshow_answer", c("nshow_answer") * 4)


@query("A12_problem_check_fingerprint", sql("axis pc", """SELECT course_id, username, user_id, index, strftime(make_timestamp(ft*1000000),'%Y-%m-%d %H:%M:%S.%f') AS time_of_first_check,
 strftime(make_timestamp(lt*1000000),'%Y-%m-%d %H:%M:%S.%f') AS time_of_last_check, round(m,3) AS avg_first_check_s, round((ft-m)/3600,7) AS delta_t_hours FROM fa""", f"{EV}, {FP}"), digits=7)
def fp_problem_check(spark, d):
    out = A.fp_problem_check(checks_of(spark, d), T.course_axis(spark, d), busy_pc(spark, d))
    return out.withColumn("avg_first_check_s", F.round("avg_first_check_s", 3))


@query("A13_show_answer_fingerprint", sql("axis pc", "SELECT course_id, username, user_id, certified, index, strftime(make_timestamp(t*1000000),'%Y-%m-%d %H:%M:%S.%f') AS time FROM fb", f"{EV}, {FP}"))
def fp_show_answer(spark, d):
    return A.fp_show_answer(reveals_of(spark, d), T.course_axis(spark, d), busy_pc(spark, d))


@query("A14_fingerprint_correlations", sql("axis pc pa", rounded("""SELECT q.course_id, master_candidate, harvester_candidate, CAMEO_uid, shadow_uid, r AS fpt_pearson_corr, n AS n_show_answer_times,
 dt AS avg_dt_show_answer_to_problem_check_in_min, percent_correct AS CAMEO_percent_correct, frac_complete AS CAMEO_frac_complete FROM (
 SELECT fa.course_id, fa.username AS master_candidate, fb.username AS harvester_candidate, fa.user_id AS CAMEO_uid, fb.user_id AS shadow_uid, corr((ft-m)/3600, t-m) AS r, count(*) AS n, avg(ft-t)/60 AS dt
 FROM fa JOIN fb ON fa.course_id=fb.course_id AND fa.index=fb.index WHERE NOT fb.certified AND fa.user_id<>fb.user_id AND t<ft GROUP BY 1,2,3,4,5) q JOIN ac ON q.course_id=ac.course_id AND q.CAMEO_uid=ac.user_id WHERE n>6 AND r>0.5""",
    "fpt_pearson_corr avg_dt_show_answer_to_problem_check_in_min CAMEO_percent_correct CAMEO_frac_complete", 5), f"{EV}, {FP}, {REV}, {AC}"), digits=5)
def fp_correlations(spark, d):
    ax, pc = T.course_axis(spark, d), busy_pc(spark, d)
    events = staged_line_events(spark, d)
    return A.fp_correlations(A.fp_problem_check(checks_of(spark, d, events), ax, pc), A.fp_show_answer(reveals_of(spark, d, events), ax, pc), attempts_of(spark, d), 6, 0.5)


@query("A15_flag_history", sql("pc", """SELECT username, n_flagged, partner, n_flagged_pair FROM (SELECT username, count(DISTINCT course_id) AS n_flagged FROM pc GROUP BY 1)
 JOIN (SELECT username, 'u'||(user_id//2) AS partner, count(DISTINCT course_id) AS n_flagged_pair FROM pc GROUP BY 1,2) USING (username)"""))
def flag_history(spark, d):
    flags = T.person_course(spark, d).select("username", "course_id", F.concat(F.lit("u"), F.floor(c("user_id") / 2).cast("string")).alias("partner"))
    by_user, by_pair = A.flag_history(flags)
    return by_user.join(by_pair, "username", "inner")
