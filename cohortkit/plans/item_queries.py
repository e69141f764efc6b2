"""Registered queries over problems and items."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortkit.operators import items as I
from cohortkit.plans.event_queries import ts
from cohortkit.plans.people_queries import STU
from cohortkit.plans.registry import query
from cohortkit.session import stage
from cohortkit.sources import testdata as T
from cohortkit.sources.testdata import rounded, sql

c = F.col


def student_modules(spark, d):
    """Problem state records with their JSON state, built from the answers."""
    a = T.answers(spark, d)
    org = F.array_join(F.slice(F.split("course_id", "/"), 1, 2), "/")
    entry = F.struct(F.when(c("correct_bool"), "correct").otherwise("incorrect").alias("correctness"), "npoints",
                     F.lit("").alias("msg"), F.lit("").alias("hint"))
    g = a.groupBy("course_id", "user_id", "problem_url_name").agg(
        F.map_from_entries(F.collect_list(F.struct(c("answer_id"), entry.alias("e")))).alias("correct_map"),
        F.map_from_entries(F.collect_list(F.struct("answer_id", "response"))).alias("student_answers"),
        F.max("attempts").alias("attempts"), F.sum("npoints").alias("g"), F.max("created").alias("created"))
    state = F.to_json(F.struct("correct_map", "student_answers", "attempts", F.lit(True).alias("done")))
    return g.select(
        "course_id", c("user_id").alias("student_id"), F.lit("problem").alias("module_type"),
        F.concat(F.lit("i4x://"), org, F.lit("/problem/"), "problem_url_name").alias("module_id"), state.alias("state"),
        F.when(c("user_id") % 7 == 0, "NULL").otherwise(c("g").cast("string")).alias("grade"), F.lit("3.0").alias("max_grade"), "created")


@query("Q1_problem_analysis", sql("ans", f"""SELECT a.course_id, a.user_id, a.problem_url_name, answer_id, '"'||response||'"' AS response,
 CASE WHEN correct_bool THEN 'correct' ELSE 'incorrect' END AS correctness, correct_bool, npoints, m AS attempts,
 CASE WHEN a.user_id%7<>0 THEN g END AS grade, 3.0::DOUBLE AS max_grade, {ts('created', 'cr')} FROM ans a JOIN (SELECT course_id, user_id, problem_url_name, max(attempts) AS m,
 sum(npoints) AS g, max(created) AS cr FROM ans GROUP BY 1,2,3) b USING (course_id, user_id, problem_url_name)"""))
def problem_analysis(spark, d):
    return I.items_of(I.problem_analysis(student_modules(spark, d))).drop("msg", "hint")


PG = """pg AS (SELECT course_id, user_id, 'i4x://'||split_part(course_id,'/',1)||'/'||split_part(course_id,'/',2)||'/problem/'||problem_url_name AS module_id,
 CASE WHEN user_id%7<>0 THEN grade END AS grade, max_grade, coalesce(user_id%7<>0 AND grade>=max_grade, false) AS perfect, user_id%7<>0 AS attempted FROM pa)"""


def grades_of(spark, d):
    return I.problem_grades(student_modules(spark, d))


@query("Q2_problem_grades", sql("pa", "SELECT * FROM pg", PG))
def problem_grades(spark, d):
    return grades_of(spark, d)


CG = """cg0 AS (SELECT pg.course_id, user_id, chapter_mid, sum(max_grade) AS user_chapter_max_grade, sum(grade) AS chgrade, max(due) AS due_date_max, min(due) AS due_date_min
 FROM pg JOIN axis a ON pg.course_id=a.course_id AND pg.module_id='i4x://'||a.module_id WHERE grade IS NOT NULL GROUP BY 1,2,3)"""


@query("Q3_chapter_grades", sql("pa axis", f"""SELECT * REPLACE ({ts('due_date_max')}, {ts('due_date_min')}) FROM cg0 JOIN
 (SELECT course_id, chapter_mid, quantile_disc(chgrade,0.5) AS median_grade, max(user_chapter_max_grade) AS chmax FROM cg0 GROUP BY 1,2) USING (course_id, chapter_mid)""", f"{PG}, {CG}"))
def chapter_grades(spark, d):
    return I.chapter_grades(grades_of(spark, d), T.course_axis(spark, d))


def reveals(spark, d):
    """Answer reveals of customers: every third answered item."""
    a = T.answers(spark, d).filter(c("attempts") + F.substring("problem_url_name", 2, 2).cast("long") > 4)
    org = F.array_join(F.slice(F.split("course_id", "/"), 1, 2), "/")
    return a.filter((c("user_id") + F.substring("answer_id", 2, 2).cast("long")) % 3 == 0).select(
        "course_id", c("created").alias("time"), F.concat(F.lit("u"), c("user_id").cast("string")).alias("username"),
        F.concat(org, F.lit("/problem/"), "problem_url_name").alias("module_id"))


REV = """rev AS (SELECT course_id, created AS time, user_id, 'u'||user_id AS username,
 split_part(course_id,'/',1)||'/'||split_part(course_id,'/',2)||'/problem/'||problem_url_name AS module_id FROM ans
 WHERE attempts+CAST(problem_url_name[2:] AS BIGINT)>4 AND (user_id+CAST(problem_url_name[2:] AS BIGINT))%3=0)"""
_CASES = {"problem_seen": "true", "not_attempted": "NOT attempted", "attempted": "attempted", "perfect": "perfect", "partial": "grade>0"}
_SAN = {n: "n_problems_seen" if n == "problem_seen" else f"n_{n}" for n in _CASES}
SABU = f"""sab AS (SELECT *, {', '.join(f'n_show_answer_{n}/nullif({t},0)*100 AS pct_show_answer_{n}' for n, t in _SAN.items())} FROM (
 SELECT pg.course_id, pg.user_id, {', '.join(f'count(*) FILTER (({x}) AND s.n>0) AS n_show_answer_{n}, count(*) FILTER ({x}) AS {_SAN[n]}' for n, x in _CASES.items())}
 FROM pg LEFT JOIN (SELECT course_id, user_id, 'i4x://'||module_id AS module_id, count(*) AS n FROM rev GROUP BY 1,2,3) s USING (course_id, user_id, module_id) GROUP BY 1,2)
 JOIN (SELECT course_id, user_id, explored, certified, mode='verified' AS verified FROM pc {STU}) USING (course_id, user_id))"""


def by_user(spark, d):
    return I.sa_stats_by_user(grades_of(spark, d), reveals(spark, d), T.person_course(spark, d))


@query("Q4_show_answer_stats_by_user", sql("pa pc", rounded("SELECT * FROM sab", " ".join(f"pct_show_answer_{n}" for n in _CASES)), f"{PG}, {REV}, {SABU}"))
def sa_stats_by_user(spark, d):
    return by_user(spark, d)


_SAC = ", ".join(f"round({fn} FILTER ({k or 'true'}),6) AS {p}_pct_show_answer_{n}{'_' + k if k else ''}" for k in ("", "certified", "explored", "verified")
                 for n in _CASES for p, fn in (("avg", f"avg(pct_show_answer_{n})"), ("median", f"quantile_disc(pct_show_answer_{n},0.5)")))


@query("Q5_show_answer_stats_by_course", sql("pa pc", f"SELECT course_id, {_SAC} FROM sab GROUP BY 1", f"{PG}, {REV}, {SABU}"))
def sa_stats_by_course(spark, d):
    return I.sa_stats_by_course(by_user(spark, d))


AC = """ac0 AS (SELECT a.course_id, a.user_id, certified, explored, count(*) FILTER (correct_bool)/count(correct_bool)*100.0 AS percent_correct, count(correct_bool) AS nattempts,
 coalesce(max(s.n),0) AS nshow_answer_unique_problems, count(DISTINCT problem_url_name) AS nproblems FROM ans a JOIN pc ON a.course_id=pc.course_id AND a.user_id=pc.user_id
 LEFT JOIN (SELECT course_id, username, count(DISTINCT module_id) AS n FROM rev GROUP BY 1,2) s ON s.course_id=pc.course_id AND s.username=pc.username WHERE viewed GROUP BY 1,2,3,4),
 ac AS (SELECT *, max(nproblems) OVER (PARTITION BY course_id) AS total_problems, nproblems/max(nproblems) OVER (PARTITION BY course_id) AS frac_complete FROM ac0)"""


def attempts_of(spark, d):
    return I.attempts_correct(T.problem_analysis(spark, d), T.person_course(spark, d), reveals(spark, d))


@query("Q6_stats_attempts_correct", sql("pa pc", rounded("SELECT * FROM ac", "percent_correct frac_complete"), f"{REV}, {AC}"))
def attempts_correct(spark, d):
    return attempts_of(spark, d)


def policy_rows(spark, d):
    """Weights of the three assignment types in every course."""
    return T.course_axis(spark, d).select("course_id").distinct().select("course_id", F.inline(F.array(*[
        F.struct(F.lit(t).alias("assignment_type"), F.lit(w).alias("fraction_of_overall_grade"), F.lit(s).alias("short_label"))
        for t, w, s in (("Homework", 0.5, "HW"), ("Lab", 0.2, "Lab"), ("Exam", 0.3, "EX"))])))


CI = """it AS (SELECT course_id, answer_id AS item_id, problem_url_name AS problem_id, count(*) AS n FROM ans GROUP BY 1,2,3 HAVING count(*)>5),
 it1 AS (SELECT *, row_number() OVER (PARTITION BY course_id, problem_id ORDER BY item_id) AS item_number, count(*) OVER (PARTITION BY course_id, problem_id) AS n_items FROM it),
 chp AS (SELECT course_id, url_name AS ch, name AS chapter_name, row_number() OVER (PARTITION BY course_id ORDER BY index) AS chapter_number FROM axis WHERE category='chapter'),
 sec AS (SELECT a.course_id, a.url_name AS sq, a.name AS section_name, chapter_name, chapter_number, row_number() OVER (PARTITION BY a.course_id, a.parent ORDER BY index) AS section_number
  FROM axis a JOIN chp ON a.course_id=chp.course_id AND a.parent=chp.ch WHERE category='sequential'),
 p0 AS (SELECT a.*, sec.section_name, sec.chapter_name, sec.chapter_number, sec.section_number, gformat||'_ch'||chapter_number||'_sec'||section_number AS assignment_id
  FROM axis a JOIN sec ON a.course_id=sec.course_id AND a.parent=sec.sq WHERE category='problem' AND gformat IS NOT NULL),
 p1 AS (SELECT *, row_number() OVER (PARTITION BY course_id, assignment_id ORDER BY index) AS pn FROM p0),
 asg AS (SELECT course_id, assignment_id, row_number() OVER (PARTITION BY course_id, gformat ORDER BY index) AS seq, count(*) OVER (PARTITION BY course_id, gformat) AS nat FROM p1 WHERE pn=1),
 c0 AS (SELECT it1.*, p1.* EXCLUDE (course_id), seq, nat FROM it1 JOIN p1 ON it1.course_id=p1.course_id AND it1.problem_id=p1.url_name JOIN asg ON p1.course_id=asg.course_id AND p1.assignment_id=asg.assignment_id),
 c1 AS (SELECT *, dense_rank() OVER (PARTITION BY course_id ORDER BY index) AS problem_nid, sum(CASE WHEN item_number=1 THEN weight ELSE 0 END) OVER (PARTITION BY course_id, assignment_id) AS sw,
  count(*) FILTER (item_number=1) OVER (PARTITION BY course_id, assignment_id) AS npa,
  CASE gformat WHEN 'Homework' THEN 0.5::DOUBLE WHEN 'Lab' THEN 0.2::DOUBLE ELSE 0.3::DOUBLE END AS fr,
  CASE gformat WHEN 'Homework' THEN 'HW' WHEN 'Lab' THEN 'Lab' ELSE 'EX' END AS lab, row_number() OVER (PARTITION BY course_id ORDER BY index, item_number) AS item_nid FROM c0),
 ci AS (SELECT *, weight*fr/n_items/sw/nat AS item_weight, lab||'_'||seq||'__'||pn AS problem_short_id FROM c1)"""


def course_items(spark, d):
    return I.course_item(T.problem_analysis(spark, d), T.course_axis(spark, d), policy_rows(spark, d))


@query("Q7_course_item", sql("ans axis", f"""SELECT course_id, item_id, problem_id, problem_nid, problem_short_id, problem_short_id||'_'||item_number AS item_short_id, round(item_weight,9) AS item_weight,
 n AS n_user_responses, chapter_name, section_name, name AS problem_name, assignment_id, npa AS n_problems_in_assignment, gformat AS assignment_type, fr AS assignment_type_weight,
 nat AS n_assignments_of_type, seq AS assignment_seq_num, chapter_number, index AS content_index, section_number, pn AS problem_number, weight AS problem_weight, item_number, n_items,
 {ts('due_date', 'due')}, item_nid, round(sum(item_weight) OVER (PARTITION BY course_id ORDER BY index, item_number),9) AS cumulative_item_weight FROM ci""", CI), digits=9)
def course_item(spark, d):
    return course_items(spark, d).drop(
        "assignment_short_id", "vertical_name", "item_points_possible", "problem_points_possible", "emperical_item_points_possible",
        "emperical_problem_points_possible", "start_date", "problem_path")


PI = """pi AS (SELECT a.course_id, a.user_id, CASE WHEN correct_bool THEN 1 ELSE 0 END AS item_grade, b.grade, b.attempts AS n_attempts, b.created AS date,
  ci.problem_short_id||'_'||ci.item_number AS item_short_id, ci.item_nid, ci.problem_nid, ci.problem_id, ci.problem_short_id, ci.name AS problem_name
 FROM ans a JOIN pa b USING (course_id, user_id, problem_url_name) JOIN ci ON a.course_id=ci.course_id AND a.answer_id=ci.item_id),
 pp AS (SELECT course_id, user_id, problem_nid, sum(item_grade) AS problem_raw_score, sum(item_grade)/count(*)*100 AS problem_pct_score, max(grade) AS grade, max(n_attempts) AS n_attempts, max(date) AS date FROM pi GROUP BY 1,2,3),
 cp AS (SELECT course_id, problem_nid, problem_id, problem_short_id, problem_name, avg(g) AS avg_problem_raw_score, stddev_samp(g) AS sdv_problem_raw_score, max(p)::DOUBLE AS max_possible_raw_score,
  avg(g/p*100) AS avg_problem_pct_score, count(*) AS n_unique_users_attempted FROM (SELECT course_id, user_id, problem_nid, problem_id, problem_short_id, problem_name, sum(item_grade) AS g, count(*) AS p
  FROM pi GROUP BY 1,2,3,4,5,6) GROUP BY 1,2,3,4,5)"""


def person_items(spark, d):
    """Grades per learner and item, and the items; records and items are computed once and read by every later step."""
    pa = stage(T.problem_analysis(spark, d), "problem-analysis")
    ci = stage(I.course_item(pa, T.course_axis(spark, d), policy_rows(spark, d)), "course-items")
    return I.person_item(pa, ci), ci


@query("Q8_person_item", sql("ans pa axis", f"SELECT course_id, user_id, item_grade, grade, n_attempts, {ts('date')}, item_short_id, item_nid FROM pi", f"{CI}, {PI}"))
def person_item(spark, d):
    return person_items(spark, d)[0]


def person_problems(spark, d):
    return I.person_problem(*person_items(spark, d))


@query("Q9_person_problem", sql("ans pa axis", f"SELECT * REPLACE (round(problem_pct_score,6) AS problem_pct_score, {ts('date')}) FROM pp", f"{CI}, {PI}"))
def person_problem(spark, d):
    return person_problems(spark, d)


@query("Q10_course_problem", sql("ans pa axis", rounded("SELECT * FROM cp", "avg_problem_raw_score sdv_problem_raw_score avg_problem_pct_score"), f"{CI}, {PI}"))
def course_problem(spark, d):
    return I.course_problem(*person_items(spark, d))


@query("Q11_problem_first_attempt_correct", sql("ans pa axis pc", "SELECT pp.course_id, problem_nid, " + ", ".join(
    f"count(*) FILTER ({k} AND n_attempts=1 AND problem_pct_score=100) AS n_first_attempt_correct_by_{k}, count(*) FILTER ({k}) AS n_{k}_users_attempted, "
    f"round(count(*) FILTER ({k} AND n_attempts=1 AND problem_pct_score=100)/nullif(count(*) FILTER ({k}),0)*100,6) AS pct_correct_first_attempt_by_{k}"
    for k in ("certified", "completed", "explored")) + " FROM pp JOIN pc ON pp.course_id=pc.course_id AND pp.user_id=pc.user_id WHERE certified OR completed OR explored GROUP BY 1,2", f"{CI}, {PI}"))
def first_attempt_correct(spark, d):
    return I.first_attempt_correct(person_problems(spark, d), T.person_course(spark, d))


@query("Q12_person_problem_wide", sql("ans pa axis", "SELECT course_id, user_id, " + ", ".join(
    f"round(max(problem_pct_score) FILTER (problem_nid={i}),6) AS y{i}" for i in range(1, 21)) + " FROM pp GROUP BY 1,2", f"{CI}, {PI}"))
def person_problem_wide(spark, d):
    return I.person_problem_wide(person_problems(spark, d), course_items(spark, d), 20)


@query("Q12_item_labels", sql("ans axis", """SELECT course_id, problem_id AS problem_url, problem_nid, '['||problem_nid||'] '||problem_short_id||' '||chapter_name||'/'||section_name||'/'||name AS plabel
 FROM ci WHERE item_number=1""", CI))
def item_labels(spark, d):
    return I.item_labels(course_items(spark, d))


def unit_scores(spark, d):
    """Mean score of each learner on five units of problems."""
    pa = T.problem_analysis(spark, d)
    nid = F.substring("problem_url_name", 2, 2).cast("long") % 5 + 1
    return pa.groupBy("course_id", "user_id", nid.alias("problem_nid")).agg(F.avg("grade").alias("y"))


def _rel(missing: str) -> str:
    grid = ("SELECT s.course_id, s.user_id, problem_nid, y FROM us s JOIN (SELECT course_id, user_id FROM us GROUP BY 1,2 HAVING count(*)=5) USING (course_id, user_id)" if missing == "complete" else
            "SELECT u.course_id, u.user_id, n AS problem_nid, coalesce(y,0) AS y FROM (SELECT DISTINCT course_id, user_id FROM us) u, (SELECT unnest([1,2,3,4,5]) AS n) LEFT JOIN us ON us.course_id=u.course_id AND us.user_id=u.user_id AND us.problem_nid=n")
    # pairwise covariances, formed explicitly: an independent route to the same coefficients
    return sql("pa", rounded(f"""SELECT course_id, j AS problem_nid, 'y'||j AS item, nobs, mean, 4.0/3*(1-ov/(ov+oc)) AS alpha, itemtestcorr, itemrestcorr, oc/12 AS itemitemcov FROM (
      SELECT g.course_id, g.problem_nid AS j, count(*) AS nobs, avg(y) AS mean, corr(y,t) AS itemtestcorr, corr(y,t-y) AS itemrestcorr FROM g JOIN tt USING (course_id, user_id) GROUP BY 1,2)
      JOIN (SELECT j, course_id, sum(cv) FILTER (a=b) AS ov, sum(cv) FILTER (a<>b) AS oc FROM pairs, (SELECT unnest([1,2,3,4,5]) AS j) WHERE a<>j AND b<>j GROUP BY 1,2) USING (course_id, j)""",
      "mean alpha itemtestcorr itemrestcorr itemitemcov"), f"""us AS (SELECT course_id, user_id, CAST(problem_url_name[2:] AS BIGINT)%5+1 AS problem_nid, avg(grade) AS y FROM pa GROUP BY 1,2,3),
      g AS ({grid}), tt AS (SELECT course_id, user_id, sum(y) AS t FROM g GROUP BY 1,2),
      pairs AS (SELECT x.course_id, x.problem_nid AS a, z.problem_nid AS b, covar_samp(x.y, z.y) AS cv FROM g x JOIN g z USING (course_id, user_id) GROUP BY 1,2,3)""")


for _m in ("complete", "zero"):
    @query(f"Q13_item_reliability_{_m}", _rel(_m))
    def item_reliability(spark, d, _m=_m):
        return I.item_reliability(unit_scores(spark, d), _m)


def irt_params(spark, d):
    """Two fits per course with three cuts per problem, from part sizes and prices."""
    ax = T.course_axis(spark, d).filter("category = 'problem'")
    k = F.length("name")
    base = ax.select("course_id", (F.substring("url_name", 2, 2).cast("long") + 1).alias("problem_nid"), k.alias("k"), c("data.weight").alias("w"))
    cuts = F.array(*[F.struct(F.lit(i).alias("cutnum"), F.lit(v).alias("cutval")) for i, v in ((1, 40.0), (2, 70.0), (3, 100.0))])
    rows = base.select("*", F.inline(cuts))
    fit = lambda m, day, shift: rows.select(
        "course_id", "problem_nid", "cutnum", (c("k") / 10.0 + c("cutnum") - 2 + shift).alias("irt_diff"), (c("w") / 2.0).alias("irt_disc"),
        F.lit(0.1).alias("diff_se"), F.lit(0.2).alias("disc_se"), "cutval", F.lit(10.0).alias("cutval0"), F.lit(m).alias("irt_method"), F.to_timestamp(F.lit(day)).alias("fitted_at"))
    return fit("old", "2020-01-01", 5.0).unionByName(fit("GRM", "2021-01-01", 0.0))


PRM = """prm AS (SELECT course_id, CAST(url_name[2:] AS BIGINT)+1 AS problem_nid, cut AS cutnum, length(name)/10.0::DOUBLE+cut-2 AS b, weight/2.0 AS a, weight AS w FROM axis,
 (SELECT unnest([1,2,3]) AS cut) WHERE category='problem')"""


@query("Q14_item_response_theory_report", sql("ans pa axis", rounded("""SELECT prm.course_id, prm.problem_nid, cp.problem_short_id, ci.chapter_name AS chapter, ci.gformat AS assignment_type,
 '['||prm.problem_nid||'] '||ci.chapter_name||' / '||ci.section_name||' / '||cp.problem_name AS problem_label, cp.problem_id, prm.problem_nid||'/'||cutnum AS IRT_item_number,
 cp.avg_problem_raw_score, cp.avg_problem_pct_score, cp.n_unique_users_attempted, CAST(NULL AS DOUBLE) AS item_test, CAST(NULL AS DOUBLE) AS item_rest, CAST(NULL AS DOUBLE) AS alpha,
 b AS Difficulty, a AS Discrimination, 0.1 AS Difficulty_SE, 0.2 AS Discrimination_SE, 'GRM' AS irt_method
 FROM prm JOIN ci ON prm.course_id=ci.course_id AND prm.problem_nid=ci.problem_nid AND ci.item_number=1 JOIN cp ON prm.course_id=cp.course_id AND prm.problem_nid=cp.problem_nid""",
    "avg_problem_raw_score avg_problem_pct_score Difficulty Discrimination"), f"{CI}, {PI}, {PRM}"))
def irt_report(spark, d):
    pi, ci = person_items(spark, d)
    return I.irt_report(irt_params(spark, d), ci, I.course_problem(pi, ci))


_P = "1/(1+exp(-a*({t}-b)))"


def _level(theta: str) -> str:
    return f"""10.0*(1-max({_P.format(t=theta)}) FILTER (cutnum=1)) + 40.0*(max({_P.format(t=theta)}) FILTER (cutnum=1) - max({_P.format(t=theta)}) FILTER (cutnum=2))
     + 70.0*(max({_P.format(t=theta)}) FILTER (cutnum=2) - max({_P.format(t=theta)}) FILTER (cutnum=3)) + 100.0*max({_P.format(t=theta)}) FILTER (cutnum=3)"""


@query("Q15_grm_expected_score", sql("axis", f"SELECT course_id, problem_nid, theta, round({_level('theta')},6) AS irt_score FROM prm, (SELECT unnest([-2.0::DOUBLE,-1,0,1,2]) AS theta) GROUP BY 1,2,3", PRM))
def grm_expected_score(spark, d):
    return I.grm_expected_score(irt_params(spark, d).filter("irt_method = 'GRM'"), [-2, -1, 0, 1, 2])


@query("Q15_grm_person_grade", sql("axis pc", f"""SELECT course_id, user_id, round(theta,6) AS theta, round(sum(s*w/100),6) AS irt_grade, sum(w) AS total_weight FROM (
 SELECT prm.course_id, user_id, problem_nid, grade*4-2 AS theta, max(w) AS w, {_level('(grade*4-2)')} AS s FROM prm JOIN pc ON prm.course_id=pc.course_id GROUP BY 1,2,3,4) GROUP BY 1,2,3""", PRM))
def grm_person_grade(spark, d):
    params = irt_params(spark, d).filter("irt_method = 'GRM'")
    theta = T.person_course(spark, d).select("course_id", "user_id", (c("grade") * 4 - 2).alias("theta"))
    weights = T.course_axis(spark, d).filter("category = 'problem'").select(
        "course_id", (F.substring("url_name", 2, 2).cast("long") + 1).alias("problem_nid"), c("data.weight").alias("pn_weight"))
    return I.grm_person_grade(params, theta, weights)


def order_days(spark, d):
    """Daily activity from orders."""
    o = T.load(spark, d, "orders")
    return o.groupBy(T._course(T._div("o_custkey", 30)).alias("course_id"), F.concat(F.lit("u"), c("o_custkey").cast("string")).alias("username"),
                     F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("nshow_answer"), F.count(F.lit(1)).alias("nprogcheck"), F.count(F.lit(1)).alias("nvideo"),
        F.sum(c("o_orderkey") % 3).alias("nforum_reads"), F.sum(c("o_orderkey") % 2).alias("nforum_posts"), F.sum((c("o_orderkey") % 1000).cast("double")).alias("sum_dt"))


@query("Q16_idv_analysis", sql("ans pa pc", f"""SELECT w.course_id, w.user_id, w.username, {ts('verified_enroll_time')}, {ts('verified_unenroll_time')}, nforum_pinned, grade AS final_course_grade,
 certified AS earned_certificate, countryLabel, {ts('start_time')}, gender, YoB, LoE, n_problem_records, n_correct, n_incorrect, total_problem_points, n_show_answer, a.nprogcheck, nvideo,
 a.nforum_reads, a.nforum_posts, round(hours_on_system,6) AS hours_on_system, n_other_idv, n_previous_idv, n_previous_certified, n_previous_participated, n_previous_idv_certified,
 verified_enroll_time IS NOT NULL AS is_idv, strftime(verified_enroll_time,'%Y-%m-%d') AS verified_enroll_date, strftime(verified_unenroll_time,'%Y-%m-%d') AS verified_unenroll_date
 FROM w JOIN (SELECT w.course_id, w.user_id, count(*) AS n_problem_records, count(*) FILTER (correct_bool) AS n_correct, count(*) FILTER (NOT correct_bool) AS n_incorrect, sum(pa.grade) AS total_problem_points
   FROM ans JOIN pa USING (course_id, user_id, problem_url_name) JOIN w ON w.course_id=ans.course_id AND w.user_id=ans.user_id WHERE pa.created<=cutoff GROUP BY 1,2) k ON w.course_id=k.course_id AND w.user_id=k.user_id
 JOIN (SELECT w.course_id, w.user_id, count(*) AS n_show_answer, count(*) AS nprogcheck, count(*) AS nvideo, sum(o_orderkey%3) AS nforum_reads, sum(o_orderkey%2) AS nforum_posts, sum(o_orderkey%1000)/3600.0 AS hours_on_system
   FROM orders JOIN w ON w.user_id=o_custkey AND w.course_id='Org'||((o_custkey//30)%3)||'/C'||(o_custkey//30)||'/T1' WHERE o_orderdate::DATE < cutoff::DATE GROUP BY 1,2) a ON w.course_id=a.course_id AND w.user_id=a.user_id
 LEFT JOIN (SELECT w.course_id, w.user_id, count(*) FILTER (o.verified_enroll_time IS NOT NULL) AS n_other_idv, count(*) FILTER (o.verified_enroll_time IS NOT NULL AND o.start_time<w.start_time) AS n_previous_idv,
   count(*) FILTER (o.certified AND o.start_time<w.start_time) AS n_previous_certified, count(*) FILTER (o.viewed AND o.start_time<w.start_time) AS n_previous_participated,
   count(*) FILTER (o.verified_enroll_time IS NOT NULL AND o.certified AND o.start_time<w.start_time) AS n_previous_idv_certified FROM w JOIN oth o ON w.user_id=o.user_id GROUP BY 1,2) h
   ON w.course_id=h.course_id AND w.user_id=h.user_id""", """w AS (SELECT *, coalesce(verified_enroll_time, max(verified_enroll_time) OVER (PARTITION BY course_id)) AS cutoff FROM pc QUALIFY verified_enroll_time IS NOT NULL OR viewed),
 oth AS (SELECT * REPLACE (start_time - to_days(CAST(user_id%3 AS INTEGER)) AS start_time) FROM pc)"""))
def idv_analysis(spark, d):
    pc = T.person_course(spark, d)
    other = pc.withColumn("start_time", F.timestamp_micros(F.unix_micros("start_time") - (c("user_id") % 3) * 86_400_000_000))
    return I.idv_analysis(T.problem_analysis(spark, d), pc, order_days(spark, d), other)
