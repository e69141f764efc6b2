"""Steps that several later ones read are computed once."""

from cohortkit.operators import groups as G, items as I
from cohortkit.plans import item_queries as Q

SF = "/root/testdata/sf0.001"


def scans(df, table):
    return df._jdf.queryExecution().optimizedPlan().toString().count(table)


def test_records_and_items_are_read_back(spark):
    pi, ci = Q.person_items(spark, SF)
    for df in (pi, I.person_problem(pi, ci), I.course_problem(pi, ci)):
        assert scans(df, "l_orderkey") == 0 and scans(df, "p_partkey") == 0 and df.count() > 0


def test_unit_scores_are_read_back(spark):
    for missing in ("complete", "zero"):
        assert scans(I.item_reliability(Q.unit_scores(spark, SF), missing), "l_orderkey") == 0


def test_counts_of_items(spark):
    pa = spark.createDataFrame(
        [("c", 1, "p", [(True,), (False,), (None,)], 1.5, "2024-01-02"), ("c", 1, "q", [(True,)], 1.0, "2024-03-01"), ("c", 1, "r", None, None, "2024-01-01")],
        "course_id string, user_id long, problem_url_name string, item array<struct<correct_bool: boolean>>, grade double, created string").selectExpr(
        "course_id", "user_id", "problem_url_name", "item", "grade", "timestamp(created) AS created")
    pc = spark.sql("""SELECT 'c' AS course_id, 1L AS user_id, 'u' AS username, true AS viewed, timestamp'2024-02-01' AS verified_enroll_time, CAST(NULL AS timestamp) AS verified_unenroll_time,
        0 AS nforum_pinned, 0.5D AS grade, true AS certified, 'X' AS countryLabel, timestamp'2024-01-01' AS start_time, 'm' AS gender, 1990 AS YoB, 'b' AS LoE""")
    pcd = spark.sql("SELECT 'c' AS course_id, 'u' AS username, date'2024-01-05' AS date, 1 AS nshow_answer, 1 AS nprogcheck, 1 AS nvideo, 1 AS nforum_reads, 1 AS nforum_posts, 3600.0D AS sum_dt")
    out = I.idv_analysis(pa, pc, pcd, pc)
    row = out.first()
    assert (row.n_problem_records, row.n_correct, row.n_incorrect, row.total_problem_points) == (3, 1, 1, 4.5)


def test_state_is_parsed_once(spark):
    state = '{"correct_map": {"p_2_1": {"correctness": "correct", "npoints": 1}}, "student_answers": {"p_2_1": "a"}, "attempts": 2, "done": true}'
    sm = spark.createDataFrame([("O/C/T", 1, "problem", "i4x://O/C/problem/p", x, "1.0", "3.0", "2024-01-01") for x in (state, "{}", None)],
                               "course_id string, student_id long, module_type string, module_id string, state string, grade string, max_grade string, created string")
    out = I.items_of(I.problem_analysis(sm))
    assert scans(out, "from_json") == 1
    row, = out.collect()
    assert (row.answer_id, row.response, row.correct_bool, row.attempts, row.grade) == ("p_2_1", '"a"', True, 2, 1.0)


def test_pairs_inside_groups_are_read_back(spark):
    who = [(1, "m", True), (2, "h", False), (3, "x", True)]
    pc = spark.createDataFrame([("c", i, u, "1", k, "honor", 5.0, "X", "s", "l", 0, 0, 0, 0.7) for i, u, k in who], "course_id string, user_id long, username string, "
                               "ip string, certified boolean, mode string, sum_dt double, countryLabel string, start_time string, last_event string, nforum_posts int, nprogcheck int, nplay_video int, grade double")
    pairs = spark.createDataFrame([("c", "m", "h", 30.0), ("c", "x", "h", 30.0)], "course_id string, master_candidate string, harvester_candidate string, percent_show_ans_before double")
    rest = [x for x in G.PAIR_COLUMNS if x not in pairs.columns]
    pairs = pairs.selectExpr("*", *[f"percent_show_ans_before + length(concat('dear', master_candidate)) AS {x}" for x in rest])
    ac = spark.createDataFrame([("c", i, 3, 50.0, 0.5) for i, _, _ in who], "course_id string, user_id long, nshow_answer_unique_problems int, percent_correct double, frac_complete double")
    groups = spark.createDataFrame([("m", "1", "g"), ("h", "1", "g"), ("x", "1", "other")], "username string, ip string, grp string")
    info = spark.createDataFrame([("c", 0.6)], "course_id string, min_certifying_grade double")
    for out in (G.ip_groups_v3(pc, pairs, ac, groups), G.ip_groups_v3_unfiltered(pc, pairs, ac, groups, info)):
        assert out._jdf.queryExecution().analyzed().toString().count("dear") == 0
        assert {(r.username, r.shadow) for r in out.collect()} == {("m", "h"), ("h", None)}
