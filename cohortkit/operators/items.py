"""Problems, items, classical reliability and fitted response curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortkit.functions.keys import plain_module_id
from cohortkit.functions.scale import count_if, group_quantiles, ratio, safe_corr, salted_lookup
from cohortkit.session import stage

KEY = ["course_id", "user_id"]
MIN_RESPONSES = 5  # an item needs more responses than this (fixed value)
MAP_TYPE = "map<string, struct<correctness: string, npoints: double, msg: string, hint: string>>"


def problem_analysis(sm: DataFrame) -> DataFrame:
    """Problem state records parsed into an item array; records without answers or results are dropped."""
    c = F.col
    mid = plain_module_id(c("module_id"))
    parts = F.split(mid, "/")
    doc = F.try_parse_json(F.replace(c("state"), F.lit("\\\\"), F.lit("\\")))
    answers = F.try_variant_get("doc", "$.student_answers", "map<string, variant>")
    # inlined through one-element arrays: filters on parsed values do not parse the state again
    once = lambda *cols: F.inline(F.array(F.struct(*cols)))
    rows = sm.filter(
        (c("module_type") == "problem") & (F.element_at(parts, -2) == "problem")
    ).select(once(
        c("course_id"), c("student_id").alias("user_id"), F.element_at(parts, -1).alias("problem_url_name"), c("grade"), c("max_grade"),
        c("created"), doc.alias("doc"), F.from_json(F.get_json_object("state", "$.correct_map"), MAP_TYPE).alias("results"),
    )).filter("results IS NOT NULL AND cardinality(results) > 0")
    rows = rows.select(once(*[c(x) for x in rows.columns], answers.alias("answers"))).filter("answers IS NOT NULL")
    item = F.transform(
        F.array_sort(F.map_entries("results")),
        lambda e: F.struct(
            e["key"].alias("answer_id"), F.coalesce(F.to_json(F.element_at(c("answers"), e["key"])), F.lit('""')).alias("response"),
            e["value"]["correctness"].alias("correctness"), (e["value"]["correctness"] == "correct").alias("correct_bool"),
            e["value"]["npoints"].alias("npoints"), e["value"]["msg"].alias("msg"), e["value"]["hint"].alias("hint")))
    return rows.select(
        "course_id", "user_id", "problem_url_name", item.alias("item"),
        F.coalesce(F.try_variant_get("doc", "$.attempts", "bigint"), F.lit(0)).alias("attempts"),
        F.try_variant_get("doc", "$.done", "boolean").alias("done"), c("grade").try_cast("double").alias("grade"),
        c("max_grade").try_cast("double").alias("max_grade"), "created",
    )


def items_of(pa: DataFrame) -> DataFrame:
    """One row per item of a problem record."""
    return pa.select("course_id", "user_id", "problem_url_name", "attempts", "grade", "max_grade", "created", F.inline("item"))


def problem_grades(sm: DataFrame) -> DataFrame:
    """Grade, maximum, and whether perfect and attempted, per learner and problem."""
    c = F.col
    missing = c("grade").isNull() | (c("grade") == "NULL")
    grade, top = F.when(~missing, c("grade").try_cast("double")), c("max_grade").try_cast("double")
    return sm.filter("module_type = 'problem'").select(
        "course_id", c("student_id").alias("user_id"), "module_id", grade.alias("grade"), top.alias("max_grade"),
        F.coalesce(grade >= top, F.lit(False)).alias("perfect"), (~missing).alias("attempted"))


def chapter_grades(pg: DataFrame, axis: DataFrame) -> DataFrame:
    """Grade sums per (user, chapter), with the chapter's median and greatest possible sum."""
    place = axis.select("course_id", F.concat(F.lit("i4x://"), "module_id").alias("module_id"), "chapter_mid", "due")
    rows = salted_lookup(pg.filter("grade IS NOT NULL"), place, ["course_id", "module_id"], "inner", salts=1)
    sums = rows.groupBy(*KEY, "chapter_mid").agg(
        F.sum("max_grade").alias("user_chapter_max_grade"), F.sum("grade").alias("chgrade"),
        F.max("due").alias("due_date_max"), F.min("due").alias("due_date_min"))
    chapter = ["course_id", "chapter_mid"]
    facts = group_quantiles(sums, chapter, {"median_grade": (F.col("chgrade"), 0.5)}).join(
        sums.groupBy(*chapter).agg(F.max("user_chapter_max_grade").alias("chmax")), chapter, "full")
    return salted_lookup(sums, facts, chapter, salts=1)


SA_CASES = ["problem_seen", "not_attempted", "attempted", "perfect", "partial"]


def sa_stats_by_user(pg: DataFrame, sa: DataFrame, pc: DataFrame) -> DataFrame:
    """Per student: problems seen, left, attempted, solved or partly solved, and how often the answer was revealed."""
    c = F.col
    who = pc.filter("forumRoles_isStudent = 1 OR forumRoles_isStudent IS NULL").select(
        *KEY, "explored", "certified", (F.coalesce(c("mode"), F.lit("")) == "verified").alias("verified"))
    names = pc.select("course_id", "username", "user_id")
    shown = sa.join(names, ["course_id", "username"], "inner").groupBy(
        *KEY, F.concat(F.lit("i4x://"), "module_id").alias("module_id")).agg(F.count(F.lit(1)).alias("n_show"))
    both = pg.join(shown, [*KEY, "module_id"], "left")
    hit = c("n_show") > 0
    tests = {"problem_seen": F.lit(True), "not_attempted": ~c("attempted"), "attempted": c("attempted"),
             "perfect": c("perfect"), "partial": c("grade") > 0}
    aggs = []
    for name, test in tests.items():
        total = "n_problems_seen" if name == "problem_seen" else f"n_{name}"
        aggs += [count_if(test & hit).alias(f"n_show_answer_{name}"), count_if(test).alias(total)]
    sums = both.groupBy(*KEY).agg(*aggs).join(who, KEY, "inner")
    pct = [(ratio(c(f"n_show_answer_{n}"), c("n_problems_seen" if n == "problem_seen" else f"n_{n}")) * 100).alias(f"pct_show_answer_{n}") for n in SA_CASES]
    return sums.select("*", *pct)


def sa_stats_by_course(by_user: DataFrame) -> DataFrame:
    """Means and medians of the reveal percentages for all, certified, explored and verified students."""
    means, wanted = [], {}
    for cohort in ("", "certified", "explored", "verified"):
        for case in SA_CASES:
            col = F.col(f"pct_show_answer_{case}")
            value = F.when(F.col(cohort), col) if cohort else col
            name = f"pct_show_answer_{case}" + (f"_{cohort}" if cohort else "")
            means.append(F.avg(value).alias(f"avg_{name}"))
            wanted[f"median_{name}"] = (value, 0.5)
    return by_user.groupBy("course_id").agg(*means).join(group_quantiles(by_user, ["course_id"], wanted), "course_id", "left")


def attempts_correct(pa: DataFrame, pc: DataFrame, sa: DataFrame | None = None) -> DataFrame:
    """Share of correct items per viewer, problems tried, revealed answers and share of the most problems tried."""
    c = F.col
    judged = F.filter("item", lambda i: i["correct_bool"].isNotNull())
    right = F.filter("item", lambda i: i["correct_bool"])
    per_problem = pa.groupBy(*KEY, "problem_url_name").agg(F.sum(F.size(right)).alias("r"), F.sum(F.size(judged)).alias("n"))
    per_user = per_problem.groupBy(*KEY).agg(F.sum("r").alias("r"), F.sum("n").alias("nattempts"), F.count(F.lit(1)).alias("nproblems"))
    who = pc.filter("viewed").select(*KEY, "username", "certified", "explored")
    if sa is not None:
        shown = sa.select("course_id", "username", "module_id").distinct().groupBy("course_id", "username").agg(
            F.count(F.lit(1)).alias("shown"))
        who = who.join(shown, ["course_id", "username"], "left")
    else:
        who = who.withColumn("shown", F.lit(0).cast("long"))
    rows = per_user.join(who, KEY, "inner")
    most = rows.groupBy("course_id").agg(F.max("nproblems").alias("total_problems"))
    rows = salted_lookup(rows, most, ["course_id"], salt_by=["user_id"])
    return rows.select(
        *KEY, "certified", "explored", (ratio(c("r"), c("nattempts")) * 100).alias("percent_correct"), "nattempts",
        F.coalesce("shown", F.lit(0)).alias("nshow_answer_unique_problems"), "nproblems", "total_problems",
        ratio(c("nproblems"), c("total_problems")).alias("frac_complete"))


def course_item(pa: DataFrame, axis: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """Items of each course with their place, assignment, weight and running numbers.

    Answers are counted per item first; every window below runs over the content of one
    course, whose size does not depend on the number of learners. Without a grading policy
    every weight fraction is 1, the label is ``none`` and ungraded problems are allowed.
    """
    c, course = F.col, "course_id"

    def over(*keys: str, by: str | None = None):
        w = W.partitionBy(course, *keys)
        return w.orderBy(by) if by else w

    counted = items_of(pa).groupBy(course, c("answer_id").alias("item_id"), c("problem_url_name").alias("problem_id"),
                                   c("max_grade").alias("points")).agg(F.count(F.lit(1)).alias("n_user_responses"))
    items = counted.filter(c("n_user_responses") > MIN_RESPONSES)
    items = items.withColumn("item_number", F.row_number().over(over("problem_id", by="item_id")))
    items = items.withColumn("n_items", F.max("item_number").over(over("problem_id")))

    heads = axis.filter(c("category").isin("chapter", "sequential", "videosequence")).select(
        course, "url_name", "index", "category", "name",
        F.when(c("category") == "chapter", c("module_id")).otherwise(c("chapter_mid")).alias("chapter_mid"))
    heads = heads.withColumn("xch", F.row_number().over(over("category", by="index")))
    heads = heads.withColumn("section_number", F.row_number().over(over("chapter_mid", "category", by="index")))
    heads = heads.withColumn("chapter_name", F.first("name").over(over("chapter_mid", by="index")))
    heads = heads.withColumn("chapter_number", F.max(F.when(c("category") == "chapter", c("xch"))).over(over("chapter_mid", by="index")))
    sections = heads.select(course, c("url_name").alias("section_mid"), c("name").alias("section_name"), "chapter_number", "section_number", "chapter_name")

    graded = axis.filter("category = 'problem'") if policy is None else axis.filter("category = 'problem' AND gformat IS NOT NULL")
    split = [x for x in ("is_split", "split_url_name") if x in axis.columns]
    prob = graded.select(
        course, c("url_name").alias("problem_id"), c("index").alias("content_index"), F.coalesce("data.weight", F.lit(1.0)).alias("problem_weight"),
        F.coalesce("gformat", F.lit("")).alias("assignment_type"), F.get(F.split("path", "/"), F.lit(2)).alias("section_mid"),
        c("name").alias("problem_name"), c("path").alias("problem_path"), c("start").alias("start_date"), c("due").alias("due_date"),
        "parent", *split)
    prob = prob.join(sections, [course, "section_mid"], "left")
    verticals = axis.filter("category = 'vertical'").select(course, c("url_name").alias("parent"), c("name").alias("vertical_name"))
    prob = prob.join(verticals, [course, "parent"], "left")
    prob = prob.withColumn("assignment_id", F.concat(
        "assignment_type", F.lit("_ch"), c("chapter_number").cast("string"), F.lit("_sec"), c("section_number").cast("string")))
    prob = prob.withColumn("problem_number", F.row_number().over(over("assignment_id", by="content_index")))
    first = c("problem_number") == 1
    prob = prob.withColumn("n_assignments_of_type", F.sum(F.when(first, 1).otherwise(0)).over(over("assignment_type")))
    prob = prob.withColumn("xseq", F.row_number().over(over("assignment_type", "problem_number", by="content_index")))
    prob = prob.withColumn("assignment_seq_num", F.max(F.when(first, c("xseq"))).over(over("assignment_id")))

    ci = items.join(prob, [course, "problem_id"], "inner")
    lead = c("assignment_id").isNotNull() & (c("item_number") == 1)
    ci = ci.withColumn("xnid", F.row_number().over(over("item_number", by="content_index")))
    ci = ci.withColumn("problem_nid", F.max(F.when(c("item_number") == 1, c("xnid"))).over(over("problem_id")))
    ci = ci.withColumn("n_problems_in_assignment", F.sum(F.when(lead, 1).otherwise(0)).over(over("assignment_id")))
    ci = ci.withColumn("sum_weight", F.sum(F.when(lead, c("problem_weight")).otherwise(0.0)).over(over("assignment_id")))
    if policy is None:
        ci = ci.withColumn("fraction", F.lit(1.0)).withColumn("short_label", F.when(c("assignment_type") == "", "none"))
    else:
        ci = ci.join(policy.select(course, "assignment_type", c("fraction_of_overall_grade").alias("fraction"), "short_label"),
                     [course, "assignment_type"], "left")
    fraction = F.coalesce("fraction", F.lit(1.0))
    weight = ratio(c("problem_weight") * fraction / c("n_items"), c("sum_weight"))
    ci = ci.withColumn("item_weight", ratio(weight, c("n_assignments_of_type")))
    ci = ci.withColumn("assignment_short_id", F.concat(F.coalesce("short_label", F.lit("")), F.lit("_"), c("assignment_seq_num").cast("string")))
    in_order = W.partitionBy(course).orderBy("content_index", "item_number")
    return ci.select(
        course, "item_id", "problem_id", "problem_nid", "assignment_short_id",
        F.concat("assignment_short_id", F.lit("__"), c("problem_number").cast("string")).alias("problem_short_id"),
        F.concat("assignment_short_id", F.lit("__"), c("problem_number").cast("string"), F.lit("_"), c("item_number").cast("string")).alias("item_short_id"),
        "item_weight", "n_user_responses", "chapter_name", "section_name", "vertical_name", "problem_name", "assignment_id",
        "n_problems_in_assignment", "assignment_type", fraction.alias("assignment_type_weight"), "n_assignments_of_type", "assignment_seq_num",
        "chapter_number", "content_index", "section_number", "problem_number", "problem_weight", F.lit(1.0).alias("item_points_possible"),
        (c("n_items") * 1.0).alias("problem_points_possible"), (c("points") / c("n_items")).alias("emperical_item_points_possible"),
        c("points").alias("emperical_problem_points_possible"), "item_number", "n_items", "start_date", "due_date", *split, "problem_path",
        F.row_number().over(in_order).alias("item_nid"),
        F.sum("item_weight").over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("cumulative_item_weight"))


def person_item(pa: DataFrame, ci: DataFrame) -> DataFrame:
    """Grade per learner and item."""
    one = items_of(pa).groupBy(*KEY, "answer_id", F.when(F.col("correct_bool"), 1).otherwise(0).alias("item_grade"), "grade",
                               F.col("attempts").alias("n_attempts")).agg(F.max("created").alias("date"))
    facts = ci.select("course_id", F.col("item_id").alias("answer_id"), "item_short_id", "item_nid")
    return salted_lookup(one, facts, ["course_id", "answer_id"], "inner", salts=1).drop("answer_id")


def person_problem(pi: DataFrame, ci: DataFrame) -> DataFrame:
    """Score per learner and problem."""
    facts = ci.select("course_id", "item_nid", "problem_nid", "item_points_possible")
    rows = salted_lookup(pi, facts, ["course_id", "item_nid"], "inner", salts=1)
    return rows.groupBy(*KEY, "problem_nid").agg(
        F.sum("item_grade").alias("problem_raw_score"),
        (ratio(F.sum("item_grade"), F.sum("item_points_possible")) * 100).alias("problem_pct_score"),
        F.max("grade").alias("grade"), F.max("n_attempts").alias("n_attempts"), F.max("date").alias("date"))


def course_problem(pi: DataFrame, ci: DataFrame) -> DataFrame:
    """Score statistics per problem."""
    labels = ["problem_nid", "problem_id", "problem_short_id", "problem_name", *[x for x in ("is_split", "split_url_name") if x in ci.columns]]
    facts = ci.select("course_id", "item_nid", "item_points_possible", *labels)
    rows = salted_lookup(pi, facts, ["course_id", "item_nid"], "inner", salts=1)
    per_user = rows.groupBy(*KEY, *labels).agg(F.sum("item_grade").alias("g"), F.sum("item_points_possible").alias("p"))
    return per_user.groupBy("course_id", *labels).agg(
        F.avg("g").alias("avg_problem_raw_score"), F.stddev_samp("g").alias("sdv_problem_raw_score"),
        F.max("p").alias("max_possible_raw_score"), F.avg(ratio(F.col("g"), F.col("p")) * 100).alias("avg_problem_pct_score"),
        F.count(F.lit(1)).alias("n_unique_users_attempted"))


def first_attempt_correct(pp: DataFrame, pc: DataFrame) -> DataFrame:
    """Share of certified, completed and explored learners who solved a problem at the first attempt."""
    c = F.col
    cohorts = ["certified", "completed", "explored"]
    rows = pp.join(pc.filter("certified OR completed OR explored").select(*KEY, *cohorts), KEY, "inner")
    at_once = (c("n_attempts") == 1) & (c("problem_pct_score") == 100)
    aggs = []
    for k in cohorts:
        ok, n = count_if(c(k) & at_once), count_if(c(k))
        aggs += [ok.alias(f"n_first_attempt_correct_by_{k}"), n.alias(f"n_{k}_users_attempted"),
                 (ratio(ok, n) * 100).alias(f"pct_correct_first_attempt_by_{k}")]
    return rows.groupBy("course_id", "problem_nid").agg(*aggs)


def person_problem_wide(pp: DataFrame, ci: DataFrame, n_problems: int | None = None) -> DataFrame:
    """One row per learner with a score column ``y<problem_nid>`` per problem number.

    ``n_problems`` fixes the columns; otherwise the greatest number in ``ci`` does.
    """
    if n_problems is None:
        n_problems = ci.agg(F.max("problem_nid")).first()[0] or 0
    cols = [F.max(F.when(F.col("problem_nid") == i, F.col("problem_pct_score"))).alias(f"y{i}") for i in range(1, n_problems + 1)]
    return pp.groupBy(*KEY).agg(*cols)


def item_labels(ci: DataFrame) -> DataFrame:
    """Readable label per problem."""
    label = F.concat(F.lit("["), F.col("problem_nid").cast("string"), F.lit("] "), "problem_short_id", F.lit(" "),
                     F.coalesce("chapter_name", F.lit("")), F.lit("/"), F.coalesce("section_name", F.lit("")), F.lit("/"), "problem_name")
    rows = ci.filter("item_number = 1").select("course_id", F.col("problem_id").alias("problem_url"), "problem_nid", label.alias("plabel"))
    return rows.groupBy("course_id", "problem_url").agg(
        F.min("problem_nid").alias("problem_nid"), F.min_by("plabel", "problem_nid").alias("plabel"))


def item_reliability(scores: DataFrame, missing: str = "complete") -> DataFrame:
    """Cronbach's alpha without each item, item-test and item-rest correlation, mean inter-item covariance.

    ``scores``: course_id, user_id, problem_nid, y. Items that do not vary are dropped.
    ``missing='complete'`` uses learners who have every remaining item; ``'zero'`` counts a
    missing item as 0, from the sums of the scores that are there. With complete rows the covariances of the other items sum to the
    variance of their total minus their own variances, so no item pairs are formed.
    """
    c, item = F.col, ["course_id", "problem_nid"]
    scores = stage(scores.select(*KEY, "problem_nid", "y").filter("y IS NOT NULL"), "item-scores")
    varying = scores.groupBy(*item).agg(F.var_pop("y").alias("v")).filter("v > 0").select(*item)
    rows = salted_lookup(scores, varying, item, "inner", salts=1)
    k = varying.groupBy("course_id").agg(F.count(F.lit(1)).alias("k"))
    totals = salted_lookup(rows.groupBy(*KEY).agg(F.sum("y").alias("total"), F.count(F.lit(1)).alias("have")), k, ["course_id"], salt_by=["user_id"])
    rest = c("total") - c("y")
    if missing == "complete":
        full = rows.join(totals.filter("have = k"), KEY, "inner")
        stats = full.groupBy(*item).agg(
            F.count(F.lit(1)).alias("nobs"), F.avg("y").alias("mean"), F.var_samp("y").alias("vy"), F.var_samp(rest).alias("vrest"),
            safe_corr("y", "total").alias("itemtestcorr"), safe_corr("y", rest).alias("itemrestcorr"), F.first("k").alias("k"))
    else:
        stats = _zero_filled(rows, totals, item)
    others = F.sum("vy").over(W.partitionBy("course_id")) - c("vy")  # one row per item of the course
    stats = stats.withColumn("others", others)
    m = c("k") - 1
    return stats.select(
        *item, F.concat(F.lit("y"), c("problem_nid").cast("string")).alias("item"), "nobs", "mean",
        (ratio(m, m - 1) * (1 - ratio(c("others"), c("vrest")))).alias("alpha"), "itemtestcorr", "itemrestcorr",
        ratio(c("vrest") - c("others"), m * (m - 1)).alias("itemitemcov"))


def _zero_filled(rows: DataFrame, totals: DataFrame, item: list[str]) -> DataFrame:
    """Statistics per item with every missing score of a course's learners counted as 0, without rows for them.

    A missing score adds nothing to the sums of y, of its square and of its product with the
    learner's total; only the number of learners and the sums of all totals must be known.
    """
    c = F.col
    learners = totals.groupBy("course_id").agg(
        F.count(F.lit(1)).alias("nobs"), F.sum("total").alias("t"), F.sum(c("total") * c("total")).alias("tt"), F.first("k").alias("k"))
    present = rows.join(totals.select(*KEY, "total"), KEY, "inner").groupBy(*item).agg(
        F.sum("y").alias("s"), F.sum(c("y") * c("y")).alias("ss"), F.sum(c("y") * c("total")).alias("st"))
    both = salted_lookup(present, learners, ["course_id"], "inner", salts=1)
    n = c("nobs")
    # sums of products about the means; differences below rounding are nothing
    product = lambda xy, x, y: F.when(F.abs(xy - x * y / n) > 1e-12 * F.abs(xy), xy - x * y / n).otherwise(F.lit(0.0))
    both = both.select(*item, "nobs", "k", (c("s") / n).alias("mean"), product(c("ss"), c("s"), c("s")).alias("yy"),
                       product(c("st"), c("s"), c("t")).alias("yt"), product(c("tt"), c("t"), c("t")).alias("tt"))
    rest = c("tt") + c("yy") - 2 * c("yt")
    both = both.withColumn("rr", F.when(rest > 1e-12 * (c("tt") + c("yy")), rest).otherwise(F.lit(0.0)))
    return both.select(
        *item, "nobs", "k", "mean", ratio(c("yy"), n - 1).alias("vy"), ratio(c("rr"), n - 1).alias("vrest"),
        ratio(c("yt"), F.sqrt(c("yy") * c("tt"))).alias("itemtestcorr"), ratio(c("yt") - c("yy"), F.sqrt(c("yy") * c("rr"))).alias("itemrestcorr"))


def irt_report(params: DataFrame, ci: DataFrame, cp: DataFrame, rel: DataFrame | None = None) -> DataFrame:
    """Fitted item parameters with problem statistics; of several fits per course the newest is used.

    ``params``: course_id, problem_nid, cutnum, irt_diff, irt_disc, diff_se, disc_se, irt_method, fitted_at.
    """
    c = F.col
    newest = params.groupBy("course_id").agg(F.max_by("irt_method", "fitted_at").alias("irt_method"))
    fit = params.join(newest, ["course_id", "irt_method"], "left_semi")
    keys = ["course_id", "problem_nid"]
    df = fit.join(ci.filter("item_number = 1").select(*keys, "chapter_name", "section_name", "assignment_type"), keys, "inner")
    df = df.join(cp.select(*keys, "problem_short_id", "problem_name", "problem_id", "avg_problem_raw_score", "avg_problem_pct_score",
                           "n_unique_users_attempted"), keys, "inner")
    if rel is not None:
        df = df.join(rel.select(*keys, c("itemtestcorr").alias("item_test"), c("itemrestcorr").alias("item_rest"), "alpha"), keys, "inner")
    else:
        df = df.select("*", *[F.lit(None).cast("double").alias(x) for x in ("item_test", "item_rest", "alpha")])
    nid = c("problem_nid").cast("string")
    return df.select(
        *keys, "problem_short_id", c("chapter_name").alias("chapter"), "assignment_type",
        F.concat(F.lit("["), nid, F.lit("] "), "chapter_name", F.lit(" / "), "section_name", F.lit(" / "), "problem_name").alias("problem_label"),
        "problem_id", F.concat(nid, F.lit("/"), c("cutnum").cast("string")).alias("IRT_item_number"), "avg_problem_raw_score",
        "avg_problem_pct_score", "n_unique_users_attempted", "item_test", "item_rest", "alpha", c("irt_diff").alias("Difficulty"),
        c("irt_disc").alias("Discrimination"), c("diff_se").alias("Difficulty_SE"), c("disc_se").alias("Discrimination_SE"), "irt_method")


def _curves(params: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Per problem: discrimination, lowest level score, and (difficulty, score step) of each cut."""
    steps = F.transform(F.array_sort(F.collect_list(F.struct("cutnum", "irt_diff", "cutval"))), lambda x: x)
    rows = params.groupBy("course_id", "problem_nid").agg(
        F.first("irt_disc").alias("a"), F.min_by("cutval0", "cutnum").alias("base"), steps.alias("cuts"))
    rows = rows.withColumn("steps", F.transform("cuts", lambda x, i: F.struct(
        x["irt_diff"].alias("b"),
        (x["cutval"] - F.when(i == 0, F.col("base")).otherwise(F.get(F.col("cuts"), i - 1)["cutval"])).alias("gain"))))
    if weights is not None:
        rows = rows.join(weights, ["course_id", "problem_nid"], "left")
    return rows


def _expected(a: Column, base: Column, steps: Column, theta: Column) -> Column:
    """Expected score: the lowest level plus each level's step times the chance of reaching it."""
    return F.aggregate(steps, base, lambda acc, s: acc + s["gain"] / (1.0 + F.exp(-a * (theta - s["b"]))))


def grm_expected_score(params: DataFrame, grid: list[float]) -> DataFrame:
    """Expected item score of a graded-response model at every ability of ``grid``.

    ``params``: course_id, problem_nid, cutnum (1..n), irt_diff, irt_disc, cutval (score from this
    cut on) and cutval0 (score below the first cut).
    """
    curves = _curves(params)
    rows = curves.withColumn("theta", F.explode(F.array(*[F.lit(float(t)) for t in grid])))
    return rows.select("course_id", "problem_nid", "theta", _expected(F.col("a"), F.col("base"), F.col("steps"), F.col("theta")).alias("irt_score"))


def grm_person_grade(params: DataFrame, theta: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted expected score per learner.

    The curves of a course travel as one array, whose length is the course's number of
    problems, so learners and problems are never paired as rows.
    """
    c = F.col
    packed = _curves(params, weights.select("course_id", "problem_nid", c("pn_weight").cast("double").alias("w"))).groupBy("course_id").agg(
        F.array_sort(F.collect_list(F.struct("problem_nid", "a", "base", "steps", "w"))).alias("curves"))
    rows = salted_lookup(theta, packed, ["course_id"], "inner", salts=1)
    points = F.aggregate("curves", F.lit(0.0), lambda acc, q: acc + F.coalesce(
        _expected(q["a"], q["base"], q["steps"], c("theta")) * q["w"] / 100.0, F.lit(0.0)))
    total = F.aggregate("curves", F.lit(0.0), lambda acc, q: acc + F.coalesce(q["w"], F.lit(0.0)))
    return rows.select(*KEY, "theta", points.alias("irt_grade"), total.alias("total_weight"))


IDV_SUMS = {"n_show_answer": "nshow_answer", "nprogcheck": "nprogcheck", "nvideo": "nvideo", "nforum_reads": "nforum_reads", "nforum_posts": "nforum_posts"}


def idv_analysis(pa: DataFrame, pc: DataFrame, pcd: DataFrame, pc_all: DataFrame, compat: bool = False) -> DataFrame:
    """Activity up to the verified enrolment (or, for other viewers, up to the course's last one), with other courses.

    Both groups share one pass: each learner has a cutoff, their own enrolment time or the
    course's greatest. "Previous" courses are those started earlier; ``compat`` counts the
    later ones instead.
    """
    c = F.col
    last = pc.groupBy("course_id").agg(F.max("verified_enroll_time").alias("last_vet"))
    who = salted_lookup(
        pc.select(*KEY, "username", "viewed", "verified_enroll_time", "verified_unenroll_time", "nforum_pinned", c("grade").alias("final_course_grade"),
                  c("certified").alias("earned_certificate"), "countryLabel", "start_time", "gender", "YoB", "LoE"),
        last, ["course_id"], salt_by=["user_id"])
    who = who.filter("verified_enroll_time IS NOT NULL OR viewed").withColumn("cutoff", F.coalesce("verified_enroll_time", "last_vet"))
    # counts travel instead of the items
    tried = pa.select(*KEY, "created", "grade", F.size("item").alias("_n"), F.size(F.filter("item", lambda i: i["correct_bool"])).alias("_r"),
                      F.size(F.filter("item", lambda i: ~i["correct_bool"])).alias("_w"))
    work = tried.join(who.select(*KEY, "cutoff"), KEY, "inner").filter("created <= cutoff").groupBy(*KEY).agg(
        F.sum("_n").alias("n_problem_records"), F.sum("_r").alias("n_correct"), F.sum("_w").alias("n_incorrect"),
        F.sum(c("grade") * c("_n")).alias("total_problem_points"))
    names = ["course_id", "username"]
    active = pcd.join(who.select(*names, "cutoff"), names, "inner").filter(c("date") < F.to_date("cutoff")).groupBy(*names).agg(
        *[F.sum(col).alias(n) for n, col in IDV_SUMS.items()], (F.sum("sum_dt") / 3600.0).alias("hours_on_system"))
    rows = who.join(work, KEY, "inner").join(active, names, "inner")
    other = pc_all.select("user_id", c("verified_enroll_time").alias("_vet"), c("start_time").alias("_st"), c("certified").alias("_cert"), c("viewed").alias("_view"))
    both = rows.select(*KEY, "start_time").join(other, "user_id", "left")
    before = c("_st") > c("start_time") if compat else c("_st") < c("start_time")
    idv = c("_vet").isNotNull()
    counts = both.groupBy(*KEY).agg(
        count_if(idv).alias("n_other_idv"), count_if(idv & before).alias("n_previous_idv"), count_if(c("_cert") & before).alias("n_previous_certified"),
        count_if(c("_view") & before).alias("n_previous_participated"), count_if(idv & before & c("_cert")).alias("n_previous_idv_certified"))
    return rows.join(counts, KEY, "left").select(
        "*", c("verified_enroll_time").isNotNull().alias("is_idv"), F.to_date("verified_enroll_time").alias("verified_enroll_date"),
        F.to_date("verified_unenroll_time").alias("verified_unenroll_date")).drop("viewed", "last_vet", "cutoff")
