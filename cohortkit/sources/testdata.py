"""Bindings of the star-schema test tables to the canonical course tables.

Every canonical row is computed from table rows, so the work grows with the data:
30 learners per course from ``customer``, 40 content elements per course from
``part``, answers from ``lineitem``, log rows from ``events``, posts from
``conversations``. ``SQL`` states the same mapping for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

EPOCH_DAY_US = 86_400_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of the test set."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _div(col: Column | str, n: int) -> Column:
    return F.floor((F.col(col) if isinstance(col, str) else col) / F.lit(n)).cast("long")


def _org(cidx: Column) -> Column:
    return F.concat(F.lit("Org"), (cidx % 3).cast("string"), F.lit("/C"), cidx.cast("string"))


def _course(cidx: Column) -> Column:
    return F.concat(_org(cidx), F.lit("/T1"))


def _two(col: Column) -> Column:
    return F.lpad(col.cast("string"), 2, "0")


def _ip(user: Column, last: Column) -> Column:
    return F.concat(
        F.lit("10."), ((user % 40) * 6).cast("string"), F.lit("."),
        (_div(user, 160) % 250).cast("string"), F.lit("."), last.cast("string"),
    )


def tracking_log(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """``events`` (or a stream of its rows) as a course log with nested ``context`` and ``event_struct``."""
    ev = (load(spark, sf_dir, "events") if events is None else events).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value",
        F.col("event_type").alias("t"), F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    us = F.unix_micros("ts")
    day = F.floor(us / F.lit(EPOCH_DAY_US)).cast("long") * F.lit(EPOCH_DAY_US)
    c = F.col
    ev = (
        ev.withColumn("time", F.timestamp_micros(day + F.floor((us - day) / 24).cast("long")))
        .withColumn("cidx", _div("user_id", 30) + _div("k", 70))
        .withColumn("d", c("k") % 10)
        .withColumn("course_id", _course(c("cidx")))
        .withColumn("thread", F.concat(F.lit("T"), (c("cidx") * 20 + c("k") % 20).cast("string")))
    )
    base = F.concat(F.lit("/courses/"), c("course_id"))
    lang = F.element_at(F.array(F.lit("fr"), F.lit("es"), F.lit("zh")), (_div("k", 10) % 3 + 1).cast("int"))
    view = (
        F.when(c("d") <= 3, "play_video").when(c("d") == 4, "pause_video").when(c("d") == 5, "stop_video")
        .when(c("d") == 6, "seek_video").when(c("d") == 7, "show_transcript")
        .when(c("d") == 8, F.concat(base, F.lit("/xblock/i4x:;_;_Org;_C;_video;_v"), (c("k") % 8).cast("string"),
                                    F.lit("/handler/transcript/translation/"), lang))
        .otherwise("edx.ui.lms.link_clicked")
    )
    click = (
        F.when(c("d") <= 5, "problem_check").when(c("d") == 6, "save_problem_check")
        .when(c("d") == 7, "problem_show").when(c("d") == 8, "problem_reset").otherwise("seq_goto")
    )
    reveal = F.when(c("k") % 2 == 0, "showanswer").otherwise("show_answer")
    enrol = F.concat(F.lit("edx.course.enrollment."), F.element_at(
        F.array(*[F.lit(x) for x in ("activated", "deactivated", "mode_changed", "upgrade.succeeded")]),
        (c("k") % 4 + 1).cast("int")))
    threads = F.concat(base, F.lit("/discussion/threads/"), c("thread"))
    talk = (
        F.when(c("d") == 0, F.concat(base, F.lit("/discussion/forum/gen/threads/"), c("thread")))
        .when(c("d") == 1, "edx.forum.thread.created")
        .when(c("d") == 2, F.concat(threads, F.lit("/reply")))
        .when(c("d") == 3, F.concat(threads, F.lit("/upvote")))
        .when(c("d") == 4, F.concat(base, F.lit("/progress")))
        .when(c("d") == 5, "textbook.pdf.page.loaded")
        .when(c("d") == 6, F.concat(base, F.lit("/wiki/page"), c("k").cast("string")))
        .when(c("d") == 7, "openassessmentblock.create_submission")
        .when(c("d") == 8, "openassessmentblock.peer_assess")
        .otherwise(F.concat(threads, F.lit("/follow")))
    )
    et = (
        F.when(c("t") == "view", view).when(c("t") == "click", click)
        .when(c("t") == "purchase", reveal).when(c("t") == "signup", enrol).otherwise(talk)
    )
    problem = F.concat(_org(c("cidx")), F.lit("/problem/p"), _two(c("k") % 20))
    video = F.concat(_org(c("cidx")), F.lit("/video/v"), (c("k") % 8).cast("string"))
    module = F.when(c("t").isin("click", "purchase"), problem).when((c("t") == "view") & (c("d") <= 7), video)
    text = F.format_string("%.2f", "value")
    event = (
        F.when((c("t") == "view") & (c("d") == 9), F.lit('{"target_url": "/x/handler/transcript/download"}'))
        .when(c("t") == "view", F.concat(
            F.lit('{"id": "i4x-Org-C-video-v'), (c("k") % 8).cast("string"), F.lit('", "currentTime": '), text,
            F.when(c("k") % 3 == 0, F.lit("}")).otherwise(F.lit(', "speed": "1.50"}'))))
        .when((c("t") == "error") & (c("d") == 7), F.concat(
            F.lit('{"submission_uuid": "s'), c("user_id").cast("string"),
            F.lit('", "attempt_number": 1, "answer": {"file_key": "x/i4x://Org/C/openassessment/o'),
            (c("user_id") % 5).cast("string"), F.lit('", "text": "t"}}')))
        .when((c("t") == "error") & (c("d") == 8), F.concat(
            F.lit('{"submission_uuid": "s'), (c("user_id") % 40).cast("string"),
            F.lit('", "parts": [{"feedback": "ok", "option": {"points": '), (c("k") % 4).cast("string"), F.lit("}}]}")))
        .otherwise(F.lit("{}"))
    )
    modes = F.element_at(F.array(F.lit("honor"), F.lit("verified"), F.lit("audit")), (c("k") % 3 + 1).cast("int"))
    check = c("t") == "click"
    # inlined through a one-element array: each derived column is computed once per row
    # instead of being copied into every condition that later reads it
    row = F.struct(
        c("event_id"), c("course_id"), c("time"),
        F.when(c("k") == 99, F.lit("")).otherwise(F.concat(F.lit("u"), c("user_id").cast("string"))).alias("username"),
        _ip(c("user_id"), c("k") % 4).alias("ip"),
        F.when(c("t") == "view", "browser").otherwise("server").alias("event_source"),
        et.alias("event_type"), module.alias("module_id"), F.lit(None).cast("string").alias("page"),
        event.alias("event"),
        F.struct(c("user_id").alias("user_id"), F.lit(None).cast("string").alias("path")).alias("context"),
        F.struct(
            F.when((c("t") == "signup") & (c("k") % 5 != 0), c("user_id")).alias("user_id"),
            F.when(c("t") == "signup", modes).alias("mode"),
            F.when(check, F.concat(F.lit("i4x://"), problem)).alias("problem"),
            F.when(check, F.concat(F.lit("choice_"), (c("k") % 5).cast("string"))).alias("answers"),
            F.when(check, F.when(c("value") > 20, "correct").otherwise("incorrect")).alias("success"),
            F.when(check, F.when(c("value") > 20, 1.0).otherwise(0.0)).alias("grade"),
            F.when(check, c("event_id") % 4 + 1).alias("attempts"),
            F.lit(None).cast("string").alias("query"), F.lit(None).cast("string").alias("GET"),
        ).alias("event_struct"),
    )
    return ev.select(F.inline(F.array(row)))


def log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The course log as a file stream."""
    schema = load(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return tracking_log(spark, sf_dir, files)


def person_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with order totals and nation as course profiles; even users take two courses."""
    orders = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("no"), F.min("o_orderdate").cast("timestamp").alias("start_time"),
        F.max("o_orderdate").cast("timestamp").alias("last_event"), F.sum("o_totalprice").alias("spent"),
    )
    nation = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    c = F.col
    base = (
        load(spark, sf_dir, "customer").join(orders, c("c_custkey") == c("o_custkey"), "left")
        .join(nation, c("c_nationkey") == c("n_nationkey"), "left")
        .withColumn("j", F.explode(F.when(c("c_custkey") % 2 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    )
    # whole cents, so that the share is cut at four digits without rounding ties
    share = F.floor((F.round(c("c_acctbal") * 100).cast("long") + 100000) / F.lit(110)).cast("long")
    u = c("c_custkey")
    base = base.withColumn("g", F.when(c("j") == 0, share).otherwise(10000 - share) / F.lit(10000.0)).withColumn(
        "mode", F.when(c("c_mktsegment") == "MACHINERY", "verified").when(c("c_mktsegment") == "AUTOMOBILE", "audit")
        .otherwise("honor"))
    no = F.coalesce(c("no"), F.lit(0))
    return base.select(
        _course(_div(u, 30) + c("j")).alias("course_id"), u.alias("user_id"),
        F.concat(F.lit("u"), u.cast("string")).alias("username"),
        F.concat(F.lit("user"), u.cast("string"), F.lit("@d"), (u % 9).cast("string"), F.lit(".org")).alias("email"),
        (c("g") > 0.1).alias("viewed"), (c("g") > 0.4).alias("explored"), (c("g") > 0.65).alias("certified"),
        (c("g") > 0.6).alias("completed"), c("g").alias("grade"), c("mode"), (no % 2).alias("is_active"),
        _ip(u, u % 4).alias("ip"), F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("cc_by_ip"),
        c("n_name").alias("countryLabel"), c("r_name").alias("continent"),
        F.when(u % 3 == 0, "m").when(u % 3 == 1, "f").otherwise(F.lit(None)).alias("gender"),
        F.when(u % 5 == 0, "b").when(u % 5 == 1, "m").when(u % 5 == 2, "p").when(u % 5 == 3, "hs").alias("LoE"),
        F.when(u % 11 != 0, 1950 + u % 50).alias("YoB"),
        c("start_time"), c("start_time").alias("first_event"), c("last_event"),
        F.when(u % 23 == 0, "Staff").otherwise("Student").alias("roles"),
        F.when(u % 23 != 0, 1).alias("forumRoles_isStudent"),
        F.when((c("mode") == "verified") & (u % 4 != 1), c("start_time") + F.expr("INTERVAL 10 DAYS")).alias("verified_enroll_time"),
        F.when((c("mode") == "verified") & (u % 8 == 0), c("start_time") + F.expr("INTERVAL 40 DAYS")).alias("verified_unenroll_time"),
        (no * 10).alias("nevents"), (no % 8).alias("nplay_video"), (no % 6).alias("nproblem_check"),
        (u % 7).alias("nforum_posts"), (u % 4).alias("nchapters"), (no + u % 3).alias("ndays_act"),
        F.round(c("spent") / 1000, 3).alias("sum_dt"), (u % 5 * 3).alias("nforum_events"),
        (no % 5).alias("nshow_answer"), (no % 3).alias("nprogcheck"), (u % 6).alias("nforum_votes"),
        (u % 2).alias("nforum_endorsed"), (u % 3).alias("nforum_threads"), (u % 5).alias("nforum_comments"),
        F.lit(0).alias("nforum_pinned"), (no % 7).alias("npause_video"), (no % 9).alias("nseq_goto"),
        F.round(c("spent") / (no * 1000), 3).alias("avg_dt"), F.lit(True).alias("registered"),
    )


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (course, user, problem, item): the last answer given."""
    c = F.col
    li = load(spark, sf_dir, "lineitem").join(
        load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), c("l_orderkey") == c("o_orderkey"))
    li = li.select(
        c("o_custkey").alias("user_id"), _two(c("l_partkey") % 20).alias("pp"), (c("l_linenumber") % 3 + 2).alias("item"),
        c("l_quantity").alias("q"), (c("l_partkey") % 4).alias("choice"), c("l_shipdate").cast("timestamp").alias("ship"),
        F.struct("l_shipdate", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity").alias("ord"),
    )
    return (
        li.groupBy("user_id", "pp", "item")
        .agg(F.max_by("q", "ord").alias("q"), F.max_by("choice", "ord").alias("choice"),
             F.count(F.lit(1)).alias("attempts"), F.max("ship").alias("created"))
        .select(
            _course(_div("user_id", 30)).alias("course_id"), "user_id",
            F.concat(F.lit("p"), c("pp")).alias("problem_url_name"),
            F.concat(F.lit("p"), c("pp"), F.lit("_"), c("item").cast("string"), F.lit("_1")).alias("answer_id"),
            F.concat(F.lit("choice_"), c("choice").cast("string")).alias("response"),
            (c("q") > 20).alias("correct_bool"), F.when(c("q") > 20, 1.0).otherwise(0.0).alias("npoints"),
            "attempts", "created",
        )
    )


def problem_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``answers`` folded to one row per (course, user, problem) with an item array."""
    c = F.col
    return answers(spark, sf_dir).groupBy("course_id", "user_id", "problem_url_name").agg(
        F.array_sort(F.collect_list(F.struct(
            "answer_id", "response", F.when(c("correct_bool"), "correct").otherwise("incorrect").alias("correctness"),
            "correct_bool", "npoints"))).alias("item"),
        F.max("attempts").alias("attempts"), F.lit(True).alias("done"), F.sum("npoints").alias("grade"),
        F.lit(3.0).alias("max_grade"), F.max("created").alias("created"),
    )


def course_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as content elements: 20 problems, 8 videos, 4 chapters, 8 sequentials per course."""
    c = F.col
    p = load(spark, sf_dir, "part").withColumn("q", c("p_partkey") % 40).withColumn("cidx", _div("p_partkey", 40))
    kind = (
        F.when(c("q") < 20, "problem").when(c("q") < 28, "video").when(c("q") < 32, "chapter").otherwise("sequential"))
    p = p.withColumn("category", kind).withColumn(
        "s", F.when(c("q") < 20, c("q") % 8).when(c("q") < 28, c("q") - 20).when(c("q") >= 32, c("q") - 32))
    p = p.withColumn("ch", F.when(c("category") == "chapter", c("q") - 28).otherwise(_div("s", 2)))
    seq_index = c("ch") * 100 + 10 + (c("s") % 2) * 40
    p = p.withColumn("url_name", F.when(c("category") == "problem", F.concat(F.lit("p"), _two(c("q"))))
                     .when(c("category") == "video", F.concat(F.lit("v"), c("s").cast("string")))
                     .when(c("category") == "chapter", F.concat(F.lit("ch"), c("ch").cast("string")))
                     .otherwise(F.concat(F.lit("sq"), c("s").cast("string"))))
    ch = F.concat(F.lit("ch"), c("ch").cast("string"))
    sq = F.concat(F.lit("sq"), c("s").cast("string"))
    p = p.withColumn("ix", F.when(c("category") == "chapter", c("ch") * 100).when(c("category") == "sequential", seq_index)
                     .when(c("category") == "video", seq_index + 9).otherwise(seq_index + 1 + _div("q", 8)))
    path = (F.when(c("category") == "chapter", F.concat(F.lit("/"), ch))
            .when(c("category") == "sequential", F.concat(F.lit("/"), ch, F.lit("/"), sq))
            .otherwise(F.concat(F.lit("/"), ch, F.lit("/"), sq, F.lit("/"), c("url_name"))))
    graded = (c("category") == "problem") & (c("s") != 7)
    itype = F.element_at(F.create_map(*[F.lit(x) for x in (
        "STANDARD", "multiplechoiceresponse", "PROMO", "choiceresponse", "LARGE", "numericalresponse",
        "SMALL", "optionresponse", "ECONOMY", "customresponse", "MEDIUM", "stringresponse")]), c("p_type"))
    return p.select(
        _course(c("cidx")).alias("course_id"), c("ix").alias("index"), "url_name", "category",
        F.when(graded, F.element_at(F.array(F.lit("Homework"), F.lit("Lab"), F.lit("Exam")), (c("s") % 3 + 1).cast("int"))).alias("gformat"),
        F.to_timestamp(F.lit("1998-01-01")).alias("start"),
        F.when(graded, F.timestamp_seconds(F.lit(883612800) + c("s") * 604800 * 10)).alias("due"),
        c("p_name").alias("name"), path.alias("path"),
        F.concat(_org(c("cidx")), F.lit("/"), c("category"), F.lit("/"), c("url_name")).alias("module_id"),
        F.struct(
            F.when(c("category") == "video", F.concat(F.lit("1.00:yt"), c("p_partkey").cast("string"))).alias("ytid"),
            F.when(c("category") == "problem", (c("p_size") % 3 + 1).cast("double")).alias("weight"),
            F.when(c("category") == "problem", itype).alias("itype"),
            F.when(c("category") == "problem", F.lit(3)).alias("num_items"),
        ).alias("data"),
        F.when(c("category") != "chapter", F.concat(_org(c("cidx")), F.lit("/chapter/"), ch)).alias("chapter_mid"),
        F.when(graded, "true").alias("graded"),
        F.when(c("category") == "chapter", F.lit(None)).when(c("category") == "sequential", ch).otherwise(sq).alias("parent"),
    )


def forum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` as posts: turn 0 opens a thread, odd turns respond, even turns comment."""
    c = F.col
    f = load(spark, sf_dir, "conversations").withColumn("cidx", _div("conv_id", 20))
    thread = F.concat(F.lit("T"), c("conv_id").cast("string"))
    post = lambda turn: F.when(turn == 0, thread).otherwise(F.concat(thread, F.lit("_"), turn.cast("string")))
    return f.select(
        _course(c("cidx")).alias("course_id"), post(c("turn")).alias("mongoid"),
        F.when(c("turn") == 0, "CommentThread").otherwise("Comment").alias("_type"),
        F.concat(F.lit("u"), (c("cidx") * 30 + (c("conv_id") * 7 + c("turn")) % 30).cast("string")).alias("author_username"),
        F.when(c("turn") > 0, thread).alias("comment_thread_id"),
        F.when((c("turn") > 0) & (c("turn") % 2 == 0), post(c("turn") - 1)).alias("parent_id"),
        F.when(c("turn") == 0, F.substring("text", 1, 30)).alias("title"), c("text").alias("body"),
        F.timestamp_seconds(F.lit(1704067200) + c("conv_id") * 3600 + c("turn") * 60).alias("created_at"),
    )


def geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as address ranges with gaps."""
    c = F.col
    first = F.lit(167772160) + c("n_nationkey").cast("long") * 10 * 65536
    return load(spark, sf_dir, "nation").select(
        first.alias("startIpNum"), (first + 7 * 65536 + 65535).alias("endIpNum"),
        F.concat(F.lit("N"), c("n_nationkey").cast("string")).alias("country"), c("n_name").alias("countryLabel"),
    )


SQL = {
    "ev0": """SELECT event_id, user_id, value, event_type AS t, CAST(json_extract_string(props,'$.k') AS BIGINT) AS k,
        date_trunc('day', ts) + to_microseconds((epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 24) AS time FROM events""",
    "ev1": """SELECT *, user_id//30 + k//70 AS cidx, k%10 AS d FROM ev0""",
    "ev2": """SELECT *, 'Org'||(cidx%3)||'/C'||cidx AS org, 'Org'||(cidx%3)||'/C'||cidx||'/T1' AS course_id,
        'T'||(cidx*20+k%20) AS thread FROM ev1""",
    "log": """SELECT event_id, course_id, time, CASE WHEN k=99 THEN '' ELSE 'u'||user_id END AS username, user_id,
        '10.'||((user_id%40)*6)||'.'||((user_id//160)%250)||'.'||(k%4) AS ip,
        CASE WHEN t='view' THEN 'browser' ELSE 'server' END AS event_source,
        CASE WHEN t='view' THEN CASE WHEN d<=3 THEN 'play_video' WHEN d=4 THEN 'pause_video' WHEN d=5 THEN 'stop_video'
               WHEN d=6 THEN 'seek_video' WHEN d=7 THEN 'show_transcript'
               WHEN d=8 THEN '/courses/'||course_id||'/xblock/i4x:;_;_Org;_C;_video;_v'||(k%8)||'/handler/transcript/translation/'
                 ||CASE (k//10)%3 WHEN 0 THEN 'fr' WHEN 1 THEN 'es' ELSE 'zh' END
               ELSE 'edx.ui.lms.link_clicked' END
             WHEN t='click' THEN CASE WHEN d<=5 THEN 'problem_check' WHEN d=6 THEN 'save_problem_check' WHEN d=7 THEN 'problem_show'
               WHEN d=8 THEN 'problem_reset' ELSE 'seq_goto' END
             WHEN t='purchase' THEN CASE WHEN k%2=0 THEN 'showanswer' ELSE 'show_answer' END
             WHEN t='signup' THEN 'edx.course.enrollment.'||CASE k%4 WHEN 0 THEN 'activated' WHEN 1 THEN 'deactivated'
               WHEN 2 THEN 'mode_changed' ELSE 'upgrade.succeeded' END
             ELSE CASE d WHEN 0 THEN '/courses/'||course_id||'/discussion/forum/gen/threads/'||thread
               WHEN 1 THEN 'edx.forum.thread.created' WHEN 2 THEN '/courses/'||course_id||'/discussion/threads/'||thread||'/reply'
               WHEN 3 THEN '/courses/'||course_id||'/discussion/threads/'||thread||'/upvote'
               WHEN 4 THEN '/courses/'||course_id||'/progress' WHEN 5 THEN 'textbook.pdf.page.loaded'
               WHEN 6 THEN '/courses/'||course_id||'/wiki/page'||k WHEN 7 THEN 'openassessmentblock.create_submission'
               WHEN 8 THEN 'openassessmentblock.peer_assess'
               ELSE '/courses/'||course_id||'/discussion/threads/'||thread||'/follow' END END AS event_type,
        CASE WHEN t IN ('click','purchase') THEN org||'/problem/p'||lpad(CAST(k%20 AS VARCHAR),2,'0')
             WHEN t='view' AND d<=7 THEN org||'/video/v'||(k%8) END AS module_id,
        t, k, d, value, thread, k%8 AS vid,
        CASE WHEN t='view' AND d<>9 THEN value END AS cur, CASE WHEN t='view' AND d<>9 AND k%3<>0 THEN 1.5 END AS speed,
        CASE WHEN t='signup' AND k%5<>0 THEN user_id END AS es_user_id,
        CASE WHEN t='signup' THEN CASE k%3 WHEN 0 THEN 'honor' WHEN 1 THEN 'verified' ELSE 'audit' END END AS mode,
        CASE WHEN t='click' THEN 'choice_'||(k%5) END AS answers,
        CASE WHEN t='click' THEN CASE WHEN value>20 THEN 'correct' ELSE 'incorrect' END END AS success,
        CASE WHEN t='click' THEN CASE WHEN value>20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END END AS grade,
        CASE WHEN t='click' THEN event_id%4+1 END AS attempts FROM ev2""",
    "ord1": """SELECT o_custkey, count(*) AS no, min(o_orderdate) AS start_time, max(o_orderdate) AS last_event,
        sum(o_totalprice) AS spent FROM orders GROUP BY 1""",
    "pc0": """SELECT c.*, o.*, n.*, r.*, j, CASE WHEN j=0 THEN (CAST(round(c_acctbal*100) AS BIGINT)+100000)//110
        ELSE 10000-(CAST(round(c_acctbal*100) AS BIGINT)+100000)//110 END::DOUBLE/10000.0::DOUBLE AS g,
        CASE WHEN c_mktsegment='MACHINERY' THEN 'verified' WHEN c_mktsegment='AUTOMOBILE' THEN 'audit' ELSE 'honor' END AS mode
        FROM customer c LEFT JOIN ord1 o ON c_custkey=o_custkey LEFT JOIN nation n ON c_nationkey=n_nationkey
        LEFT JOIN region r ON n_regionkey=r_regionkey CROSS JOIN (SELECT unnest([0,1]) AS j) WHERE j=0 OR c_custkey%2=0""",
    "pc": """SELECT 'Org'||((c_custkey//30+j)%3)||'/C'||(c_custkey//30+j)||'/T1' AS course_id, c_custkey AS user_id,
        'u'||c_custkey AS username, 'user'||c_custkey||'@d'||(c_custkey%9)||'.org' AS email,
        g>0.1 AS viewed, g>0.4 AS explored, g>0.65 AS certified, g>0.6 AS completed, g AS grade, mode,
        coalesce(no,0)%2 AS is_active,
        '10.'||((c_custkey%40)*6)||'.'||((c_custkey//160)%250)||'.'||(c_custkey%4) AS ip,
        'N'||n_nationkey AS cc_by_ip, n_name AS countryLabel, r_name AS continent,
        CASE c_custkey%3 WHEN 0 THEN 'm' WHEN 1 THEN 'f' END AS gender,
        CASE c_custkey%5 WHEN 0 THEN 'b' WHEN 1 THEN 'm' WHEN 2 THEN 'p' WHEN 3 THEN 'hs' END AS LoE,
        CASE WHEN c_custkey%11<>0 THEN 1950+c_custkey%50 END AS YoB,
        start_time, start_time AS first_event, last_event,
        CASE WHEN c_custkey%23=0 THEN 'Staff' ELSE 'Student' END AS roles,
        CASE WHEN c_custkey%23<>0 THEN 1 END AS forumRoles_isStudent,
        CASE WHEN mode='verified' AND c_custkey%4<>1 THEN start_time + INTERVAL 10 DAY END AS verified_enroll_time,
        CASE WHEN mode='verified' AND c_custkey%8=0 THEN start_time + INTERVAL 40 DAY END AS verified_unenroll_time,
        coalesce(no,0)*10 AS nevents, coalesce(no,0)%8 AS nplay_video, coalesce(no,0)%6 AS nproblem_check,
        c_custkey%7 AS nforum_posts, c_custkey%4 AS nchapters, coalesce(no,0)+c_custkey%3 AS ndays_act,
        round(spent/1000,3) AS sum_dt, c_custkey%5*3 AS nforum_events, coalesce(no,0)%5 AS nshow_answer,
        coalesce(no,0)%3 AS nprogcheck, c_custkey%6 AS nforum_votes, c_custkey%2 AS nforum_endorsed,
        c_custkey%3 AS nforum_threads, c_custkey%5 AS nforum_comments, 0 AS nforum_pinned, coalesce(no,0)%7 AS npause_video,
        coalesce(no,0)%9 AS nseq_goto, round(spent/(no*1000),3) AS avg_dt, true AS registered FROM pc0""",
    "ans0": """SELECT o_custkey AS user_id, lpad(CAST(l_partkey%20 AS VARCHAR),2,'0') AS pp, l_linenumber%3+2 AS item,
        l_quantity AS q, l_partkey%4 AS choice, l_shipdate, row_number() OVER (PARTITION BY o_custkey, l_partkey%20, l_linenumber%3
        ORDER BY l_shipdate DESC, l_orderkey DESC, l_partkey DESC, l_linenumber DESC, l_quantity DESC) AS rn,
        count(*) OVER (PARTITION BY o_custkey, l_partkey%20, l_linenumber%3) AS attempts
        FROM lineitem JOIN orders ON l_orderkey=o_orderkey""",
    "ans": """SELECT 'Org'||((user_id//30)%3)||'/C'||(user_id//30)||'/T1' AS course_id, user_id, 'p'||pp AS problem_url_name,
        'p'||pp||'_'||item||'_1' AS answer_id, 'choice_'||choice AS response, q>20 AS correct_bool,
        CASE WHEN q>20 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS npoints, attempts, l_shipdate AS created FROM ans0 WHERE rn=1""",
    "pa": """SELECT course_id, user_id, problem_url_name, count(*) AS nitems, max(attempts) AS attempts, sum(npoints) AS grade,
        3.0::DOUBLE AS max_grade, max(created) AS created FROM ans GROUP BY 1,2,3""",
    "ax0": """SELECT *, p_partkey%40 AS q, p_partkey//40 AS cidx, CASE WHEN p_partkey%40<20 THEN 'problem' WHEN p_partkey%40<28 THEN 'video'
        WHEN p_partkey%40<32 THEN 'chapter' ELSE 'sequential' END AS category,
        CASE WHEN p_partkey%40<20 THEN (p_partkey%40)%8 WHEN p_partkey%40<28 THEN p_partkey%40-20
             WHEN p_partkey%40>=32 THEN p_partkey%40-32 END AS s FROM part""",
    "ax1": """SELECT *, CASE WHEN category='chapter' THEN q-28 ELSE s//2 END AS ch FROM ax0""",
    "axis": """SELECT 'Org'||(cidx%3)||'/C'||cidx||'/T1' AS course_id,
        CASE category WHEN 'chapter' THEN ch*100 WHEN 'sequential' THEN ch*100+10+(s%2)*40 WHEN 'video' THEN ch*100+19+(s%2)*40
             ELSE ch*100+11+(s%2)*40+q//8 END AS index,
        CASE category WHEN 'problem' THEN 'p'||lpad(CAST(q AS VARCHAR),2,'0') WHEN 'video' THEN 'v'||s WHEN 'chapter' THEN 'ch'||ch ELSE 'sq'||s END AS url_name,
        category, CASE WHEN category='problem' AND s<>7 THEN CASE s%3 WHEN 0 THEN 'Homework' WHEN 1 THEN 'Lab' ELSE 'Exam' END END AS gformat,
        TIMESTAMP '1998-01-01' AS start, CASE WHEN category='problem' AND s<>7 THEN make_timestamp((883612800+s*6048000)*1000000) END AS due,
        p_name AS name,
        CASE category WHEN 'chapter' THEN '/ch'||ch WHEN 'sequential' THEN '/ch'||ch||'/sq'||s
             WHEN 'problem' THEN '/ch'||ch||'/sq'||s||'/p'||lpad(CAST(q AS VARCHAR),2,'0') ELSE '/ch'||ch||'/sq'||s||'/v'||s END AS path,
        'Org'||(cidx%3)||'/C'||cidx||'/'||category||'/'||CASE category WHEN 'problem' THEN 'p'||lpad(CAST(q AS VARCHAR),2,'0')
             WHEN 'video' THEN 'v'||s WHEN 'chapter' THEN 'ch'||ch ELSE 'sq'||s END AS module_id,
        CASE WHEN category='video' THEN '1.00:yt'||p_partkey END AS ytid,
        CASE WHEN category='problem' THEN (p_size%3+1)::DOUBLE END AS weight,
        CASE WHEN category='problem' THEN CASE p_type WHEN 'STANDARD' THEN 'multiplechoiceresponse' WHEN 'PROMO' THEN 'choiceresponse'
             WHEN 'LARGE' THEN 'numericalresponse' WHEN 'SMALL' THEN 'optionresponse' WHEN 'ECONOMY' THEN 'customresponse'
             ELSE 'stringresponse' END END AS itype,
        CASE WHEN category='problem' THEN 3 END AS num_items,
        CASE WHEN category<>'chapter' THEN 'Org'||(cidx%3)||'/C'||cidx||'/chapter/ch'||ch END AS chapter_mid,
        CASE WHEN category='problem' AND s<>7 THEN 'true' END AS graded,
        CASE category WHEN 'chapter' THEN NULL WHEN 'sequential' THEN 'ch'||ch ELSE 'sq'||s END AS parent FROM ax1""",
    "forum": """SELECT 'Org'||((conv_id//20)%3)||'/C'||(conv_id//20)||'/T1' AS course_id,
        CASE WHEN turn=0 THEN 'T'||conv_id ELSE 'T'||conv_id||'_'||turn END AS mongoid,
        CASE WHEN turn=0 THEN 'CommentThread' ELSE 'Comment' END AS _type,
        'u'||((conv_id//20)*30+(conv_id*7+turn)%30) AS author_username, CASE WHEN turn>0 THEN 'T'||conv_id END AS comment_thread_id,
        CASE WHEN turn>0 AND turn%2=0 THEN 'T'||conv_id||'_'||(turn-1) END AS parent_id,
        CASE WHEN turn=0 THEN substr(text,1,30) END AS title, text AS body,
        make_timestamp((1704067200+conv_id*3600+turn*60)*1000000) AS created_at FROM conversations""",
    "geo": """SELECT 167772160+n_nationkey::BIGINT*655360 AS startIpNum, 167772160+n_nationkey::BIGINT*655360+524287 AS endIpNum,
        'N'||n_nationkey AS country, n_name AS countryLabel FROM nation""",
}

NEEDS = {
    "log": ["ev0", "ev1", "ev2"], "pc": ["ord1", "pc0"], "ans": ["ans0"], "pa": ["ans0", "ans"], "axis": ["ax0", "ax1"],
}


def sql(names: str, body: str, extra: str = "") -> str:
    """A checking query: the named canonical tables as leading CTEs, then ``body``."""
    wanted: list[str] = []
    for name in names.split():
        for part in [*NEEDS.get(name, []), name]:
            if part not in wanted:
                wanted.append(part)
    ctes = ", ".join(f"{n} AS ({SQL[n]})" for n in wanted)
    return f"WITH {ctes}{', ' + extra if extra else ''} {body}"


def rounded(query: str, columns: str, digits: int = 6) -> str:
    """``query`` with the named columns rounded."""
    swaps = ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({swaps}) FROM ({query})"
