"""Registered queries over readers, cleaning steps and writers."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T_

from cohortkit import schema as S
from cohortkit.functions import keys as K, modules as M, text as X
from cohortkit.plans.event_queries import ts
from cohortkit.plans.registry import query
from cohortkit.session import scratch_path
from cohortkit.sources import dumps as D, logs as L, sinks as SK, testdata as T
from cohortkit.sources.testdata import sql

c = F.col
LINE_FIELDS = ["course_id", "time", "username", "ip", "event_source", "event_type", "event"]


def keyed_log(spark, d):
    """The log with the event's own number ``k``."""
    ev = T.load(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))
    return T.tracking_log(spark, d).join(ev, "event_id", "inner")


def json_lines(spark, d):
    """Log rows as JSON lines, some with a syslog prefix, some broken."""
    log = keyed_log(spark, d)
    line = F.to_json(F.struct(*LINE_FIELDS), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return log.select("event_id", F.when(c("k") % 11 == 0, F.substring(line, 1, 30)).when(c("k") % 7 == 0, F.concat(F.lit("Dec  1 00:00:00 localhost "), line)).otherwise(line).alias("value"))


@query("I1_read_event_log", sql("log", f"SELECT course_id, {ts('time')}, username, ip, event_source, event_type FROM log WHERE k%11<>0"))
def read_event_log(spark, d):
    return L.parse_log_lines(json_lines(spark, d)).select("course_id", "time", "username", "ip", "event_source", "event_type")


@query("I2_resolve_course_id", sql("log", "SELECT event_id, CASE WHEN k%5=4 THEN NULL ELSE course_id END AS course_id FROM log"))
def resolve_course_id(spark, d):
    log, k, cid = keyed_log(spark, d), c("k") % 5, c("course_id")
    opaque = F.concat(F.lit("course-v1:"), F.translate(cid, "/", "+"))
    df = log.select(
        "event_id", F.when(k == 0, cid).alias("course_id"), F.struct(F.when(k == 1, opaque).alias("course_id")).alias("context"),
        F.when(k == 2, "browser").otherwise("server").alias("event_source"),
        F.when(k == 2, F.concat(F.lit("https://x.org/courses/"), cid, F.lit("/info"))).alias("page"),
        F.when(k == 3, F.concat(F.lit("/courses/"), cid, F.lit("/about"))).otherwise("x").alias("event_type"))
    return L.resolve_course_id(df).select("event_id", "course_id")


@query("I3_write_event_log", sql("log", """SELECT course_id, strftime(time - INTERVAL 5 HOUR,'%Y-%m-%d') AS date, count(*) AS n FROM log GROUP BY 1,2"""))
def write_event_log(spark, d):
    path = scratch_path(spark, "event-log")
    log = T.tracking_log(spark, d).select("course_id", "time", "username", "event_type", "event")
    L.write_event_log(log, path, "America/New_York")
    return L.over_folders(spark, path, L.with_date(log, "America/New_York").schema, lambda part: part.groupBy("course_id", "date").agg(F.count(F.lit(1)).alias("n")))


_KNOWN = "t='signup' OR (t='view' AND (d<=3 OR d=6)) OR (t='purchase' AND k%2=1)"


@query("I4_rephrase_events", sql("log", f"""SELECT event_id, event_type, CASE WHEN t='click' AND d<=8 THEN 'a_b,child_id' WHEN t='click' THEN '' WHEN {_KNOWN} THEN 'GET,other' ELSE 'GET' END AS payload_keys,
 CASE WHEN t='click' THEN NULL ELSE '{{"q":"1"}}' END AS get_value, '{{"oldagent":"ua","client":"app"}}' AS agent, '{{"old_mongoid":"m'||event_id||'","referer":"r"'||CASE WHEN t='click' AND d<=8 THEN ',"content":"c"}}'
 WHEN t='click' THEN ',"num_attempts":"3"}}' ELSE '}}' END AS mongoid, k%2=0 AS has_user, CASE WHEN k%3=0 THEN '{{"new_field":"5","other_new":"{{\\"a\\":[1]}}"}}' END AS unlisted FROM log"""))
def rephrase_events(spark, d):
    log = keyed_log(spark, d)
    click = ~c("event_type").startswith("/") & (c("event_type").contains("problem_") | (c("event_type") == "seq_goto"))
    q = lambda x: F.lit(f'"{x}"')
    is_click = click & (c("event_source") == "server")
    event = F.when(is_click & c("event_type").contains("problem_"), F.lit('{"a-b": "x", "child-id": {"z": 1}, "content": "c"}')).when(
        is_click, F.lit('{"num_attempts": 3}')).otherwise(F.lit('{"GET": {"q":"1"}, "other": 5}'))
    user = F.when(c("k") % 2 == 0, c("context.user_id").cast("string")).otherwise(F.lit(""))
    line = F.concat(F.lit('{"_id": {"$oid": "m'), c("event_id").cast("string"), F.lit('"}, "event_type": "'), c("event_type"), F.lit('", "event_source": "server", "referer": "r", "course_id": "'),
                    c("course_id"), F.lit('", "time": "2024-01-01T00:00:00Z", "context": {"user_id": "'), user, F.lit('", "client": "app", "agent": "ua"}, "event": '), event, F.when(c("k") % 3 == 0, F.lit(', "new_field": 5, "other_new": {"a": [1]}}')).otherwise(F.lit("}")))
    out = L.rephrase_events(log.select(line.alias("value")))
    return out.select(
        F.substring(F.get_json_object("mongoid", "$.old_mongoid"), 2, 20).cast("long").alias("event_id"), "event_type",
        F.array_join(F.array_sort(F.map_keys("event_struct")), ",").alias("payload_keys"), c("event_struct")["GET"].alias("get_value"),
        c("context")["agent"].alias("agent"), "mongoid", c("context")["user_id"].isNotNull().alias("has_user"), "unlisted")


@query("I5_add_module_id", sql("log", """SELECT event_id, CASE k%8 WHEN 0 THEN org||'/video/b'||k WHEN 1 THEN org||'/forum/T'||k WHEN 2 THEN org||'/jump_to_id/j'||k WHEN 3 THEN org||'/problem/q'||k
 WHEN 4 THEN org||'/sequential/s'||k||'/' WHEN 5 THEN org||'/html/h'||k WHEN 6 THEN org||'/problem/p'||k END AS module_id FROM (SELECT *, split_part(course_id,'/',1)||'/'||split_part(course_id,'/',2) AS org FROM log)"""))
def add_module_id(spark, d):
    log, k = keyed_log(spark, d), c("k").cast("string")
    parts = F.split("course_id", "/")
    o, n, r = parts[0], parts[1], parts[2]
    run = F.concat(F.lit("course-v1:"), o, F.lit("+"), n, F.lit("+"), r)
    block = lambda t, x: F.concat(F.lit("block-v1:"), o, F.lit("+"), n, F.lit("+"), r, F.lit(f"+type@{t}+block@"), x)
    base, m = F.concat(F.lit("/courses/"), c("course_id")), c("k") % 8
    et = (F.when(m == 0, F.concat(F.lit("/courses/"), run, F.lit("/xblock/"), block("video", F.concat(F.lit("b"), k)), F.lit("/handler")))
          .when(m == 1, F.concat(base, F.lit("/discussion/threads/T"), k)).when(m == 2, F.concat(base, F.lit("/jump_to_id/j"), k))
          .when(m == 3, "problem").when(m == 4, F.concat(base, F.lit("/courseware/c/s"), k, F.lit("/"))).otherwise("x"))
    event = (F.when(m == 3, F.concat(F.lit("input_i4x-"), o, F.lit("-"), n, F.lit("-problem-q"), k, F.lit("_2_1=choice_1")))
             .when(m == 5, F.concat(F.lit('{"id": "'), block("html", F.concat(F.lit("h"), k)), F.lit('"}')))
             .when(m == 6, F.concat(F.lit('{"problem_id": "i4x://'), o, F.lit("/"), n, F.lit("/problem/p"), k, F.lit('"}'))).otherwise("{}"))
    df = log.select("event_id", et.alias("event_type"), F.lit("server").alias("event_source"), F.lit("").alias("page"), F.lit("").alias("path"), event.alias("event"))
    return M.add_module_id(df).select("event_id", "module_id")


def loose_rows(spark, d):
    """Rows whose whole number is text and sometimes not a number."""
    log = keyed_log(spark, d)
    return log.select(
        c("event_id").cast("string").alias("event_id"), F.when(c("k") % 9 == 0, F.lit("x1")).otherwise(c("k").cast("string")).alias("attempts"),
        F.when(c("k") % 5 == 0, F.lit("n/a")).otherwise(F.lit("0.5")).alias("grade"))


LOOSE = T_.StructType([T_.StructField("event_id", T_.LongType()), T_.StructField("attempts", T_.LongType()), T_.StructField("grade", T_.DoubleType())])


@query("I6_conform_ok", sql("log", "SELECT event_id, k AS attempts, CASE WHEN k%5<>0 THEN 0.5::DOUBLE END AS grade FROM log WHERE k%9<>0"))
def conform_ok(spark, d):
    return S.conform(loose_rows(spark, d), LOOSE)[0]


@query("I6_conform_rejects", sql("log", "SELECT CAST(event_id AS VARCHAR) AS event_id, 'x1' AS attempts, 'attempts' AS bad FROM log WHERE k%9=0"))
def conform_rejects(spark, d):
    return S.conform(loose_rows(spark, d), LOOSE)[1].select("event_id", "attempts", F.array_join("bad_fields", ",").alias("bad"))


@query("I7_normalize_keys", sql("axis", """SELECT course_id, 'i4x://'||module_id AS module_id, 'course-v1:'||replace(course_id,'/','+') AS opaque, replace(course_id,'/','__') AS dataset FROM axis"""))
def normalize_keys(spark, d):
    ax = T.course_axis(spark, d)
    run = F.translate("course_id", "/", "+")
    df = ax.select(F.concat(F.lit("course-v1:"), run).alias("course_id"),
                   F.concat(F.lit("block-v1:"), run, F.lit("+type@"), "category", F.lit("+block@"), "url_name").alias("module_id"))
    out = K.normalize_keys(df, ["course_id"], ["module_id"])
    return out.select("course_id", "module_id", K.opaque_course_id(c("course_id")).alias("opaque"), K.dataset_name(c("course_id")).alias("dataset"))


@query("I8_course_key_version", sql("log", """SELECT course_id, CASE WHEN count(*) FILTER (k%20=0)>32 THEN 'v1' ELSE 'standard' END AS version FROM log GROUP BY 1"""))
def course_key_version(spark, d):
    log = keyed_log(spark, d)
    return L.course_key_version(log.withColumn("event_type", F.when(c("k") % 20 == 0, F.concat(F.lit("block-v1:"), "event_type")).otherwise(c("event_type"))))


@query("I9_match_course", sql("axis", """SELECT file, course_id FROM (SELECT DISTINCT replace(course_id,'/','-')||'-auth_user-prod.sql' AS file, course_id FROM axis) UNION ALL
 SELECT DISTINCT 'X-'||replace(course_id,'/','-'), NULL FROM axis"""))
def match_course(spark, d):
    courses = T.course_axis(spark, d).select("course_id").distinct()
    name = F.translate("course_id", "/", "-")
    files = courses.select(F.explode(F.array(F.concat(name, F.lit("-auth_user-prod.sql")), F.concat(F.lit("X-"), name))).alias("file"))
    return D.match_course(files, courses)


def read_back_dump(spark, d):
    """Customers written as a tab-separated dump with NULL marks."""
    path = scratch_path(spark, "sql-dump")
    cust = T.load(spark, d, "customer").select("c_custkey", "c_mktsegment", F.when(c("c_custkey") % 7 != 0, c("c_nationkey")).alias("c_nationkey"))
    cust.write.option("sep", "\t").option("header", True).option("nullValue", "NULL").csv(path)
    return D.read_sql_dump(spark, path, "c_custkey bigint, c_mktsegment string, c_nationkey int")


@query("I9_read_sql_dump", "SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey%7<>0 THEN c_nationkey END AS c_nationkey FROM customer")
def read_sql_dump(spark, d):
    return read_back_dump(spark, d)


@query("I10_rephrase_forum", sql("forum", f"""SELECT mongoid, _type, length(author_username) AS author_id, author_username, comment_thread_id, parent_id,
 CASE WHEN parent_id IS NOT NULL THEN comment_thread_id||' '||parent_id ELSE '' END AS parent_ids, {ts('created_at')}, length(body)%3=0 AS pinned, length(body)%5 AS votes_count, title FROM forum"""))
def rephrase_forum(spark, d):
    f = T.forum(spark, d)
    oid = lambda x: F.concat(F.lit('{"$oid": "'), x, F.lit('"}'))
    quoted = F.to_json(F.struct(c("title").alias("title")))
    ms = F.unix_millis("created_at").cast("string")
    date = F.when(F.length("body") % 2 == 0, ms).otherwise(F.concat(F.lit('"'), F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('Z"')))
    line = F.concat(
        F.lit('{"_id": '), oid(c("mongoid")), F.lit(', "_type": "'), "_type", F.lit('", "author_id": "'), F.length("author_username").cast("string"), F.lit('", "author_username": "'), "author_username",
        F.lit('", "created_at": {"$date": '), date, F.lit('}, "pinned": '), (F.length("body") % 3 == 0).cast("string"), F.lit(', "votes": {"count": '), (F.length("body") % 5).cast("string"), F.lit(', "up": []}'),
        F.coalesce(F.concat(F.lit(', "comment_thread_id": '), oid(c("comment_thread_id"))), F.lit("")),
        F.coalesce(F.concat(F.lit(', "parent_id": '), oid(c("parent_id")), F.lit(', "parent_ids": ['), oid(c("comment_thread_id")), F.lit(", "), oid(c("parent_id")), F.lit("]")), F.lit(', "parent_ids": []')),
        F.coalesce(F.concat(F.lit(", "), F.substr(quoted, F.lit(2), F.length(quoted) - 2)), F.lit("")).alias("x"), F.lit(', "context": "c", "endorsement": null}'))
    line = F.replace(line, F.lit(', , '), F.lit(", "))
    line = F.replace(line, F.lit(', "context"'), F.lit(', "context"'))
    out = D.rephrase_forum(f.select(line.alias("value")))
    return out.select("mongoid", "_type", "author_id", "author_username", "comment_thread_id", "parent_id", F.coalesce("parent_ids", F.lit("")).alias("parent_ids"), "created_at", "pinned", "votes_count", "title")


@query("I11_grades_persistent", sql("pc", f"SELECT course_id, user_id, grade, CASE WHEN certified THEN strftime(start_time,'%Y-%m-%d %H:%M:%S.%f') END AS passed_timestamp FROM pc"))
def grades_persistent(spark, d):
    pc = T.person_course(spark, d)
    raw = pc.select(F.concat(F.lit("course-v1:"), F.translate("course_id", "/", "+")).alias("course_id"), "user_id", "grade",
                    F.when(c("certified"), F.date_format("start_time", "yyyy-MM-dd HH:mm:ss")).otherwise("NULL").alias("passed_timestamp"))
    return D.load_grades_persistent(raw)


@query("I12_infer_event_schema", sql("log", """SELECT * FROM (SELECT 'attempts' AS path, 'BIGINT' AS types, count(*) AS n, false AS conflict FROM log UNION ALL SELECT 'mixed', 'BIGINT,STRING', count(*), true FROM log
 UNION ALL SELECT 'state', 'OBJECT', count(*), false FROM log UNION ALL SELECT 'state.grade', 'DOUBLE', count(*), false FROM log
 UNION ALL SELECT 'state.parts', 'ARRAY', count(*), false FROM log UNION ALL SELECT 'state.parts[]', 'OBJECT', sum(1 + length(event_type) % 2)::BIGINT, false FROM log
 UNION ALL SELECT 'state.parts[].id', 'BIGINT', sum(1 + length(event_type) % 2)::BIGINT, false FROM log UNION ALL SELECT 'state.parts[].seen', 'OBJECT', count(*), false FROM log
 UNION ALL SELECT 'state.parts[].seen.' || event_type, CASE WHEN length(event_type) % 2 = 0 THEN 'BIGINT' ELSE 'BOOLEAN' END, count(*), false FROM log GROUP BY event_type
 UNION ALL SELECT 'state.parts[].seen.last', 'BOOLEAN,STRING,VOID', count(*), true FROM log)"""))
def infer_event_schema(spark, d):
    """Lines made of the events, with objects in arrays, a field per event type at depth five and one of several types there."""
    log = keyed_log(spark, d).withColumn("even", F.length("event_type") % 2 == 0)
    number = c("k").cast("string")
    last = F.when(c("k") % 3 == 0, "null").when(c("k") % 3 == 1, '"abc"').otherwise("true")
    line = F.concat(F.lit('{"attempts": '), F.when(c("k") % 2 == 0, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number),
                    F.lit(', "mixed": '), F.when(c("k") % 2 == 0, F.lit('"abc"')).otherwise(number), F.lit(', "state": {"grade": 0.25, "parts": ['),
                    F.when(c("even"), "").otherwise('{"id": 7}, '), F.lit('{"id": "12", "seen": {"'), c("event_type"), F.lit('": '),
                    F.when(c("even"), "3").otherwise("true"), F.lit(', "last": '), last, F.lit("}}]}}"))
    out = L.infer_event_schema(log.select(line.alias("value")))
    return out.select("path", F.array_join("types", ",").alias("types"), "n", "conflict")


@query("I13_user_partitions", sql("pc", "SELECT course_id, user_id, CASE user_id%3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE 'group b' END AS value FROM pc"))
def user_partitions(spark, d):
    pc = T.person_course(spark, d)
    v = F.when(c("user_id") % 3 == 0, "True").when(c("user_id") % 3 == 1, "FALSE").otherwise("Group B")
    return D.load_user_partitions(pc.select("course_id", "user_id", v.alias("value")))


@query("I14_listings", sql("axis", "SELECT course_id, count(*) AS n FROM axis GROUP BY 1"))
def listings(spark, d):
    path = scratch_path(spark, "listings")
    T.course_axis(spark, d).groupBy("course_id").agg(F.count(F.lit(1)).alias("n")).write.option("header", True).csv(path)
    return D.load_listings(spark, path, "course_id string, n bigint")


@query("I15_grading_policy", sql("axis", """SELECT course_id, t AS assignment_type, CASE WHEN t='Lab' THEN 'Labs' ELSE t END AS name, w AS fraction_of_overall_grade, l AS short_label, m AS min_count, 0 AS drop_count,
 n%2=0 AS weights_ok, 0.9::DOUBLE AS overall_cutoff_for_a, 0.6::DOUBLE AS overall_cutoff_for_pass FROM (SELECT course_id, n, unnest(['Homework','Lab','Exam']) AS t, unnest([0.5::DOUBLE, 0.2, CASE WHEN n%2=0 THEN 0.3 ELSE 0.4 END]) AS w,
 unnest(['HW','LB','EX']) AS l, unnest([n, 2, 1]) AS m FROM (SELECT course_id, sum(length(name)) AS n FROM axis GROUP BY 1))"""))
def grading_policy(spark, d):
    n = T.course_axis(spark, d).groupBy("course_id").agg(F.sum(F.length("name")).alias("n"))
    doc = F.concat(
        F.lit('{"GRADE_CUTOFFS": {"A": 0.9, "Pass": 0.6}, "GRADER": [{"type": "Homework", "weight": 0.5, "short_label": "HW", "drop_count": 0, "min_count": '), c("n").cast("string"),
        F.lit('}, {"type": "Lab", "name": "Labs", "weight": 0.2, "short_label": "LB", "drop_count": 0, "min_count": 2}, {"type": "Exam", "short_label": "EX", "drop_count": 0, "min_count": 1, "weight": '),
        F.when(c("n") % 2 == 0, "0.3").otherwise("0.4"), F.lit("}]}"))
    return D.grading_policy(n.select("course_id", doc.alias("policy")), ["A", "Pass"])


TITLE = "Сообщение о новых занятиях и заданиях этой недели для всех слушателей курса математики и физики"


@query("I16_repair_text", f"""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text WHEN 1 THEN text || ' {TITLE[:-1]}' || chr(65533) ELSE text || ' ' || chr(65533) || ' {TITLE}' END AS text FROM documents""")
def repair_text(spark, d):
    """Texts read with the wrong character set; a third of them cut within the last character, a third with a stray byte."""
    docs = T.load(spark, d, "documents")
    whole = F.encode(F.concat("text", F.lit(f" {TITLE}")), "UTF-8")
    cut = F.substr(whole, F.lit(1), F.octet_length(whole) - 1)
    stray = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("20FF20")), F.encode(F.lit(TITLE), "UTF-8"))
    data = F.when(c("doc_id") % 3 == 0, F.encode("text", "UTF-8")).when(c("doc_id") % 3 == 1, cut).otherwise(stray)
    return X.repair_text(docs.select("doc_id", F.decode(data, "ISO-8859-1").alias("text")), ["text"])


@query("I17_export_combine", sql("axis", "SELECT course_id, index, category, name FROM axis"))
def export_combine(spark, d):
    ax = T.course_axis(spark, d).select("course_id", "index", "category", "name")
    paths = {}
    for i in range(3):
        paths[i] = scratch_path(spark, "export")
        SK.export(ax.filter(c("course_id").startswith(f"Org{i}")), paths[i], "json", gzip=True, rows_per_file=500)
    schema = "course_id string, index bigint, category string, name string"
    return SK.combine({str(i): spark.read.schema(schema).json(p) for i, p in paths.items()})


@query("I18_load_table", sql("log", f"SELECT course_id, {ts('time')}, username, event_type FROM log WHERE k%11<>0 AND k%7<>0"))
def load_table(spark, d):
    path = scratch_path(spark, "load")
    json_lines(spark, d).select("value").write.text(path)
    schema = T_.StructType([T_.StructField(n, T_.TimestampType() if n == "time" else T_.StringType()) for n in LINE_FIELDS])
    return D.load_table(spark, path, schema, max_bad=1 << 40).select("course_id", "time", "username", "event_type")


@query("I18_load_rejects", sql("log", "SELECT count(*) FILTER (k%11=0) AS n_cut, count(*) FILTER (k%11<>0 AND k%7=0) AS n_prefixed FROM log"))
def load_rejects(spark, d):
    path = scratch_path(spark, "load")
    json_lines(spark, d).select("value").write.text(path)
    schema = T_.StructType([T_.StructField(n, T_.TimestampType() if n == "time" else T_.StringType()) for n in LINE_FIELDS])
    rejects = D.load_checked(spark, path, schema, max_bad=1 << 40)[1]
    prefixed = c("record").startswith("Dec ")
    return rejects.agg(F.count(F.when(~prefixed, 1)).alias("n_cut"), F.count(F.when(prefixed, 1)).alias("n_prefixed"))


@query("I19_duplicates", sql("pc", "SELECT user_id, count(*) AS n FROM pc GROUP BY 1 HAVING count(*)>1"))
def duplicates(spark, d):
    return D.duplicates(T.person_course(spark, d), ["user_id"])


@query("I19_duplicate_summary", sql("pc", "SELECT sum(n) AS n_rows, count(*) AS n_keys, count(*) FILTER (n>1) AS n_duplicated FROM (SELECT user_id, count(*) AS n FROM pc GROUP BY 1)"))
def duplicate_summary(spark, d):
    return D.duplicate_summary(T.person_course(spark, d), ["user_id"])
