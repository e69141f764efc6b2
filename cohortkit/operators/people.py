"""Learner, role and profile tables, and the person-course table assembled from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.functions.keys import ip_number, plain_course_id
from cohortkit.functions.scale import count_if, most_frequent, range_lookup, ratio, salted_lookup

KEY = ["course_id", "user_id"]
USER = ["course_id", "username"]
# Fields of the profile and certificate dumps (fixed values).
PROFILE = ["name", "language", "location", "meta", "courseware", "gender", "mailing_address", "year_of_birth", "level_of_education", "goals",
           "allow_certificate", "country", "city"]
ENROLLMENT = ["course_id", "created", "is_active", "mode"]
CERTIFICATE = ["download_url", "grade", "course_id", "key", "distinction", "status", "verify_uuid", "download_uuid", "name", "created_date",
               "modified_date", "error_reason", "mode"]
# Role name in the dumps -> output column (fixed values).
COURSE_ROLES = {
    "beta_testers": "roles_isBetaTester", "instructor": "roles_isInstructor", "staff": "roles_isStaff",
    "ccx_coach": "roles_isCCX", "finance_admin": "roles_isFinance", "library_user": "roles_isLibrary",
    "sales_admin": "roles_isSales",
}
FORUM_ROLES = {
    "Administrator": "forumRoles_isAdmin", "CommunityTA": "forumRoles_isCommunityTA",
    "Moderator": "forumRoles_isModerator", "Student": "forumRoles_isStudent",
}


def _prefixed(df: DataFrame, prefix: str, fields: list[str]) -> DataFrame:
    """Key plus the fields, each with a prefix and null where the dump lacks it; the row's own course is un-mangled."""
    cols = [F.col("course_id"), F.col("user_id")]
    for f in fields:
        src = "row_course_id" if f == "course_id" else f
        col = F.col(src) if src in df.columns else F.lit(None).cast("string")
        cols.append((plain_course_id(col) if f == "course_id" else col).alias(f"{prefix}_{f}"))
    return df.select(*cols)


def user_info_combo(
    users: DataFrame,
    profiles: DataFrame,
    enrollment: DataFrame,
    certificates: DataFrame,
    id_map: DataFrame,
    alt: dict[str, DataFrame] | None = None,
    grade_report: DataFrame | None = None,
    cutoff: str | None = None,
) -> DataFrame:
    """One row per (course, user) known to any dump of the course.

    Every input has ``course_id`` (the course the dump belongs to) and ``user_id``;
    enrolments and certificates name their own course in ``row_course_id``. ``alt``
    (``users``, ``profiles``, ``enrollment``) fills users, profiles and enrolments that
    are missing; a filled profile, of which empty values count as missing, is marked
    ``y1_anomalous`` and such a learner is left out when enrolled after ``cutoff``. Rows whose own course differs are dropped.
    """
    core = users.select(*KEY, *[c for c in users.columns if c not in KEY])
    core = core.join(_prefixed(profiles, "profile", PROFILE), KEY, "full")
    core = core.join(_prefixed(enrollment, "enrollment", ENROLLMENT), KEY, "full")
    core = core.withColumn("y1_anomalous", F.lit(None).cast("long"))
    if alt:
        info = [c for c in users.columns if c not in KEY]
        more = alt["users"].select(*KEY, *[F.col(c).alias(f"_a_{c}") for c in info], F.lit(True).alias("_known"))
        known = core.withColumn("_had", F.lit(True)).join(more, KEY, "full")
        fresh = F.col("_had").isNull()
        for c in info:
            known = known.withColumn(c, F.when(fresh, F.col(f"_a_{c}")).otherwise(F.col(c)))
        core = known.drop("_had", "_known", *[f"_a_{c}" for c in info])
        prof = _prefixed(alt["profiles"], "alt", PROFILE).withColumn("_filled", F.lit(True))
        core = core.join(prof, KEY, "full")
        fill = F.col("_filled") & (F.coalesce(F.col("profile_name"), F.lit("")) == "")
        core = core.withColumn("_fill", F.coalesce(fill, F.lit(False)))
        for f in PROFILE:
            given = F.when(F.col("_fill") & (F.col(f"alt_{f}").cast("string") != ""), F.col(f"alt_{f}"))
            core = core.withColumn(f"profile_{f}", F.coalesce(given, F.col(f"profile_{f}")))
        core = core.withColumn("y1_anomalous", F.when(F.col("_fill"), F.lit(1).cast("long")))
        core = core.drop("_fill", "_filled", *[f"alt_{f}" for f in PROFILE])
        enr = _prefixed(alt["enrollment"], "alt", ENROLLMENT).withColumn("_enr", F.lit(True))
        core = core.join(enr, KEY, "full")
        take = F.col("_enr").isNotNull() & F.col("enrollment_course_id").isNull()
        late = F.lit(False)
        if cutoff:
            late = take & (F.col("alt_created") > F.to_timestamp(F.lit(cutoff))) & (F.col("y1_anomalous") == 1)
        core = core.filter(~F.coalesce(late, F.lit(False))).withColumn("_take", take)
        for f in ENROLLMENT:
            core = core.withColumn(f"enrollment_{f}", F.when(F.col("_take"), F.col(f"alt_{f}")).otherwise(F.col(f"enrollment_{f}")))
        core = core.drop("_take", "_enr", *[f"alt_{f}" for f in ENROLLMENT])
    if grade_report is not None:
        core = core.join(_prefixed(grade_report, "edxinstructordash", ["Grade", "Grade_timestamp"]), KEY, "full")
    core = core.join(_prefixed(certificates, "certificate", CERTIFICATE), KEY, "full")
    core = core.join(_prefixed(id_map, "id_map", ["hash_id"]), KEY, "full")
    own = F.coalesce(F.when(F.col("enrollment_course_id") != "", F.col("enrollment_course_id")), F.col("course_id"))
    return core.withColumn("enrollment_course_id", own).filter(F.col("enrollment_course_id") == F.col("course_id"))


def roles(course_roles: DataFrame, forum_roles: DataFrame | None = None) -> DataFrame:
    """Role rows as one 0/1 row per (course, user); any role but Student makes ``Staff``."""

    def wide(df: DataFrame, name: str, known: dict[str, str]) -> DataFrame:
        return df.groupBy(*KEY).agg(*[F.max(F.when(F.col(name) == r, 1)).alias(c) for r, c in known.items()])

    out = wide(course_roles, "role", COURSE_ROLES)
    staff = list(COURSE_ROLES.values())
    if forum_roles is not None:
        out = out.join(wide(forum_roles, "name", FORUM_ROLES), KEY, "full")
        staff += [c for r, c in FORUM_ROLES.items() if r != "Student"]
    return out.withColumn("roles", F.when(F.coalesce(*[F.col(c) for c in staff]).isNotNull(), "Staff").otherwise("Student"))


def passing_grades(policy: DataFrame) -> DataFrame:
    """Lowest overall cutoff per course."""
    cutoffs = [F.col(c) for c in policy.columns if c.startswith("overall_cutoff")]
    lowest = cutoffs[0] if len(cutoffs) == 1 else F.least(*cutoffs)
    return policy.groupBy("course_id").agg(F.min(lowest).cast("double").alias("passing_grade"))


def pc_base(uic: DataFrame, policy: DataFrame, dump_date: str | None = None) -> DataFrame:
    """First columns of person-course, with the grade chosen from certificate and grade report.

    A report newer than the dump date wins over the certificate; without a certificate
    grade the report is used; otherwise the certificate.
    """
    c = F.col
    df = salted_lookup(uic, passing_grades(policy), ["course_id"], salt_by=["user_id"])
    dash, when, cert = c("edxinstructordash_Grade"), F.to_timestamp("edxinstructordash_Grade_timestamp"), c("certificate_grade")
    has = dash.isNotNull() & when.isNotNull()
    newer = when > F.to_timestamp(F.lit(dump_date)) if dump_date else F.lit(False)
    grade = F.when(has & (cert.isNull() | newer), dash).otherwise(cert)
    certified = F.coalesce(c("certificate_status") == "downloadable", F.lit(False))
    return df.select(
        F.coalesce("enrollment_course_id", "certificate_course_id").alias("course_id"), "user_id", "username",
        c("profile_gender").alias("gender"), c("profile_level_of_education").alias("LoE"),
        c("profile_year_of_birth").alias("YoB"), grade.alias("grade"), c("enrollment_created").alias("start_time"),
        c("enrollment_mode").alias("mode"), c("enrollment_is_active").alias("is_active"),
        c("certificate_created_date").alias("cert_created_date"), c("certificate_modified_date").alias("cert_modified_date"),
        c("certificate_status").alias("cert_status"), "profile_country", "y1_anomalous",
        F.lit(True).alias("registered"), "passing_grade",
        (certified | F.coalesce(grade >= c("passing_grade"), F.lit(False))).alias("completed"),
        certified.alias("certified"), F.element_at(F.split("email", "@"), 2).alias("email_domain"),
    )


def pc_nchapters(sm: DataFrame) -> DataFrame:
    """Distinct chapters seen per (course, user)."""
    seen = sm.filter("module_type = 'chapter'").select("course_id", F.col("student_id").alias("user_id"), "module_id").distinct()
    return seen.groupBy(*KEY).agg(F.count(F.lit(1)).alias("nchapters"))


def pc_forum(forum: DataFrame) -> DataFrame:
    """Forum posting counts per (course, author)."""
    kind = F.col("_type")
    return forum.groupBy("course_id", F.col("author_id").alias("user_id")).agg(
        F.count(F.lit(1)).alias("nforum_posts"), F.sum("votes_count").alias("nforum_votes"),
        count_if(F.col("pinned")).alias("nforum_pinned"), count_if(F.col("endorsed")).alias("nforum_endorsed"),
        count_if(kind == "CommentThread").alias("nforum_threads"), count_if(kind == "Comment").alias("nforum_comments"),
    )


def pc_course_nchapters(axis: DataFrame, metainfo: DataFrame | None = None) -> DataFrame:
    """Chapters per course: the metainfo count when there is one, else counted in the axis."""
    counted = axis.groupBy("course_id").agg(count_if(F.col("category") == "chapter").alias("n_axis"))
    if metainfo is None:
        return counted.select("course_id", F.col("n_axis").alias("course_nchapters"))
    given = metainfo.filter("key = 'count_chapter'").groupBy("course_id").agg(F.max("value").try_cast("long").alias("n_meta"))
    return counted.join(given, "course_id", "full").select("course_id", F.coalesce("n_meta", "n_axis").alias("course_nchapters"))


def pc_viewing(base: DataFrame, nchapters: DataFrame, course_nchapters: DataFrame) -> DataFrame:
    """viewed / explored per learner: explored means at least half of the chapters, rounded down."""
    df = base.join(nchapters, KEY, "left")
    df = salted_lookup(df, course_nchapters, ["course_id"], salt_by=["user_id"])
    half = F.floor(F.col("course_nchapters") / 2)
    return df.withColumn("viewed", F.col("nchapters").isNotNull()).withColumn(
        "explored", F.when(F.col("viewed"), F.coalesce(F.col("nchapters") >= half, F.lit(False)))).drop("course_nchapters")


TOTAL_COLUMNS = [
    "nevents", "nprogcheck", "nshow_answer", "nvideo", "nproblem_check", "nforum", "ntranscript", "nseq_goto",
    "nseek_video", "npause_video",
]


def pc_day_totals(pcd: DataFrame) -> DataFrame:
    """Daily activity summed per (course, user); the deviation pools the daily ones by their gap counts."""
    pooled = F.sqrt(ratio(F.sum(F.col("sdv_dt") * F.col("sdv_dt") * F.col("n_dt")), F.sum("n_dt")))
    return pcd.groupBy(*USER).agg(
        F.count(F.lit(1)).alias("ndays_act"), *[F.sum(c).alias(c) for c in TOTAL_COLUMNS],
        F.min("first_event").alias("first_event"), F.max("last_event").alias("last_event"),
        F.avg("avg_dt").alias("avg_dt"), pooled.alias("sdv_dt"), F.max("max_dt").alias("max_dt"),
        F.sum("n_dt").alias("n_dt"), F.sum("sum_dt").alias("sum_dt"),
    )


def modal_ip(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Most used address per key with the number of different addresses; ties go to the least text."""
    top = most_frequent(counts, keys, "ip", F.col("ipcount"), distinct_as="n_different_ip", count_as="ip_count")
    return top.withColumnRenamed("ip", "modal_ip")


def pc_modal_ip(uic: DataFrame, course_ip: DataFrame, global_ip: DataFrame) -> DataFrame:
    """Address per learner: the course's modal address, else the global one."""
    course = course_ip.select(*USER, F.col("modal_ip").alias("course_modal_ip"), F.col("ip_count").alias("course_ip_count"))
    whole = global_ip.select("username", F.col("modal_ip").alias("global_modal_ip"), F.col("ip_count").alias("global_ip_count"))
    df = uic.select(*USER).join(course, USER, "left").join(whole, "username", "left")
    return df.withColumn("modal_ip", F.coalesce("course_modal_ip", "global_modal_ip")).withColumn(
        "source", F.when(F.coalesce("course_modal_ip", F.lit("")) != "", "course")
        .when(F.coalesce("global_modal_ip", F.lit("")) != "", "global").otherwise("missing"))


def lang_multi(counts: DataFrame) -> DataFrame:
    """Transcript languages per (course, user) with use counts, number of languages and rank by use."""
    from pyspark.sql import Window as W

    per = counts.groupBy(*USER, "resource", "resource_event_data").agg(
        count_if(F.col("resource_event_type") == "transcript_download").alias("transcript_download"),
        F.sum("langcount").alias("n_events"), F.max("last_time").alias("last_time_used_lang"))
    # a learner has at most as many rows here as there are languages
    w = W.partitionBy(*USER)
    return per.withColumn("n_diff_lang", F.count("resource_event_data").over(w)).withColumn(
        "rank_num", F.rank().over(w.orderBy(F.desc("n_events"))))


def modal_language(multi: DataFrame) -> DataFrame:
    """Most used language per (course, user); of equally used ones the latest, then the least code."""
    top = multi.filter("rank_num = 1")
    pick = F.max_by(F.struct("resource", "resource_event_data", "transcript_download", "n_events", "n_diff_lang"),
                    F.struct("last_time_used_lang", F.translate("resource_event_data", "abcdefghijklmnopqrstuvwxyz",
                                                                "zyxwvutsrqponmlkjihgfedcba")))
    return top.groupBy(*USER).agg(pick.alias("p")).select(
        *USER, F.col("p.resource").alias("resource"), F.col("p.resource_event_data").alias("language"),
        F.col("p.transcript_download").alias("language_download"), F.col("p.n_events").alias("language_nevents"),
        F.col("p.n_diff_lang").alias("language_ndiff"))


def geoip_join(ips: DataFrame, ranges: DataFrame) -> DataFrame:
    """Address range of each learner's modal address; cells of 65,536 addresses make it an equi-join."""
    numbered = ips.filter("modal_ip IS NOT NULL").withColumn("ip_num", ip_number(F.col("modal_ip")))
    return range_lookup(numbered, "ip_num", ranges, "startIpNum", "endIpNum", 65536, "inner")


def geo_fill(pc: DataFrame, extra_geoip: DataFrame, regions: DataFrame) -> DataFrame:
    """Country for learners that have an address but no country, then region attributes by country."""
    extra = extra_geoip.select("ip", F.col("country").alias("_cc"), F.col("countryLabel").alias("_label"), F.col("continent").alias("_cont"))
    df = salted_lookup(pc, extra, ["ip"], salt_by=["user_id"])
    empty = F.col("cc_by_ip").isNull()
    df = df.withColumn("countryLabel", F.when(empty & F.col("_cc").isNotNull(), F.col("_label")).otherwise(F.col("countryLabel")))
    df = df.withColumn("continent", F.when(empty & F.col("_cc").isNotNull(), F.col("_cont")).otherwise(F.col("continent")))
    df = df.withColumn("cc_by_ip", F.coalesce("cc_by_ip", "_cc")).drop("_cc", "_label", "_cont")
    reg = regions.select(F.col("cc").alias("cc_by_ip"), F.col("name").alias("_name"), F.col("continent").alias("_cont"),
                         F.col("un_region").alias("un_major_region"), F.col("econ_group").alias("un_economic_group"),
                         F.col("developing_nation").alias("un_developing_nation"))
    df = salted_lookup(df, reg, ["cc_by_ip"], salt_by=["user_id"])
    return df.withColumn("countryLabel", F.coalesce("countryLabel", "_name")).withColumn(
        "continent", F.coalesce("continent", "_cont")).drop("_name", "_cont")


def ips_missing_country(pc: DataFrame) -> DataFrame:
    """Addresses of learners without a country, with their number."""
    return pc.filter("cc_by_ip IS NULL").groupBy("ip").agg(F.count(F.lit(1)).alias("n"))


def pc_roles(pc: DataFrame, role_table: DataFrame) -> DataFrame:
    """Role columns added to person-course."""
    return pc.join(role_table, KEY, "left")


def pc_verified(pc: DataFrame, verified: DataFrame) -> DataFrame:
    """Verified enrol and un-enrol times added to person-course."""
    return pc.join(verified.select(*KEY, "verified_enroll_time", "verified_unenroll_time"), KEY, "left")


def _replace(pc: DataFrame, part: DataFrame, on: list[str]) -> DataFrame:
    """Left join that overwrites the columns ``part`` brings."""
    return pc.drop(*[c for c in part.columns if c not in on]).join(part, on, "left")


def activity_part(day_totals: DataFrame, with_ends: bool = True) -> DataFrame:
    """Day totals under their person-course names."""
    part = day_totals.withColumn("nplay_video", F.col("nvideo")).withColumnRenamed("nforum", "nforum_events")
    return part if with_ends else part.drop("first_event", "last_event")


def person_course(
    base: DataFrame,
    refresh: str = "all",
    nchapters: DataFrame | None = None,
    course_nchapters: DataFrame | None = None,
    forum_counts: DataFrame | None = None,
    day_totals: DataFrame | None = None,
    videos: DataFrame | None = None,
    modal: DataFrame | None = None,
    language: DataFrame | None = None,
    geo: DataFrame | None = None,
    extra_geoip: DataFrame | None = None,
    regions: DataFrame | None = None,
    role_table: DataFrame | None = None,
    verified: DataFrame | None = None,
) -> DataFrame:
    """Assemble person-course from its parts, or replace one part of an existing table.

    ``refresh``: ``all`` adds every part given; ``nightly`` only activity, videos and
    language, keeping addresses and first/last event; ``phase2`` only chapters and forum;
    ``geo`` only the country fallback. ``base`` is the first-phase or the existing table.
    """
    steps = {"all": {"2", "3", "ip", "4", "5", "6"}, "nightly": {"3"}, "phase2": {"2"}, "geo": {"5"}}[refresh]
    pc = base
    if "2" in steps:
        if nchapters is not None and course_nchapters is not None:
            pc = pc_viewing(pc.drop("nchapters", "viewed", "explored"), nchapters, course_nchapters)
        if forum_counts is not None:
            pc = _replace(pc, forum_counts, KEY)
    if "3" in steps:
        if day_totals is not None:
            pc = _replace(pc, activity_part(day_totals, with_ends=refresh == "all"), USER)
        if videos is not None:
            pc = _replace(pc, videos.select(*KEY, F.col("n_unique_videos_watched").alias("nvideos_unique_viewed"),
                                            F.col("fract_total_videos_watched").alias("nvideos_total_watched")), KEY)
        if language is not None:
            pc = _replace(pc, language.select(*USER, "language", "language_download", "language_nevents", "language_ndiff"), USER)
    if "ip" in steps and modal is not None:
        pc = _replace(pc, modal.select(*USER, F.col("modal_ip").alias("ip")), USER)
    if "4" in steps and geo is not None:
        pc = _replace(pc, geo.select(*USER, F.col("country").alias("cc_by_ip"), "countryLabel"), USER)
    if "5" in steps and extra_geoip is not None and regions is not None:
        for col in ("cc_by_ip", "countryLabel", "continent"):
            if col not in pc.columns:
                pc = pc.withColumn(col, F.lit(None).cast("string"))
        pc = geo_fill(pc, extra_geoip, regions)
    if "6" in steps:
        pc = pc if role_table is None else _replace(pc, role_table, KEY)
        pc = pc if verified is None else pc_verified(pc.drop("verified_enroll_time", "verified_unenroll_time"), verified)
    return pc


def strict_union(tables: list[DataFrame]) -> DataFrame:
    """Union of tables that must have the same columns."""
    first = tables[0].columns
    for t in tables[1:]:
        if t.columns != first:
            raise ValueError(f"headers differ: {first} and {t.columns}")
    return reduce(lambda a, b: a.unionByName(b), tables)


def combine_person_course(tables: list[DataFrame], subset: str | None = None) -> DataFrame:
    """Person-course of many courses in one; ``viewed`` and ``idv`` keep viewers or verified enrolments."""
    out = strict_union(tables)
    rules: dict[str | None, Column] = {
        None: F.lit(True), "viewed": F.col("viewed"), "idv": F.col("verified_enroll_time").isNotNull()}
    return out.filter(rules[subset])
