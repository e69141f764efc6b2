"""Course content: the ordered axis, content counts, metainfo and course summaries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortkit.functions.scale import count_if, ratio, salted_lookup
from cohortkit.session import cut_lineage

# Fixed values of the content rules.
LEAF_TAGS = ["html", "problem", "discussion", "customtag", "poll_question", "combinedopenended", "metadata"]
SKIPPED_TAGS = ["discussion", "source"]
SEQUENCE_TAGS = ["problemset", "sequential", "videosequence", "proctor", "randomize"]
INHERITING_TAGS = ["sequential", "problem", "problemset", "course", "chapter"]
UNCOUNTED_TAGS = (
    "html p div iframe ol li ul blockquote h1 em b h2 h3 body span strong a sub strike table td tr s tbody sup i pre "
    "policy metadata grading_policy br center wiki course font tt it dl startouttext endouttext h4 head source dt hr u "
    "style dd script th small text title"
).split()
QUALITATIVE = ["openassessment", "optionresponse", "multiplechoiceresponse", "choiceresponse", "word_cloud",
               "combinedopenended", "stringresponse", "textannotation", "openended", "lti"]
QUANTITATIVE = ["formularesponse", "numericalresponse", "customresponse", "symbolicresponse", "coderesponse", "imageresponse"]
DATE_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss'+00:00'", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss'+0000'", "MMMM d, yyyy",
    "MMMM d, HH:mm, yyyy", "MMMM d, yyyy, HH:mm", "MMMM d yyyy, HH:mm", "MMMM d yyyy", "MMMM d HH:mm, yyyy",
]
MIN_VIEWS = 20
MIN_SOLUTION = 65


def parse_course_date(col: Column) -> Column:
    """A course date in any of the known formats, quotes allowed; null when none fits."""
    text = F.regexp_replace(col, '^"(.*)"$', "$1")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])


def walk_tree(elements: DataFrame, root_state: Callable[[DataFrame], DataFrame],
              step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Carry state from parents to children, one tree level per round.

    ``elements`` has (course_id, element_id, parent_id, ...). ``root_state`` and ``step``
    add a struct ``state``; ``step`` sees the child's columns and the parent's state as
    ``up``. Rows whose state is null, and their subtrees, are dropped. Every level is a
    checkpoint, so a deep tree does not replay the levels above it.
    """
    level = cut_lineage(root_state(elements.filter("parent_id IS NULL")).filter("state IS NOT NULL"))
    done = level
    while not level.isEmpty():
        up = level.select("course_id", F.col("element_id").alias("parent_id"), F.col("state").alias("up"))
        children = elements.join(up, ["course_id", "parent_id"], "inner")
        level = cut_lineage(step(children).filter("state IS NOT NULL").select(*done.columns))
        done = done.unionByName(level)
    return done


def _clean_name(name: Column) -> Column:
    """A display name in the form used as url name."""
    text = F.translate(F.trim(name), " :.()", "_____")
    return F.replace(text, F.lit("__"), F.lit("_"))


def course_axis(elements: DataFrame, policy: DataFrame | None = None) -> DataFrame:
    """Flattened content tree in document order.

    ``elements``: course_id, element_id, parent_id, position, tag, url_name, display_name,
    start, due, format, graded, hide_from_toc, youtube, youtube_id_1_0 and optionally
    ``meta`` (struct from ``problem_meta``). ``policy``: course_id, tag, url_name and any of
    start, due, format, graded, hide_from_toc, display_name; it overrides inherited values
    but not an element's own attribute. Hidden elements go with their subtree; a start
    before the parent's is moved to the parent's.
    """
    c = F.col
    settings = ["start", "due", "format", "graded"]
    el = elements.filter(~c("tag").isin(SKIPPED_TAGS))
    order = W.partitionBy("course_id", "parent_id").orderBy("position")
    el = el.withColumn("seq", F.row_number().over(order))
    if policy is not None:
        names = [x for x in policy.columns if x not in ("course_id", "tag", "url_name")]
        el = el.join(policy.withColumnsRenamed({n: f"p_{n}" for n in names}), ["course_id", "tag", "url_name"], "left")
    for n in [*settings, "hide_from_toc", "display_name"]:
        if f"p_{n}" not in el.columns:
            el = el.withColumn(f"p_{n}", F.lit(None).cast("string"))
    el = el.withColumn("url_name", F.coalesce(F.when(c("url_name") != "", c("url_name")), _clean_name(c("display_name")), F.lit("")))
    org = F.array_join(F.slice(F.split("course_id", "/"), 1, 2), "/")

    def given(name: str) -> Column:
        own = F.when((c(name) != "") & (c(name) != "null"), c(name))
        return F.coalesce(own, c(f"p_{name}"))

    def state(df: DataFrame, root: bool) -> DataFrame:
        up = lambda f, t: F.lit(None).cast(t) if root else c(f"up.{f}")
        tag, url = c("tag"), c("url_name")
        named = url != ""
        hide = F.coalesce(c("p_hide_from_toc"), up("hide", "string"))
        inherited = {n: F.coalesce(given(n), up(n, "string")) for n in settings}
        own_start, parent_start = parse_course_date(inherited["start"]), up("start_at", "timestamp")
        start = F.when(parent_start.isNotNull() & (own_start.isNull() | (own_start < parent_start)), parent_start).otherwise(own_start)
        empty = F.array().cast("array<string>")
        before = empty if root else F.coalesce(c("up.path"), empty)
        keep_seq = F.lit(False) if root else F.coalesce(c("up.pass_seq"), F.lit(False))
        seq = c("seq") if root else F.when(keep_seq, c("up.seq")).otherwise(c("seq"))
        path = (
            F.when(~named, before).when(tag == "chapter", F.array(url))
            .when(tag.isin(SEQUENCE_TAGS), F.concat(F.slice(before, 1, 1), F.array(url)))
            .otherwise(F.concat(before, F.array(seq.cast("string"))))
        )
        df = df.withColumn("_path", path).withColumn("_seq", seq)
        seq_type = F.when(tag.isin(SEQUENCE_TAGS), tag).otherwise(up("seq_type", "string"))
        module = F.when(tag == "html", F.concat_ws("/", org, seq_type, F.array_join(F.slice("_path", 2, 2), "/"))).otherwise(
            F.concat_ws("/", org, tag, url))
        split = F.coalesce(up("split_in", "string"), F.when(tag == "split_test", url))
        lineage = F.concat(empty if root else c("up.lineage"), F.array(F.lpad(c("position").cast("string"), 9, "0")))
        st = F.struct(
            c("_path").alias("path"), c("_seq").alias("seq"), ((tag == "vertical") & ~named).alias("pass_seq"),
            seq_type.alias("seq_type"), F.when(named, start).alias("start_at"),
            *[v.alias(n) for n, v in inherited.items()],
            F.coalesce(F.when((c("hide_from_toc") != "") & (c("hide_from_toc") != "null"), c("hide_from_toc")), hide).alias("hide"),
            module.alias("module_id"), up("chapter_in", "string").alias("chapter_mid"),
            F.when(tag == "chapter", module).otherwise(up("chapter_in", "string")).alias("chapter_in"),
            up("url", "string").alias("parent_url"), url.alias("url"), up("split_in", "string").alias("split_url"),
            split.alias("split_in"), lineage.alias("lineage"), tag.isin(LEAF_TAGS).alias("leaf"),
        )
        visible = hide.isNull() | (hide == "false")
        walked = F.lit(True) if root else ~c("up.leaf")
        return df.withColumn("state", F.when(visible & walked, st)).drop("_path", "_seq", "up")

    tree = walk_tree(el, lambda df: state(df, True), lambda df: state(df, False)).filter("state.url != ''")
    s = lambda f: c(f"state.{f}")
    ytid = F.coalesce(
        F.regexp_extract(F.replace("youtube", F.lit(" "), F.lit("")), r"(?:^|,)1\.0:([^,]+)", 1),
        F.lit(""))
    ytid = F.when(c("tag") == "video", F.coalesce(F.when(ytid != "", ytid), F.when(c("youtube") != "", c("youtube")),
                                                  F.when(c("youtube_id_1_0") != "", c("youtube_id_1_0"))))
    data = [ytid.alias("ytid")] + ([c("meta.*")] if "meta" in elements.columns else [])
    in_order = W.partitionBy("course_id").orderBy(F.array_join(s("lineage"), "/"))
    rows = tree.select("*", *data)
    extra = [x for x in rows.columns if x not in tree.columns]
    return rows.select(
        "course_id", F.row_number().over(in_order).alias("index"), s("url").alias("url_name"), c("tag").alias("category"),
        s("format").alias("gformat"), s("start_at").alias("start"), parse_course_date(s("due")).alias("due"),
        F.coalesce("p_display_name", "display_name", s("url")).alias("name"),
        F.concat(F.lit("/"), F.array_join(s("path"), "/")).alias("path"), s("module_id").alias("module_id"),
        F.struct(*[c(x) for x in extra]).alias("data"), s("chapter_mid").alias("chapter_mid"), s("graded").alias("graded"),
        s("parent_url").alias("parent"), s("split_url").isNotNull().alias("is_split"), s("split_url").alias("split_url_name"),
    )


def problem_meta(elements: DataFrame) -> DataFrame:
    """Per problem: response type (``mixed`` when several), items, image, solution and weight.

    ``elements`` has one row per element inside a problem: course_id, problem_id, tag, text, weight.
    """
    c = F.col
    types = ["multiplechoiceresponse", "numericalresponse", "choiceresponse", "optionresponse", "stringresponse",
             "formularesponse", "customresponse", "fieldset"]  # fixed values
    item = c("tag").isin(types)
    first, last = F.min(F.when(item, c("tag"))), F.max(F.when(item, c("tag")))
    solution = (c("tag") == "solution") & ((F.length("text") > MIN_SOLUTION) | c("text").contains("img src"))
    return elements.groupBy("course_id", "problem_id").agg(
        F.when(first == last, first).when(first.isNotNull(), "mixed").alias("itype"),
        F.nullif(count_if(item), F.lit(0)).alias("num_items"),
        F.max(c("tag") == "img").alias("has_image"), F.max(solution).alias("has_solution"),
        F.max(c("weight").try_cast("double")).alias("weight"),
    )


def dedupe_url_names(axis: DataFrame) -> DataFrame:
    """Verticals whose url name is used more than once in the course get a ``_vertical`` ending."""
    shared = F.count(F.lit(1)).over(W.partitionBy("course_id", "url_name")) > 1
    renamed = F.when(F.col("_shared") & (F.col("category") == "vertical"), F.concat("url_name", F.lit("_vertical")))
    return axis.withColumn("_shared", shared).withColumn("url_name", F.coalesce(renamed, F.col("url_name"))).drop("_shared")


def module_usage(sm: DataFrame) -> DataFrame:
    """Learner records per module."""
    return sm.groupBy("course_id", "module_type", "module_id").agg(F.count(F.lit(1)).alias("ncount"))


def content_stats(elements: DataFrame, usage: DataFrame, listings: DataFrame) -> DataFrame:
    """Content counts as (course_id, key, value) rows.

    Elements with a known view count under 20 are left out with everything below them.
    ``elements``: course_id, element_id, parent_id, tag, url_name, showanswer, graded, random_script;
    ``usage``: course_id, tag, url_name, ncount; ``listings``: course_id, launch and wrap dates.
    """
    c = F.col
    el = elements.withColumn("tag", F.lower("tag")).join(usage.select("course_id", "tag", "url_name", "ncount"),
                                                        ["course_id", "tag", "url_name"], "left")

    def state(df: DataFrame, root: bool) -> DataFrame:
        passes = c("tag").isin(INHERITING_TAGS)
        vals = [F.coalesce(F.when(passes & (c(n) != ""), c(n)), F.lit(None).cast("string") if root else c(f"up.{n}")).alias(n)
                for n in ("showanswer", "graded")]
        rare = F.lit(False) if root else F.coalesce(c("ncount") < MIN_VIEWS, F.lit(False))
        live = F.lit(True) if root else ~c("up.rare")
        return df.withColumn("state", F.when(live, F.struct(*vals, rare.alias("rare")))).drop("up")

    tree = walk_tree(el, lambda df: state(df, True), lambda df: state(df, False))
    kept, tag = tree.filter("NOT state.rare"), c("tag")
    key = lambda prefix, col: F.concat(F.lit(prefix), col)
    counts = kept.filter(~tag.isin(UNCOUNTED_TAGS)).select("course_id", key("count_", tag).alias("key"), F.lit(1).alias("v"))
    out = tree.filter("state.rare").select("course_id", key("nexcluded_sub_20_", tag).alias("key"), F.lit(1).alias("v"))
    shown = lambda label: F.coalesce(F.concat(F.lit(f"{label}showanswer_"), c("state.showanswer")), F.lit(f"{label}shownanswer_finished"))
    graded = c("state.graded").isin("true", "True")
    rnd = F.coalesce(c("random_script"), F.lit(False))
    names = F.array(
        F.struct(F.lit("n_capa_problems").alias("key"), F.lit(1).alias("v")), F.struct(shown("n_").alias("key"), F.lit(1).alias("v")),
        F.struct(F.lit("n_random_script").alias("key"), rnd.cast("int").alias("v")),
        F.struct(F.when(graded, "n_capa_problems_graded").alias("key"), F.lit(1).alias("v")),
        F.struct(F.when(graded, "n_graded_random_script").alias("key"), rnd.cast("int").alias("v")),
        F.struct(F.when(graded, shown("n_graded_")).alias("key"), F.lit(1).alias("v")))
    stats = kept.filter(tag == "problem").select("course_id", F.inline(names)).filter("key IS NOT NULL").select(
        "course_id", key("problem_stat_", c("key")).alias("key"), "v")
    tallies = counts.unionByName(out).unionByName(stats).groupBy("course_id", "key").agg(F.sum("v").cast("double").alias("value"))
    length = listings.select("course_id", F.datediff("wrap", "launch").alias("days"))
    weeks = c("days") / 7.0
    qual, quant = tag.isin(QUALITATIVE), tag.isin(QUANTITATIVE)
    per_week = kept.groupBy("course_id").agg(count_if(qual).alias("a"), count_if(quant).alias("b")).join(length, "course_id", "inner").select(
        "course_id", F.inline(F.array(
            F.struct(F.lit("course_length_days").alias("key"), c("days").cast("double").alias("value")),
            F.struct(F.lit("nweeks").alias("key"), weeks.alias("value")),
            F.struct(F.lit("nqual_per_week").alias("key"), ratio(c("a"), weeks).alias("value")),
            F.struct(F.lit("nquant_per_week").alias("key"), ratio(c("b"), weeks).alias("value")),
            F.struct(F.lit("total_assessments_per_week").alias("key"), ratio(c("a") + c("b"), weeks).alias("value")))))
    return tallies.unionByName(per_week)


def course_metainfo(parts: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Key/value facts per course; an override replaces or adds a value."""
    base = parts.select("course_id", "key", F.col("value").cast("string").alias("value"))
    if overrides is None:
        return base
    over = overrides.select("course_id", "key", F.col("value").cast("string").alias("_new"))
    return base.join(over, ["course_id", "key"], "full").select("course_id", "key", F.coalesce("_new", "value").alias("value"))


def metainfo_wide(metainfo: DataFrame, keys: list[str]) -> DataFrame:
    """The named keys as columns, characters not allowed in names replaced."""
    aggs = [F.max(F.when(F.col("key") == k, F.col("value"))).alias("".join(ch if ch.isalnum() else "_" for ch in k)) for k in keys]
    return metainfo.groupBy("course_id").agg(*aggs)


def listing_date(col: Column, end_of_day: bool = False) -> Column:
    """A month/day/year date, optionally its last second."""
    part = lambda i: F.regexp_extract(col, r"(\d+)/(\d+)/(\d+)", i).try_cast("int")
    at = F.when(col.rlike(r"\d+/\d+/\d+"), F.make_date(part(3), part(1), part(2))).cast("timestamp")
    return at + F.expr("INTERVAL '23:59:59' HOUR TO SECOND") if end_of_day else at


def _dates(metainfo: DataFrame) -> DataFrame:
    pick = lambda k: F.max(F.when(F.col("key") == k, F.col("value")))
    raw = metainfo.groupBy("course_id").agg(
        pick("listings_Course Wrap").alias("w"), pick("listings_Course Launch").alias("l"),
        pick("listings_Empirical Course Wrap").alias("e"))
    return raw.select("course_id", listing_date(F.col("w"), True).alias("wrap_date"), listing_date(F.col("l")).alias("launch_date"),
                      listing_date(F.col("e"), True).alias("ewrap_date"))


def registered_by_wrap(pc: DataFrame, metainfo: DataFrame) -> DataFrame:
    """Registrations before the course's wrap date, and their share."""
    dates = _dates(metainfo).select("course_id", "wrap_date")
    by = count_if(F.col("start_time") < F.col("wrap_date"))
    df = salted_lookup(pc.select("course_id", "user_id", "start_time"), dates, ["course_id"], salt_by=["user_id"])
    return df.groupBy("course_id", "wrap_date").agg(
        F.count(F.lit(1)).alias("nregistered"), by.alias("nregistered_by_wrap"),
        (ratio(by, F.count(F.lit(1))) * 100).alias("nregistered_by_wrap_pct"))


def cert_rates(pc: DataFrame, metainfo: DataFrame) -> DataFrame:
    """Certification rates by registration before launch, during the course, by wrap and by empirical wrap."""
    c = F.col
    df = salted_lookup(pc.select("course_id", "user_id", "start_time", "certified", "viewed", "cert_created_date"),
                       _dates(metainfo), ["course_id"], salt_by=["user_id"])
    st, wrap, launch, ewrap = c("start_time"), c("wrap_date"), c("launch_date"), c("ewrap_date")
    during = (st >= launch) & (st < wrap)
    counts = {
        "ncertified": c("certified"), "ncertified_by_ewrap": (c("cert_created_date") < ewrap) & c("certified") & c("viewed"),
        "nviewed": c("viewed"), "nregistered_by_wrap": st < wrap, "nviewed_by_wrap": (st < wrap) & c("viewed"),
        "nviewed_by_ewrap": (st < ewrap) & c("viewed"), "nregistered_before_launch": st < launch,
        "ncertified_and_registered_before_launch": (st < launch) & c("certified"), "nregistered_during_course": during,
        "ncertified_and_registered_during_course": during & c("certified"),
    }
    sums = df.groupBy("course_id", "wrap_date").agg(
        F.count(F.lit(1)).alias("nregistered"), *[count_if(x).alias(n) for n, x in counts.items()])
    pct = lambda a, b: ratio(c(a), c(b)) * 100
    return sums.select(
        "*", pct("nregistered_by_wrap", "nregistered").alias("nregistered_by_wrap_pct"),
        pct("ncertified", "nregistered").alias("pct_certified_of_reg"),
        pct("ncertified_and_registered_before_launch", "nregistered_before_launch").alias("pct_certified_reg_before_launch"),
        pct("ncertified_and_registered_during_course", "nregistered_during_course").alias("pct_certified_reg_during_course"),
        pct("ncertified", "nregistered_by_wrap").alias("pct_certified_of_reg_by_wrap"),
        pct("ncertified", "nviewed").alias("pct_certified_of_viewed"),
        pct("ncertified", "nviewed_by_wrap").alias("pct_certified_of_viewed_by_wrap"),
        pct("ncertified_by_ewrap", "nviewed_by_ewrap").alias("pct_certified_of_viewed_by_ewrap"))


def course_summary(
    broad: DataFrame, medians: dict[str, DataFrame], by_wrap: DataFrame, rates: DataFrame, tot: DataFrame | None = None,
    serial_tot: DataFrame | None = None, show_answer: DataFrame | None = None, metainfo: DataFrame | None = None,
    listings: DataFrame | None = None,
) -> DataFrame:
    """One wide row per course from the reports, each under its own column prefix.

    ``metainfo`` and ``listings`` are wide tables; a listing fills a metainfo column that
    is empty. The certified share of registrations by wrap is certified / registered.
    """
    c = F.col

    def add(left: DataFrame, right: DataFrame | None, prefix: str) -> DataFrame:
        if right is None:
            return left
        names = {x: f"{prefix}{x}" for x in right.columns if x != "course_id"}
        return left.join(right.withColumnsRenamed(names), "course_id", "left")

    out = add(broad, by_wrap.select("course_id", c("wrap_date").alias("nbw_wrap_date"), "nregistered_by_wrap", "nregistered_by_wrap_pct"), "")
    out = out.withColumn("frac_female", ratio(c("n_female_viewed"), c("n_male_viewed") + c("n_female_viewed")))
    out = out.withColumn("certified_of_nregistered_by_wrap_pct", ratio(c("certified_sum"), c("nregistered_by_wrap")) * 100)
    out = add(out, rates, "cbr_")
    for cohort, table in medians.items():
        out = add(out, table, f"msbc_{cohort}_")
    out = add(add(add(out, tot, "ToT_"), serial_tot, "SToT_"), show_answer, "SAS_")
    out = add(out, metainfo, "")
    if metainfo is not None and "nweeks" in metainfo.columns:
        out = out.withColumn("nforum_posts_per_week", F.when(c("nforum_posts_sum") > 0, ratio(c("nforum_posts_sum"), c("nweeks").try_cast("double"))))
    if listings is not None:
        for name in [x for x in listings.columns if x != "course_id"]:
            col = f"listings_{name}"
            out = out.join(listings.select("course_id", c(name).alias("_given")), "course_id", "left")
            have = F.when(c(col) != "", c(col)) if col in out.columns else F.lit(None).cast("string")
            out = out.withColumn(col, F.coalesce(have, c("_given"))).drop("_given")
    return out


def recommend_pin_dates(listings: DataFrame, dumps: DataFrame) -> DataFrame:
    """Dump to use per course: the first one not before its wrap date, else the latest one before it."""
    wrap = listings.select("course_id", listing_date(F.col("Course Wrap")).cast("date").alias("wrap")).filter("wrap IS NOT NULL")
    d = dumps.select("course_id", F.to_date("dump_date").alias("dump"))
    after, before = F.min(F.when(F.col("dump") >= F.col("wrap"), F.col("dump"))), F.max(F.when(F.col("dump") < F.col("wrap"), F.col("dump")))
    return wrap.join(d, "course_id", "left").groupBy("course_id").agg(F.coalesce(after, before).alias("pin_date"))
