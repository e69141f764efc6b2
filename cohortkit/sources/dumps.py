"""Reading and cleaning the database dumps of a course."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from cohortkit.session import scratch_path

WEIGHT_TOLERANCE = 0.001  # fixed value


def read_sql_dump(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A tab-separated dump with a header; ``NULL`` is null."""
    return spark.read.csv(path, sep="\t", header=True, schema=schema, nullValue="NULL", escape="\\")


def match_course(files: DataFrame, courses: DataFrame) -> DataFrame:
    """The known course whose name is the longest leading part of a file name.

    Every leading part is listed and joined by equality, instead of comparing each file
    with each course. Course ids are written with ``-`` in file names.
    """
    c = F.col
    parts = files.withColumn("lead", F.explode(F.transform(F.sequence(F.lit(1), F.length("file")), lambda i: F.substr(c("file"), F.lit(1), i))))
    names = courses.select("course_id", F.translate("course_id", "/", "-").alias("lead")).distinct()
    best = parts.join(names, "lead", "inner").groupBy("file").agg(F.max_by("course_id", F.length("lead")).alias("course_id"))
    return files.join(best, "file", "left")


def load_checked(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", max_bad: int = 0, target: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """A JSON or CSV file as a Parquet table below ``target``: (its rows, the records that do not parse).

    The file is read once: the pass that writes the table also counts the bad records, and
    puts them in a folder of their own. More than ``max_bad`` are an error; what was written
    stays below ``target`` to look at. Rejects have the parsed columns and ``record``.
    """
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path)
    bad, target = F.col("_corrupt_record").isNotNull(), target or scratch_path(spark, "load")
    seen = Observation()
    marked = df.withColumn("_bad", bad).observe(seen, F.count(F.when(F.col("_bad"), 1)).alias("bad"))
    marked.write.partitionBy("_bad").parquet(target)
    if seen.get["bad"] > max_bad:
        raise ValueError(f"{seen.get['bad']} bad records, at most {max_bad} allowed; see {target}")
    stored = spark.read.schema(T.StructType([*full.fields, T.StructField("_bad", T.BooleanType())])).parquet(target)
    return (stored.filter("NOT _bad").drop("_bad", "_corrupt_record"),
            stored.filter("_bad").drop("_bad").withColumnRenamed("_corrupt_record", "record"))


def load_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json", max_bad: int = 0) -> DataFrame:
    """A JSON or CSV file as a table; more than ``max_bad`` records that do not parse are an error."""
    return load_checked(spark, path, schema, fmt, max_bad)[0]


def _at(json: str, path: str) -> Column:
    return F.get_json_object(json, path)


def _date(json: str, field: str, compat: bool = False) -> Column:
    """An exported date: milliseconds since the epoch or text, of which ``compat`` reads whole minutes without a zone."""
    raw = _at(json, f"$['{field}']['$date']")
    minute = F.try_to_timestamp(F.substr(raw, F.lit(1), F.lit(16)), F.lit("yyyy-MM-dd'T'HH:mm"))
    return F.coalesce(F.timestamp_millis(raw.try_cast("long")), *([] if compat else [F.try_to_timestamp(raw)]), minute)


def rephrase_forum(lines: DataFrame, column: str = "value", compat: bool = False) -> DataFrame:
    """Exported forum documents as flat rows: keys and dates unwrapped, lists as text, dropped fields left out."""
    oid = lambda f: _at(column, f"$['{f}']['$oid']")
    text = lambda f: _at(column, f"$['{f}']")
    ids = F.from_json(text("parent_ids"), "array<map<string,string>>")
    end = F.when(~F.coalesce(text("endorsement"), F.lit("null")).isin("null", "", "{}"), text("endorsement"))
    return lines.filter(F.try_parse_json(column).isNotNull()).select(
        oid("_id").alias("mongoid"), text("_type").alias("_type"), text("author_id").try_cast("long").alias("author_id"),
        text("author_username").alias("author_username"), oid("comment_thread_id").alias("comment_thread_id"), oid("parent_id").alias("parent_id"),
        F.array_join(F.transform(ids, lambda x: x["$oid"]), " ").alias("parent_ids"), text("title").alias("title"), text("body").alias("body"),
        _date(column, "created_at", compat).alias("created_at"), _date(column, "updated_at", compat).alias("updated_at"),
        _date(column, "last_activity_at", compat).alias("last_activity_at"), text("pinned").try_cast("boolean").alias("pinned"),
        text("endorsed").try_cast("boolean").alias("endorsed"), _at(column, "$.votes.count").try_cast("long").alias("votes_count"),
        _at(column, "$.votes.up").alias("votes_up"), _at(column, "$.votes.down").alias("votes_down"),
        *[text(f).alias(f) for f in ("abuse_flaggers", "historical_abuse_flaggers", "at_position_list", "tags_array")], end.alias("endorsement"))


def load_grades_persistent(df: DataFrame, subsection: bool = False) -> DataFrame:
    """Persistent course or subsection grades: ``NULL`` in the time field is null, the course id is plain."""
    field = "first_attempted" if subsection else "passed_timestamp"
    course = F.translate(F.element_at(F.split("course_id", ":"), -1), "+", "/")
    return df.withColumn(field, F.try_to_timestamp(F.nullif(field, F.lit("NULL")))).withColumn("course_id", course)


def load_user_partitions(df: DataFrame) -> DataFrame:
    """Cohort tags; the values true and false become 1 and 0."""
    v = F.lower("value")
    return df.withColumn("value", F.when(v == "true", "1").when(v == "false", "0").otherwise(v))


def load_listings(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Course listings."""
    return spark.read.csv(path, header=True, schema=schema)


def load_staff(spark: SparkSession, path: str, schema: T.StructType | str = "user_id string, username string, email string") -> DataFrame:
    """Staff list."""
    return spark.read.csv(path, header=True, schema=schema)


GRADER = ("array<struct<type: string, name: string, weight: double, short_label: string, min_count: bigint, drop_count: bigint, category: string>>")


def grading_policy(df: DataFrame, cutoffs: list[str], column: str = "policy") -> DataFrame:
    """Grading policies (course_id, JSON) as one row per assignment type with the cutoffs as columns.

    ``cutoffs`` names the cutoffs to lay out. ``weights_ok`` tells whether the weights of
    the course add up to 1 within a thousandth.
    """
    c = F.col
    cuts = F.transform_keys(F.from_json(F.get_json_object(column, "$.GRADE_CUTOFFS"), "map<string,double>"), lambda k, _: F.lower(k))
    rows = df.select("course_id", cuts.alias("cuts"), F.from_json(F.get_json_object(column, "$.GRADER"), GRADER).alias("grader"))
    total = F.aggregate("grader", F.lit(0.0), lambda acc, g: acc + g["weight"])
    rows = rows.select("course_id", "cuts", (F.abs(total - 1.0) < WEIGHT_TOLERANCE).alias("weights_ok"), F.inline("grader"))
    return rows.select(
        "course_id", c("type").alias("assignment_type"), F.coalesce("name", "type").alias("name"), c("weight").alias("fraction_of_overall_grade"),
        "short_label", "min_count", "drop_count", "weights_ok",
        *[c("cuts")[k.lower()].alias("overall_cutoff_for_" + "".join(ch if ch.isalnum() else "_" for ch in k.lower())) for k in cutoffs])


def cutoff_names(df: DataFrame, column: str = "policy") -> DataFrame:
    """Cutoff names used in the policies, in lower case."""
    cuts = F.from_json(F.get_json_object(column, "$.GRADE_CUTOFFS"), "map<string,double>")
    return df.select(F.explode(F.map_keys(cuts)).alias("k")).select(F.lower("k").alias("name")).distinct()


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and keys with duplicates, as one row."""
    per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_keys"), F.count(F.when(F.col("n") > 1, 1)).alias("n_duplicated"))
