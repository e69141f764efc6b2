"""Writing tables out and combining them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortkit.operators.people import strict_union


def export(df: DataFrame, path: str, fmt: str = "csv", gzip: bool = False, rows_per_file: int | None = None) -> None:
    """A table as CSV (with header) or JSON lines, optionally compressed and split by size."""
    writer = df.write.mode("overwrite")
    if gzip:
        writer = writer.option("compression", "gzip")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def combine(tables: dict[str, DataFrame], add_course_id: bool = False) -> DataFrame:
    """Tables of several courses in one; all must have the same header."""
    parts = [df.withColumn("course_id", F.lit(cid)) if add_course_id else df for cid, df in tables.items()]
    return strict_union(parts)


def schema_of(df: DataFrame) -> list[dict[str, str]]:
    """Names and types of a table's columns."""
    return [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema.fields]
