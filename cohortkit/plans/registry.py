"""Registry of the queries and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Plain result types: doubles rounded, whole numbers as long, dates and times as text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, oracle: str | None = None, digits: int = 6) -> Callable[[Build], Build]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def add(build: Build) -> Build:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return tidy(build(spark, sf_dir), digits)

        run.__name__ = build.__name__
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add
