"""Helpers shared by the operators: tables, words, staged intermediate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortkit.session import scratch_path

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    Cuts the lineage where a result is read more than once; the files survive lost
    executors, and later steps read only the columns they use.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of documents that no model learns from; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def unit_hash(*cols: Column) -> Column:
    """A uniform number in [0, 1) from the MD5 of the columns' text; null counts as empty."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


#: Keys that hold more than one in so many rows are looked up without a shuffle; there are fewer of them than this.
HEAVY = 1024


def heavy_lookup(rows: DataFrame, table: DataFrame, key: list[str], copies: str) -> DataFrame:
    """``rows`` joined with ``table``, which has one row per key and counts the rows of each in ``copies``.

    Keys with more than a ``HEAVY``-th of all rows, fewer than ``HEAVY`` by their definition,
    are broadcast; the others meet by shuffle, so no task receives more of one key than that.
    """
    total = table.agg(F.sum(copies)).first()[0] or 0
    most = F.col(copies) * HEAVY > total
    heavy, light = table.filter(most).drop(copies), table.filter(~most).drop(copies)
    hot = rows.join(F.broadcast(heavy), key)
    cold = rows.join(F.broadcast(heavy.select(*key)), key, "left_anti").join(light, key)
    return hot.unionByName(cold)
