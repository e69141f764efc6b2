"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "cohortkit", **conf: str) -> SparkSession:
    """A session with the settings every operator expects (UTC, AQE, skew joins)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster such a
    folder is private to one machine and is lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    set_dir = spark.sparkContext.getCheckpointDir()
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="cohortkit-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder."""
    spark = df.sparkSession
    root = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


#: Settings of a staging write: shuffle files go when it ends, times are 8 bytes.
STAGING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
#: Tables laid out by the same few columns meet where they lie, though they are joined by more.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


@contextlib.contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def stage(df: DataFrame, label: str, in_place: bool = False) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts the lineage and lets later steps read the columns they use.

    The write's shuffle files are removed when it ends. ``in_place`` lets the plan join tables that
    ``repartition`` has laid out by some of the join's columns without moving them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with settings(spark, {**STAGING, **(IN_PLACE if in_place else {})}):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
