"""Mixing sources to target weights.

Tokens are added up per source, a repetition rate follows for each source, and every
document is emitted floor(rate) times plus once more with a probability equal to the
fraction, drawn from a hash of its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from cohortkit.llm.common import WORD, staged, unit_hash

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix over words of the input, and the most a source may be repeated.
SHARE, MOST = 1.5, 2


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows with ``source`` and ``size``; one row per source, null included.

    Sources share ``share`` times all sizes by weight; none is given more than ``most``
    times its own size, the excess goes to the others by weight. With sources ordered by
    cap over weight, the common level is the greatest of the levels that arise when the
    first k are taken at their caps, so no iteration is needed. The windows see one row
    per source.
    """
    c = F.col
    per = sizes.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(c("source").asc_nulls_last())) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))
    before = W.orderBy(c("source_size") / c("weight"), c("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = (per.withColumn("capped", F.coalesce(F.sum(most * c("source_size")).over(before), F.lit(0)))
           .withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
           .withColumn("level", (share * F.sum("source_size").over(every) - c("capped")) / (F.sum("weight").over(every) - c("used"))))
    level = F.max("level").over(every)
    return per.select("source", "source_size", F.least((most * c("source_size")).cast("double"), level * c("weight")).alias("target"))


def _drawn(docs: DataFrame, seed: str = "mix", **rules) -> DataFrame:
    """``docs`` with its figures in columns whose names begin with _mix_."""
    c = F.col
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    targets = staged(source_targets(docs.select("source", words.alias("size")), **rules), "mix-targets")
    targets = targets.select(*[c(x).alias(f"_mix_{x}") for x in targets.columns])
    joined = docs.withColumn("_mix_size", words).join(targets, c("source").eqNullSafe(c("_mix_source")), "left")
    rate = F.coalesce(F.try_divide("_mix_target", "_mix_source_size"), F.lit(0.0))
    own = F.coalesce(c("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    copies = F.floor(rate) + F.when(unit_hash(F.lit(seed), own) < rate - F.floor(rate), 1).otherwise(0)
    return joined.withColumn("_mix_copies", copies.cast("int"))


def plan_mix(docs: DataFrame, seed: str = "mix", **rules) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), one row per document.

    Sizes are words of the text (null: 0). A null source is a source of its own and comes
    last. A source without words has target 0 and its documents are not emitted; a document of
    size 0 of another source may be emitted but takes nothing. The draw depends on doc_id and
    the seed alone, so reruns agree and repeated rows are drawn alike; a document without an
    id draws by its text. An empty table gives an
    empty result.
    """
    return _drawn(docs, seed, **rules).select("doc_id", "source", *[F.col(f"_mix_{x}").alias(x) for x in ("size", "source_size", "target", "copies")])


def mix(docs: DataFrame, seed: str = "mix", **rules) -> DataFrame:
    """The mixed documents, with the input's columns; a document appears ``copies`` times."""
    drawn = _drawn(docs, seed, **rules).filter("_mix_copies > 0")
    return drawn.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))).select(*[F.col(f"`{x}`") for x in docs.columns])
