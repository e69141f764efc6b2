"""Building blocks that stay balanced when one key holds a large share of the rows.

No block here collects a whole group in one task: groups are split by time slot,
value bucket or salt, and whatever crosses the splits is reduced first.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

SALTS = 16
# Value buckets of the quantile search: |v|**(1/4) * BUCKETS, so that a bucket is
# narrow near zero and the count of buckets grows with the fourth root of the range.
BUCKETS = 4096


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, null when the denominator is 0 or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def safe_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows with both values; null, not an error, when one of them does not vary."""
    x, y = (F.col(c) if isinstance(c, str) else c for c in (x, y))
    xs, ys = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return ratio(F.covar_pop(x, y), F.stddev_pop(xs) * F.stddev_pop(ys))


def count_if(cond: Column) -> Column:
    """Number of rows where ``cond`` holds; 0 for no row."""
    return F.count(F.when(cond, F.lit(1)))


def flag(cond: Column) -> Column:
    """1 where ``cond`` holds, else 0 (null counts as 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def micros(col: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp."""
    return F.unix_micros(F.col(col) if isinstance(col, str) else col)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Difference of two timestamps in seconds, exact to the microsecond."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1.0e6)


def salted_lookup(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    salt_by: Iterable[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``big`` to a table with at most one row per key, spreading hot keys.

    ``small`` is repeated once per salt, so a key holding a third of ``big`` is
    spread over ``salts`` shuffle partitions. The copies come from a cross join,
    whose estimated size is that of all of them: the planner broadcasts them only
    when they are small together. ``salt_by`` names columns that vary within a key.

    ``salts=1`` is for facts about single items, nodes or groups, which are as many as
    the content: copies would outgrow ``big``. The tables are merged by key, never
    broadcast (their files may be far smaller than their rows), and AQE splits a
    partition that a hot key makes large.
    """
    if salts == 1:
        return big.join(small.hint("merge"), on, how)
    source = [F.col(c) for c in salt_by] if salt_by else [F.col(c) for c in big.columns if c not in on] or [F.col(c) for c in on]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*source), F.lit(salts)).cast("int"))
    spread = small.crossJoin(small.sparkSession.range(salts).select(F.col("id").cast("int").alias("_salt")))
    return salted.join(spread, [*on, "_salt"], how).drop("_salt")


def with_halo(df: DataFrame, time: str, slot_s: int, halo_s: int) -> DataFrame:
    """Cut a log into time slots, repeating each slot's last ``halo_s`` seconds in the next.

    Adds ``_slot`` and ``_real`` (false for repeated context rows). Any look-back
    limited to ``halo_s`` seconds can then run inside (key, slot): one very active
    user becomes many small groups and the log is shuffled only once.
    """
    if halo_s > slot_s:
        raise ValueError("the halo must not be longer than a slot")
    us = F.unix_micros(F.col(time))
    slot_us = slot_s * 1_000_000
    slot = F.floor(us / F.lit(slot_us)).cast("long")
    left = (slot + 1) * F.lit(slot_us) - us
    copies = F.when(
        left <= F.lit(halo_s * 1_000_000),
        F.array(F.struct(slot.alias("_slot"), F.lit(True).alias("_real")),
                F.struct((slot + 1).alias("_slot"), F.lit(False).alias("_real"))),
    ).otherwise(F.array(F.struct(slot.alias("_slot"), F.lit(True).alias("_real"))))
    return df.select("*", F.inline(copies))


def lag_by_slot(
    df: DataFrame, keys: list[str], order: list[str], columns: Mapping[str, str], slot: Column
) -> DataFrame:
    """Previous row's values within ``keys`` without sorting a whole key in one task.

    ``columns`` maps a source column to the name of its lagged copy; ``slot`` is any
    expression that never decreases along ``order``. Rows take their predecessor
    inside the slot; the first row of a slot takes the last row of the key's latest
    earlier slot, found from one row per (key, slot).
    """
    packed = df.withColumn("_slot", slot).withColumn(
        "_pack", F.struct(*[F.col(c) for c in columns])
    )
    inner = W.partitionBy(*keys, "_slot").orderBy(*order)
    rows = packed.withColumn("_prev", F.lag("_pack").over(inner)).withColumn(
        "_first", F.row_number().over(inner) == 1
    )
    tails = (
        packed.groupBy(*keys, "_slot")
        .agg(F.max_by("_pack", F.struct(*[F.col(c) for c in order])).alias("_tail"))
        .withColumn("_carry", F.lag("_tail").over(W.partitionBy(*keys).orderBy("_slot")))
        .drop("_tail")
    )
    joined = rows.join(tails, [*keys, "_slot"], "left")
    prev = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))
    out = joined.withColumn("_prev", prev)
    for src, name in columns.items():
        out = out.withColumn(name, F.col(f"_prev.{src}"))
    return out.drop("_slot", "_pack", "_prev", "_first", "_carry")


def most_frequent(
    df: DataFrame,
    keys: list[str],
    value: str,
    weight: Column,
    tie: Column | None = None,
    distinct_as: str | None = None,
    count_as: str = "n",
) -> DataFrame:
    """Modal value per key from weighted rows; ties go to ``tie`` (greatest), then the least value.

    Two combining aggregations and no sort: the weights are summed per (key, value)
    and the winner is the greatest (weight, tie) pair.
    """
    sums = [F.sum(weight).alias("_w")]
    if tie is not None:
        sums.append(F.max(tie).alias("_t"))
    per_value = df.groupBy(*keys, value).agg(*sums)
    rank = [F.col("_w")] + ([F.col("_t")] if tie is not None else [])
    best = F.struct(*rank).alias("_rank")
    per_value = per_value.withColumn("_rank", best)
    aggs = [F.max("_rank").alias("_best")]
    if distinct_as:
        aggs.append(F.count(F.lit(1)).alias(distinct_as))
    aggs.append(
        # greatest rank first, then the least value: negate by comparing pairs
        F.max_by(F.struct(value), F.struct("_rank", _descending(F.col(value)))).alias("_win")
    )
    out = per_value.groupBy(*keys).agg(*aggs)
    cols = [*[F.col(k) for k in keys], F.col(f"_win.{value}").alias(value), F.col("_best._w").alias(count_as)]
    if tie is not None:
        cols.append(F.col("_best._t").alias("_tie"))
    if distinct_as:
        cols.append(F.col(distinct_as))
    return out.select(*cols)


def _descending(text: Column) -> Column:
    """A key that orders texts in reverse byte order (the end mark sorts above any byte)."""
    return F.concat(
        F.translate(F.hex(F.encode(text.cast("string"), "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210"),
        F.lit("~"),
    )


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    wanted: Mapping[str, tuple[Column, float]],
    mode: str = "disc",
    pre_counted: str | None = None,
) -> DataFrame:
    """Exact quantiles of many expressions per group; no group is held in one task.

    Equal values are counted first (a combining shuffle on the value itself), then
    counts per value bucket locate the bucket with the wanted rank, and only that
    bucket is ranked. ``mode`` is ``disc`` (smallest value whose share of the rows
    reaches p) or ``cont`` (linear interpolation). ``wanted`` maps a result name to
    (expression, p). Groups whose values are all null give null.
    """
    names = list(wanted)
    cells = F.array(*[
        F.struct(F.lit(i).alias("_m"), expr.cast("double").alias("_v"))
        for i, (expr, _) in enumerate(wanted.values())
    ])
    share = F.create_map(*[x for i, (_, p) in enumerate(wanted.values()) for x in (F.lit(i), F.lit(float(p)))])
    group = [*keys, "_m"]
    long = df.select(*keys, F.inline(cells)).filter(F.col("_v").isNotNull())
    counted = long.groupBy(*group, "_v").agg(F.count(F.lit(1)).alias("_c"))
    # sqrt is correctly rounded everywhere, so a value always falls in the same bucket
    magnitude = F.sqrt(F.sqrt(F.abs(F.col("_v")))) * F.lit(BUCKETS)
    counted = counted.withColumn("_b", F.floor(F.signum("_v") * magnitude).cast("long"))
    by_bucket = counted.groupBy(*group, "_b").agg(F.sum("_c").alias("_bc"))
    run = W.partitionBy(*group).orderBy("_b").rowsBetween(W.unboundedPreceding, W.currentRow)
    total = W.partitionBy(*group)
    buckets = by_bucket.withColumn("_upto", F.sum("_bc").over(run)).withColumn("_n", F.sum("_bc").over(total))
    buckets = buckets.withColumn("_p", F.element_at(share, F.col("_m")))
    if mode == "disc":
        # rank of the smallest value reaching the share, 1-based
        low = F.greatest(F.ceil(F.col("_p") * F.col("_n")), F.lit(1)).cast("long")
        ranks = F.array(F.struct(F.lit(0).alias("_end"), low.alias("_r")))
    else:
        place = F.col("_p") * (F.col("_n") - 1)
        ranks = F.array(
            F.struct(F.lit(0).alias("_end"), (F.floor(place) + 1).cast("long").alias("_r")),
            F.struct(F.lit(1).alias("_end"), (F.ceil(place) + 1).cast("long").alias("_r")),
        )
    targets = (
        buckets.select(*group, "_b", "_bc", "_upto", "_n", "_p", F.inline(ranks))
        .filter((F.col("_r") <= F.col("_upto")) & (F.col("_r") > F.col("_upto") - F.col("_bc")))
        .withColumn("_need", F.col("_r") - (F.col("_upto") - F.col("_bc")))
        .select(*group, "_b", "_n", "_p", "_end", "_need")
    )
    inside = W.partitionBy(*group, "_b", "_end").orderBy("_v").rowsBetween(W.unboundedPreceding, W.currentRow)
    picked = (
        counted.join(targets, [*group, "_b"], "inner")
        .withColumn("_cum", F.sum("_c").over(inside))
        .filter((F.col("_cum") >= F.col("_need")) & (F.col("_cum") - F.col("_c") < F.col("_need")))
    )
    aggs = []
    for i, name in enumerate(names):
        here = F.col("_m") == i
        low_v = F.max(F.when(here & (F.col("_end") == 0), F.col("_v")))
        if mode == "disc":
            aggs.append(low_v.alias(name))
            continue
        high_v = F.max(F.when(here & (F.col("_end") == 1), F.col("_v")))
        place = F.max(F.when(here, F.col("_p") * (F.col("_n") - 1)))
        aggs.append((low_v + (high_v - low_v) * (place - F.floor(place))).alias(name))
    return picked.groupBy(*keys).agg(*aggs)


def range_lookup(
    points: DataFrame, point: str, ranges: DataFrame, start: str, end: str, width: int, how: str = "left"
) -> DataFrame:
    """Join points to closed number ranges through fixed-width cells, never as a nested loop.

    Each range is listed once per cell it touches and the cell is an equi-join key.
    Points are reduced to distinct values first, so a hot point is matched once.
    """
    cells = ranges.withColumn(
        "_cell",
        F.explode(F.sequence(F.floor(F.col(start) / width).cast("long"), F.floor(F.col(end) / width).cast("long"))),
    )
    distinct = points.select(point).filter(F.col(point).isNotNull()).distinct().withColumn(
        "_cell", F.floor(F.col(point) / width).cast("long")
    )
    hit = distinct.join(cells, "_cell", "inner").filter(F.col(point).between(F.col(start), F.col(end)))
    return salted_lookup(points, hit.drop("_cell"), [point], how)
