"""Minimax contiguous partition of documents into shards.

Equal texts stay together: the order is that of the texts' MD5 digests, cut into a fixed
number of bins, which are the atomic groups. The smallest feasible shard capacity is found
by binary search, each trial walks greedily over the bins' prefix sums, and the shards are
cut there. Only the bins' sizes reach the driver, as many at any input size.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window as W, functions as F

from cohortkit.llm.common import staged

#: Hex digits of the digest that name a bin: 4 make 65,536 bins.
DIGITS = 4
#: Cells per shard in which rows are numbered apart.
CELLS = 1024


def _greedy(prefix: list[int], first: int, last: int, capacity: int) -> list[int]:
    """Starts of the shards that a greedy walk over bins first..last-1 makes; no bin exceeds the capacity."""
    starts, at = [], first
    while at < last:
        starts.append(at)
        at = min(bisect_right(prefix, prefix[at] + capacity) - 1, last)
    return starts


def cut_points(sizes: list[int], n_shards: int) -> list[int]:
    """Starts of at most ``n_shards`` contiguous shards over the groups' sizes, the largest as small as can be.

    A group above the even share decides the largest shard alone and gets a shard of its
    own, so that the rest is still cut evenly; runs between such groups are cut with the
    smallest capacity for which all runs together need no more than the shards left.
    """
    prefix = [0]
    for s in sizes:
        prefix.append(prefix[-1] + s)
    alone: set[int] = set()
    while len(alone) < n_shards - 1:
        left = n_shards - len(alone)
        rest = prefix[-1] - sum(sizes[i] for i in alone)
        more = {i for i, s in enumerate(sizes) if i not in alone and s * left > rest}
        runs = _runs(len(sizes), alone | more)
        if not more or len(alone | more) + len(runs) > n_shards:
            break
        alone |= more
    runs = _runs(len(sizes), alone)
    left = n_shards - len(alone)
    low = max((max(sizes[a:b]) for a, b in runs), default=0)
    low = max(low, -(-sum(prefix[b] - prefix[a] for a, b in runs) // max(1, left)))
    high = max((prefix[b] - prefix[a] for a, b in runs), default=0)
    low = min(low, high)
    while low < high:
        mid = (low + high) // 2
        if sum(len(_greedy(prefix, a, b, mid)) for a, b in runs) <= left:
            high = mid
        else:
            low = mid + 1
    return sorted([*alone, *(x for a, b in runs for x in _greedy(prefix, a, b, low))])


def _runs(n: int, alone: set[int]) -> list[tuple[int, int]]:
    """The maximal runs of 0..n-1 without the members of ``alone``."""
    marks = [-1, *sorted(alone), n]
    return [(a + 1, b) for a, b in zip(marks, marks[1:]) if a + 1 < b]


def shard_by_bytes(docs: DataFrame, n_shards: int = 40, cells: int = CELLS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per document.

    Size is the text's UTF-8 bytes plus 16; a null text counts as empty. All rows of equal
    text share a shard; shards are near equal in bytes as far as groups of copies allow.
    Slots number a shard's rows without a gap in an order that depends on ids and texts
    only; rows are numbered apart in cells of the id's hash, offsets come from the cells'
    counts. Equal rows are numbered in any order, which cannot be told apart. Null ids are
    kept. An empty table gives an empty result.
    """
    c = F.col
    text = F.coalesce(c("text"), F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGITS), 16, 10).cast("int").alias("bin"),
        (F.crc32(F.coalesce(c("doc_id").cast("string"), F.lit("")).cast("binary")) % cells).cast("int").alias("cell"))
    slim = staged(slim, "shard-sizes")
    bins = sorted((r["bin"], r["size"]) for r in slim.groupBy("bin").agg(F.sum("size").alias("size")).collect())
    starts = [bins[i][0] for i in cut_points([s for _, s in bins], n_shards)]
    shard = sum(((c("bin") >= F.lit(s)).cast("int") for s in starts[1:]), F.lit(0))
    placed = slim.withColumn("shard", shard.cast("int"))
    before = W.partitionBy("shard").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "cell").count().select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    rank = F.row_number().over(W.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size"))
    return (placed.join(offsets, ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (c("ahead") + rank - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
