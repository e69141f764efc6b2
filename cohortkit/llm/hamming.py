"""Exact top-k search over binary codes by incremental multi-index hashing.

Codes are cut into segments, each with a table from values to codes. Two codes at distance
d agree up to floor(d / segments) bits in some segment, so once every table has been probed
up to radius r, all codes at a distance below segments * (r + 1) have been seen. A query's
radius grows until its k-th verified distance is below that.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortkit.llm.common import staged

#: Bits of a code and of a segment, neighbours wanted.
BITS, SEGMENT, K = 64, 16, 10
#: Codes and queries that meet in one task at most; least number of blocks of codes.
CODES, QUERIES, BLOCKS = 1 << 18, 1 << 12, 24
#: Parts in which the ids of one code are cut to the smallest.
SALTS = 32


def sign_codes(vectors: DataFrame, bits: int = BITS) -> DataFrame:
    """(vec_id, code): bit i is set if component i is above 0; missing components and vectors count as 0.

    Only the first ``bits`` components, at most 64, have a bit.
    """
    c = F.col
    part = lambda i: F.when(F.try_element_at(c("embedding"), F.lit(i + 1)) > 0, F.shiftleft(F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    code = part(0)
    for i in range(1, bits):
        code = code.bitwiseOR(part(i))
    return vectors.select(c("vec_id").cast("long").alias("vec_id"), code.alias("code"))


def _least_ids(codes: DataFrame, keep: int) -> DataFrame:
    """(code, ids): the ``keep`` smallest ids of each code, sorted. Salted first, so one very common code is not one task."""
    c = F.col
    rank = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy("vec_id"))
    some = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).withColumn("r", rank("code", "salt")).filter(c("r") <= keep)
    best = some.withColumn("r", rank("code")).filter(c("r") <= keep)
    return best.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))


class SegmentTables:
    """Codes by the values of their segments."""

    def __init__(self, codes: np.ndarray, weights: np.ndarray, bits: int = BITS, width: int = SEGMENT):
        self.codes, self.weights = codes, weights
        self.cuts = [(at, min(width, bits - at)) for at in range(0, bits, width)]
        self.tables = []
        for at, w in self.cuts:
            values = ((codes >> np.uint64(at)) & np.uint64((1 << w) - 1)).astype(np.int64)
            order = np.argsort(values, kind="stable")
            self.tables.append((order, *np.unique(values[order], return_index=True)))
        self.masks: dict[tuple[int, int], np.ndarray] = {}

    def _mask(self, width: int, radius: int) -> np.ndarray:
        if (width, radius) not in self.masks:
            self.masks[width, radius] = np.array([sum(1 << b for b in m) for m in combinations(range(width), radius)], dtype=np.int64)
        return self.masks[width, radius]

    def _probe(self, value: int, table, width: int, radius: int) -> np.ndarray:
        """Positions of the codes whose segment is exactly ``radius`` bits from the value, through keys or, if fewer, the values that occur."""
        order, values, starts = table
        masks = self._mask(width, radius)
        if len(masks) < len(values):
            keys = value ^ masks
            at = np.minimum(np.searchsorted(values, keys), len(values) - 1)
            at = at[values[at] == keys]
        else:
            at = np.flatnonzero(np.bitwise_count(values ^ value) == radius)
        ends = np.append(starts[1:], len(order))
        sizes = ends[at] - starts[at]
        if not sizes.size:
            return order[:0]
        base = np.repeat(starts[at] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
        return order[base + np.arange(sizes.sum())]

    def nearest(self, query: int, want: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the nearest codes of weight ``want`` together or more, with all ties of the last distance."""
        seen = np.zeros(len(self.codes), dtype=bool)
        distances = np.full(len(self.codes), 255, dtype=np.uint8)
        for radius in range(max(w for _, w in self.cuts) + 1):
            for (at, width), table in zip(self.cuts, self.tables):
                if radius <= width:
                    met = self._probe((query >> at) & ((1 << width) - 1), table, width, radius)
                    met = met[~seen[met]]
                    seen[met] = True
                    distances[met] = np.bitwise_count(self.codes[met] ^ np.uint64(query))
            sure = np.flatnonzero(distances < len(self.cuts) * (radius + 1))
            if self.weights[sure].sum() >= want:
                break
        else:
            sure = np.flatnonzero(seen)
        by = np.bincount(distances[sure], weights=self.weights[sure], minlength=1).cumsum()
        last = int(np.searchsorted(by, want)) if by[-1] >= want else 255
        sure = sure[distances[sure] <= last]
        return sure, distances[sure]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, bits: int = BITS, width: int = SEGMENT) -> DataFrame:
    """(query_id, rank, neighbor_id, distance): the k codes nearest to each query, exact, ties by id.

    ``vectors`` and ``queries`` have vec_id and embedding; a query's own id is not among its
    neighbours. Equal codes are one entry with its k+1 smallest ids, which is all that any
    result can show of them, and equal queries are searched once. Codes and queries are
    dealt out in blocks, and each block of queries meets each block of codes in a task that
    builds the segment tables of its codes; rows are few for the work they make, so the number
    of tasks is stated and not left to their bytes. Rows without an id are left out of both sides,
    since a result could not name them; repeated ids count once. Fewer than k other ids give
    fewer rows; empty tables give an empty result.
    """
    c = F.col
    index = staged(_least_ids(sign_codes(vectors, bits).filter("vec_id IS NOT NULL").distinct(), k + 1), "hamming-index")
    asked = staged(sign_codes(queries, bits).filter("vec_id IS NOT NULL").distinct(), "hamming-queries")
    parts = max(BLOCKS, -(-index.count() // CODES))
    q_parts = -(-max(1, asked.count()) // QUERIES)
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    block = lambda n, name: F.pmod(F.xxhash64("code"), F.lit(n)).cast("int").alias(name)
    left = index.select("code", F.size("ids").alias("n"), block(parts, "part"), every(q_parts, "q_part"))
    right = asked.select("code").distinct().select("code", every(parts, "part"), block(q_parts, "q_part"))

    def search(codes: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(codes) and len(wanted):
            own = codes["code"].to_numpy()
            tables = SegmentTables(own.view(np.uint64), codes["n"].to_numpy(), bits, width)
            for q in wanted["code"].to_numpy():
                at, distances = tables.nearest(int(q) & ((1 << 64) - 1), k + 1)
                found.append(pd.DataFrame({"q": q, "code": own[at], "n": tables.weights[at], "distance": distances.astype(np.int32)}))
        return pd.concat(found) if found else pd.DataFrame({"q": [], "code": [], "n": [], "distance": []})

    dealt = lambda rows: rows.repartition(parts * q_parts, "part", "q_part").groupBy("part", "q_part")
    met = dealt(left).cogroup(dealt(right)).applyInPandas(search, "q long, code long, n int, distance int")
    best = _nearest(staged(met, "hamming-found"), k)
    named = best.join(index, "code").select("q", "distance", F.explode("ids").alias("neighbor_id"))
    order = lambda by: W.partitionBy(by).orderBy("distance", "neighbor_id")
    few = named.withColumn("r", F.row_number().over(order("q"))).filter(c("r") <= k + 1).drop("r")
    rows = asked.select(c("vec_id").alias("query_id"), c("code").alias("q")).join(few, "q").filter("query_id != neighbor_id")
    return rows.withColumn("rank", F.row_number().over(order("query_id"))).filter(c("rank") <= k).select("query_id", "rank", "neighbor_id", "distance")


def _nearest(pairs: DataFrame, k: int) -> DataFrame:
    """Of each query's codes, the nearest that together have k+1 ids or more, with all ties of the last distance.

    Per query and distance the ids are added up first, so the cut comes from a few numbers.
    """
    c = F.col
    steps = pairs.groupBy("q", "distance").agg(F.sum("n").alias("ids"))
    ahead = F.coalesce(F.sum("ids").over(W.partitionBy("q").orderBy("distance").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = steps.withColumn("ahead", ahead).filter(c("ahead") <= k).groupBy("q").agg(F.max("distance").alias("cut"))
    return pairs.join(cut, "q").filter(c("distance") <= c("cut")).select("q", "code", "n", "distance")
