"""SimHash near-duplicates, linked through BK-trees.

Fingerprints within a few bits of each other agree on some pair of blocks of their bits,
so every pair of blocks' values names a shard, and a BK-tree per shard finds the links in
it. Trees and their queries meet by shuffle; nothing that grows with the data is broadcast.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cohortkit.llm.common import heavy_lookup, staged
from cohortkit.llm.graph import components

#: Words of a shingle, the most differing bits of a link, the hash's seed.
SHINGLE, RADIUS, SEED = 4, 4, 42
#: A shard with more members is dealt out in cells of two chunks of at most about this size.
CHUNK = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text; 0 without a word, and of the whole text's words if they are few."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        return digest(joined, seed)
    ends = list(accumulate(map(len, words), lambda a, x: a + 1 + x))
    starts = [0, *(e + 1 for e in ends)]
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1:])], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * votes.astype(np.int64) > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, digest, fp): the text's MD5 and its fingerprint as a signed 64-bit number; a null text counts as an empty one."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            fps = np.fromiter((fingerprint(t.as_py() or b"", shingle, seed) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(fps.view(np.int64))], ["doc_id", "digest", "fp"])

    rows = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "md5(cast(coalesce(text, '') AS binary)) AS digest", "text")
    return rows.mapInArrow(run, "doc_id long, digest string, fp long")


class BKTree:
    """Codes whose children are keyed by their Hamming distance to the parent."""

    def __init__(self, code: int):
        self.root = [code, {}]

    def add(self, code: int) -> None:
        node = self.root
        while True:
            d = (node[0] ^ code).bit_count()
            child = node[1].get(d)
            if child is None:
                node[1][d] = [code, {}]
                return
            node = child

    def near(self, code: int, radius: int):
        """Codes within the radius, following only edges that can lead to one."""
        stack = [self.root]
        while stack:
            own, children = stack.pop()
            d = (own ^ code).bit_count()
            if d <= radius:
                yield own
            if children:
                for edge, child in children.items():
                    if d - radius <= edge <= d + radius:
                        stack.append(child)


def shard_links(codes: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect whatever chains of codes within the radius connect.

    Codes without a link so far share one tree; every group of linked codes has a tree of
    its own, in which one code within the radius is enough. So a large group of near
    copies costs a short search per member, not one per pair.
    """
    links: list[tuple[int, int]] = []
    lone: BKTree | None = None
    single: set[int] = set()
    groups: list[list[BKTree]] = []
    for x in codes:
        mine, others = [], []
        for g in groups:
            y = next((y for t in g for y in t.near(x, radius)), None)
            if y is None:
                others.append(g)
            else:
                mine.append(g)
                links.append((x, y))
        alone = [y for y in lone.near(x, radius) if y in single] if lone and single else []
        if not mine and not alone:
            single.add(x)
            if lone:
                lone.add(x)
            else:
                lone = BKTree(x)
            continue
        trees = [t for g in mine for t in g] or [BKTree(x)]
        if mine:
            trees[0].add(x)
        for y in alone:
            links.append((x, y))
            single.discard(y)
            trees[0].add(y)
        groups = [*others, trees]
    return links


def block_pairs(bits: int = 64, radius: int = RADIUS) -> list[tuple[int, int, int, int]]:
    """(shift, width, shift, width) of the pairs among radius+2 blocks: codes within the radius agree on one pair at least."""
    n = radius + 2
    widths = [bits // n + (i < bits % n) for i in range(n)]
    shifts = [sum(widths[:i]) for i in range(n)]
    return [(shifts[a], widths[a], shifts[b], widths[b]) for a, b in combinations(range(n), 2)]


def _shard_keys(fp: Column, radius: int) -> Column:
    part = lambda s, w: F.shiftrightunsigned(fp, s).bitwiseAND(F.lit((1 << w) - 1))
    keys = [F.lit(k << 40).cast("long") + F.shiftleft(part(s1, w1), w2) + part(s2, w2) for k, (s1, w1, s2, w2) in enumerate(block_pairs(64, radius))]
    return F.array(*keys)


def links(codes: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(u, v): links between the distinct codes of ``codes`` (fp), enough of them to connect every group.

    A shard of more than ``chunk`` codes is split into chunks by a hash; each pair of chunks
    is a cell, so that no link is lost and no task holds more than two chunks at once.
    """
    c = F.col
    rows = codes.select("fp", F.explode(_shard_keys(c("fp"), radius)).alias("shard"))
    large = rows.groupBy("shard").count().filter(c("count") > chunk).select("shard", F.ceil(c("count") / chunk).cast("int").alias("parts"))
    rows = rows.join(large, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    mine = F.pmod(F.xxhash64("fp"), c("parts")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), c("parts") - 1), lambda j: F.least(mine, j) * c("parts") + F.greatest(mine, j))
    rows = rows.select("fp", "shard", F.explode(cells).alias("cell"))
    spread = rows.repartition(F.col("shard"), F.col("cell")).sortWithinPartitions("shard", "cell", "fp")

    def run(batches):
        held: list[int] = []
        at = None
        for batch in batches:
            fp, shard, cell = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("fp", "shard", "cell"))
            if not len(fp):
                continue
            edges = np.flatnonzero((shard[1:] != shard[:-1]) | (cell[1:] != cell[:-1])) + 1
            bounds = [0, *edges.tolist(), len(fp)]
            codes = fp.view(np.uint64).tolist()
            found: list[tuple[int, int]] = []
            for a, b in zip(bounds, bounds[1:]):
                key = (shard[a], cell[a])
                if key != at:
                    if len(held) > 1:
                        found += shard_links(held, radius)
                    at, held = key, []
                held += codes[a:b]
            if found:
                yield out(found)
        if len(held) > 1 and (found := shard_links(held, radius)):
            yield out(found)

    def out(found):
        pairs = np.array(found, dtype=np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    return spread.mapInArrow(run, "u long, v long")


def grouped(docs: DataFrame, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """The documents' (doc_id, digest, fp), and (fp, copies, least, root) of the distinct codes; both staged.

    ``root`` names a code's component, ``least`` is the code's least (no id, doc_id, digest).
    """
    c = F.col
    slim = staged(fingerprints(docs, shingle), "simhash-codes")
    order = F.struct(c("doc_id").isNull().alias("anonymous"), "doc_id", "digest")
    codes = staged(slim.groupBy("fp").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("copies")), "simhash-distinct")
    roots = components(links(codes, radius))
    named = codes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("_least"))
    return slim, staged(named.join(least, "root").select("fp", "copies", c("_least").alias("least"), "root"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id), one row per document; the component's name is its smallest doc_id.

    Documents link when their fingerprints differ in at most ``radius`` bits; components are
    what chains of links connect. Equal fingerprints are one code, so exact copies are not
    paired. Texts without a word have fingerprint 0 and link like others. Null ids take part
    but never name a component unless it has no other (null). An empty table gives an empty
    result.
    """
    slim, codes = grouped(docs, shingle, radius)
    table = codes.select("fp", "copies", F.col("least.doc_id").alias("component_id"))
    return heavy_lookup(slim, table, ["fp"], "copies").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: that with the least doc_id (null last), then the least digest of the text.

    Rows are told apart by id and text, so of rows that share an id but not the text each is
    decided for itself; rows equal in both are one document. What goes is listed by id and
    digest: texts move only if that list is too long for Spark to broadcast.
    """
    c = F.col
    slim, codes = grouped(docs, shingle, radius)
    table = codes.select("fp", "copies", c("least.doc_id").alias("_id"), c("least.digest").alias("_digest"))
    rows = heavy_lookup(slim, table, ["fp"], "copies")
    first = c("doc_id").eqNullSafe(c("_id")) & (c("digest") == c("_digest"))
    known = staged(rows.groupBy("doc_id", "digest").agg(F.max(first).alias("first"), F.count(F.lit(1)).alias("n")), "simhash-known")
    listed = known.filter("NOT first OR n > 1").select(c("doc_id").alias("_dedup_id"), c("digest").alias("_dedup_digest"), c("first").alias("_dedup_first"))
    keyed = docs.withColumn("_dedup_key", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    joined = keyed.join(listed, c("doc_id").cast("long").eqNullSafe(c("_dedup_id")) & (c("_dedup_key") == c("_dedup_digest")), "left")
    alone = joined.filter("_dedup_first IS NULL")
    again = joined.filter("_dedup_first").dropDuplicates(["_dedup_id", "_dedup_key"])
    return alone.unionByName(again).select(*[c(f"`{x}`") for x in docs.columns])
