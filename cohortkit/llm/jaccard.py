"""N-gram Jaccard join by vertical partitioning.

A document is the set of its word shingles (64-bit hashes), equal sets are one class. The
global order of the shingles goes from rare to common and is cut into fragments of about equal
weight, so every set falls into one segment per fragment. Overlaps of candidate pairs are
counted fragment by fragment and the partial counts are added up per pair.

Two bounds keep the candidates few. Of a set that has any link, at most 15 of 100 shingles may
be missing in the other set: sets with more shingles of their own are dropped. Before that, each
set is cut into more parts by ranges of the hashes than a linked set can differ in: every part
that differs holds a difference, so sets with more parts of their own than differences are
dropped. Parts of several shingles are not met by chance, however large the corpus. And the first common shingle lies within the first 15 of 100 of
both sets (plus one): sets meet by these, at first each with one hub per shingle. What is
connected by then needs no further pair; other sets that meet are compared as pairs, or, where
very many meet, in blocks inside a task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortkit.llm.common import heavy_lookup, staged
from cohortkit.llm.graph import components

#: Words of a shingle, and the least similarity of a link in percent.
SHINGLE, PERCENT = 4, 85
#: Fragments of the global order.
FRAGMENTS = 16
#: Sets that share a first shingle are compared as pairs if no more than so many do.
MEETING = 32
#: A block of larger meetings holds at most about so many sets and shingles.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 21
#: Columns of shingles that a block counts at once.
COLUMNS = 4096

SETS = "doc_id long, text_key long, n long, d1 long, d2 long, levels int, probe array<long>"
#: A part is named by a hash whose lowest bits tell the level, the logarithm of the number of parts.
LEVEL_BITS = 5


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one shingle, one without words none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    grams = {b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}
    return np.sort(np.fromiter(map(digest, grams), dtype=np.uint64, count=len(grams)).view(np.int64))


def spare_parts(n: int, percent: int) -> int:
    """Shingles in which a set of size n and one linked with it can differ, counted in both."""
    return (100 - percent) * (100 * n // percent) // 100


def level(n: int, percent: int) -> int:
    """Sets of size n are cut into 2 ** level parts, some more than they may differ in."""
    return math.ceil(math.log2(1.15 * spare_parts(n, percent) + 2)) if spare_parts(n, percent) else 0


def part_levels(n: int, percent: int) -> range:
    """The levels at which a set of size n meets those linked with it: its own and those of the larger ones."""
    return range(level(n, percent), level(100 * n // percent, percent) + 1)


def parts_of(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Names of the parts of a set (sorted hashes) at all its levels; empty parts have none."""
    out = [np.zeros(0, dtype=np.uint64)]
    plain = hashes.view(np.uint64)
    for k in part_levels(len(hashes), percent) if len(hashes) else ():
        place = (plain ^ np.uint64(1 << 63)) >> np.uint64(64 - k) if k else np.zeros(len(plain), dtype=np.uint64)
        first = np.flatnonzero(np.diff(place, prepend=place[:1] + np.uint64(1)))
        names = np.add.reduceat(plain, first)
        out.append((names >> np.uint64(LEVEL_BITS) << np.uint64(LEVEL_BITS)) | np.uint64(k))
    return np.concatenate(out).view(np.int64)


def _digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), dtype="<i8").tolist())


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)])))


def shingle_sets(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: its set's size and digest, its number of levels and the names of its parts; staged."""

    def run(batches):
        for batch in batches:
            sets = [shingles(t.as_py() or b"", size) for t in batch.column("text").cast(pa.binary())]
            names = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()),
                pa.array([len(part_levels(len(s), percent)) for s in sets], pa.int32()), _lists([parts_of(s, percent) for s in sets])],
                ["doc_id", "text_key", "n", "d1", "d2", "levels", "probe"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return staged(rows.mapInArrow(run, SETS), "jaccard-sets")


def classes_of(sets: DataFrame) -> DataFrame:
    """(cls, d1, d2, n, levels, copies, least, text_key): the distinct sets that are not empty, staged."""
    rows = sets.filter("n > 0").groupBy("d1", "d2").agg(
        F.max("n").alias("n"), F.max("levels").alias("levels"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least"), F.min("text_key").alias("text_key"))
    return staged(rows.withColumn("cls", F.monotonically_increasing_id()), "jaccard-classes")


def _spare(percent: int) -> str:
    """Shingles of a set of size n that another one linked with it may lack."""
    return f"((100 - {percent}) * n) div 100"


def promising(sets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The classes that do not, at all their levels, have more parts of their own than a linked set can differ in; staged.

    Linked sets are cut alike at the level of the larger one, and a part of one alone holds a
    difference. Parts are told apart by one half of the digests; classes that share that half stay.
    """
    c = F.col
    rows = sets.select("d1", F.explode("probe").alias("part")).groupBy("part").agg(F.min("d1").alias("d1"), F.max("d1").alias("other"))
    own = rows.filter("d1 = other").groupBy("d1", c("part").bitwiseAND((1 << LEVEL_BITS) - 1).alias("level")).agg(F.count(F.lit(1)).alias("own"))
    sizes = classes.groupBy("d1").agg(F.count(F.lit(1)).alias("twins"), F.max("n").alias("n"))
    most = F.expr(f"((100 - {percent}) * ((100 * n) div {percent})) div 100")
    alone = own.join(sizes, "d1").filter(c("own") > most).groupBy("d1").agg(F.count(F.lit(1)).alias("alone"))
    joined = classes.join(alone, "d1", "left").join(sizes.select("d1", "twins"), "d1")
    return staged(joined.filter((c("twins") > 1) | (F.coalesce("alone", F.lit(0)) < c("levels"))).select(*classes.columns), "jaccard-promising")


def ordered_sets(docs: DataFrame, chosen: DataFrame, size: int, percent: int, fragments: int) -> DataFrame:
    """(cls, n, own, toks): the sets of the chosen classes that may have links; staged.

    ``toks`` are the shingles that at least two sets have, (ord, frag, tok), in global order:
    by frequency in steps of an eighth of its logarithm, then by hash. Only the texts of the
    chosen classes are read again, each once; they are found by a hash, kept as a table of
    its own so that it is as short as can be.
    """
    c = F.col
    keys = staged(chosen.select("text_key").distinct(), "jaccard-keys")
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text").join(keys, "text_key", "left_semi")
    texts = texts.withColumn("digest", F.md5(F.col("text").cast("binary"))).dropDuplicates(["digest"]).select("text")

    def run(batches):
        for batch in batches:
            sets = [shingles(t.as_py() or b"", size) for t in batch.column("text").cast(pa.binary())]
            names = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in names], pa.int64()), pa.array([b for _, b in names], pa.int64()), _lists(sets)], ["d1", "d2", "toks"])

    sets = texts.mapInArrow(run, "d1 long, d2 long, toks array<long>").join(chosen.select("cls", "n", "d1", "d2"), ["d1", "d2"])
    sets = staged(sets.select("cls", "n", "toks"), "jaccard-tokens")
    counts = staged(sets.select("cls", F.explode("toks").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df"), F.min("cls").alias("cls")), "jaccard-counts")
    own = counts.filter("df = 1").groupBy("cls").agg(F.count(F.lit(1)).alias("own"))
    left = sets.join(own, "cls", "left").filter(F.coalesce("own", F.lit(0)) <= F.expr(_spare(percent)))
    rows = left.select("cls", "n", F.explode("toks").alias("tok"))
    often = counts.filter("df > 1").select("tok", "df", F.floor(8 * F.log2("df")).cast("int").alias("ord"), F.shiftright("tok", 58).cast("int").alias("sub"))
    cuts = often.groupBy("ord", "sub").agg(F.sum("df").alias("weight"))
    ahead = W.orderBy("ord", "sub").rowsBetween(W.unboundedPreceding, -1)  # over 64 rows per step of the order, a few thousand at any size
    cuts = cuts.withColumn("ahead", F.coalesce(F.sum("weight").over(ahead), F.lit(0)))
    total = often.agg(F.sum("df")).first()[0] or 1
    cuts = cuts.select("ord", "sub", F.floor(c("ahead") * fragments / total).cast("int").alias("frag"))
    order = often.join(cuts, ["ord", "sub"]).select("tok", "ord", "frag")
    sets = rows.join(order, "tok").groupBy("cls", "n").agg(F.array_sort(F.collect_list(F.struct("ord", "frag", "tok"))).alias("toks"))
    sets = sets.withColumn("own", c("n") - F.size("toks"))
    return staged(sets.filter(c("own") <= F.expr(_spare(percent))), "jaccard-ordered")


def segments_of(sets: DataFrame, fragments: int) -> DataFrame:
    """(cls, frag, seg): the vertical partition of the sets, staged."""
    c = F.col
    rows = sets.select("cls", "toks", F.explode(F.sequence(F.lit(0), F.lit(fragments - 1))).alias("frag"))
    rows = rows.select("cls", "frag", F.transform(F.filter("toks", lambda t: t["frag"] == c("frag")), lambda t: t["tok"]).alias("seg"))
    return staged(rows.filter(F.size("seg") > 0), "jaccard-segments")


def linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """(u, v): the pairs (x, y, nx, ny) that link; overlaps are counted per fragment and added up."""
    c = F.col
    left = segments.select(c("cls").alias("x"), "frag", c("seg").alias("sx"))
    right = segments.select(c("cls").alias("y"), "frag", c("seg").alias("sy"))
    parts = pairs.join(left, "x").join(right, ["y", "frag"]).select("x", "y", "nx", "ny", F.size(F.array_intersect("sx", "sy")).alias("part"))
    sums = parts.groupBy("x", "y", "nx", "ny").agg(F.sum("part").alias("o"))
    return sums.filter(100 * c("o") >= percent * (c("nx") + c("ny") - c("o"))).select(c("x").alias("u"), c("y").alias("v"))


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Distinct (x, y, nx, ny), x < y, of rows (a, na, b, nb) whose sizes allow a link."""
    c = F.col
    rows = rows.filter((c("a") != c("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    first = c("a") < c("b")
    pick = lambda p, q: F.when(first, c(p)).otherwise(c(q))
    return rows.select(pick("a", "b").alias("x"), pick("b", "a").alias("y"), pick("na", "nb").alias("nx"), pick("nb", "na").alias("ny")).distinct()


def block_links(cls: np.ndarray, n: np.ndarray, comp: np.ndarray, chunk: np.ndarray, frags: list, segs: list, percent: int) -> list[tuple[int, int]]:
    """Links between sets of different components in one block, enough to connect what they connect.

    Rows are segments. Overlaps are matrix products per fragment, added up over the fragments.
    """
    names, first, who = np.unique(cls, return_index=True, return_inverse=True)
    n, comp, chunk = n[first], comp[first], chunk[first]
    if len(np.unique(comp)) < 2:
        return []
    overlap = np.zeros((len(names), len(names)), dtype=np.int64)
    order = np.argsort(frags, kind="stable")
    edges = np.flatnonzero(np.diff(np.asarray(frags)[order])) + 1
    for rows in np.split(order, edges):
        doc = np.repeat(who[rows], [len(segs[r]) for r in rows])
        _, tok = np.unique(np.concatenate([segs[r] for r in rows]), return_inverse=True)
        for at in range(0, int(tok.max()) + 1, COLUMNS):
            inside = (tok >= at) & (tok < at + COLUMNS)
            has = np.zeros((len(names), COLUMNS), dtype=np.float32)
            has[doc[inside], tok[inside] - at] = 1
            overlap += (has @ has.T).astype(np.int64)
    found = (100 * overlap >= percent * (n[:, None] + n[None, :] - overlap)) & (comp[:, None] != comp[None, :])
    if chunk.min() != chunk.max():
        found &= chunk[:, None] != chunk[None, :]
    head = {x: x for x in comp.tolist()}

    def top(x):
        while head[x] != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    out = []
    for i, j in np.argwhere(np.triu(found)).tolist():
        a, b = top(int(comp[i])), top(int(comp[j]))
        if a != b:
            head[a] = b
            out.append((int(names[i]), int(names[j])))
    return out


def crowd_links(crowds: DataFrame, segments: DataFrame, percent: int, block_sets: int, block_shingles: int) -> DataFrame:
    """(u, v): links between the components of large meetings, rows (tok, cls, n, comp).

    Sets that meet directly or over others are one crowd. It is dealt out in chunks by a hash,
    and every pair of chunks is a block, so no pair is missed and a task holds two chunks.
    """
    c = F.col
    least = crowds.groupBy("tok").agg(F.min("cls").alias("v"))
    roots = components(crowds.join(least, "tok").select(c("cls").alias("u"), "v"))
    sets = crowds.select("cls", "n", "comp").distinct().join(roots.select(c("node").alias("cls"), c("root").alias("crowd")), "cls")
    sets = staged(sets, "jaccard-crowds")
    sizes = sets.groupBy("crowd").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("t"))
    sizes = sizes.select("crowd", F.greatest(F.ceil(c("m") / block_sets), F.ceil(c("t") / block_shingles)).cast("int").alias("parts"))
    rows = sets.join(sizes, "crowd").withColumn("chunk", F.pmod(F.xxhash64("cls"), c("parts")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), c("parts") - 1), lambda j: F.struct(F.least(c("chunk"), j).alias("i"), F.greatest(c("chunk"), j).alias("j")))
    rows = rows.withColumn("block", F.explode(others)).select("crowd", "block.i", "block.j", "cls", "n", "comp", "chunk")

    def run(table: pa.Table) -> pa.Table:
        cls, n, comp, chunk = (table.column(x).to_numpy() for x in ("cls", "n", "comp", "chunk"))
        segs = [s.values.to_numpy() for s in table.column("seg")]
        out = block_links(cls, n, comp, chunk, table.column("frag").to_pylist(), segs, percent)
        return pa.table([pa.array([u for u, _ in out], pa.int64()), pa.array([v for _, v in out], pa.int64())], ["u", "v"])

    return rows.join(segments, "cls").groupBy("crowd", "i", "j").applyInArrow(run, "u long, v long")


def class_links(sets: DataFrame, fragments: int, percent: int, meeting: int = MEETING, block_sets: int = BLOCK_SETS, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(u, v): links between classes that connect what all links connect; staged."""
    c = F.col
    segments = segments_of(sets, fragments)
    first = F.slice("toks", F.lit(1), (F.expr(_spare(percent)) + 1 - c("own")).cast("int"))
    met = staged(sets.select("cls", "n", "own", F.explode(first).alias("t")).select("cls", "n", "own", "t.tok"), "jaccard-first")
    hubs = met.groupBy("tok").agg(F.min(F.struct((1000 * c("own") / c("n")).cast("int").alias("rare"), "cls", "n")).alias("hub"))
    star = met.join(hubs, "tok").select(c("cls").alias("a"), c("n").alias("na"), c("hub.cls").alias("b"), c("hub.n").alias("nb"))
    star = staged(_pairs(star, percent), "jaccard-star")
    links = staged(linked(star, segments, percent), "jaccard-links")
    roots = components(links).select(c("node").alias("cls"), "root")
    named = met.join(roots, "cls", "left").select("tok", "cls", "n", F.coalesce("root", "cls").alias("comp"))
    open_ = named.groupBy("tok").agg(F.count(F.lit(1)).alias("m"), F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a < b").select("tok", "m")
    open_ = staged(named.join(open_, "tok"), "jaccard-open")
    few = open_.filter(c("m") <= meeting)
    a, b = (few.select("tok", c("cls").alias(x), c("n").alias(f"n{x}"), c("comp").alias(f"c{x}")) for x in "ab")
    rest = _pairs(a.join(b, "tok").filter("a < b AND ca != cb"), percent).join(star.select("x", "y"), ["x", "y"], "left_anti")
    more = linked(rest, segments, percent)
    crowds = open_.filter(c("m") > meeting).select("tok", "cls", "n", "comp")
    return staged(links.union(more).union(crowd_links(crowds, segments, percent, block_sets, block_shingles)), "jaccard-all-links")


def similar_documents(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, fragments: int = FRAGMENTS, **limits: int) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document.

    Documents link when their sets' intersection is at least ``percent`` of their union; the
    component's name is the smallest doc_id that links reach. A document without a word links
    with nothing. Null ids take part but name a component only if it has no other id (null).
    Repeated rows give repeated results; an empty table gives an empty result. Only doc_id
    and text are read.
    """
    c = F.col
    sets = shingle_sets(docs, size, percent)
    classes = classes_of(sets)
    links = class_links(ordered_sets(docs, promising(sets, classes, percent), size, percent, fragments), fragments, percent, **limits)
    roots = components(links).select(c("node").alias("cls"), "root")
    named = roots.join(classes.select("cls", "least"), "cls")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("cls", "component_id", F.lit(True).alias("found"))
    table = classes.join(named, "cls", "left").select("d1", "d2", "copies", F.when(c("found"), c("component_id")).otherwise(c("least")).alias("component_id"))
    rows = sets.filter("n > 0").select("doc_id", c("n").alias("n_shingles"), "d1", "d2")
    out = heavy_lookup(rows, staged(table, "jaccard-components"), ["d1", "d2"], "copies").select("doc_id", "n_shingles", "component_id")
    return out.unionByName(sets.filter("n = 0").select("doc_id", c("n").alias("n_shingles"), c("doc_id").alias("component_id")))
