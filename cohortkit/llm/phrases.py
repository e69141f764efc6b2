"""Phrase collocations by set-oriented mining over persisted occurrence relations.

The relation of length k holds every occurrence (piece, position, phrase) of phrases whose
parts are frequent. It is written to the shared folder in blocks of documents, each sorted by
piece and position. The next length comes from a merge join of the frequent occurrences with
those at the adjacent position of the same piece; counting groups them by phrase, and the
frequent groups are semi-joined with the occurrences before these are extended again.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortkit.llm.common import staged

#: Least count of a phrase, its most words, and phrases returned per language.
LEAST, LONGEST, TOP = 100, 5, 2000
#: Words after which a block is closed; a document is never split.
BLOCK = 1 << 22
#: The language of rows without one.
UNKNOWN = "und"
#: One row is a block of ``size`` occurrences in order: ``slots`` (differences) and ``items``, both compressed; ``phrases`` names the items and counts
#: them. Words are named by language and text, longer phrases by the numbers of their first and last part.
WORDS = "block long, size int, slots binary, items binary, phrases array<struct<lang:string,phrase:string,n:long>>"
PHRASES = "block long, size int, slots binary, items binary, phrases array<struct<x:long,y:long,n:long>>"
#: A phrase's number holds a block in its upper bits and the place in that block's list in so many lower ones.
PLACE_BITS = 30

#: A-Z to a-z, piece ends to line feeds, tabs to spaces.
_PLAIN = bytes(ord("\n") if b in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_EMPTY, _GAP = -2, -1


def _batch(block: int, slots: np.ndarray, items: np.ndarray, **names) -> pa.RecordBatch:
    named = pa.StructArray.from_arrays([pa.array(x) for x in names.values()], list(names))
    packed = [pa.array([pa.compress(x.astype("<i4").tobytes(), "zstd", asbytes=True)], pa.binary()) for x in (np.diff(slots, prepend=0), items)]
    row = [pa.array([block], pa.int64()), pa.array([len(items)], pa.int32()), *packed, pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named)]
    return pa.RecordBatch.from_arrays(row, ["block", "size", "slots", "items", "phrases"])


class _Words(dict):
    """Word to number, counting on over several languages."""

    def __init__(self, names: list):
        super().__init__({b"": _EMPTY, b"\n": _GAP})
        self.names = names

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self.names)
        self.names.append(word)
        return self[word]


def word_relation(docs: DataFrame, block_words: int = BLOCK) -> DataFrame:
    """The relation of length 1, staged. Adjacent words of a piece have adjacent slots; between pieces a slot is left out."""

    def run(batches):
        base, number = TaskContext.get().partitionId() << 12, 0
        names: list[bytes] = []
        by_lang: dict[str, _Words] = {}
        parts: list[np.ndarray] = []
        held = 0

        def close():
            items = np.concatenate(parts)
            slots = np.flatnonzero(items >= 0)
            items = items[slots]
            langs = np.empty(len(names), dtype=object)
            for lang, words in by_lang.items():
                ids = np.fromiter(words.values(), dtype=np.int64, count=len(words))
                langs[ids[ids >= 0]] = lang
            return _batch(base + number, slots, items, lang=pa.array(langs, pa.string()), phrase=pa.array(names, pa.binary()).cast(pa.string()),
                          n=np.bincount(items, minlength=len(names)).astype(np.int64))

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                text = text.as_py()
                if not text:
                    continue
                words = by_lang.get(lang)
                if words is None:
                    words = by_lang[lang] = _Words(names)
                found = text.translate(_PLAIN).replace(b"\n", b" \n ").split(b" ")
                ids = np.fromiter(map(words.__getitem__, found), dtype=np.int32, count=len(found))
                parts += [ids[ids != _EMPTY], np.array([_GAP], dtype=np.int32)]
                held += len(ids)
                if held >= block_words:
                    if names:
                        yield close()
                        number += 1
                    names, by_lang, parts, held = [], {}, [], 0
        if names:
            yield close()

    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    return staged(rows.mapInArrow(run, WORDS), "phrases-words")


def groups(relation: DataFrame) -> DataFrame:
    """(own, the names, n): the phrases of every block, with a number of their own."""
    own = F.shiftleft("block", PLACE_BITS) + F.col("place")
    return relation.select("block", F.posexplode("phrases").alias("place", "p")).select(own.alias("own"), "p.*")


def frequent(relation: DataFrame, least: int) -> DataFrame:
    """The groups of phrases with at least ``least`` occurrences, with that count ``a`` and the phrase's ``number``; staged.

    Groups meet once by phrase, one row per block, which gives the count as well as the
    semi-joined groups. A phrase's number is that of its first group.
    """
    rows = groups(relation)
    mine = W.partitionBy(*[x for x in rows.columns if x not in ("own", "n")])
    rows = rows.withColumn("a", F.sum("n").over(mine)).withColumn("number", F.min("own").over(mine))
    return staged(rows.filter(F.col("a") >= least).drop("n"), "phrases-frequent")


def extend(relation: DataFrame, often: DataFrame, last: bool) -> DataFrame:
    """The relation one word longer, staged: frequent occurrences joined with those at the next position.

    A block meets its own frequent groups, so no occurrence is shuffled by its phrase. The occurrences of the last length are counted but not written.
    """

    none = np.zeros(0, dtype=np.int64)

    def step(table: pa.Table, kept: pa.Table) -> pa.Table:
        if not table.num_rows or not kept.num_rows:
            return pa.Table.from_batches([_batch(0, none, none, x=none, y=none, n=none)]).slice(0, 0)
        block = table.column("block")[0].as_py()
        size = 4 * table.column("size")[0].as_py()
        slots, items = (np.frombuffer(pa.decompress(table.column(x)[0].as_py(), size, "zstd"), dtype="<i4") for x in ("slots", "items"))
        slots = np.cumsum(slots, dtype=np.int64)
        places, numbers = kept.column("own").to_numpy() & ((1 << PLACE_BITS) - 1), kept.column("number").to_numpy()
        at = np.full(max(int(items.max(initial=0)), int(places.max())) + 1, -1, dtype=np.int64)
        at[places] = np.arange(len(places))
        stays = at[items]
        slots, stays = slots[stays >= 0], stays[stays >= 0]
        meets = np.flatnonzero(slots[1:] == slots[:-1] + 1)
        pairs, items, counts = np.unique(stays[meets] * len(places) + stays[meets + 1], return_inverse=True, return_counts=True)
        return pa.Table.from_batches([_batch(block, none if last else slots[meets], none if last else items,
                                             x=numbers[pairs // len(places)], y=numbers[pairs % len(places)], n=counts.astype(np.int64))])

    rows = relation.select("block", "size", "slots", "items").groupBy("block")
    kept = often.select(F.shiftright("own", PLACE_BITS).alias("block"), "own", "number").groupBy("block")
    return staged(rows.cogroup(kept).applyInArrow(step, PHRASES), "phrases-next")


def named(often: DataFrame, shorter: DataFrame | None) -> DataFrame:
    """(number, lang, phrase, a): each frequent phrase once, its text put together from the texts one word ``shorter``; staged."""
    c = F.col
    one = often.filter("own = number")
    if shorter is None:
        return staged(one.select("number", "lang", "phrase", "a"), "phrases-named")
    head = shorter.select(c("number").alias("x"), "lang", c("phrase").alias("head"))
    tail = shorter.select(c("number").alias("y"), F.substring_index("phrase", " ", -1).alias("tail"))
    rows = one.select("number", "x", "y", "a").join(head, "x").join(tail, "y")
    return staged(rows.select("number", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "a"), "phrases-named")


def scored(levels: list[DataFrame], totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more, each at its lowest-scoring cut; exact whole numbers."""
    c = F.col
    known = reduce(DataFrame.union, levels)
    cands = None
    for k, level in enumerate(levels[1:], start=2):
        words = F.split("phrase", " ", -1)
        cuts = level.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("k"), words.alias("w"))
        cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), c("k")), " ").alias("first"),
                           F.array_join(F.slice("w", c("k") + 1, F.lit(k) - c("k")), " ").alias("rest"))
        cands = cuts if cands is None else cands.union(cuts)
    left = known.select("lang", c("phrase").alias("first"), c("a").alias("l"))
    right = known.select("lang", c("phrase").alias("rest"), c("a").alias("r"))
    rows = cands.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    wide = lambda x: x.cast("decimal(19,0)")
    rows = rows.withColumn("up", wide(c("a") * 1000) * wide(c("n"))).withColumn("down", wide(c("l")) * wide(c("r")))
    rows = rows.withColumn("score", F.expr("up div down"))
    best = rows.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score")


def covered(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase, inside): the greatest count of a longer candidate that holds the phrase's words."""
    parts = None
    for k, level in enumerate(levels[2:], start=3):
        spans = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for m in range(2, k) for i in range(1, k - m + 2)])
        rows = level.select("lang", "a", F.split("phrase", " ", -1).alias("w"), F.explode(spans).alias("s"))
        rows = rows.select("lang", F.array_join(F.slice("w", F.col("s.i"), F.col("s.m")), " ").alias("phrase"), "a")
        parts = rows if parts is None else parts.union(rows)
    return parts.groupBy("lang", "phrase").agg(F.max("a").alias("inside"))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, block_words: int = BLOCK) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best-scoring phrases of 2 to ``longest`` words per language.

    Texts are lower-cased (A-Z), cut into pieces at punctuation marks and line ends, and into
    words at spaces and tabs. Null texts are empty, rows without a language belong to ``und``;
    repeated rows count each time; an empty table gives an empty result. Only ``text`` and
    ``lang`` are read. ``longest`` is 3 at least.
    """
    c = F.col
    relation = word_relation(docs, block_words)
    totals = staged(groups(relation).groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    often = frequent(relation, least)
    levels = [named(often, None)]
    for k in range(2, longest + 1):
        relation = extend(relation, often, k == longest)
        often = frequent(relation, least)
        levels.append(named(often, levels[-1]))
    levels = [x.drop("number") for x in levels]
    rows = scored(levels, totals).join(covered(levels), ["lang", "phrase"], "left")
    rows = rows.filter(c("inside").isNull() | (c("inside") < c("a")))
    order = W.partitionBy("lang").orderBy(c("score").desc(), c("a").desc(), c("phrase"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(c("rank") <= top)
    return ranked.select("lang", c("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
