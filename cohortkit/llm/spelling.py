"""Spelling variants by a frequency-vector trie.

A word's vector counts its letters by group; one inserted letter raises one count, one
deleted letter lowers one, one replaced letter does both or neither. Words are arranged in a
trie by these counts, level by level. The upper levels are rows: a query descends by joins, one
level per round, into every node that its budget of one surplus and one deficit allows, until
the node is small. The levels below are searched depth first inside a task, and the words
in the leaves are verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortkit.llm.common import staged

#: Least code points and occurrences of a word, and how much more frequent its form must be.
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
#: A run whose checksum this number divides loses a code point.
DIVISOR = 199
#: Letters of each level of the trie; other letters are dealt out by code point.
LEVELS = ("et", "ak", "io", "nw", "rx", "sz", "hj", "dp", "lg", "uq", "cv", "mb", "fy")
#: Nodes with more words are descended by rows, smaller ones inside a task; a task's leaves hold so many words.
NODE, LEAF = 2048, 8
#: Words that a task counts before it hands them on.
HELD = 200_000
#: Pairs verified at once, and the longest word that is verified by columns.
PAIRS, WIDE = 1 << 17, 64

_RUN = re.compile("[A-Za-zÀ-ÿ]+")


def altered(run: str, prefix: int, divisor: int = DIVISOR) -> str:
    """The run as it counts: without one code point if ``divisor`` divides its checksum; ``prefix`` is that of the text before it."""
    h = zlib.crc32(run.encode(), prefix)
    if h % divisor:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, divisor: int = DIVISOR) -> DataFrame:
    """(word, n): lower-cased words of enough code points and occurrences, counted over all texts; staged.

    Tasks count words before these are shuffled. A null doc_id has the checksum of an empty one.
    """

    def rows(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts):
                text = text.as_py()
                if not text:
                    continue
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(_RUN.findall(text.lower().decode())).items():
                    word = altered(word, prefix, divisor)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) >= HELD:
                    yield rows(counts)
                    counts = Counter()
        if counts:
            yield rows(counts)

    found = docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(run, "word string, n long")
    return staged(found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count), "spelling-words")


def letter_counts(words: pa.Array) -> np.ndarray:
    """One row per word: its letters in each level's group."""
    group = np.arange(0x100) % len(LEVELS)
    for k, letters in enumerate(LEVELS):
        group[[ord(x) for x in letters]] = k
    codes = [np.frombuffer(w.encode("utf-32-le"), dtype="<u4") for w in words.to_pylist()]
    if not codes:
        return np.zeros((0, len(LEVELS)), dtype=np.int32)
    rows = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    flat = rows * len(LEVELS) + group[np.concatenate(codes) % 0x100]
    return np.bincount(flat, minlength=len(codes) * len(LEVELS)).reshape(len(codes), -1).astype(np.int32)


def with_vectors(words: DataFrame) -> DataFrame:
    """``words`` with ``length`` and ``vector``, staged."""

    def run(batches):
        for batch in batches:
            counts = letter_counts(batch.column("word"))
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(0, counts.size + 1, len(LEVELS)), pa.int32()), pa.array(counts.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), vectors], ["word", "n", "vector"])

    rows = words.mapInArrow(run, "word string, n long, vector array<int>")
    return staged(rows.withColumn("length", F.char_length("word")), "spelling-vectors")


def place(words: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """Every word with its node, and the nodes that were split, level by level.

    A node is named by the length and the counts on the way to it. Nodes of more than ``most``
    words are split by the next count; below the last level they are dealt out in cells.
    """
    c = F.col
    rest = words.withColumn("node", F.array("length"))
    done, split = [], []
    for level in range(len(LEVELS) + 1):
        large = staged(rest.groupBy("node").count().filter(c("count") > most), "spelling-nodes")
        split.append(large)
        if level == len(LEVELS) or large.isEmpty():
            done.append(rest)
            break
        inside = rest.join(large.select("node", F.lit(True).alias("large")), "node", "left")
        inside = staged(inside.withColumn("large", F.coalesce("large", F.lit(False))), "spelling-placed")
        done.append(inside.filter("NOT large").drop("large"))
        rest = inside.filter("large").drop("large").withColumn("node", F.concat("node", F.slice("vector", level + 1, 1)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out, split


def descend(words: DataFrame, split: list[DataFrame]) -> DataFrame:
    """(word, longer, surplus, deficit, node): the nodes each query reaches within its budget.

    A query looks for words of its own length (surplus and deficit of one) or of one letter
    more (surplus of one), so each pair of near words is met from the shorter or both sides.
    """
    c = F.col
    ways = F.array(F.struct(F.lit(False).alias("longer"), F.lit(1).alias("surplus"), F.lit(1).alias("deficit")),
                   F.struct(F.lit(True).alias("longer"), F.lit(1).alias("surplus"), F.lit(0).alias("deficit")))
    rest = words.select("word", "vector", "length", F.explode(ways).alias("w")).select("word", "vector", "length", "w.*")
    rest = rest.withColumn("node", F.array(c("length") + c("longer").cast("int")))
    done = []
    for level, large in enumerate(split):
        if level == len(LEVELS):
            done.append(rest)
            break
        inside = rest.join(large.select("node", F.lit(True).alias("large")), "node", "left")
        done.append(inside.filter("large IS NULL").drop("large"))
        steps = F.filter(F.array(F.lit(0), F.lit(1), F.lit(-1)), lambda s: ((s < 1) | (c("surplus") > 0)) & ((s > -1) | (c("deficit") > 0)))
        rest = inside.filter("large").drop("large").withColumn("step", F.explode(steps))
        rest = (rest.withColumn("node", F.concat("node", F.array(F.element_at("vector", level + 1) + c("step"))))
                .withColumn("surplus", c("surplus") - F.when(c("step") > 0, 1).otherwise(0))
                .withColumn("deficit", c("deficit") - F.when(c("step") < 0, 1).otherwise(0)).drop("step"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def search(members: np.ndarray, queries: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, level: int = 0, leaf: int = LEAF):
    """Depth-first search of the trie over the members' vectors from ``level`` down, with all queries at once.

    Yields (members, queries) of every leaf that queries reach: ``members`` has to be in order of its rows.
    """
    levels = members.shape[1]
    stack = [(level, 0, len(members), np.arange(len(queries)), surplus, deficit)]
    while stack:
        level, a, b, who, up, down = stack.pop()
        if not who.size:
            continue
        if level == levels or b - a <= leaf:
            yield a, b, who
            continue
        counts = members[a:b, level]
        edges = [0, *(np.flatnonzero(counts[1:] != counts[:-1]) + 1).tolist(), b - a]
        own = queries[who, level]
        for x, y in zip(edges, edges[1:]):
            step = counts[x] - own
            ok = (step == 0) | ((step == 1) & (up > 0)) | ((step == -1) & (down > 0))
            stack.append((level + 1, a + x, a + y, who[ok], (up - (step == 1))[ok], (down - (step == -1))[ok]))


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


class Letters:
    """Words as rows of code points, for verifying many pairs at once."""

    def __init__(self, words: list[str]):
        self.words = words
        self.length = np.array([len(w) for w in words], dtype=np.int64)
        width = min(WIDE, int(self.length.max(initial=0))) + 1
        self.codes = np.zeros((len(words), width), dtype=np.uint16)
        for i, w in enumerate(words):
            if len(w) <= WIDE:
                self.codes[i, :len(w)] = np.frombuffer(w.encode("utf-16-le"), dtype="<u2")


def verified(q: Letters, m: Letters, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether query ``left[i]`` and member ``right[i]``, which is of the same length or longer by one, are one edit apart."""
    width = min(q.codes.shape[1], m.codes.shape[1])
    a, b = q.codes[left], m.codes[right]
    differ = a[:, :width] != b[:, :width]
    same = q.length[left] == m.length[right]
    ok = same & (differ.sum(axis=1) + abs((a[:, width:] > 0).sum(axis=1) - (b[:, width:] > 0).sum(axis=1)) == 1)
    grown = np.flatnonzero(~same)
    if grown.size:
        d = differ[grown]
        first = np.where(d.any(axis=1), d.argmax(axis=1), width)
        x, y = a[grown], b[grown]
        wide = max(x.shape[1], y.shape[1] - 1)
        x = np.pad(x, ((0, 0), (0, wide - x.shape[1])))
        y = np.pad(y[:, 1:], ((0, 0), (0, wide - y.shape[1] + 1)))
        ok[grown] = ((x == y) | (np.arange(wide) < first[:, None])).all(axis=1)
    long = np.flatnonzero((q.length[left] > WIDE) | (m.length[right] > WIDE))
    for i in long:
        ok[i] = one_edit(q.words[left[i]], m.words[right[i]])
    return ok


def near_pairs(words: DataFrame, node: int = NODE) -> DataFrame:
    """(a, b): every pair of near words once or twice; ``b`` has the length of ``a`` or one code point more.

    A task holds the words of one node (or cell) and the queries that reach it.
    """
    c = F.col
    members, split = place(words, node)
    queries = descend(words, split)
    flat = F.coalesce(F.ceil(c("count") / node), F.lit(1)).cast("int")
    last = split[-1] if len(split) > len(LEVELS) else None
    if last is None:
        members, queries = members.withColumn("cell", F.lit(0)), queries.withColumn("cell", F.lit(0))
    else:
        cells = last.select("node", "count")
        members = members.join(cells, "node", "left").withColumn("cell", F.pmod(F.xxhash64("word"), flat).cast("int")).drop("count")
        queries = queries.join(cells, "node", "left").withColumn("cell", F.explode(F.sequence(F.lit(0), flat - 1))).drop("count")
    members = members.select("node", "cell", "word", "vector")
    queries = queries.select(c("node").alias("at"), c("cell").alias("part"), c("word").alias("asked"), c("vector").alias("wanted"), "surplus", "deficit")

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        return column.combine_chunks().flatten().to_numpy().reshape(-1, len(LEVELS))

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        if held.num_rows and asked.num_rows:
            vectors = matrix(held.column("vector"))
            order = np.lexsort(vectors.T[::-1])
            vectors, mine = vectors[order], Letters(held.column("word").take(pa.array(order)).to_pylist())
            for at in range(0, asked.num_rows, 8 * node):
                part = asked.slice(at, 8 * node)
                theirs = Letters(part.column("asked").to_pylist())
                lefts, rights, size = [], [], 0

                def flush():
                    left, right = np.concatenate(lefts), np.concatenate(rights)
                    keep = verified(theirs, mine, left, right)
                    out_a.extend(theirs.words[i] for i in left[keep])
                    out_b.extend(mine.words[i] for i in right[keep])

                found = search(vectors, matrix(part.column("wanted")), part.column("surplus").to_numpy(), part.column("deficit").to_numpy(),
                               len(held.column("node")[0]) - 1)
                for a, b, who in found:
                    for x in range(0, len(who), max(1, PAIRS // (b - a))):
                        some = who[x:x + max(1, PAIRS // (b - a))]
                        lefts.append(np.repeat(some, b - a))
                        rights.append(np.tile(np.arange(a, b), len(some)))
                        size += len(lefts[-1])
                        if size >= PAIRS:
                            flush()
                            lefts, rights, size = [], [], 0
                if lefts:
                    flush()
        return pa.table([pa.array(out_a, pa.string()), pa.array(out_b, pa.string())], ["a", "b"])

    return members.groupBy("node", "cell").cogroup(queries.groupBy("at", "part")).applyInArrow(run, "a string, b string")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that forms lead to, by pointer jumping; forms grow in count, so chains end."""
    c = F.col
    at = staged(forms.select("word", c("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(c("word").alias("root"), c("root").alias("next"))
        moved = staged(at.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), c("next").isNotNull().alias("moved")), "spelling-roots")
        at = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return at


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES, divisor: int = DIVISOR, node: int = NODE) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word that is long and frequent enough.

    A word's form is its most frequent near word (ties: the least in code-point order) if that
    is at least ``times`` as frequent; its root is where forms end, the word itself if it has
    none. Null and empty texts have no words; repeated rows count each time; an empty table
    gives an empty result. Only doc_id and text are read.
    """
    c = F.col
    words = with_vectors(word_counts(docs, least_length, least_count, divisor))
    pairs = near_pairs(words, node)
    pairs = staged(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "spelling-pairs")
    both = pairs.select(c("a").alias("word"), c("b").alias("near")).union(pairs.select(c("b").alias("word"), c("a").alias("near")))
    counts = words.select("word", "n")
    best = both.join(counts.select(c("word").alias("near"), c("n").alias("m")), "near")
    best = best.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-c("m")).alias("m"), "near")).alias("b"))
    rows = counts.join(best, "word", "left")
    good = -c("b.m") >= times * c("n")
    rows = staged(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(good, c("b.near")).alias("form"), F.when(good, -c("b.m")).alias("form_n")), "spelling-forms")
    roots = follow(rows.filter("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
