"""Quality rules with the perplexity of a modified Kneser-Ney model per language.

The model is of code points as they stand, five in a row; nothing is folded and every
language has its own, so what it holds grows with the corpus. Grams are counted over all
documents by Spark, the levels of the model are joins and aggregates, and the result is
kept as sorted arrays of 64-bit hashes, in slices of a stated size: a slice is broadcast,
and texts are read once per slice, so no task and not the driver ever holds more.

A gram that occurs once in the whole corpus says nothing about itself: levels above two
drop it, and its probability comes from the level below. Otherwise rare noise would
predict itself well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortkit.functions.scale import salted_lookup
from cohortkit.llm.common import staged

#: Code points of a gram, words of a repeated window, least words, most repeated words in percent.
ORDER, REPEAT, LEAST_WORDS, MOST_REPEATED = 5, 8, 20, 30
#: Levels above this one drop grams that occur once.
PRUNED_ABOVE = 2
#: Band: the median of bits per character, less and plus so many times its distance to the lower and upper quartile.
BELOW, ABOVE = 10.0, 8.0
#: The band's least half width in bits, for languages whose documents are all alike.
MARGIN = 0.25
#: Grams of a broadcast slice (12 bytes each).
SLICE = 8_000_000
#: Symbols that a task looks at together; distinct grams that it holds before it gives them out.
PIECE, HELD = 1 << 20, 1 << 22
#: Stands before a text's first character.
EDGE = "\x02"
_SPACES, _MARKS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def model_name(lang: Column) -> Column:
    """The model of a document: its language's; documents without one have a model of their own."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def code_points(text: str) -> np.ndarray:
    """Code points of a text after the edge's."""
    return np.frombuffer((EDGE * (ORDER - 1) + text).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def pieces(text: str):
    """The code points of a text in pieces that overlap by a gram less one, so that every gram lies in one piece."""
    s = code_points(text)
    for start in range(0, len(s) - ORDER + 1, PIECE):
        yield s[start:start + PIECE + ORDER - 1]


def gram_keys(s: np.ndarray, model: str) -> np.ndarray:
    """64-bit hashes of a model's grams."""
    n = len(s) - ORDER + 1
    h = np.full(n, int.from_bytes(hashlib.md5(model.encode("utf-8", "surrogatepass")).digest()[:8], "little"), dtype=np.uint64)
    for j in range(ORDER):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += s[j:j + n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _summed(keys: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with the sums of their counts (of ones, without counts)."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    sums = np.diff(np.append(starts, len(keys))) if counts is None else np.add.reduceat(counts, starts) if len(keys) else counts
    return keys[starts], sums.astype(np.int64)


class GramCounter:
    """Counts of the grams of one model inside a task.

    Grams of code points below 4,096 are packed in one number; the rare others are
    counted as pairs of numbers.
    """

    def __init__(self) -> None:
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.wide: dict[tuple[int, int], int] = {}

    def add(self, s: np.ndarray) -> None:
        n = len(s) - ORDER + 1
        packed = np.zeros(n, dtype=np.uint64)
        for j in range(ORDER):
            packed = (packed << np.uint64(12)) | s[j:j + n]
        if s.max() >= 4096:
            big = s >= 4096
            wide = np.zeros(n, dtype=bool)
            for j in range(ORDER):
                wide |= big[j:j + n]
            at = np.flatnonzero(wide)
            packed = packed[~wide]
            high = (s[at] << np.uint64(21)) | s[at + 1]
            low = (s[at + 2] << np.uint64(42)) | (s[at + 3] << np.uint64(21)) | s[at + 4]
            for key, count in pd.DataFrame({"a": high, "b": low}).groupby(["a", "b"], sort=False).size().items():
                self.wide[key] = self.wide.get(key, 0) + int(count)
        self.waiting.append(packed)
        self.n_waiting += len(packed)
        if self.n_waiting >= HELD:
            self.settle()

    def settle(self) -> None:
        """Add what waits to the counts."""
        if self.waiting:
            keys, counts = _summed(np.concatenate(self.waiting), None)
            self.keys, self.counts = _summed(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
            self.waiting, self.n_waiting = [], 0

    def size(self) -> int:
        return len(self.keys) + len(self.wide) + self.n_waiting

    def rows(self) -> tuple[list[str], np.ndarray]:
        """Grams as text, and their counts."""
        self.settle()
        shifts = np.arange(12 * (ORDER - 1), -1, -12, dtype=np.uint64)
        cps = ((self.keys[:, None] >> shifts) & np.uint64(0xFFF)).astype("<u4")
        if self.wide:
            pairs = np.array(list(self.wide), dtype=np.uint64)
            m = np.uint64((1 << 21) - 1)
            parts = [pairs[:, 0] >> np.uint64(21), pairs[:, 0] & m, pairs[:, 1] >> np.uint64(42), (pairs[:, 1] >> np.uint64(21)) & m, pairs[:, 1] & m]
            cps = np.concatenate([cps, np.stack(parts, 1).astype("<u4")])
        text = cps.tobytes().decode("utf-32-le", "replace")
        counts = np.concatenate([self.counts, np.fromiter(self.wide.values(), np.int64, len(self.wide))])
        return [text[i:i + ORDER] for i in range(0, len(text), ORDER)], counts


def count_grams(docs: DataFrame) -> DataFrame:
    """(model, gram, n): how often each model's grams occur in all of its documents."""

    def run(batches):
        counters: dict[str, GramCounter] = {}

        def give():
            for model, counter in counters.items():
                grams, counts = counter.rows()
                for i in range(0, len(grams), 100_000):
                    part = grams[i:i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array([model] * len(part), pa.string()), pa.array(part, pa.string()), pa.array(counts[i:i + 100_000])], ["model", "gram", "n"])
            counters.clear()

        for batch in batches:
            for model, text in zip(batch.column("model").to_pylist(), batch.column("text")):
                text = text.as_py()
                if text:
                    counter = counters.setdefault(model, GramCounter())
                    for s in pieces(text):
                        counter.add(s)
            if sum(x.size() for x in counters.values()) > 2 * HELD:
                yield from give()
        yield from give()

    counted = docs.select(model_name(F.col("lang")).alias("model"), "text").mapInArrow(run, "model string, gram string, n long")
    return counted.groupBy("model", "gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """(model, d1, d2, d3): what is taken off counts of 1, 2, and 3 or more; usual values where a count of counts is missing."""
    c = F.col
    seen = level.groupBy("model").agg(*[F.count(F.when(c("n") == i, 1)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = c("n1") / (c("n1") + 2 * c("n2"))
    whole = F.least(c("n1"), c("n2"), c("n3"), c("n4")) > 0
    cut = lambda i: F.greatest(F.lit(0.05), F.least(F.lit(float(i)), i - (i + 1) * y * c(f"n{i + 1}") / c(f"n{i}")))
    return seen.select("model", *[F.when(whole, cut(i)).otherwise(F.lit(0.5 * i)).alias(f"d{i}") for i in (1, 2, 3)])


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(model, gram, p): probability of the last code point of each counted gram after the ones before it.

    Level by level from the shortest grams up. Lower levels count distinct left
    neighbours. Grams that a level drops take the weight their context leaves to the
    level below, all of it where the context has no gram left.
    """
    c = F.col
    levels = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        grown = levels[k + 1].groupBy("model", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        levels[k] = staged(grown, f"quality-level{k}")
    below = levels[1].groupBy("model").agg((1.0 / (F.count(F.lit(1)) + 1)).alias("q"))
    for k in range(1, ORDER + 1):
        kept = levels[k] if k <= PRUNED_ABOVE else levels[k].withColumn("n", F.when(c("n") > 1, c("n")))
        taken = F.when(c("n") == 1, c("d1")).when(c("n") == 2, c("d2")).when(c("n") > 2, c("d3"))
        rows = salted_lookup(kept, _discounts(kept), ["model"], "left", salt_by=["gram"]).select(
            "model", "gram", F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("rest"), "n", taken.alias("taken"))
        total = rows.groupBy("model", "context").agg(F.sum("n").alias("total"), F.sum("taken").alias("left"))
        if k == 1:
            rows = salted_lookup(rows, total.drop("context"), ["model"], "left", salt_by=["gram"])
            rows = salted_lookup(rows, below, ["model"], "left", salt_by=["gram"])
        else:
            rows = rows.join(total, ["model", "context"]).join(below.select("model", c("gram").alias("rest"), c("p").alias("q")), ["model", "rest"])
        own = F.coalesce((c("n") - c("taken")) / c("total"), F.lit(0.0))
        p = own + F.coalesce(c("left") / c("total"), F.lit(1.0)) * c("q")
        below = staged(rows.select("model", "gram", p.alias("p")), f"quality-model{k}")
    return below


def hashed_model(model: DataFrame) -> DataFrame:
    """(key, bits): the model by the hash of its grams."""

    def run(batches):
        for batch in batches:
            names, grams = batch.column("model").to_pylist(), batch.column("gram").to_pylist()
            keys = np.zeros(len(grams), dtype=np.uint64)
            order = pd.Series(names).groupby(names, sort=False).indices if names else {}
            for name, at in order.items():
                s = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
                every = gram_keys(s, name)[::ORDER]
                keys[at] = every
            bits = -np.log2(batch.column("p").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(bits.astype(np.float32))], ["key", "bits"])

    return model.mapInArrow(run, "key long, bits float")


def slices(hashed: DataFrame, size: int):
    """The model as sorted arrays (keys, bits), in slices of about ``size`` grams by the keys' remainder."""
    n = -(-hashed.count() // size)

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.column(i).to_numpy().tobytes()]) for i in (0, 1)], ["keys", "bits"])

    for i in range(n):
        rows = hashed.filter(F.pmod("key", F.lit(n)) == i).mapInArrow(pack, "keys binary, bits binary").collect()
        keys = np.concatenate([np.frombuffer(bytes(r["keys"]), np.uint64) for r in rows] or [np.zeros(0, np.uint64)])
        bits = np.concatenate([np.frombuffer(bytes(r["bits"]), np.float32) for r in rows] or [np.zeros(0, np.float32)])
        order = np.argsort(keys, kind="stable")
        yield keys[order], bits[order]


class SortedHashes:
    """Look-ups in sorted hashes: a table by their first binary digits tells where to begin."""

    def __init__(self, keys: np.ndarray, bits: np.ndarray) -> None:
        digits = max(1, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - digits)
        self.starts = np.searchsorted(keys, np.arange(1 << digits, dtype=np.uint64) << self.shift).astype(np.int64)
        self.keys = np.append(keys, _MASK)
        self.bits = np.append(bits, np.float32(0))

    def total(self, wanted: np.ndarray) -> float:
        """Sum of the bits of hashes; those in other slices count nothing."""
        at = self.starts[wanted >> self.shift]
        found = self.keys[at]
        late = np.flatnonzero(found < wanted)
        while len(late):
            at[late] += 1
            late = late[self.keys[at[late]] < wanted[late]]
        return float(np.where(self.keys[at] == wanted, self.bits[at], 0).sum(dtype=np.float64))


def repeated_words(words: list, window: int = REPEAT) -> int:
    """Words that lie in a window of so many words that occurs twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.uint64)
    mixed = (ids + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    code = np.zeros(n, dtype=np.uint64)
    for j in range(window):
        code = code * np.uint64(0xBF58476D1CE4E5B9) + mixed[j:j + n]
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    if not same.any():
        return 0
    rows = np.lib.stride_tricks.sliding_window_view(ids, window)
    a, b = order[:-1][same], order[1:][same]
    if (rows[a] != rows[b]).any():  # different windows with one code: count the windows themselves
        _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        twice = counts[inverse.ravel()] > 1
    else:
        twice = np.zeros(n, dtype=bool)
        twice[a] = twice[b] = True
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    steps[:n] += twice
    steps[window:window + n] -= twice
    return int((steps.cumsum() > 0).sum())


def base_figures(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    spaces = len(data) - len(data.translate(None, _SPACES))
    seen: set = set()
    repeated = 0
    lines = data.split(b"\n")
    if len(lines) > 1:
        for line in lines:
            if line.strip():
                repeated += line in seen
                seen.add(line)
    return len(words), len(text) - spaces, len(data) - len(data.translate(None, _MARKS)), repeated, repeated_words(words)


FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _text_bits(shared, with_figures: bool):
    """A task's work: the bits of each text under one slice of the model, and its figures if wanted."""

    def run(batches):
        table = SortedHashes(*shared.value)
        for batch in batches:
            bits, figures = [], []
            for model, text in zip(batch.column("model").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                bits.append(sum(table.total(gram_keys(s, model)) for s in pieces(text)) / len(text) if text else None)
                if with_figures:
                    figures.append(base_figures(text))
            kept = [n for n in batch.schema.names if n != "text"]
            columns = [batch.column(n) for n in kept] + [pa.array(bits, pa.float64())]
            if with_figures:
                columns += [pa.array([f[i] for f in figures], pa.int64()) for i in range(len(FIGURES))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "bits", *(FIGURES if with_figures else [])])

    return run


def score_documents(docs: DataFrame, hashed: DataFrame, size: int = SLICE) -> DataFrame:
    """Figures and bits per character of every document; bits are null for null and empty texts.

    Every text is read once per slice of the model. What further slices add is looked up by
    the digest of model and text, so repeated texts need no row number.
    """
    c = F.col
    context = docs.sparkSession.sparkContext
    texts = docs.select(c("doc_id").cast("long").alias("doc_id"), model_name(c("lang")).alias("model"), "text")
    keyed = texts.withColumn("digest", F.md5(F.concat_ws("|", "model", F.coalesce("text", F.lit("")))))
    scored, more = None, None
    whole = "doc_id long, model string, digest string, bits double, " + ", ".join(f"{f} long" for f in FIGURES)
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.float32))
    for number, arrays in enumerate(slices(hashed, size)):
        shared = context.broadcast(arrays)
        if number == 0:
            scored = staged(keyed.mapInArrow(_text_bits(shared, True), whole), "quality-scores")
        else:
            part = keyed.filter("text != ''").select("digest", "model", "text").mapInArrow(_text_bits(shared, False), "digest string, model string, bits double")
            part = staged(part.groupBy("digest").agg(F.max("bits").alias("more")), "quality-slice")
            more = part if more is None else more.unionByName(part)
        shared.unpersist()
    if scored is None:
        scored = keyed.mapInArrow(_text_bits(context.broadcast(empty), True), whole)
    if more is not None:
        more = more.groupBy("digest").agg(F.sum("more").alias("more"))
        scored = salted_lookup(scored, more, ["digest"], "left", salt_by=["doc_id"]).withColumn("bits", c("bits") + F.coalesce("more", F.lit(0.0)))
    return scored.select("doc_id", "model", *FIGURES, "bits")


def bands(scored: DataFrame) -> DataFrame:
    """(model, lower, upper) from the quartiles of bits over all documents that pass the base rules.

    Quartiles are exact to a thousandth of a bit: documents are counted per thousandth, and
    the window sees those counts only.
    """
    c = F.col
    bins = scored.filter("NOT base_failed AND bits IS NOT NULL").groupBy("model", F.round(c("bits") * 1000).cast("long").alias("bin")).count()
    upto = F.sum("count").over(W.partitionBy("model").orderBy("bin"))
    ranked = bins.withColumn("upto", upto).withColumn("all", F.sum("count").over(W.partitionBy("model")))
    at = lambda share, name: (F.min(F.when(c("upto") >= share * c("all"), c("bin"))) / 1000).alias(name)
    quarts = ranked.groupBy("model").agg(at(0.25, "q1"), at(0.5, "q2"), at(0.75, "q3"))
    return quarts.select("model", (c("q2") - F.greatest(BELOW * (c("q2") - c("q1")), F.lit(MARGIN))).alias("lower"),
                         (c("q2") + F.greatest(ABOVE * (c("q3") - c("q2")), F.lit(MARGIN))).alias("upper"))


def judge_quality(docs: DataFrame, size: int = SLICE) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, bits), one row per document.

    A null text has no words and fails the base rules. A null language is a language of its
    own. Repeated rows count, and are judged, each; an empty table gives an empty result.
    A document is kept if it passes the base rules and its bits per character lie in its
    language's band.
    """
    c = F.col
    model = kneser_ney(staged(count_grams(docs), "quality-counts"))
    hashed = staged(hashed_model(model), "quality-hashes")
    failed = (c("n_words") < LEAST_WORDS) | (100 * c("n_repeat_words") > MOST_REPEATED * c("n_words"))
    scored = staged(score_documents(docs, hashed, size).withColumn("base_failed", failed), "quality-judged")
    inside = F.coalesce((c("bits") >= c("lower")) & (c("bits") <= c("upper")), F.lit(True))
    return salted_lookup(scored, bands(scored), ["model"], "left", salt_by=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~c("base_failed") & inside).alias("kept"), "bits")
