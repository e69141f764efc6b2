"""Language identification by prediction by partial matching.

Each language has a byte context tree of variable order, learned once and then frozen. A
text's code length under it is exact: a byte costs what the longest matching context says,
escapes to shorter contexts (method C, without exclusions) included. The language with the
shortest code wins. The trees of all languages are stored together as sorted arrays of
byte strings with a cost per language, so all code lengths come from the same look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from cohortkit.llm.common import held_out, staged, unit_hash

#: Longest context in bytes (7 at most); a text is read as if so many line feeds preceded it.
ORDER = 4
#: The sample that trees are learned from: so many texts a language, of a longer one a passage of so many characters.
SAMPLE_TEXTS, SAMPLE_CHARS = 400, 10_000
#: Bytes that are scored at once.
CHUNK = 1 << 20
#: The value for texts without a letter, and the least score a text must have to stay.
UNKNOWN, LEAST_SCORE = "und", 0.5


class KeyTable:
    """Sorted distinct keys with a hashed index: position of each key, or -1."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys = keys
        left, at = np.arange(len(keys)), self._hash(keys)
        while left.size:
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            lost = self.slots[at] != left
            left, at = left[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        at = self._hash(keys)
        out = self.slots[at]
        if not len(self.keys):
            return out
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while open_.size:
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            out[open_] = self.slots[at[open_]]
            open_ = open_[(out[open_] >= 0) & (self.keys[out[open_]] != keys[open_])]
        return out


def _grams(data: np.ndarray, order: int) -> list[np.ndarray]:
    """For k from 0 to ``order``: at each byte after the first ``order``, it and the k bytes before it as one number."""
    wide = data.astype(np.uint64)
    n = len(data) - order
    grams = [wide[order:]]
    for k in range(1, order + 1):
        grams.append(grams[-1] | (wide[order - k:order - k + n] << np.uint64(8 * k)))
    return grams


@dataclass
class Trees:
    """``grams[k]``: byte strings of k+1 bytes that some language has seen, ``costs[k]`` their last byte's bits per language;
    ``contexts[k]``: contexts of k bytes, ``escapes[k]`` the bits of leaving them (0 where a language has not seen one)."""

    langs: list[str]
    order: int
    grams: list[np.ndarray]
    costs: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]


def learn(texts: dict[str, list[bytes]], order: int = ORDER) -> Trees:
    """The frozen trees of the languages' texts."""
    langs = sorted(texts)
    counted: dict[str, list[tuple]] = {}
    for lang in langs:
        parts = [_grams(np.frombuffer(b"\n" * order + t, dtype=np.uint8), order) for t in texts[lang] if t]
        counted[lang] = [np.unique(np.concatenate([p[k] for p in parts] or [np.zeros(0, np.uint64)]), return_counts=True) for k in range(order + 1)]
    trees = Trees(langs, order, [], [], [], [])
    for k in range(order + 1):
        union = np.unique(np.concatenate([counted[x][k][0] for x in langs])) if langs else np.zeros(0, np.uint64)
        contexts = np.unique(union >> np.uint64(8))
        costs = np.zeros((len(union), len(langs)), dtype=np.float32)
        escapes = np.zeros((len(contexts), len(langs)), dtype=np.float32)
        for j, lang in enumerate(langs):
            keys, counts = counted[lang][k]
            own, first, inverse = np.unique(keys >> np.uint64(8), return_index=True, return_inverse=True)
            total = np.bincount(inverse, weights=counts, minlength=len(own))
            distinct = np.bincount(inverse, minlength=len(own))
            escapes[np.searchsorted(contexts, own), j] = np.log2((total + distinct) / np.maximum(distinct, 1))
            if k:
                shorter = trees.costs[k - 1][np.searchsorted(trees.grams[k - 1], union & np.uint64((1 << 8 * k) - 1)), j]
            else:
                shorter = np.full(len(union), 8.0, dtype=np.float32)
            costs[:, j] = escapes[np.searchsorted(contexts, union >> np.uint64(8)), j] + shorter
            costs[np.searchsorted(union, keys), j] = np.log2((total + distinct)[inverse] / counts)
        trees.grams.append(union)
        trees.costs.append(costs)
        trees.contexts.append(contexts)
        trees.escapes.append(escapes)
    return trees


class Scorer:
    """Code lengths of texts in bits per language."""

    def __init__(self, trees: Trees):
        self.trees = trees
        self.grams = [KeyTable(g) for g in trees.grams]
        self.contexts = [KeyTable(c) for c in trees.contexts]

    def _bits(self, grams: list[np.ndarray], k: int) -> np.ndarray:
        if k < 0:
            return np.full((len(grams[0]), len(self.trees.langs)), 8.0, dtype=np.float32)
        at = self.grams[k].find(grams[k])
        out = self.trees.costs[k][at] if len(self.trees.costs[k]) else np.zeros((len(at), len(self.trees.langs)), dtype=np.float32)
        lost = np.flatnonzero(at < 0)
        if lost.size:
            rest = [g[lost] for g in grams[:max(k, 1)]]
            bits = self._bits(rest, k - 1)
            context = self.contexts[k].find(grams[k][lost] >> np.uint64(8))
            known = context >= 0
            bits[known] += self.trees.escapes[k][context[known]]
            out[lost] = bits
        return out

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """One row per text, one column per language. Long texts are cut into chunks that keep their context."""
        order, pad = self.trees.order, b"\n" * self.trees.order
        total = np.zeros((len(texts), len(self.trees.langs)))
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush():
            data = np.frombuffer(b"".join(p for _, p in held), dtype=np.uint8)
            starts = np.cumsum([0, *(len(p) for _, p in held)])
            bits = self._bits(_grams(data, order), order)
            for (row, _), a, b in zip(held, starts, starts[1:]):
                total[row] += bits[a:b - order].sum(axis=0, dtype=np.float64)
            held.clear()

        for row, text in enumerate(texts):
            whole = pad + text
            for at in range(0, len(text), CHUNK):
                held.append((row, whole[at:at + CHUNK + order]))
                size += len(held[-1][1])
                if size >= CHUNK:
                    flush()
                    size = 0
        if held:
            flush()
        return total


def sample_texts(docs: DataFrame, n: int = SAMPLE_TEXTS, most_chars: int = SAMPLE_CHARS) -> dict[str, list[bytes]]:
    """At most ``n`` texts of each language, none of a held-out document; of a long text a passage of ``most_chars`` characters.

    A hash of the id (of the text, if there is none) chooses texts and where passages begin.
    Rows are thinned by each language's share before they are ranked, so ranking sees a few
    times the sample and not a language's rows. The counts are written first: as a small table
    they reach the documents without moving any text.
    """
    c = F.col
    rows = docs.select("doc_id", "lang", "text").filter(~held_out() & c("lang").isNotNull() & c("text").isNotNull())
    own = F.coalesce(c("doc_id").cast("string"), F.md5(c("text").cast("binary")))
    spare = F.greatest(F.char_length("text") - most_chars, F.lit(0))
    rows = rows.withColumn("u", unit_hash(F.lit("lang"), own, c("lang")))
    rows = rows.withColumn("text", F.substr("text", 1 + F.floor(unit_hash(F.lit("passage"), own) * spare).cast("int"), F.lit(most_chars)))
    counts = staged(rows.groupBy("lang").count(), "lang-counts")
    thin = rows.join(counts, "lang").filter(c("u") <= 3.0 * n / c("count"))
    ranked = thin.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("u", "doc_id", "text"))).filter(c("r") <= n)
    texts: dict[str, list[bytes]] = {}
    for r in ranked.select("lang", "text").collect():
        texts.setdefault(r["lang"], []).append(r["text"].encode())
    return texts


def _predict(shared, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Languages and scores of a batch; the score is the share of the winner among all languages' probabilities."""
    trees = shared.value
    if not hasattr(trees, "scorer"):  # once per worker
        trees.scorer = Scorer(trees)
    scorer = trees.scorer
    langs = scorer.trees.langs
    plain = texts.to_pylist()
    spoken = [t is not None and any(map(str.isalpha, t)) for t in plain]
    pred, score = [UNKNOWN] * len(plain), np.zeros(len(plain))
    rows = [i for i, s in enumerate(spoken) if s and langs]
    if rows:
        bits = scorer.code_lengths([plain[i].encode("utf-8", "replace") for i in rows])
        best = bits.argmin(axis=1)
        share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
        for i, b, s in zip(rows, best, share):
            pred[i], score[i] = langs[b], s
    return pred, score


def identify(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per document, from the whole text alone.

    The score is the winner's share of probability. A null text, one without a letter, and
    every text if no language was learned give ``und`` with score 0. Equal code lengths go
    to the first name. Repeated rows give repeated results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            pred, score = _predict(shared, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, trees: Trees, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` whose language is told with a score of at least ``least``; all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            pred, score = _predict(shared, batch.column(at))
            yield batch.filter(pa.array([p != UNKNOWN and s >= least for p, s in zip(pred, score)], pa.bool_()))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
