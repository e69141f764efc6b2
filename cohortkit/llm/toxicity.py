"""Toxicity by a support vector machine over a gapped subsequence string kernel.

The kernel of two strings adds up, over all subsequences of three characters, the products
of their gap-weighted occurrences, and is normalised. Nyström landmarks turn it into a
fixed number of features. The unit of a kernel is a word, or a run of single characters
that white space has pulled apart; a sentence is as toxic as its most toxic unit and a text
as its most toxic sentence, so the machine learns from sentences of which only the text's
label is known: in a toxic text the unit that scores highest stands for it.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from cohortkit.llm.common import held_out, staged, unit_hash

#: Length of the subsequences, weight of each character that one spans.
LENGTH, DECAY = 3, 0.7
#: Landmarks of each class, and the rounds in which toxic texts choose their units anew.
LANDMARKS, ROUNDS = 200, 3
#: The sample the machine is fitted on: so many labelled texts of each class, none longer than this in characters.
SAMPLE_TEXTS, SAMPLE_CHARS = 1500, 20_000
#: Units are cut into overlapping pieces of so many characters.
PIECE = 18
#: Strings that meet the landmarks at once.
BLOCK = 128
#: Units whose score a worker remembers.
REMEMBERED = 500_000
#: Units of toxic texts that are also learned with an inserted character.
VARIED = 120
#: Weight of those units among the toxic ones in fitting, and of missing one in choosing the threshold.
SHARE, GAPPED = 0.4, 0.15
#: Units of clean texts used in fitting.
CLEAN_UNITS = 6000
#: Clean units of at most so many characters are all used, half that number at most: few subsequences tell them from parts of insults.
SHORT = 6

_UNIT = re.compile(r"(?:(?<!\S)\S(?:[^\S\n]\S)+(?!\S))|\S+")
_INSIDE = re.compile(r"[\W_]+")


def units(text: str) -> list[str]:
    """The units of a text: lower case, without marks inside; single characters in a row count as one word."""
    words = text.lower().split()
    out: list[str] = []
    run: list[str] = []
    for w in words:
        if len(w) == 1:
            run.append(w)
            continue
        if run:
            out.append("".join(run))
            run = []
        out.append(w)
    if run:
        out.append("".join(run))
    return out


def pieces(unit: str) -> list[str]:
    """What the kernel sees of a unit: its letters and digits between brackets, in pieces that overlap by half if it is long."""
    if not unit.isalnum():
        unit = _INSIDE.sub("", unit)
    if not unit:
        return []
    unit = f"<{unit}>"
    if len(unit) <= PIECE:
        return [unit]
    return [unit[i:i + PIECE] for i in range(0, len(unit) - PIECE // 2, PIECE // 2)]


def encode(strings: list[str]) -> np.ndarray:
    """Code points in rows of PIECE columns, 0 where a string has ended."""
    data = np.zeros((len(strings), PIECE), dtype=np.uint32)
    for row, s in zip(data, strings):
        row[:len(s)] = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return data


def kernel(a: np.ndarray, b: np.ndarray, pairwise: bool = False) -> np.ndarray:
    """Subsequence kernel of encoded strings: every row of ``a`` with every row of ``b``, or with the same row if ``pairwise``.

    The usual recursion over prefixes, for all strings at once: ``inner[p][j]`` holds the
    weight of the common subsequences of p characters of the prefixes, spans counted to the
    prefixes' ends. Only the row of the current prefix of ``a`` is held, so memory grows with
    the length of one string and not with the product of two.
    """
    shape = (len(a),) if pairwise else (len(a), len(b))
    x = (lambda j: a[:, j]) if pairwise else (lambda j: a[:, j, None])
    y = (lambda j: b[:, j]) if pairwise else (lambda j: b[None, :, j])
    used_a = int((a != 0).sum(axis=1).max(initial=0))
    used_b = int((b != 0).sum(axis=1).max(initial=0))
    zero = np.zeros(shape, np.float32)
    inner = [[np.ones(shape, np.float32)] * (used_b + 1)] + [[zero] * (used_b + 1) for _ in range(LENGTH - 1)]
    total = np.zeros(shape, np.float32)
    for i in range(used_a):
        same = [((x(i) == y(j)) & (x(i) != 0)).astype(np.float32) * (DECAY * DECAY) for j in range(used_b)]
        for j in range(used_b):
            total += same[j] * inner[-1][j]
        for p in range(LENGTH - 1, 0, -1):
            row, run = [zero], zero
            for j in range(used_b):
                run = DECAY * run + same[j] * inner[p - 1][j]
                row.append(DECAY * inner[p][j + 1] + run)
            inner[p] = row
    return total


class Machine:
    """The fitted machine; scores pieces, units and texts.

    As the landmarks are fixed, the decision is a sum over the landmarks' subsequences:
    ``weights`` holds what each of them adds, so a piece costs its own subsequences and not
    one kernel per landmark. Norms are exact.
    """

    def __init__(self, landmarks: list[str], beta: np.ndarray, bias: float, scale: float, shift: float):
        self.bias, self.scale, self.shift = bias, scale, shift
        self.letters = {ch: i + 1 for i, ch in enumerate(sorted({ch for m in landmarks for ch in m}))}
        size = len(self.letters) + 1
        self.weights = np.zeros((size, size, size), dtype=np.float32)
        for m, b in zip(landmarks, beta):
            ids = [self.letters[ch] for ch in m]
            for i in range(len(ids)):
                for j in range(i + 1, len(ids)):
                    for k in range(j + 1, len(ids)):
                        self.weights[ids[i], ids[j], ids[k]] += b * DECAY ** (k - i + 1)
        self.weights[0], self.weights[:, 0], self.weights[:, :, 0] = 0, 0, 0
        self.known: dict[str, float] = {}

    def piece_scores(self, strings: list[str]) -> np.ndarray:
        """Decision values of pieces."""
        if not strings:
            return np.zeros(0, dtype=np.float32)
        letters = self.letters
        ids = np.zeros((len(strings), PIECE), dtype=np.int64)
        for row, s in zip(ids, strings):
            row[:len(s)] = [letters.get(ch, 0) for ch in s]
        used = int(max(map(len, strings)))
        size = self.weights.shape[0]
        flat = self.weights.ravel()
        total = np.zeros(len(strings), dtype=np.float32)
        for i in range(used - 2):
            for j in range(i + 1, used - 1):
                pair = (ids[:, i] * size + ids[:, j]) * size
                for k in range(j + 1, used):
                    total += DECAY ** (k - i + 1) * flat[pair + ids[:, k]]
        return total / self_norm(encode(strings)) + self.bias

    def unit_scores(self, wanted: list[str]) -> None:
        """Remember the scores of units: that of their best piece."""
        if len(self.known) + len(wanted) > REMEMBERED:
            self.known.clear()
        parts = [(u, p) for u in wanted for p in pieces(u)]
        parts.sort(key=lambda x: len(x[1]))
        for at in range(0, len(parts), 4096):
            block = parts[at:at + 4096]
            for (u, _), s in zip(block, self.piece_scores([p for _, p in block]).tolist()):
                if s > self.known.get(u, -1e9):
                    self.known[u] = s
        for u in wanted:
            self.known.setdefault(u, self.bias)

    def text_values(self, texts: list[str]) -> list[float]:
        """Decision values of texts: that of their best unit, the bias alone without one."""
        split = [set(units(t)) for t in texts]
        wanted = sorted(set().union(*split).difference(self.known)) if split else []
        if len(self.known) + len(wanted) > REMEMBERED:
            wanted = sorted(set().union(*split))
            self.known.clear()
        self.unit_scores(wanted)
        return [max(map(self.known.__getitem__, s), default=self.bias) for s in split]

    def probabilities(self, texts: list[str]) -> np.ndarray:
        values = np.array(self.text_values(texts), dtype=np.float64)
        return 1 / (1 + np.exp(-np.clip(self.scale * (values - self.shift), -60, 60)))


def self_norm(data: np.ndarray) -> np.ndarray:
    """Square roots of the strings' kernels with themselves; 1 where a string is too short for a subsequence."""
    own = np.sqrt(kernel(data, data, pairwise=True))
    return np.where(own > 0, own, 1.0)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 60.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """A linear machine with squared hinge loss, by Newton steps over the rows inside the margin."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    ridge = np.ones(x1.shape[1])
    ridge[-1] = 1e-6
    loss = lambda v: float((ridge * v * v).sum() + 2 * c * (weight * np.maximum(0, 1 - y * (x1 @ v)) ** 2).sum())
    best = loss(w)
    for _ in range(steps):
        rows = y * (x1 @ w) < 1
        part = x1[rows] * (2 * c * weight[rows])[:, None]
        goal = np.linalg.solve(np.diag(ridge) + part.T @ x1[rows], part.T @ y[rows])
        size = 1.0
        while size > 1e-3 and loss(w + size * (goal - w)) > best:
            size /= 2
        w = w + size * (goal - w)
        now = loss(w)
        if best - now < 1e-9 * max(1.0, best):
            break
        best = now
    return w[:-1], float(w[-1])


def _variants(piece: str) -> list[str]:
    """A piece with one character inserted, or doubled, at each inner place."""
    word = piece[:PIECE - 1]
    return [word[:i] + ch + word[i:] for i in range(2, len(word) - 1) for ch in ("x", word[i])]


def _shares(counts: list[int]) -> np.ndarray:
    """Weights that add up to 1, half by count and half alike."""
    n = np.array(counts, dtype=np.float64)
    return 0.5 * n / n.sum() + 0.5 / len(n)


def fit(texts: list[str], labels: list[int]) -> Machine:
    """The machine of labelled texts; with no text of one class, one that gives every text the score of its class (0 without any).

    Landmarks are the units that differ most in how many texts of each class have them, and
    as many common units of clean texts. Toxic texts first choose the unit that is rarest
    in clean ones, then, of those more usual in toxic texts, the one that scores highest,
    until the rounds are over. The units that toxic texts choose most also count with a
    letter inserted or doubled, so that the machine learns what a gap costs.
    """
    once: dict[str, str] = {}
    bags = [sorted({once.setdefault(p, p) for u in units(t) for p in pieces(u)}) for t in texts]
    toxic = [b for b, y in zip(bags, labels) if y == 1 and b]
    clean = [b for b, y in zip(bags, labels) if y == 0 and b]
    if not toxic or not clean:
        sure = -8.0 if not toxic else 8.0
        return Machine([], np.zeros(0), sure, 1.0, 0.0)
    bad: dict[str, int] = {}
    good: dict[str, int] = {}
    for bag in toxic:
        for p in bag:
            bad[p] = bad.get(p, 0) + 1
    for bag in clean:
        for p in bag:
            good[p] = good.get(p, 0) + 1
    telling = lambda p: bad[p] / len(toxic) - 3 * good.get(p, 0) / len(clean)
    ranked = sorted((p for p in bad if len(p) >= LENGTH), key=lambda p: (-telling(p), p))
    common = sorted((p for p in good if len(p) >= LENGTH), key=lambda p: (-good[p], p))
    landmarks = list(dict.fromkeys(ranked[:LANDMARKS] + common[:LANDMARKS]))
    marks = encode(landmarks)
    norms = self_norm(marks)
    gram = np.vstack([kernel(marks[at:at + BLOCK], marks) for at in range(0, len(marks), BLOCK)]).astype(np.float64) / norms[:, None] / norms[None, :]
    value, vector = np.linalg.eigh(gram)
    keep = value > 1e-6 * value.max(initial=0.0)
    root = vector[:, keep] / np.sqrt(value[keep])

    def features(strings: list[str]) -> np.ndarray:
        out = []
        for at in range(0, len(strings), BLOCK):
            data = encode(strings[at:at + BLOCK])
            out.append(kernel(data, marks).astype(np.float64) / self_norm(data)[:, None] / norms[None, :] @ root)
        return np.concatenate(out) if out else np.zeros((0, root.shape[1]))

    step = max(1, len(common) // CLEAN_UNITS)
    short = [p for p in common if len(p) <= SHORT][:CLEAN_UNITS // 2]
    clean_units = list(dict.fromkeys(common[:CLEAN_UNITS // 2] + common[CLEAN_UNITS // 2::step][:CLEAN_UNITS // 2] + short))
    chosen = [max(bag, key=lambda p: (telling(p), p)) for bag in toxic]
    for turn in range(ROUNDS):
        counted: dict[str, int] = {}
        for p in chosen:
            counted[p] = counted.get(p, 0) + 1
        positive = sorted(p for p in counted if telling(p) > 0) or sorted(counted)
        usual = sorted(positive, key=lambda p: (-counted[p], p))[:VARIED]
        changed = sorted({v for p in usual for v in _variants(p)}.difference(good))
        x = np.vstack([features(positive), features(changed), features(clean_units)])
        y = np.concatenate([np.ones(len(positive) + len(changed)), -np.ones(len(clean_units))])
        weight = np.concatenate([(1 - SHARE) * _shares([counted[p] for p in positive]), np.full(len(changed), SHARE / max(1, len(changed))), _shares([good[p] for p in clean_units])])
        w, bias = _svm(x, y, weight * len(y) / 2)
        machine = Machine(landmarks, (root @ w) / norms, bias, 1.0, 0.0)
        machine.unit_scores(sorted({p for bag in bags for p in bag}))
        if turn + 1 < ROUNDS:
            chosen = [max(bag, key=lambda p: (telling(p) > 0, min(machine.known[p], 1.0), telling(p), p)) for bag in toxic]
            hard = sorted((p for p in good if machine.known[p] > -0.5), key=lambda p: (-machine.known[p], p))[:CLEAN_UNITS // 2]
            clean_units = list(dict.fromkeys(clean_units + hard))
    high = np.array([max(machine.known[p] for p in bag) for bag in toxic])
    gapped = np.sort(machine.piece_scores(changed))
    low = np.array([max(machine.known[p] for p in bag) for bag in clean])
    edges = np.unique(np.concatenate([high, low]))
    between = np.concatenate([edges[:1] - 1, (edges[1:] + edges[:-1]) / 2, edges[-1:] + 1])
    miss = np.searchsorted(np.sort(high), between) / len(high) + GAPPED * np.searchsorted(gapped, between) / max(1, len(gapped)) + 3 * (1 - np.searchsorted(np.sort(low), between) / len(low))
    best = np.flatnonzero(miss <= miss.min() + 1e-12)
    machine.shift = float(between[best[len(best) // 2]])
    gap = max(0.05, float(np.median(high) - np.median(low)))
    machine.scale = 8.0 / gap
    machine.known.clear()
    return machine


def sample_labelled(docs: DataFrame, labels: DataFrame, n: int = SAMPLE_TEXTS, most_chars: int = SAMPLE_CHARS) -> tuple[list[str], list[int]]:
    """At most ``n`` texts of each label, none held out or longer than ``most_chars``, chosen by a hash of the id.

    Documents with several labels count as toxic if one of them says so; repeated rows count
    once. Ids and hashes are drawn first, so that only the chosen texts (at most ``n`` of each
    label) are moved.
    """
    c = F.col
    marked = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = marked.filter(~held_out()).groupBy("toxic").count()
    drawn = marked.filter(~held_out()).withColumn("u", unit_hash(F.lit("toxic"), c("doc_id"))).join(share, "toxic").filter(c("u") <= 3.0 * n / c("count"))
    short = docs.filter(~held_out() & (F.char_length("text") <= most_chars)).select("doc_id", "text").withColumn("code", F.xxhash64("text"))
    rows = short.select("doc_id", "code").join(drawn, "doc_id").distinct()
    ranked = rows.withColumn("r", F.row_number().over(W.partitionBy("toxic").orderBy("u", "doc_id", "code"))).filter(c("r") <= n)
    chosen = staged(ranked.select("doc_id", "code", "toxic", "u"), "toxic-sample")
    picked = short.join(chosen, ["doc_id", "code"]).groupBy("doc_id", "code", "toxic", "u").agg(F.first("text").alias("text"))
    got = picked.orderBy("u", "doc_id", "code").select("toxic", "text").collect()
    return [r["text"] for r in got], [int(r["toxic"]) for r in got]


def score_toxicity(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document, from the whole text alone.

    Null and empty texts get the score of a text without units. Repeated rows give repeated
    results; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        machine = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            score = np.concatenate([machine.probabilities([t or "" for t in texts[at:at + 512]]) for at in range(0, len(texts), 512)]) if texts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
