from itertools import combinations

import numpy as np
import pytest

from cohortkit.llm import toxicity as T
from cohortkit.llm.common import table
from tests.llm.cases import awkward, empty


def plain_kernel(a, b):
    """Sum over all index triples that spell the same subsequence."""
    def seen(s):
        out = {}
        for t in combinations(range(len(s)), T.LENGTH):
            key = "".join(s[i] for i in t)
            out[key] = out.get(key, 0.0) + T.DECAY ** (t[-1] - t[0] + 1)
        return out
    x, y = seen(a), seen(b)
    return sum(v * y.get(k, 0.0) for k, v in x.items())


WORDS = ["and", "idiot", "idxiot", "loser", "los", "aaaa", "banana", "ab", "réeuxment", "abcdefghijklmnop"]


def test_kernel_is_exact():
    data = T.encode(WORDS)
    want = np.array([[plain_kernel(a, b) for b in WORDS] for a in WORDS])
    assert T.kernel(data, data) == pytest.approx(want, rel=1e-4, abs=1e-7)
    assert T.kernel(data, data, pairwise=True) == pytest.approx(want.diagonal(), rel=1e-4, abs=1e-7)


def test_kernel_holds_no_row_per_pair_of_characters():
    """Memory of the kernel follows the length of one string: far less than a matrix for each of the 18 x 18 pairs of characters."""
    import tracemalloc

    data = T.encode([w.ljust(T.PIECE, "q") for w in WORDS] * 13)
    tracemalloc.start()
    T.kernel(data, data)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6 * T.PIECE * len(data) ** 2 * 4


def test_fast_scores_equal_the_kernel_sum():
    marks = ["idiot", "loser", "and", "banana", "réeux"]
    beta = np.array([1.0, -2.0, 0.5, 3.0, -1.0])
    machine = T.Machine(marks, beta, 0.25, 1.0, 0.0)
    norm = lambda s: plain_kernel(s, s) ** 0.5 or 1.0
    want = [sum(b * plain_kernel(w, m) for b, m in zip(beta, marks)) / norm(w) + 0.25 for w in WORDS]
    assert machine.piece_scores(WORDS) == pytest.approx(np.array(want), rel=1e-3, abs=1e-4)


def test_units_and_pieces():
    assert T.units("You I d i o t\nx-y") == ["you", "idiot", "x-y"]
    assert T.pieces("i.d-i_o.t!") == ["<idiot>"] and T.pieces("!!") == []
    assert all(len(p) <= T.PIECE for p in T.pieces("abc" * 40)) and "".join(p[:9] for p in T.pieces("abc" * 40)).startswith("<abcabcabcabc")


def test_held_out_accuracy(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    machine = T.fit(*T.sample_labelled(docs, labels, 600))
    rows = T.score_toxicity(docs.join(labels.select("doc_id", "toxic"), "doc_id"), machine).filter("held_out")
    rows = rows.join(labels.select("doc_id", "toxic"), "doc_id").collect()
    bad, good = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert len(bad) > 50 and sum(r.predicted for r in bad) / len(bad) > 0.85
    assert sum(r.predicted for r in good) / len(good) < 0.05
    gapped = machine.probabilities(["the onand " + w + " ered" for w in ("i.d.i.o.t", "i d i o t", "idxiot", "mor-on", "worthleess", "disgustiing")])
    assert (gapped >= 0.5).sum() >= 5
    assert machine.probabilities(["on and the ered", ""]).max() < 0.5


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (9, None), (None, 1)], "doc_id long, toxic int")
    machine = T.fit(*T.sample_labelled(awkward(spark), labels))
    rows = T.score_toxicity(awkward(spark), machine).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    for y, want in ((0, 0), (1, 1)):
        one = T.fit(["some words here"], [y])
        assert (one.probabilities(["anything", ""]) >= 0.5).tolist() == [bool(want)] * 2
    assert (T.fit([], []).probabilities(["x"]) < 0.5).all()
    assert T.score_toxicity(empty(spark), machine).count() == 0
