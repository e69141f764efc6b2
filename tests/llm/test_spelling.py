"""Spelling variants against a plain comparison of all words."""

import random
import re
import zlib
from collections import Counter

from cases import DOCS, awkward, empty

from cohortkit.llm import spelling as S


def counted(rows, divisor=199):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % divisor == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return n


def edits(word, letters):
    for i in range(len(word) + 1):
        for x in letters:
            yield word[:i] + x + word[i:]
            if i < len(word):
                yield word[:i] + x + word[i + 1:]
        if i < len(word):
            yield word[:i] + word[i + 1:]


def brute(rows, least_length=6, least_count=5, times=5, divisor=199):
    n = {w: k for w, k in counted(rows, divisor).items() if len(w) >= least_length and k >= least_count}
    letters = set("".join(n))
    near = {w: sorted({e for e in edits(w, letters) if e != w and e in n}) for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def got(df, **kw):
    rows = S.variants(df, **kw)
    assert rows.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: r[0])


def corpus():
    rnd = random.Random(3)
    base = ["".join(rnd.choice(["an", "er", "Th", "ing", "é", "ö", "st", "a", "x"]) for _ in range(rnd.randint(3, 6))) for _ in range(40)]
    words = []
    for w in base:
        for _ in range(6):
            words.append(rnd.choice(list(edits(w, "aéxt"))))
    weights = [rnd.choice([1, 1, 5, 30, 200]) for _ in base + words]
    return [(i, " ".join(rnd.choices(base + words, weights, k=400)) + rnd.choice([".", " ×÷ ", "1a"])) for i in range(60)]


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, divisor=7)
    assert got(df, divisor=7) == want
    assert got(df, divisor=7, node=16) == want and sum(r[1] is not None for r in want) > 30
    assert any(r[1] is not None and r[2] != r[1] for r in want)


def test_nodes_deeper_than_all_levels(spark):
    words = ["".join(p) for p in {tuple(random.Random(i).sample("aekstt", 6)) for i in range(80)}]
    rows = [(i, " ".join(words)) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df, node=4) == brute(rows)


def test_long_words(spark):
    long = "ab" * 200
    rows = [(1, " ".join([long] * 30 + [long + "c"] * 6 + [long[:-1] + "x"] * 5 + ["z" * 64] * 30 + ["z" * 65] * 5 + ["z" * 63 + "y"] * 5)), (2, "y" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows)


def test_one_edit():
    rnd = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rnd.choices("ab", k=rnd.randint(1, 6))) for _ in range(2))
        want = a != b and b in set(edits(a, "ab"))
        assert S.one_edit(a, b) == want
        if 0 <= len(b) - len(a) <= 1:
            q, m = S.Letters([a, "abcdefghi"]), S.Letters([b])
            import numpy as np

            assert bool(S.verified(q, m, np.array([0]), np.array([0]))[0]) == want


def test_awkward_and_empty(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    assert got(awkward(spark), least_count=1, least_length=1) == brute(rows, 1, 1)
    assert got(empty(spark)) == []
    assert DOCS
