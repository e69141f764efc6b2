"""Phrase mining against a plain count of all phrases."""

import random
import re
from collections import Counter

from cases import awkward, empty

from cohortkit.llm import phrases as P


def brute(rows, least, longest, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = {}
    for (lang, p), a in cands.items():
        if any(la == lang and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for (la, q), b in cands.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, v in out.items() for i, (s, a, p, x, y) in enumerate(sorted(v)[:top]))


def texts(count=300):
    rnd = random.Random(5)
    words = ["Of", "the", "new", "york", "Éa", "èb", "漢", "x-y", "and", "San", "francisco", "a"]
    rows = []
    for i in range(count):
        out = []
        for _ in range(rnd.randint(0, 60)):
            out.append(rnd.choice(["new york", "san francisco bay area", rnd.choice(words), rnd.choice(words), "tail%d" % rnd.randint(0, 400)]))
            out.append(rnd.choice([" ", " ", "  ", "\t", ", ", "\n", ".", "!?", "\r\n", "   "]))
        rows.append((rnd.choice(["en", "de", None]), rnd.choice(["", " ", "\n"]) + "".join(out)))
    return rows


def test_against_brute_force(spark):
    rows = texts() + [("en", None), ("en", ""), (None, " \t ")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in P.collocations(df, 12, block_words=700).collect())
    assert got == brute(rows, 12, 5, 2000) and len(got) > 30
    assert sorted(tuple(r) for r in P.collocations(df, 12, top=4).collect()) == brute(rows, 12, 5, 4)


def test_products_beyond_64_bits(spark):
    big = 9 * 10**12
    level = lambda rows: spark.createDataFrame(rows, "lang string, phrase string, a long")
    levels = [level([("en", "a", big), ("en", "b", big - 1)]), level([("en", "a b", big - 7)]), level([]), level([]), level([])]
    row = P.scored(levels, spark.createDataFrame([("en", 10**13)], "lang string, n long")).first()
    assert row.score == 1000 * (big - 7) * 10**13 // (big * (big - 1))


def test_runs_overlap_and_long_text(spark):
    rows = [("en", "ha " * 5000), ("en", "ha ha")]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in P.collocations(df, 100).collect()) == brute(rows, 100, 5, 2000)


def test_awkward_and_empty(spark):
    rows = [(r.lang, r.text) for r in awkward(spark).collect()]
    got = P.collocations(awkward(spark), 2)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 2, 5, 2000)
    assert P.collocations(empty(spark)).collect() == []
