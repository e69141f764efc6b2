import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortkit.llm import perplexity as P
from cohortkit.llm.common import table
from tests.llm.cases import awkward, empty


def plain_figures(text):
    spaces = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for ch in text + " ":
        if ch in spaces:
            if word:
                words.append(word)
            word = ""
        else:
            word += ch
    lines = [x for x in text.split("\n") if x.strip(spaces)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    hit = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), len(lines) - len(set(lines)), len(hit)


def test_base_figures(spark):
    texts = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    rnd = random.Random(2)
    texts += ["", " \n ", "a " * 30, "é\x85ü x\x1cy\n\né\x85ü x\x1cy"]
    texts += [" ".join(rnd.choice("abc") for _ in range(200)) for _ in range(10)]
    for t in texts:
        assert P.base_figures(t) == plain_figures(t)


def plain_grams(text):
    s = P.EDGE * (P.ORDER - 1) + text
    return [s[i:i + P.ORDER] for i in range(len(text))]


def plain_model(texts):
    """Modified Kneser-Ney probabilities of the counted grams from the definitions, with dictionaries."""
    levels = {P.ORDER: Counter(g for t in texts for g in plain_grams(t))}
    for k in range(P.ORDER - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    tables = {}
    for k, counts in levels.items():
        kept = {g: n for g, n in counts.items() if k <= P.PRUNED_ABOVE or n > 1}
        n = [sum(1 for c in kept.values() if c == i) for i in range(1, 5)]
        d = [0, 0.5, 1.0, 1.5]
        if min(n):
            y = n[0] / (n[0] + 2 * n[1])
            d = [0] + [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i) for i in (1, 2, 3)]
        total, left = defaultdict(int), defaultdict(float)
        for g, c in kept.items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3)]
        tables[k] = kept, d, total, left

    def p(g):
        if not g:
            return 1 / (len(levels[1]) + 1)
        kept, d, total, left = tables[len(g)]
        lower = p(g[1:])
        if g[:-1] not in total:
            return lower
        c = kept.get(g, 0)
        return (c - d[min(c, 3)]) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * lower
    return p


def odd_texts():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcdefgh .é") for _ in range(n)) for n in (5, 200, 900, 900)]
    return texts + ["漢字かな交じり文" * 3 + "𝒳y 漢字", "a", "", None, texts[1], "ab\x00cd \x02 \u0fff\u1000"]


@pytest.mark.parametrize("size", [P.SLICE, 97])
def test_bits_follow_the_definitions(spark, size):
    rows = [(i, t, lang) for i, t in enumerate(odd_texts()) for lang in ("en", "de", None)]
    rows = [r for r in rows if r[2] == "en" or r[0] % 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("n", F.lit("other"))
    hashed = P.hashed_model(P.kneser_ney(P.count_grams(docs)))
    got = sorted(((r.model, r.doc_id, r.bits) for r in P.score_documents(docs, hashed, size).collect()), key=repr)
    models = {lang: plain_model([t for _, t, la in rows if t and la == lang]) for lang in ("en", "de", None)}
    want = [("" if la is None else "=" + la, i, -sum(math.log2(models[la](g)) for g in plain_grams(t)) / len(t) if t else None) for i, t, la in rows]
    want.sort(key=repr)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    for (_, _, x), (_, _, y) in zip(got, want):
        assert x == (None if y is None else pytest.approx(y, rel=1e-4))


def test_probabilities_sum_to_one():
    p = plain_model([t for t in odd_texts() if t])
    symbols = {c for t in odd_texts() if t for c in t}
    for context in ("abcd", "d ab", "zzzz", ""):
        assert sum(p(context + c) for c in [*symbols, "\uffff"]) == pytest.approx(1)


def test_counts_cover_all_documents(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    docs = docs.unionByName(spark.createDataFrame([(-i, t, None, "s", 1) for i, t in enumerate(odd_texts())], docs.schema))
    want = Counter()
    for r in docs.collect():
        want.update(("" if r.lang is None else "=" + r.lang, g) for g in plain_grams(r.text or ""))
    got = {(r.model, r.gram): r.n for r in P.count_grams(docs).collect()}
    assert got == dict(want)


def test_pieces_and_small_buffers(monkeypatch):
    monkeypatch.setattr(P, "PIECE", 50)
    monkeypatch.setattr(P, "HELD", 64)
    for text in [t for t in odd_texts() if t]:
        counter = P.GramCounter()
        for s in P.pieces(text):
            counter.add(s)
        grams, counts = counter.rows()
        assert dict(zip(grams, counts.tolist())) == dict(Counter(plain_grams(text)))


def test_languages_have_no_limit(spark):
    rows = [(i, f"word{i % 7} other text {i % 5} and more words of language here", f"l{i:04d}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert P.kneser_ney(P.count_grams(docs)).select("model").distinct().count() == 600


def test_noise_does_not_predict_itself(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rnd = random.Random(8)
    noise = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCDEFGH") + (" " if rnd.random() < 0.2 else "") for _ in range(900)) for _ in range(10)]
    odd = docs.unionByName(spark.createDataFrame([(-1 - i, t, "en", "s", 1) for i, t in enumerate(noise)], docs.schema))
    got = P.judge_quality(odd).filter("doc_id < 0").collect()
    assert len(got) == 10 and not any(r.kept for r in got) and not any(r.base_failed for r in got)


def test_verdicts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = P.judge_quality(docs).collect()
    assert len(rows) == docs.count()
    passed = [r for r in rows if not r.base_failed]
    assert sum(r.kept for r in passed) > 0.9 * len(passed)
    assert not any(r.kept for r in rows if r.base_failed)
    odd = docs.unionByName(spark.createDataFrame([(-1, "qzx#kw vj%wq xkq " * 40 + " ".join(f"w{i}" for i in range(300)), "en", "s", 1), (-2, "".join(chr(33 + i * 7 % 90) + (" " if i % 5 == 0 else "") for i in range(900)), "en", "s", 1)], docs.schema))
    verdict = {r.doc_id: r for r in P.judge_quality(odd).filter("doc_id < 0").collect()}
    assert not verdict[-2].kept


def test_awkward_rows(spark):
    rows = P.judge_quality(awkward(spark)).collect()
    assert len(rows) == 11
    by = {r.doc_id: r for r in rows}
    assert by[3].n_words == by[4].n_words == by[5].n_words == 0 and by[3].base_failed
    assert by[6].base_failed and by[6].n_repeat_words == 20_000
    assert P.judge_quality(empty(spark)).count() == 0
