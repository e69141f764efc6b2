import math
import random
from collections import Counter, defaultdict

import pytest

from cohortkit.llm import langid
from cohortkit.llm.common import table
from tests.llm.cases import awkward, empty


def plain_bits(train, text, order):
    """Code length of a text by walking the contexts byte by byte."""
    counts = defaultdict(Counter)
    for t in train:
        data = b"\n" * order + t
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[data[i - k:i]][data[i]] += 1
    data, bits = b"\n" * order + text, 0.0
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = counts.get(data[i - k:i])
            if not seen:
                continue
            total, distinct = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("chunk", [1 << 20, 37])
def test_code_lengths_are_exact(monkeypatch, chunk):
    monkeypatch.setattr(langid, "CHUNK", chunk)
    rnd = random.Random(1)
    make = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n)).encode()
    train = {"aa": [make("abcd ", 300), make("abé", 50)], "bb": [make("bcxyz ", 400)], "cc": [b""]}
    texts = [make("abcdxyz é!", n) for n in (1, 5, 80, 200)] + [b"", b"\xff\x00zz"]
    got = langid.Scorer(langid.learn(train, 4)).code_lengths(texts)
    for row, text in zip(got, texts):
        for bits, lang in zip(row, sorted(train)):
            assert bits == pytest.approx(plain_bits(train[lang], text, 4), rel=1e-5, abs=1e-4)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    trees = langid.learn(langid.sample_texts(docs))
    rows = langid.identify(docs, trees).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 100 and sum(r.lang_pred == r.lang for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert langid.keep_identified(docs, trees).count() >= 0.97 * docs.count()


def test_awkward_rows(spark):
    docs = awkward(spark)
    trees = langid.learn(langid.sample_texts(docs))
    rows = langid.identify(docs, trees).collect()
    assert len(rows) == 11
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5, 8))
    assert by[1].lang_pred in ("en", "de") and not by[None].held_out
    kept = langid.keep_identified(docs, trees, 0.0)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 6, 7, 9]
    nothing = langid.learn(langid.sample_texts(empty(spark)))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(empty(spark), nothing).count() == 0


def test_long_texts_and_rows_without_id_are_learned_from(spark):
    rows = [(i, "lange Wörter und ähnliche Sätze stehen hier " * 600, "de") for i in range(40)]
    rows += [(None, f"des mots français numéro {i} et encore autre chose", "fr") for i in range(300)] + [(i, f"plain english words {i}", "en") for i in range(100, 140)]
    texts = langid.sample_texts(spark.createDataFrame(rows, "doc_id long, text string, lang string"), n=50)
    assert set(texts) == {"de", "en", "fr"} and len(texts["fr"]) == 50 and all(len(t.decode()) <= langid.SAMPLE_CHARS for t in texts["de"])
