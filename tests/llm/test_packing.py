import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cohortkit.llm import packing
from cohortkit.llm.common import table
from tests.llm.cases import awkward, empty

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


PLAIN = Tokenizer.from_file(PATH)


def whole_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [1]


def test_special_marks_in_texts():
    for text in ("a <|endoftext|> b", "x<|startoftext|>y <|endoftext|><|endoftext|>", "<|endof text|>", "Ünï <|ENDOFTEXT|>", "end.<|endoftext|>."):
        assert np.frombuffer(packing.encoder(PATH).text_ids(text.encode()), "<u4").tolist() == whole_ids(text)[:-1]
    assert whole_ids("a <|endoftext|> b") == [320, 49407, 321, 1]


def check(rows, texts):
    """Every id in one piece, windows gapless and within bounds; returns the padding's share."""
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for doc_id, text in texts.items():
        ids = whole_ids(text)
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for w in windows.values():
        at = 0
        for r in sorted(w, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / total


def test_round_trip(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(packing.pack_documents(docs, PATH).collect(), texts) < 0.01


def test_awkward_rows(spark):
    docs = awkward(spark).filter("doc_id IS NULL OR doc_id != 8")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert check(packing.pack_documents(docs, PATH).collect(), texts) < 0.01
    twice = packing.pack_documents(awkward(spark).filter("doc_id = 8"), PATH).collect()
    assert len({(r.sequence_id, r.offset) for r in twice}) == len(twice) and sum(r.length for r in twice) == 20
    assert packing.pack_documents(empty(spark), PATH).count() == 0


def test_words_are_encoded_as_texts():
    enc = packing.WordEncoder(PATH)
    assert enc.direct
    text = "Don't STOP. <|endoftext|> naïve Straße,. été  x y 漢字かな 12.5% --> Σίσυφος ΣΑΣ ''s're"
    assert enc.text_ids(text.encode()) == np.array(whole_ids(text)[:-1], "<u4").tobytes()


def test_level_choice_is_the_least_sum_of_squares():
    rnd = random.Random(5)
    packer = packing.LevelPacker(20)
    for _ in range(400):
        s = rnd.randint(1, 19)
        before = packer.counts.copy()
        packer.place(s, (0, b"", 0, 0))
        best = None
        for h in [0, *[h for h in range(1, 20) if before[h] and h + s <= 20]]:
            n = before.copy()
            n[h] -= h > 0
            if h + s < 20:
                n[h + s] += 1
            value = int((n[1:20] ** 2).sum())
            best = value if best is None else min(best, value)
        assert int((packer.counts[1:20] ** 2).sum()) == best


def test_batches_of_whole_texts_are_small(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    docs = spark.range(3000).selectExpr("id AS doc_id", "'some words' AS text").coalesce(1)
    for before, after in (("10000", str(packing.BATCH_ROWS)), ("0", str(packing.BATCH_ROWS)), ("7", "7")):
        spark.conf.set(name, before)
        packed = packing.pack_documents(docs, PATH)
        assert spark.conf.get(name) == after and packed.count() >= 3000

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    spark.conf.set(name, "10000")
    packing.pack_documents(docs, PATH)
    assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) <= packing.BATCH_ROWS
    spark.conf.unset(name)
