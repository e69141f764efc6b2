"""The pipeline's stages one after the other, each against a plain rule on its own input."""

import zlib
from collections import Counter, defaultdict

import corpus_pipeline as C
import numpy as np
import pytest

from cohortkit.llm import simhash
from cohortkit.llm.common import staged, table

SF = "/root/testdata/sf0.001"


def test_stages_on_given_documents(spark):
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(C.public_tokenizer())
    docs = table(spark, SF, "documents")
    outs = [docs]
    for name, stage in C.STAGES:
        outs.append(staged(stage(spark, outs[-1], SF), "pipeline-test"))
        if name != C.STAGES[-1][0]:
            assert outs[-1].columns == docs.columns
    whole, told, unique, clean, mixed, packed = [[r.asDict() for r in df.collect()] for df in outs]

    assert {r["doc_id"] for r in told} <= {r["doc_id"] for r in whole} and len(told) > 0.9 * len(whole)

    prints = {r["doc_id"]: simhash.fingerprint((r["text"] or "").encode()) for r in told}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints.items():
            low = min(root[j] for j, b in prints.items() if (a ^ b).bit_count() <= simhash.RADIUS)
            if low < root[i]:
                root[i], changed = low, True
    assert sorted(r["doc_id"] for r in unique) == sorted({root[i] for i in root})

    before = {r["doc_id"]: r["text"] for r in unique}
    assert len(clean) == len(unique) and all(r["text"] == before[r["doc_id"]] or "[secret]" in r["text"] for r in clean)

    copies, texts = Counter(r["doc_id"] for r in mixed), {r["doc_id"]: r["text"] for r in clean}
    assert set(copies) <= set(texts) and max(copies.values()) <= 2

    pieces, windows = defaultdict(list), defaultdict(list)
    for r in packed:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(copies)
    for i, n in copies.items():
        ids = plain.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        assert sum(length for _, length, _ in pieces[i]) == n * len(ids)
        assert all(crc == zlib.crc32(np.array(ids[a:a + length], "<u4").tobytes()) for a, length, crc in pieces[i])
    for w in windows.values():
        at = 0
        for offset, length in sorted(w):
            assert offset == at
            at += length
        assert at <= 2048
