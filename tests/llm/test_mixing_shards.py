import random
import zlib
from collections import defaultdict

import pytest

from cohortkit.llm import mixing, shards
from cohortkit.llm.common import table
from tests.llm.cases import DOCS, awkward, empty


def plain_targets(sizes):
    """Shares by weight, the excess over twice a source's size dealt again until none is left."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target = dict.fromkeys(names, 0.0)
    left, open_ = 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2 * sizes[s]
                open_.discard(s)
    return target


def test_targets(spark):
    rnd = random.Random(1)
    for _ in range(4):
        sizes = {f"s{i}": rnd.choice([0, 5, 100, 5000, 10 ** 6]) for i in range(rnd.randint(1, 12))} | {None: 40}
        rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(rows).collect()}
        assert got == pytest.approx(plain_targets(sizes), rel=1e-9)


def test_mix_follows_the_plan(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    plan = mixing.plan_mix(docs)
    rows = plan.select("doc_id", "source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == docs.count() and all(r.copies <= 2 for r in rows)
    taken = defaultdict(int)
    for r in rows:
        taken[r.source] += r.size * r.copies
    for r in rows:
        assert abs(taken[r.source] - r.target) < 0.1 * r.target
    assert sorted(map(tuple, rows)) == sorted(map(tuple, plan.select("doc_id", "source", "size", "source_size", "target", "copies").collect()))
    assert mixing.mix(docs).count() == sum(r.copies for r in rows)


def test_mix_awkward_rows(spark):
    plan = mixing.plan_mix(awkward(spark)).collect()
    assert len(plan) == 11
    size = {i: len((t or "").split()) for i, t in awkward(spark).select("doc_id", "text").collect()}
    assert all(r.copies <= 2 and r.size == size[r.doc_id] for r in plan)
    mixed = mixing.mix(awkward(spark))
    assert mixed.columns == awkward(spark).columns and {r["size"] for r in mixed.collect()} == {"other"}
    assert mixing.plan_mix(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0


def plain_capacity(sizes, n):
    """Smallest largest sum of n contiguous parts, by trying all cuts."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(n):
        best = [0] + [min(max(best[j], sum(sizes[j:i])) for j in range(i)) for i in range(1, len(sizes) + 1)]
    return best[-1]


def test_cut_points_are_minimax():
    rnd = random.Random(2)
    for _ in range(60):
        sizes = [rnd.randint(1, 30) for _ in range(rnd.randint(1, 25))]
        n = rnd.randint(1, 8)
        if max(sizes) * n > sum(sizes):  # a group above the even share is cut out; see the next test
            continue
        starts = shards.cut_points(sizes, n)
        assert starts[0] == 0 and len(starts) <= n
        parts = [sum(sizes[a:b]) for a, b in zip(starts, [*starts[1:], len(sizes)])]
        assert max(parts) == plain_capacity(sizes, n)


def test_a_large_group_stands_alone():
    sizes = [3] * 50 + [1000] + [3] * 50
    starts = shards.cut_points(sizes, 10)
    parts = [sum(sizes[a:b]) for a, b in zip(starts, [*starts[1:], len(sizes)])]
    assert len(parts) <= 10 and sorted(parts)[-1] == 1000 and sorted(parts)[-2] <= 45
    assert shards.cut_points([], 5) == [] or shards.cut_points([], 5) == [0]


def test_shards(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = shards.shard_by_bytes(docs, 40).collect()
    assert len(rows) == len(texts)
    by, where = defaultdict(list), {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert r.size == len(data) + 16 and r.text_crc32 == zlib.crc32(data) and r.law == "bytes" and r.grown_shard is None
        assert where.setdefault(texts[r.doc_id], r.shard) == r.shard
        by[r.shard].append(r)
    assert set(by) == set(range(40))
    for group in by.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
    sums = [sum(r.size for r in g) for g in by.values()]
    assert max(sums) < 1.15 * sum(sums) / 40


def test_shards_awkward_rows(spark):
    rows = shards.shard_by_bytes(awkward(spark), 4).collect()
    assert len(rows) == 11
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert shards.shard_by_bytes(empty(spark), 4).count() == 0
    assert shards.shard_by_bytes(spark.createDataFrame([(i, "same", "en", "a", 4) for i in range(50)], DOCS), 4).select("shard").distinct().count() == 1


def test_source_without_words_and_rows_without_id(spark):
    rows = [(1, "a b c d", "x"), (2, "", "empty"), (3, None, "empty"), *[(None, f"w{i} of a text", "y") for i in range(600)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.plan_mix(df).collect()
    assert len(plan) == len(rows)
    assert all(r.target == 0 and r.copies == 0 for r in plan if r.source == "empty")
    taken = sum(r.size * r.copies for r in plan if r.source == "y")
    target = next(r.target for r in plan if r.source == "y")
    assert abs(taken - target) < 0.1 * target
    assert {r.source for r in mixing.mix(df).collect()} == {"x", "y"}
