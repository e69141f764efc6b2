import random

from cohortkit.llm import hamming
from tests.llm.cases import empty

SCHEMA = "vec_id long, embedding array<float>, code string"


def plain(rows, k):
    code = lambda v: sum(1 << i for i in range(64) if v is not None and i < len(v) and v[i] is not None and v[i] > 0)
    codes = {(i, code(v)) for i, v, _ in rows if i is not None}
    out = []
    for q, x in codes:
        if q % 20 == 0:
            near = sorted(((x ^ y).bit_count(), i) for i, y in codes if i != q)[:k]
            out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return sorted(out)


def run(spark, rows, k=10):
    vectors = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, hamming.top_k(vectors, vectors.filter("vec_id % 20 = 0"), k).collect()))


def test_equals_brute_force(spark):
    rnd = random.Random(7)
    base = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rnd.gauss(0, 0.6) for x in rnd.choice(base)], "c") for i in range(400)]
    rows += [(1000 + i, rows[3][1], "c") for i in range(60)] + [(2000 + i, [0.0] * 64, "c") for i in range(25)]
    assert run(spark, rows) == plain(rows, 10)


def test_awkward_rows(spark):
    rows = [(20, [1.0, None, -1.0], "c"), (40, None, "c"), (60, [], "c"), (1, [1.0] * 70, "c"), (None, [1.0], "c"), (2, [-1.0], "c"), (2, [-1.0], "c")]
    assert run(spark, rows) == plain(rows, 10)
    assert run(spark, rows, 1) == plain(rows, 1)
    assert run(spark, []) == []
