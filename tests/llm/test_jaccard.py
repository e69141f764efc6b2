"""The Jaccard join against a comparison of all pairs."""

import random

import pytest
from cases import awkward, empty

from cohortkit.llm import jaccard as J


def sets(text, size=4):
    words = [w for w in "".join(x.lower() if x.isascii() else x for x in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    return {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=85):
    all_ = [sets(t) for _, t in rows]
    near = [[j for j in range(len(rows)) if all_[i] and all_[j] and 100 * len(all_[i] & all_[j]) >= percent * len(all_[i] | all_[j])] for i in range(len(rows))]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((doc_id, len(all_[i]), min(ids) if ids else None))
    return sorted(out, key=repr)


def family(rnd, base, count, rate):
    for _ in range(count):
        words = list(base)
        for _ in range(rnd.randint(0, rate)):
            at = rnd.randrange(len(words))
            words[at:at + rnd.randint(0, 1)] = [f"z{rnd.randint(0, 10**6)}"] if rnd.random() < 0.7 else []
        yield " ".join(words)


def corpus():
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(500)] + ["Éa", "the", "of"] * 20
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 80))) for _ in range(60)]
    for _ in range(6):
        texts += family(rnd, rnd.choices(vocabulary, k=rnd.choice([5, 30, 90, 200])), 12, 6)
    passage = " ".join(rnd.choices(vocabulary, k=60))
    texts += [passage + " " + " ".join(rnd.choices(vocabulary, k=rnd.randint(0, 30))) for _ in range(40)]
    texts += texts[:20] + [t.upper() for t in texts[60:70]] + ["", None, " \n", "one", "one", "ONE two"]
    rnd.shuffle(texts)
    return list(enumerate(texts, start=5))


def got(df, **limits):
    rows = J.similar_documents(df, **limits)
    assert rows.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"meeting": 2, "block_sets": 5, "fragments": 3}, {"meeting": 1, "block_shingles": 200, "fragments": 1}])
def test_against_brute_force(spark, limits):
    rows = corpus()
    want = brute(rows)
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), **limits) == want
    assert len({r[2] for r in want}) < len(rows) - 60


def test_bounds_are_met_exactly(spark):
    """Sets of 100 shingles with 85 of 100 in common link, those with one less do not."""
    words = [f"a{i}" for i in range(103)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:88])), (3, " ".join(words[16:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(df) == brute(rows) == [(1, 100, 1), (2, 85, 1), (3, 84, 3)]


def test_large_crowd_in_blocks(spark):
    rnd = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    rows = list(enumerate(family(rnd, base, 150, 9)))
    assert got(spark.createDataFrame(rows, "doc_id long, text string"), meeting=10, block_sets=40) == brute(rows)


def test_parts_name_equal_sets_alike():
    """At the level of the larger of two linked sets, the parts of one alone are no more than their differences."""
    rnd = random.Random(4)
    for n in (1, 5, 6, 20, 90, 400, 2000):
        a = [rnd.getrandbits(64) - (1 << 63) for _ in range(n)]
        for percent in (85, 50):
            off = rnd.randint(0, n * (100 - percent) // 100)
            b = a[off:] + [rnd.getrandbits(64) - (1 << 63) for _ in range((percent * n - 100 * (n - off)) // -percent if 100 * (n - off) > percent * n else 0)]
            if 100 * (n - off) < percent * len({*a, *b}):
                continue
            x, y = (J.parts_of(J.np.sort(J.np.array(s, dtype="int64")), percent) for s in (a, b))
            k = J.level(max(len(a), len(b)), percent)
            at = lambda v: {p for p in v.tolist() if p % 32 == k}
            assert at(x) and at(y)
            for own, size in ((at(x) - at(y), len(a)), (at(y) - at(x), len(b))):
                assert len(own) <= len({*a} ^ {*b}) <= J.spare_parts(size, percent)


def test_sets_of_common_shingles_are_dropped(spark):
    """Every shingle is in many texts, but only two texts are alike: the others are not compared."""
    rnd = random.Random(8)
    texts = [rnd.choices("abcdef", k=300) for _ in range(60)]
    texts.append(texts[0][:100] + ["x"] + texts[0][101:])
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = J.shingle_sets(df)
    classes = J.classes_of(found)
    assert sorted(r.least for r in J.promising(found, classes, J.PERCENT).collect()) == [0, 60]
    assert got(df) == brute(rows)


def test_awkward_and_empty(spark):
    rows = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    assert got(awkward(spark)) == brute(rows)
    assert got(empty(spark)) == []
