import random
from collections import Counter

import xxhash

from cohortkit.llm import simhash
from cohortkit.llm.common import table
from tests.llm.cases import awkward, empty


def plain_fingerprint(text):
    words = [w for w in (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(codes, radius):
    """Least id of each code's component by comparing all pairs."""
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(codes))]


def test_matches_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    codes = [plain_fingerprint(r.text) for r in rows]
    want = plain_components(codes, 4)
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert len(got) == len(rows)
    for r, code, root in zip(rows, codes, want):
        assert got[r.doc_id].fp % (1 << 64) == code
        assert got[r.doc_id].component_id == rows[root].doc_id


def planted(seed):
    """Random codes, with chains, a ball of near copies and codes that share most blocks."""
    rnd = random.Random(seed)
    codes = [rnd.getrandbits(64) for _ in range(300)]
    base = rnd.getrandbits(64)
    for _ in range(300):
        x = base
        for b in rnd.sample(range(64), rnd.randint(0, 6)):
            x ^= 1 << b
        codes.append(x)
    for i in range(100):
        codes.append(codes[-1] ^ sum(1 << b for b in rnd.sample(range(64), 5 if i % 7 == 0 else 4)))
    return sorted(set(codes) | {0, 3, 1 << 63})


def test_links_keep_components(spark):
    codes = planted(3)
    want = plain_components(codes, 4)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in codes]
    for chunk in (4096, 40):
        found = simhash.links(spark.createDataFrame(signed, "fp long"), 4, chunk).collect()
        parent = {x: x for x in codes}

        def find(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for r in found:
            u, v = r.u % (1 << 64), r.v % (1 << 64)
            assert (u ^ v).bit_count() <= 4
            parent[find(u)] = find(v)
        groups = lambda label: sorted(Counter(label).values())
        assert groups(map(find, codes)) == groups(want)


def test_tree_search_is_complete():
    codes = planted(9)[:200]
    tree = simhash.BKTree(codes[0])
    for x in codes[1:]:
        tree.add(x)
    for q in codes[::7]:
        assert sorted(tree.near(q, 6)) == sorted(x for x in codes if (x ^ q).bit_count() <= 6)


def test_awkward_rows(spark):
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(awkward(spark)).collect()]
    assert len(got) == 11
    by = {i: (f, k) for i, f, k in got}
    assert by[1] == by[2] and by[1][1] == 1
    assert by[3] == by[4] == by[5] == (0, 3)
    assert by[None][1] is None
    kept = simhash.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 6, 7, 8, 9]
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0


def test_keep_one_decides_by_row(spark):
    """Rows that share an id but not the text are different documents."""
    a, b = "one two three four five six", "quite another text of several words here"
    kept = lambda rows: sorted(tuple(r) for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept([(3, a), (8, a), (8, b)]) == [(3, a), (8, b)]
    assert kept([(8, a), (8, b)]) == kept([(8, b), (8, a)]) == sorted([(8, a), (8, b)])
    assert kept([(8, a), (8, a), (9, a)]) == [(8, a)]
    assert [r[1] for r in simhash.keep_one(spark.createDataFrame([(None, a), (None, a), (None, b)], "doc_id long, text string")).orderBy("text").collect()] == sorted([a, b])
