import base64
import hashlib
import os
import random

from cohortkit.llm import warc
from cohortkit.llm.common import table
from cohortkit.session import scratch_path

SCHEMA = "page_id long, url string, html string, extra string"


def record(payload: bytes, kind="response", number=1, version=b"1.1"):
    return (b"WARC/" + version + b"\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:page:%d>\r\nContent-Length: %d\r\n\r\n" % (kind.encode(), number, len(payload))) + payload + b"\r\n\r\n"


def expected(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        ids = [i for i, _, h in rows if (h or "") == (html or "") and i is not None]
        first = min(ids) if ids else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        again = first is not None and page_id != first
        out.append((page_id, len(payload), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def round_trip(spark, rows):
    path = scratch_path(spark, "warc-test")
    pages = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    warc.write_archives(pages, path)
    got = warc.archived_pages(warc.read_archives(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    return sorted(map(tuple, got), key=repr)


def test_awkward_pages(spark):
    inner = record(b"fake <b>record</b>", number=99).decode()
    rows = [
        (1, "http://a", "<p>one</p>"), (2, "http://b", "<p>one</p>"), (3, None, None), (4, "x\r\nContent-Length: 3", ""), (5, "u", inner + inner),
        (6, "u", "WARC/1.1\r\n"), (7, "u", "WARC/1.1\r\nContent-Length: 10\r\n\r\n"), (8, "u", "ü€漢\r\n\r\n\n"), (9, "u", "y" * 300_000 + "WARC/1.1\r\n" * 50),
        (None, "u", "no id"), (10, "u", "no id"), (None, None, "alone"), (11, "u", inner + inner), (12, "u", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: x\r\n\r\n"),
    ]
    assert round_trip(spark, rows) == expected(rows)
    assert round_trip(spark, []) == []
    twice = [(1, "u", "same"), (1, "u", "same"), (2, "u", "same")]
    assert round_trip(spark, twice) == expected(twice)


def test_given_pages_over_small_blocks(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        rows = [(r.page_id, r.url, (r.html + record(b"zz").decode()) if r.page_id % 3 == 0 else r.html) for r in table(spark, "/root/testdata/sf0.001", "pages").collect()]
        assert round_trip(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_broken_chain_and_binary_payloads(spark):
    """A foreign file: any bytes as payload; what follows a wrong length is not a record."""
    rnd = random.Random(1)
    blobs = [bytes(rnd.randrange(256) for _ in range(500)), record(b"inner", number=7), b""]
    path = scratch_path(spark, "warc-foreign")
    os.makedirs(path)
    with open(path + "/a.warc", "wb") as f:
        f.write(b"".join(record(b, number=i) for i, b in enumerate(blobs)))
    with open(path + "/b.warc", "wb") as f:
        f.write(record(b"good", number=10) + record(b"cut", number=11)[:-6] + record(b"lost", number=12))
    with open(path + "/c.warc", "wb") as f:
        f.write(b"no record here")
    got = sorted(bytes(r.payload) for r in warc.read_archives(spark, path).filter("header NOT LIKE '%urn:page:11>%'").collect())
    assert got == sorted([*blobs, b"good"])


def test_older_version_and_many_magics(spark):
    """Archives of version 1.0, mixed ones, and payloads full of magics and of what only looks like one."""
    blobs = [b"one", record(b"x", version=b"1.0") * 3, b"WARC/1.0\r\nWARC/1.7\r\nWARC/1." * 2000, b"WARC/1.", b""]
    path = scratch_path(spark, "warc-old")
    os.makedirs(path)
    for name, versions in (("a", [b"1.0"]), ("b", [b"1.0", b"1.1"])):
        with open(f"{path}/{name}.warc", "wb") as f:
            f.write(b"".join(record(b, number=i, version=versions[i % len(versions)]) for i, b in enumerate(blobs)))
    with open(f"{path}/c.warc", "wb") as f:
        f.write(record(b"unknown version", version=b"1.5"))
    rows = warc.read_archives(spark, path).collect()
    assert sorted(bytes(r.payload) for r in rows) == sorted(blobs * 2)
    assert all(r.header.startswith("WARC-Type: response") for r in rows)


def test_pointer_jumping(spark):
    rnd = random.Random(3)
    rows, want = [], set()
    for name in ("f", "g"):
        at, chain = 0, []
        while at < 400:
            chain.append(at)
            at += rnd.randint(1, 9)
        want |= {(name, x) for x in chain}
        rows += [(name, x, y) for x, y in zip(chain, [*chain[1:], None])]
        rows += [(name, x, rnd.choice([None, x + 1, x + 5, 10_000])) for x in range(1, 400) if x not in chain]
    got = {(r.file, r.offset) for r in warc.reachable(spark.createDataFrame(rows, "file string, offset long, next long")).collect()}
    assert got == want
