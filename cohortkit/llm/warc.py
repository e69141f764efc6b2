"""WARC archives: writing with digest-based revisits, reading by boundary-chain verification.

Readers split plain archives (not compressed ones) at every occurrence of what the record
magics of versions 1.0 and 1.1 begin with. Each magic is a candidate that names its successor's offset (header length plus declared length). Only what
pointer jumping from the start of each file reaches is a record; magic inside payloads is
never reached and is given back to the payload it lies in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from cohortkit.llm.common import staged

# Fixed values of the archive format.
MAGIC = "WARC/1.1\r\n"
MARK = "WARC/1."
VERSIONS = ["0\r\n", "1\r\n"]
HEADER_END = "\r\n\r\n"
RECORD_END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

#: Records are named by these; the number is the page's id.
RECORD_URN = "urn:page:"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a payload's SHA-1; five hex digits make four characters."""
    hexed = F.sha1(payload)
    letters = F.array(*[F.lit(x) for x in BASE32])
    groups = [F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 10).cast("int") for i in range(8)]
    pick = lambda v, bits: F.element_at(letters, (F.shiftright(v, bits).bitwiseAND(31) + 1))
    return F.concat(*[pick(v, bits) for v in groups for bits in (15, 10, 5, 0)])


def _with_digest(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", base32_sha1(F.col("payload")))


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, url, digest, refers_to) of the rows that repeat an earlier page's payload; no payload is moved.

    Among payloads of at least ``least`` bytes that are equal, the row with the smallest
    page_id is the response. Rows that share that smallest id are all responses; null ids
    come last, and without any id all equal rows are responses. The smallest ids are a
    combining aggregate; joining them back splits a digest with very many pages (AQE).
    """
    c = F.col
    rows = _with_digest(pages).filter(F.octet_length("payload") >= least).drop("payload")
    first = rows.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    return rows.join(first, "digest").filter(~c("page_id").eqNullSafe(c("refers_to"))).select("page_id", "url", "digest", "refers_to")


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """One WARC record per row of ``pages`` (page_id, url, html) below ``path``.

    A record is a line of text without its last line feed, so Spark's text writer lays down
    the exact bytes and commits whole files only. Revisits have no payload and are written
    from their short rows; responses are the other rows, told apart by id and digest, for
    which payloads move only if the list of revisits is too long for Spark to broadcast. A
    null html is an empty payload, a null url an empty target; line breaks in a url become
    spaces.
    """
    c = F.col
    again = staged(revisits(pages, least), "warc-revisits")
    listed = again.select(c("page_id").alias("_id"), F.xxhash64("digest").alias("_hash"))
    rows = _with_digest(pages)
    fresh = rows.join(listed, c("page_id").eqNullSafe(c("_id")) & (F.xxhash64("digest") == c("_hash")), "left_anti")
    rows = fresh.withColumn("refers_to", F.lit(None).cast("long")).unionByName(again.withColumn("payload", F.lit(b"")))
    name = lambda x: F.concat(F.lit("<" + RECORD_URN), F.coalesce(x.cast("string"), F.lit("none")), F.lit(">\r\n"))
    header = F.concat(
        F.lit(MAGIC), F.lit("WARC-Type: "), F.when(c("refers_to").isNull(), F.lit("response")).otherwise(F.lit("revisit")), F.lit("\r\n"),
        F.lit("WARC-Record-ID: "), name(c("page_id")), F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " "), F.lit("\r\n"),
        F.lit("WARC-Payload-Digest: sha1:"), c("digest"), F.lit("\r\n"),
        F.when(c("refers_to").isNull(), F.lit("")).otherwise(F.concat(F.lit("WARC-Refers-To: "), name(c("refers_to")))),
        F.lit("Content-Length: "), F.octet_length("payload").cast("string"), F.lit(HEADER_END))
    line = F.concat(header.cast("binary"), c("payload"), F.lit(RECORD_END[:-1]).cast("binary")).cast("string")
    rows.select(line.alias("value")).write.text(path, lineSep="\n")


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, seq, data): the texts between occurrences of the magic, in order of seq within a block.

    Written once as read, without a shuffle, so that seq is fixed.
    """
    c = F.col
    return staged(spark.read.text(path, lineSep=MARK).select(
        c("_metadata.file_path").alias("file"), c("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), c("value").cast("binary").alias("data")), "warc-segments")


def _offsets(lengths: DataFrame) -> DataFrame:
    """``lengths`` (file, block, seq, length, ...) with the offset of the magic before each segment.

    Segments tile a file, so offsets are sums of lengths: within a block over its own
    segments, across blocks over one number per block. No window holds a file's rows.
    """
    c = F.col
    step = c("length") + len(MARK)
    sums = lengths.groupBy("file", "block").agg(F.sum(step).alias("total"))
    ahead = sums.select("file", "block", F.coalesce(F.sum("total").over(
        W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum(step).over(W.partitionBy("file", "block").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return lengths.join(ahead, ["file", "block"]).withColumn("offset", c("ahead") + inside - len(MARK)).drop("ahead")


def _field(header: Column, name: str) -> Column:
    """A header field's value, empty if it is missing."""
    return F.regexp_extract(header, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the records that lead on from offset 0 of each file.

    ``candidates`` has file, offset, next (null if no successor is named). Each round the
    reached set takes in what its jumps point to and every jump is doubled, so a file of n
    records takes log2(n) rounds. A round's result is written, not kept on one executor.
    """
    c = F.col
    state = staged(candidates.select("file", "offset", "next", (c("offset") == 0).alias("reached")), "warc-jumps")
    before = -1
    while True:
        n = state.filter("reached").count()
        if n == before:
            return state.filter("reached").select("file", "offset")
        before = n
        ahead = state.select("file", c("offset").alias("next"), c("next").alias("_next"))
        hit = state.filter("reached AND next IS NOT NULL").select("file", c("next").alias("offset")).distinct().withColumn("_hit", F.lit(True))
        doubled = state.join(ahead, ["file", "next"], "left").select("file", "offset", c("_next").alias("next"), "reached")
        state = staged(doubled.join(hit, ["file", "offset"], "left").select(
            "file", "offset", "next", (c("reached") | c("_hit").isNotNull()).alias("reached")), "warc-jumps")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload) of the verified records below ``path``.

    A candidate's declared end must be the next candidate's start or the file's end for the
    chain to go on; bytes after a broken chain are not records, and the record at the break has
    the bytes that are there. Payloads that hold the magic
    are put together from their segments: these are looked up in the list of segments that
    are not a record by themselves, and only they are shuffled. Files without a record give
    no rows.
    """
    c = F.col
    seg = _segments(spark, path)
    text = c("data").cast("string")
    cut = (F.locate(HEADER_END, text) > 0) & F.substring(text, 1, 3).isin(VERSIONS)
    head = F.substring_index(text, HEADER_END, 1)
    slim = seg.select("file", "block", "seq", F.octet_length("data").cast("long").alias("length"), F.when(cut, F.octet_length(head)).alias("_at"),
                      F.when(cut, _field(head, "Content-Length")).alias("_len"))
    following = c("offset") + len(MARK) + c("_at") + len(HEADER_END) + F.expr("try_cast(_len AS BIGINT)") + len(RECORD_END)
    placed = staged(_offsets(slim).select("file", "block", "seq", "offset", following.alias("next"), c("_at").isNotNull().alias("magic")), "warc-offsets")
    slim = placed.filter("offset >= 0")
    good = reachable(slim.filter("magic")).withColumn("start", c("offset"))
    marked = staged(slim.select("file", "block", "seq", "offset").join(good, ["file", "offset"], "left"), "warc-marked")
    last = W.partitionBy("file").orderBy("block")
    carried = marked.groupBy("file", "block").agg(F.max("start").alias("_last")).select(
        "file", "block", F.max("_last").over(last.rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    inside = W.partitionBy("file", "block").orderBy("offset").rowsBetween(W.unboundedPreceding, 0)
    owned = marked.join(carried, ["file", "block"], "left").withColumn("record", F.coalesce(F.max("start").over(inside), c("_before")))
    extra = staged(owned.filter("start IS NULL").select("file", "block", "seq", "offset", "record"), "warc-extra")
    owners = marked.join(extra.select("file", c("record").alias("offset")).distinct(), ["file", "offset"], "left_semi")
    before = placed.filter("offset < 0").select("file", "block", "seq", "offset", F.lit(None).cast("long").alias("record"))
    several = owners.select("file", "block", "seq", "offset", c("offset").alias("record"))
    odd = staged(extra.unionByName(several).unionByName(before).withColumn("odd", F.lit(True)), "warc-odd")
    told = seg.join(odd, ["file", "block", "seq"], "left")
    parts = told.filter("odd AND record IS NOT NULL").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("offset", "data"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["data"].cast("string")), MARK).cast("binary")  # bytes stay as they are
    whole = told.filter("odd IS NULL").select("data").unionByName(parts.select(joined.alias("data")))
    rows = whole.withColumn("_head", head).withColumn("header", F.substr("_head", F.lit(4))).withColumn("_len", _field(c("_head"), "Content-Length"))
    size = F.coalesce(F.expr("try_cast(_len AS INT)"), F.lit(0))
    return rows.select("header", F.substring("data", F.octet_length("_head") + len(HEADER_END) + 1, size).alias("payload"))


def archived_pages(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of read records.

    Length and digest are taken from the payload read; a revisit has the length of the
    response that it names by id and digest, null if that is missing.
    """
    c = F.col
    number = lambda field: F.expr(f"try_cast(nullif(regexp_extract({field}, '{RECORD_URN}(-?[0-9]+)', 1), '') AS BIGINT)")
    rows = records.select(
        _field(c("header"), "WARC-Type").alias("record_type"), _field(c("header"), "WARC-Record-ID").alias("_id"), _field(c("header"), "WARC-Refers-To").alias("_to"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(_field(c("header"), "WARC-Type") == "revisit", F.regexp_replace(_field(c("header"), "WARC-Payload-Digest"), "^sha1:", "")).otherwise(base32_sha1(c("payload"))).alias("payload_digest"))
    rows = staged(rows.select(number("_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("_to").alias("refers_to")), "warc-pages")
    own = rows.filter("record_type != 'revisit'")
    known = own.groupBy(c("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    again = rows.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "payload_digest").join(known, ["refers_to", "payload_digest"], "left")
    return own.unionByName(again.select(*own.columns))
