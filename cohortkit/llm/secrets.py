"""Secret scan with corpus-wide ownership frequency.

Candidates are found per text with three fixed patterns and one for bare credentials. Their
hashes are aggregated by distinct repositories and distinct owners over the whole corpus. A
value that many owners have in many repositories is a copied example; one that stays with
few owners, or in few repositories however often they are mirrored, looks live. Bare
credentials are reported only where they look live; matches of the fixed patterns always.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortkit.llm.common import heavy_lookup, staged

# The patterns of the three base kinds.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Bare credentials: long runs with a digit, a small and a capital letter (checked on the match).
BARE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "bare")
#: A value with more owners than this, in more repositories than this, is a copied example.
OWNERS, REPOSITORIES = 2, 2
#: Prefix sums inside a document are taken in blocks of so many matches.
BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; inside a lambda an expression is computed per element."""
    return F.get(F.transform(F.array(value), body), 0)


def _ahead(lens: Column) -> Column:
    """Sums of the elements before each element, in steps linear in the block size."""
    add = lambda a, x: a + x
    total = lambda arr: F.aggregate(arr, F.lit(0), add)
    blocks = F.when(F.size(lens) > 0, F.sequence(F.lit(0), F.floor((F.size(lens) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    block = lambda b: F.slice(lens, b * BLOCK + 1, BLOCK)
    inside = lambda part, start: F.transform(part, lambda _, i: start + total(F.slice(part, F.lit(1), i)))
    parts = lambda sums: F.transform(blocks, lambda b: _let(
        block(b), lambda part: _let(total(F.slice(sums, F.lit(1), b)), lambda start: inside(part, start))))
    return F.flatten(_let(F.transform(blocks, lambda b: total(block(b))), parts))


def _spans(text: Column, kind: int, pattern: str, group: int, keep) -> Column:
    """Array of (start, kind_no, end, value) of a pattern's matches, leftmost and not overlapping; code points.

    The texts between the matches come from split, the matches from regexp_extract_all;
    their lengths add up to positions.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
    row = lambda r: F.struct(
        (r["a"] + r["l"] - F.char_length(r["m"])).alias("start"), F.lit(kind).alias("kind_no"), (r["a"] + r["l"]).alias("end"), r["v"].alias("value"))
    rows = lambda ms, lens: F.transform(F.arrays_zip(_ahead(lens).alias("a"), lens.alias("l"), ms.alias("m"), (value if group else ms).alias("v")), row)
    lengths = lambda ms: F.zip_with(F.slice(gaps, F.lit(1), F.size(ms)), ms, lambda g, m: g + F.char_length(m))
    spans = _let(whole, lambda ms: _let(lengths(ms), lambda lens: rows(ms, lens)))
    found = F.when(F.rlike(text, F.lit(pattern)), F.filter(spans, lambda r: keep(r["value"])))
    return F.coalesce(found, F.array().cast("array<struct<start:int,kind_no:int,end:int,value:string>>"))


def _looks_random(v: Column) -> Column:
    """A digit, a small and a capital letter, and at least ten different characters."""
    distinct = F.size(F.array_distinct(F.split(v, "")))
    return v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]") & (distinct >= 10)


def candidate_spans(text: Column) -> Column:
    """Candidates of one text in order of start and kind."""
    parts = [
        _spans(text, 0, ASSIGN, 2, lambda v: F.char_length(v) >= 8),
        _spans(text, 1, ACCESS, 0, lambda v: F.lit(True)),
        _spans(text, 2, HEX, 0, lambda v: F.lit(True)),
        _spans(text, 3, BARE, 0, _looks_random),
    ]
    return F.array_sort(F.concat(*parts))


def ownership(rows: DataFrame) -> DataFrame:
    """(key, owners, repositories): distinct owners and repositories of each key, without nulls.

    Repeated (key, repository, owner) are combined before any shuffle, and so are the counts.
    """
    c = F.col
    sides = F.array(*[F.struct(F.lit(x).alias("side"), c(x).cast("string").alias("value")) for x in ("owner", "repository")])
    pairs = rows.groupBy("key", "repository", "owner").agg(F.lit(1).alias("_")).select("key", F.inline(sides)).distinct()
    return pairs.groupBy("key").agg(*[F.count(F.when(c("side") == x, c("value"))).alias(name) for x, name in (("owner", "owners"), ("repository", "repositories"))])


def flagged_spans(found: DataFrame, max_owners: int = OWNERS, max_repositories: int = REPOSITORIES) -> DataFrame:
    """(digest, spans): for each text with candidates, its spans (start, kind_no, end, live, reach).

    ``found`` has digest, repository, owner and candidates. Owners and repositories are counted
    without nulls. A value is copied only when both counts pass their limits. Bare candidates
    stay only when live and clear of every other kind's span. ``reach`` is where the spans
    before this one end (0 without any).
    """
    c = F.col
    rows = found.filter(F.size("candidates") > 0).select("digest", "repository", "owner", F.explode("candidates").alias("s"))
    rows = rows.withColumn("key", F.sha2(c("s.value"), 256))
    texts = rows.groupBy("digest", "key", "s.start", "s.kind_no", "s.end").agg(F.lit(1).alias("_"))
    spread = staged(ownership(rows).join(texts.groupBy("key").agg(F.count(F.lit(1)).alias("copies")), "key"), "secret-owners")
    spans = heavy_lookup(texts, spread, ["key"], "copies").select(
        "digest", "start", "kind_no", "end", ((c("owners") <= max_owners) | (c("repositories") <= max_repositories)).alias("live"))
    order = W.partitionBy("digest").orderBy("start", "kind_no")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(1, W.unboundedFollowing)
    base = lambda x: F.when(c("kind_no") < 3, c(x))
    clear = (F.coalesce(F.max(base("end")).over(before), F.lit(0)) <= c("start")) & (F.coalesce(F.min(base("start")).over(after), c("end")) >= c("end"))
    kept = spans.withColumn("clear", clear).filter("kind_no < 3 OR (live AND clear)")
    kept = kept.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0)))
    return kept.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("start", "kind_no", "end", "live", "reach"))).alias("spans"))


def with_candidates(docs: DataFrame, owner: str, repository: str | None = None) -> DataFrame:
    """(doc_id, owner, repository, digest, candidates) of every document; a null text is empty.

    Without a repository column a repository is a distinct text, so that copies of one text count once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = F.md5(text.cast("binary"))
    return docs.select("doc_id", F.col(owner).alias("owner"), (F.col(repository) if repository else digest).alias("repository"),
                       digest.alias("digest"), candidate_spans(text).alias("candidates"))


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str | None = None, max_owners: int = OWNERS,
                 max_repositories: int = REPOSITORIES) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied), one row per document.

    Spans are kind:start:end in code points, end exclusive, comma-joined in order of start
    and kind. Null and empty texts have none. Repeated rows give repeated results; an empty
    table gives an empty result.
    """
    c = F.col
    found = staged(with_candidates(docs, owner, repository), "secret-candidates")
    flagged = flagged_spans(found, max_owners, max_repositories)
    none = F.array().cast("array<struct<start:int,kind_no:int,end:int,live:boolean,reach:int>>")
    hit = found.filter(F.size("candidates") > 0).select("doc_id", "digest").join(flagged, "digest", "left").select("doc_id", F.coalesce("spans", none).alias("s"))
    rows = found.filter(F.size("candidates") == 0).select("doc_id", none.alias("s")).unionByName(hit)
    name = lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind_no"] + 1), s["start"], s["end"])
    listed = lambda spans: F.concat_ws(",", F.transform(spans, name))
    count = lambda k: F.size(F.filter("s", lambda s: s["kind_no"] == k)).cast("long")
    return rows.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(F.filter("s", lambda s: s["kind_no"] < 3)), 256).alias("base_sha256"), listed(c("s")).alias("spans"),
        F.size(F.filter("s", lambda s: s["live"])).cast("long").alias("n_live"), F.size(F.filter("s", lambda s: ~s["live"])).cast("long").alias("n_copied"))


def redact_secrets(docs: DataFrame, owner: str = "source", repository: str | None = None, max_owners: int = OWNERS,
                   max_repositories: int = REPOSITORIES, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; other texts and columns are unchanged.

    Overlapping spans are masked once. n_chars, if there, follows the new text.
    """
    c = F.col
    found = staged(with_candidates(docs, owner, repository), "secret-candidates")
    flagged = staged(flagged_spans(found, max_owners, max_repositories), "secret-spans").select(c("digest").alias("_redact_digest"), c("spans").alias("_redact_spans"))
    text = F.coalesce(c("text"), F.lit(""))
    keyed = docs.withColumn("_redact_key", F.md5(text.cast("binary")))
    joined = keyed.join(flagged, c("_redact_key") == c("_redact_digest"), "left")
    piece = lambda s: F.when(s["start"] >= s["reach"], F.concat(F.substr(c("text"), s["reach"] + 1, s["start"] - s["reach"]), F.lit(mask))).otherwise("")
    end = F.array_max(F.transform("_redact_spans", lambda s: s["end"]))
    clean = F.concat(F.array_join(F.transform("_redact_spans", piece), ""), F.substr(c("text"), end + 1))
    out = joined.withColumn("text", F.when(c("_redact_spans").isNull(), c("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(c("_redact_spans").isNull(), c("n_chars")).otherwise(F.char_length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[c(f"`{x}`") for x in docs.columns])
