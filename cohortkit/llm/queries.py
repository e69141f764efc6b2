"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortkit.llm import hamming, jaccard, langid, mixing, packing, perplexity, phrases, secrets, shards, simhash, spelling, toxicity, warc
from cohortkit.llm.common import table
from cohortkit.session import scratch_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``, with SQL that gives the same rows if there is any."""

    def add(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, strlen(t) AS payload_bytes, sha1(t) AS h, t FROM p),
b AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
        min(page_id) OVER (PARTITION BY t) AS f FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id != f THEN f END AS refers_to FROM b
"""


@query("op1_warc", WARC_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back through verified record chains."""
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.archived_pages(warc.read_archives(spark, path))


@query("op4_sharding")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in 40 contiguous shards of near equal bytes, equal texts together."""
    return shards.shard_by_bytes(table(spark, sf_dir, "documents"), 40)


SECRETS_SQL = r"""
WITH docs AS (SELECT doc_id, source, row_number() OVER () AS r, coalesce(text, '') AS t, md5(coalesce(text, '')) AS repo FROM documents),
pats(kind, name, pat, grp, least) AS (VALUES
  (0, 'assign', '((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 16), (2, 'hex', '[0-9a-f]{32,}', 0, 32), (3, 'bare', '[A-Za-z0-9+/_=-]{20,}', 0, 20)),
m AS (SELECT doc_id, source, repo, r, kind, name, least, regexp_extract_all(t, pat) AS ms, string_split_regex(t, pat) AS gs,
        CASE WHEN grp = 2 THEN regexp_extract_all(t, pat, 2) ELSE regexp_extract_all(t, pat) END AS vs FROM docs, pats),
e AS (SELECT doc_id, source, repo, r, kind, name, least, unnest(range(1, len(ms) + 1)) AS i, ms, gs, vs FROM m WHERE len(ms) > 0),
s AS (SELECT doc_id, source, repo, r, kind, name, vs[i] AS v, least,
        list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS a, length(ms[i]) AS n FROM e),
k AS (SELECT *, a + n AS b FROM s WHERE length(v) >= least AND (kind < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]')
        AND regexp_matches(v, '[A-Z]') AND len(list_distinct(string_split(v, ''))) >= 10))),
o AS (SELECT v, count(DISTINCT source) AS owners, count(DISTINCT repo) AS repositories FROM k GROUP BY v),
f AS (SELECT k.*, NOT (owners > 2 AND repositories > 2) AS live FROM k JOIN o USING (v)),
g AS (SELECT * FROM f WHERE kind < 3 OR (live AND NOT EXISTS (SELECT 1 FROM f x WHERE x.r = f.r AND x.kind < 3 AND x.a < f.b AND f.a < x.b)))
SELECT d.doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  sha256(coalesce(string_agg(name || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, kind) FILTER (kind < 3), '')) AS base_sha256,
  coalesce(string_agg(name || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, kind) FILTER (kind IS NOT NULL), '') AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
FROM docs d LEFT JOIN g ON d.r = g.r GROUP BY d.r, d.doc_id
"""


@query("op5_secrets", SECRETS_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; sources are the owners, distinct texts the repositories."""
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


MIX_SQL = r"""
WITH s AS (SELECT doc_id, coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS own, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS z FROM s GROUP BY source),
w AS (SELECT source, z, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM p),
l AS (SELECT *, (1.5::DOUBLE * sum(z) OVER () - coalesce(sum(2 * z) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS lev
      FROM w WINDOW b AS (ORDER BY z / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, z, least((2 * z)::DOUBLE, max(lev) OVER () * w) AS target FROM l),
r AS (SELECT doc_id, size, z, target, coalesce(target / nullif(z, 0), 0) AS rate,
        ('0x' || substr(md5('mix|' || own), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, z AS source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""


@query("op6_mixing", MIX_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def public_tokenizer() -> str:
    """The tokenizer file of the packing query."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document in windows of 2048 ids."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizer())


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


HAMMING_SQL = """
WITH c AS (SELECT DISTINCT vec_id, list_reduce(list_transform(range(64), lambda i: CASE WHEN embedding[i + 1] > 0 THEN 1::UBIGINT << i ELSE 0::UBIGINT END),
        lambda a, x: a | x) AS code FROM embeddings),
p AS (SELECT q.vec_id AS query_id, x.vec_id AS neighbor_id, bit_count(xor(q.code, x.code))::BIGINT AS distance
      FROM c q JOIN c x ON q.vec_id % 20 = 0 AND q.vec_id != x.vec_id)
SELECT query_id, rank, neighbor_id, distance FROM
  (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM p) WHERE rank <= 10
"""


@query("op9_hamming_top_k", HAMMING_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vector whose id is divisible by 20, among all."""
    vectors = table(spark, sf_dir, "embeddings")
    return hamming.top_k(vectors, vectors.filter("vec_id % 20 = 0"))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by code lengths under byte context trees."""
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(langid.sample_texts(docs)))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures and perplexity verdict of every document."""
    return perplexity.judge_quality(table(spark, sf_dir, "documents"))


@query("op10_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(*toxicity.sample_labelled(docs, table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, machine)


PHRASES_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS s FROM d),
w AS (SELECT lang, regexp_extract_all(s, '[^\x20\x09]+') AS ws FROM p),
tot AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM i, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
x AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS c FROM f WHERE k > 1),
s AS (SELECT x.lang, x.phrase, x.a, c, u.a AS l, v.a AS r, n, (1000::HUGEINT * x.a * n) // (u.a::HUGEINT * v.a) AS score
      FROM x JOIN f u ON u.lang = x.lang AND u.phrase = array_to_string(ws[1:c], ' ')
      JOIN f v ON v.lang = x.lang AND v.phrase = array_to_string(ws[c + 1:], ' ') JOIN tot ON tot.lang = x.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
y AS (SELECT DISTINCT lang, a, k, string_split(phrase, ' ') AS ws FROM f WHERE k > 2),
z AS (SELECT lang, a, array_to_string(ws[i:i + m - 1], ' ') AS phrase
      FROM y, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS i) WHERE m < k AND i + m - 1 <= k),
q AS (SELECT lang, phrase, max(a) AS inside FROM z GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank
      FROM b LEFT JOIN q ON q.lang = b.lang AND q.phrase = b.phrase WHERE inside IS NULL OR inside < b.a)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM o WHERE rank <= 2000
"""


@query("op11_phrase_collocations", PHRASES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scoring phrases of two to five words of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words with the form that each is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))


JACCARD_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM i),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 85 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""


@query("op12_jaccard_join", JACCARD_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of near equal shingle sets."""
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))
