"""The training-data operators bound to the tables, with the SQL they are checked against where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bands, blocks, extract, langid, lines, manifest, mixing, packing, records, revisit, simhash, toxicity, variants
from .sql import LINES_SQL, MANIFEST_SQL, VARIANTS_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


MIX_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), z AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), k AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM z
), w AS (SELECT *, 1 + (rank - 1) % 3 AS weight, source_size * 3 AS cap, (source_size * 3) / (1 + (rank - 1) % 3) AS ratio FROM k
), o AS (SELECT *, (SELECT sum(source_size) FROM z)::BIGINT - coalesce(sum(cap) OVER (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS remaining,
    (sum(weight) OVER (ORDER BY ratio, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest FROM w
), f AS (SELECT *, remaining * weight <= cap * rest AS fits FROM o
), l AS (SELECT ratio AS at_ratio, rank AS at_rank, remaining / rest AS level FROM f WHERE fits ORDER BY ratio, rank LIMIT 1
), t AS (SELECT source, source_size, rank, CASE WHEN (ratio, rank) >= (at_ratio, at_rank) THEN level * weight ELSE cap::DOUBLE END AS target FROM f, l
), q AS (
  SELECT r, doc_id, size, rank, t.source_size, t.target, round(t.target)::BIGINT AS quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), a AS (SELECT words, sources, greatest(1, least(1024, words // 131072), (2 * words + 2971215072) // 2971215073) AS block FROM (SELECT sum(source_size)::BIGINT AS words, count(*) AS sources FROM z)
), fib(prev, n) AS (SELECT 1::BIGINT, 2::BIGINT UNION ALL SELECT n, prev + n FROM fib, a WHERE n < words // block + sources + 1
), g AS (SELECT max(n) AS n, max(prev) AS prev, block FROM fib, a GROUP BY block
), s AS (SELECT rank, (round(target)::BIGINT + block - 1) // block AS slots FROM t, a
), e AS (SELECT rank, slots, coalesce(sum(slots) OVER (ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo FROM s WHERE slots > 0
), p AS (SELECT rank, unnest(range(lo, lo + slots)) AS position FROM e
), y AS (SELECT rank, position * CASE WHEN prev * prev % n = 1 THEN prev ELSE n - prev END % n AS slot FROM p, g
), nt AS (SELECT rank, slot, row_number() OVER (PARTITION BY rank ORDER BY slot) - 1 AS nth FROM y
), v AS (SELECT r, rank, epoch, start + epoch * source_size AS lo, least(start + epoch * source_size + size, quota) AS hi FROM q, range(3) x(epoch) WHERE size > 0
), c AS (SELECT r, rank, epoch, lo, hi, block, unnest(range(lo // block, (hi - 1) // block + 1)) AS nth FROM v, a WHERE lo < hi
), h AS (
  SELECT r, slot, epoch, greatest(lo, nth * block) - lo AS first_word, least(hi, (nth + 1) * block) - greatest(lo, nth * block) AS n_words FROM c JOIN nt USING (rank, nth)
), m AS (
  SELECT r, sum(n_words)::BIGINT AS taken, min(slot) AS first_slot, count(*) AS n_draws,
    sum((slot * 1000003 + epoch * 65537 + first_word * 8191 + n_words) % 2147483647)::BIGINT AS draws_checksum FROM h GROUP BY r)
SELECT doc_id, size::BIGINT AS size, source_size, target::DOUBLE AS target, coalesce(taken, 0) AS taken, first_slot, coalesce(n_draws, 0) AS n_draws, coalesce(draws_checksum, 0) AS draws_checksum
FROM q LEFT JOIN m USING (r)
"""

#: every page as the record of a crawl and, a month later, the record of a crawl that got a 304 for another spelling of
#: its URL; every seventh page changed meanwhile, some records lack a tag or a date
CAPTURES = """
SELECT 'r' || CAST(page_id AS STRING) AS record_id, 'response' AS kind, url, page_id * 60000 AS ts, 200 AS status, md5(html) AS digest,
  CASE WHEN page_id % 5 <> 0 THEN '"' || substr(md5(html), 1, 16) || '"' END AS etag,
  CASE WHEN page_id % 10 <> 0 THEN 'day ' || CAST(page_id % 97 AS STRING) END AS modified, page_id
FROM {pages}
UNION ALL
SELECT 'v' || CAST(page_id AS STRING), 'revisit',
  CASE page_id % 4 WHEN 0 THEN replace(url, 'https://', 'http://') WHEN 1 THEN url || '#again' WHEN 2 THEN replace(url, '://', '://www.') ELSE upper(substr(url, 1, 8)) || substr(url, 9) END,
  page_id * 60000 + 2592000000, 304, CASE WHEN page_id % 3 = 0 THEN md5(html) END,
  CASE WHEN page_id % 7 = 0 THEN '"gone"' WHEN page_id % 5 <> 1 THEN 'W/"' || substr(md5(html), 1, 16) || '"' END,
  CASE WHEN page_id % 20 <> 0 THEN 'day ' || CAST(page_id % 97 AS STRING) END, page_id
FROM {pages}
"""

REVISIT_SQL = r"""
WITH c AS (""" + CAPTURES.replace("STRING", "VARCHAR").format(pages="pages") + r"""), p AS (
  SELECT *, regexp_matches(url, '(?i)^[a-z][a-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]+)(?::(\d+))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$') AS is_url,
    regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]+)(?::(\d+))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$', ['host', 'port', 'path', 'query']) AS u
  FROM (SELECT * REPLACE (trim(url) AS url) FROM c)
), n AS (
  SELECT *, CASE WHEN is_url THEN regexp_replace(lower(u.host), '^www\d*\.', '') || CASE WHEN u.port IN ('', '80', '443') THEN '' ELSE ':' || u.port END
    || regexp_replace(regexp_replace(u.path, '/{2,}', '/', 'g'), '/$', '') || CASE WHEN q = '' THEN '' ELSE '?' || q END ELSE url END AS canonical_url
  FROM (SELECT *, array_to_string(list_sort(list_filter(string_split(u.query, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|fbclid|gclid|msclkid|ref|sessionid|jsessionid|phpsessid|sid)(=|$)'))), '&') AS q FROM p)
), j AS (
  SELECT v.record_id, v.canonical_url, v.ts, v.page_id AS v_page, v.etag AS v_etag, v.modified AS v_modified, v.digest AS v_digest,
    r.record_id AS refers_to, r.ts AS refers_ts, r.digest, r.etag, r.modified, r.page_id AS r_page,
    row_number() OVER (PARTITION BY v.record_id ORDER BY r.ts DESC NULLS LAST, r.record_id DESC NULLS LAST) AS nth
  FROM n v LEFT JOIN n r ON r.kind = 'response' AND r.canonical_url = v.canonical_url AND r.ts < v.ts WHERE v.kind = 'revisit'
), o AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'missing'
    WHEN v_etag IS NOT NULL AND etag IS NOT NULL THEN CASE WHEN regexp_replace(v_etag, '^W/', '') = etag THEN 'resolved' ELSE 'changed' END
    WHEN v_modified IS NOT NULL AND modified IS NOT NULL THEN CASE WHEN v_modified = modified THEN 'resolved' ELSE 'changed' END
    WHEN v_digest IS NOT NULL AND digest IS NOT NULL THEN CASE WHEN v_digest = digest THEN 'resolved' ELSE 'changed' END
    ELSE 'unverified' END AS outcome FROM j WHERE nth = 1)
SELECT record_id, canonical_url, ts, outcome, refers_to, refers_ts, CASE WHEN outcome = 'resolved' THEN digest END AS payload_digest,
  CASE WHEN outcome = 'resolved' THEN 'content-length: ' || r_page::VARCHAR || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || ts::VARCHAR
    || CASE WHEN coalesce(v_etag, etag) IS NOT NULL THEN chr(10) || 'etag: ' || coalesce(v_etag, etag) ELSE '' END
    || CASE WHEN coalesce(v_modified, modified) IS NOT NULL THEN chr(10) || 'last-modified: ' || coalesce(v_modified, modified) ELSE '' END END AS headers
FROM o
"""

EXACT_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id) = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
"""


def _held_out(doc_id: str = "doc_id") -> Column:
    """A quarter of the ids, never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@_query("op1_token_records")
def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(_read(spark, sf_dir, "documents"))


@_query("op2_mixing", MIX_SQL)
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_read(spark, sf_dir, "documents"))


@_query("op3_minimum_cut")
def op3_minimum_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_read(spark, sf_dir, "pages"))


@_query("op4_revisits", REVISIT_SQL)
def op4_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = spark.sql(CAPTURES, pages=_read(spark, sf_dir, "pages"))
    length = F.when(F.col("kind") == "response", F.col("page_id")).otherwise(0).cast("string")
    headers = F.map_from_entries(F.filter(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (
        ("Content-Type", F.lit("text/html")), ("Content-Length", length), ("Date", F.col("ts").cast("string")),
        ("ETag", F.col("etag")), ("Last-Modified", F.col("modified"))))), lambda e: e.value.isNotNull()))
    records_ = captures.withColumn("headers", headers).withColumnRenamed("digest", "payload_digest")
    found = revisit.resolve(records_)
    return found.withColumn("headers", revisit.header_text(F.col("headers")))


@_query("op5_cross_parsing")
def op5_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    found = langid.identify(documents, documents.where(~_held_out()))
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


@_query("op6_compression_bands")
def op6_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.quality(_read(spark, sf_dir, "documents"))


@_query("op7_mixture_packing")
def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


@_query("op8_anchor_simhash")
def op8_anchor_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


@_query("op9_ngram_toxicity")
def op9_ngram_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _read(spark, sf_dir, "labels").where(~_held_out())
    scored = toxicity.toxicity(_read(spark, sf_dir, "documents"), known)
    return scored.select("doc_id", _held_out().alias("held_out"), "score", "predicted")


@_query("op10_block_naming", EXACT_SQL)
def op10_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.exact_duplicates(_read(spark, sf_dir, "documents"))


@_query("op11_subtree_exchange", MANIFEST_SQL)
def op11_subtree_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    # a row without text has nothing to lose and is checked as it is
    without_breaks = F.when(tampered, F.replace("text", F.lit("\n"), F.lit("")))
    return manifest.manifest(_read(spark, sf_dir, "documents"), without_breaks)


@_query("op12_line_dedup", LINES_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.drop_repeated_lines(_read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@_query("op13_permuterm", VARIANTS_SQL)
def op13_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_read(spark, sf_dir, "documents"))


@_query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
