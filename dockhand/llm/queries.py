"""Registered queries of this subpackage: one ``opN_<name>`` per operator over
its whole table, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.llm import (alignment, decontaminate, digest_index, fixity, host_reputation, jaccard_join, lattice, mixing,
                          packing, pii, quality, repair, sharding)
from dockhand.session import read_table, scratch_path


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under five-word shingle Jaccard >= 0.75."""
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * k >= 75 * (a.n + b.n - k)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM words UNION SELECT r.x, e.y FROM reach r JOIN edges e ON e.x = r.y)
SELECT w.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id
JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) c ON c.x = w.doc_id
"""


def op1_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP1_SQL = r"""
WITH texts AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
words AS (
  SELECT kind, id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM texts),
widths AS (SELECT DISTINCT least(len(w), 5) AS width FROM words WHERE kind = 1 AND len(w) > 0),
shingles AS (
  SELECT DISTINCT kind, id, width, unnest(list_transform(range(1, (len(w) - width + 2)::BIGINT), lambda i: array_to_string(w[i:i+width-1], ' '))) AS s
  FROM words, widths WHERE len(w) >= width AND (kind = 0 OR width = least(len(w), 5))),
items AS (SELECT id, width, s, count(*) OVER (PARTITION BY id) AS n FROM shingles WHERE kind = 1)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared, max(i.n) AS item_size, count(*)::DOUBLE / max(i.n) AS containment
FROM shingles d JOIN items i ON d.s = i.s AND d.width = i.width WHERE d.kind = 0
GROUP BY 1, 2 HAVING count(*) >= 0.75 * max(i.n)
"""


def op2_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed token rows of all documents."""
    return packing.pack_tokens(read_table(spark, sf_dir, "documents"))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus mixed to square-root source shares."""
    return mixing.poisson_mix(read_table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH RECURSIVE sized AS (SELECT *, coalesce(strlen(text), 0) + 1 AS b FROM documents),
per AS (SELECT source, sum(b)::DOUBLE AS bytes, pow(sum(b)::DOUBLE, 0.5) AS share FROM sized GROUP BY source),
rates AS (
  SELECT source, share / (SELECT sum(share) FROM per) * 1.0 * (SELECT sum(bytes) FROM per) / bytes AS rate FROM per),
cdf(source, rate, k, log_p, total) AS (
  SELECT source, rate, 0, -rate, exp(-rate) FROM rates
  UNION ALL
  SELECT source, rate, k + 1, log_p + ln(rate / (k + 1)), total + exp(log_p + ln(rate / (k + 1)))
  FROM cdf WHERE k + 1 < (rate + 12 * sqrt(rate) + 20)::INT),
named AS (
  SELECT *, CASE WHEN doc_id IS NOT NULL AND count(*) OVER (PARTITION BY doc_id) = 1 THEN doc_id::VARCHAR ELSE
    md5(coalesce(doc_id::VARCHAR, '') || chr(31) || coalesce(text, '') || chr(31) || coalesce(lang, '') || chr(31) || coalesce(source, '') || chr(31)
        || coalesce(n_chars::VARCHAR, '')) || ':' || (row_number() OVER (PARTITION BY doc_id, text, lang, source, n_chars) - 1)::VARCHAR END AS name
  FROM documents),
drawn AS (
  SELECT *, ('0x' || substr(md5('mix-1:' || name), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM named),
counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.name, count(*) AS n
  FROM drawn d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source AND c.total <= d.u GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, unnest(range(0, n))::INT AS replica FROM counted
"""


def op6_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return host_reputation.judge(read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels"))


OP7_SQL = r"""
WITH cut AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)),
known AS (SELECT doc_id AS page_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
counted AS (
  SELECT host, string_split(host, '.') AS labels, coalesce(sum(good), 0)::DOUBLE AS good, count(good)::DOUBLE AS n
  FROM cut LEFT JOIN known USING (page_id) GROUP BY host),
hosts AS (
  SELECT host, good, n, array_to_string(labels[-k:], '.') AS suffix, array_to_string(labels[-k - 1:], '.') AS domain
  FROM (SELECT *, CASE WHEN array_to_string(labels[-2:], '.') IN (
          'ac.jp', 'ac.uk', 'co.in', 'co.jp', 'co.kr', 'co.nz', 'co.uk', 'co.za', 'com.ar', 'com.au', 'com.br', 'com.cn', 'com.hk', 'com.mx',
          'com.pl', 'com.sg', 'com.tr', 'com.tw', 'com.ua', 'gov.au', 'gov.uk', 'ne.jp', 'net.au', 'net.uk', 'or.jp', 'org.au', 'org.uk')
          THEN 2 ELSE 1 END AS k FROM counted)),
domains AS (SELECT domain, suffix, sum(good) AS good, sum(n) AS n FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(good) AS good, sum(n) AS n FROM domains GROUP BY 1),
corpus AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS root FROM suffixes),
s0 AS (SELECT suffixes.*, root AS mean FROM suffixes, corpus),
sw AS (SELECT CASE WHEN count(*) = 0 OR sum(n - 1) = 0 THEN 1.0 ELSE
         1 / least(0.5, greatest(0.0001, (sum(pow(good / n - mean, 2) * n / (mean * (1 - mean))) - count(*)) / sum(n - 1))) - 1 END AS w
       FROM s0 WHERE n > 0),
s1 AS (SELECT suffix, (good + w * mean) / (n + w) AS rate FROM s0, sw),
d0 AS (SELECT d.*, s1.rate AS mean FROM domains d JOIN s1 USING (suffix)),
dw AS (SELECT CASE WHEN count(*) = 0 OR sum(n - 1) = 0 THEN 1.0 ELSE
         1 / least(0.5, greatest(0.0001, (sum(pow(good / n - mean, 2) * n / (mean * (1 - mean))) - count(*)) / sum(n - 1))) - 1 END AS w
       FROM d0 WHERE n > 0),
d1 AS (SELECT domain, (good + w * mean) / (n + w) AS rate FROM d0, dw),
h0 AS (SELECT h.*, d1.rate AS mean FROM hosts h JOIN d1 USING (domain)),
hw AS (SELECT CASE WHEN count(*) = 0 OR sum(n - 1) = 0 THEN 1.0 ELSE
         1 / least(0.5, greatest(0.0001, (sum(pow(good / n - mean, 2) * n / (mean * (1 - mean))) - count(*)) / sum(n - 1))) - 1 END AS w
       FROM h0 WHERE n > 0),
h1 AS (SELECT host, rate + 1.645 * sqrt(rate * (1 - rate) / (n + w + 1)) AS upper
       FROM (SELECT host, n, w, (good + w * mean) / (n + w) AS rate FROM h0, hw)),
rules(verdict, rhost, rpath) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
judged AS (
  SELECT c.page_id, c.host, c.path, r.rhost || r.rpath AS rule, r.verdict, h1.upper,
         row_number() OVER (PARTITION BY c.page_id, c.host, c.path ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS k
  FROM cut c JOIN h1 USING (host)
  LEFT JOIN rules r ON (c.host = r.rhost OR ends_with(c.host, '.' || r.rhost)) AND starts_with(c.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN upper < 0.9 * root THEN 'block' ELSE 'allow' END) AS verdict
FROM judged, corpus WHERE k = 1
"""


def op8_skip_chain_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.find_pii(read_table(spark, sf_dir, "documents"))


def op9_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of the page archives against a replica with planted damage.

    The tables hold no second replica, so one is derived from them.  By the first 16 bits of a
    hash of the page id, its records have a flipped first character (0 to 255), are
    zeroed (to 319), lost (to 383), longer by two characters (to 447), or followed by a record of
    another page id that the first replica lacks (to 511).  Lost, longer and further records move those behind them.
    """
    pages = read_table(spark, sf_dir, "pages")
    record = fixity.warc_record()
    lead = F.conv(F.substring(F.md5(F.concat(F.lit("rot:"), F.col("page_id").cast("string")).cast("binary")), 1, 4), 16, 10).cast("int")
    damaged = (F.when(lead < 256, F.concat(F.lit("?"), F.substring(record, 2, 2147483647)))
               .when(lead < 320, F.repeat(F.lit("0"), F.octet_length(record)))
               .when(lead.between(384, 447), F.concat(record, F.lit("\r\n"))).otherwise(record))
    lost = F.coalesce(lead.between(320, 383), F.lit(False))
    further = pages.where(lead.between(448, 511)).withColumn("page_id", -1 - F.col("page_id"))
    second = fixity.record_hashes(pages.where(~lost), damaged).unionByName(fixity.record_hashes(further, record))
    return fixity.audit_replicas(fixity.record_hashes(pages, record), second)


OP9_SQL = r"""
WITH leads AS (SELECT page_id, url, html, ('0x' || substr(md5('rot:' || page_id::VARCHAR), 1, 4))::INT AS lead FROM pages),
both_sides AS (
  SELECT page_id, url, html, lead, false AS further FROM leads
  UNION ALL SELECT -1 - page_id, url, html, lead, true FROM leads WHERE lead BETWEEN 448 AND 511),
records AS (
  SELECT *, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
    || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))::VARCHAR || chr(13) || chr(10)
    || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM both_sides),
sides AS (
  SELECT *, CASE WHEN NOT further THEN record END AS one,
    CASE WHEN further THEN record WHEN lead < 256 THEN '?' || substr(record, 2) WHEN lead < 320 THEN repeat('0', strlen(record)::BIGINT)
         WHEN lead BETWEEN 320 AND 383 THEN NULL WHEN lead BETWEEN 384 AND 447 THEN record || chr(13) || chr(10) ELSE record END AS two
  FROM records),
archived AS (
  SELECT *, ('0x' || substr(md5(coalesce(page_id::VARCHAR, 'url:' || url, 'sha256:' || sha256(coalesce(one, two)))), 1, 8))::BIGINT
    % (SELECT greatest(1, ceil(sum(strlen(one)) / 16777216.0)::BIGINT) FROM sides) AS archive
  FROM sides),
laid AS (
  SELECT *, coalesce(sum(strlen(one)) OVER before, 0)::BIGINT AS start_one, coalesce(sum(strlen(two)) OVER before, 0)::BIGINT AS start_two
  FROM archived
  WINDOW before AS (PARTITION BY archive ORDER BY page_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT archive, CASE WHEN one IS NULL THEN start_two ELSE start_one END AS start, strlen(coalesce(one, two))::BIGINT AS length, page_id,
  CASE WHEN two IS NULL THEN 'missing' WHEN one IS NULL THEN 'extra' ELSE 'corrupt' END AS status,
  sha256(one) AS first_sha256, sha256(two) AS second_sha256
FROM laid WHERE one IS DISTINCT FROM two
"""


def op10_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents, through a new digest index."""
    index = digest_index.DigestIndex(spark, scratch_path(spark, "digest-index"))
    found = digest_index.dedupe(read_table(spark, sf_dir, "documents"), index)
    index.close()
    return found


OP10_SQL = r"""
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM digests WINDOW g AS (PARTITION BY text_sha256)
"""


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over every document."""
    return alignment.align_corpus(read_table(spark, sf_dir, "documents"))


def op12_edit_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation, after planted damage."""
    conversations = read_table(spark, sf_dir, "conversations")
    return repair.repair_all(repair.damaged(conversations), conversations)


def op13_subword_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of every document."""
    return lattice.lattice_scores(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training-corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_minhash_containment": (op1_minhash_containment, OP1_SQL),
    "op2_karmarkar_karp": (op2_karmarkar_karp, None),
    "op3_best_fit_packing": (op3_best_fit_packing, None),
    "op4_poisson_mix": (op4_poisson_mix, OP4_SQL),
    "op5_ngram_jaccard": (op5_ngram_jaccard, OP5_SQL),
    "op6_knn_quality": (op6_knn_quality, None),
    "op7_host_reputation": (op7_host_reputation, OP7_SQL),
    "op8_skip_chain_crf": (op8_skip_chain_crf, None),
    "op9_merkle_fixity": (op9_merkle_fixity, OP9_SQL),
    "op10_digest_index": (op10_digest_index, OP10_SQL),
    "op11_token_alignment": (op11_token_alignment, None),
    "op12_edit_lattice": (op12_edit_lattice, None),
    "op13_subword_lattice": (op13_subword_lattice, None),
    "pipeline": (pipeline, corpus_pipeline.ORACLE_SQL),
}
