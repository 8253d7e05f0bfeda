"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, jaccard, merkle, mixing, packing, pii, quality, rules, tokencount, topk, trie, urls, vectors, warc


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.read_table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(common.read_table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(common.read_table(spark, sf_dir, "pages"), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.deduplicated(common.read_table(spark, sf_dir, "embeddings"), audited=True)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(common.read_table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.found(common.read_table(spark, sf_dir, "documents")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels")
    return quality.scored(docs, labels)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(common.read_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.scored(common.read_table(spark, sf_dir, "documents"))
    counts = [F.col("counts")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "base_failed", "kept", "p_good")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(common.read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle.manifest(common.read_table(spark, sf_dir, "documents"))
    return proved.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(common.read_table(spark, sf_dir, "embeddings"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(common.read_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (
        op1_best_fit_packing, op2_url_filter, op3_warc, op4_embedding_near_dedup, op5_mixing,
        op6_pii, op7_quality_classifier, op8_ngram_jaccard_join, op9_quality_rules, op10_token_counts,
        op11_merkle_manifest, op12_exact_topk, op13_conversation_trie,
    )
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    sql = {"op2_url_filter": _urls_sql(), "op3_warc": _WARC, "op5_mixing": _mixing_sql(), "op11_merkle_manifest": merkle.sql(), "op12_exact_topk": topk.SQL, "op13_conversation_trie": trie.sql()}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})


def _urls_sql() -> str:
    rules_table = ", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in urls.RULES)
    labels = "|".join(urls.LISTED_LABELS)
    return f"""
WITH rules(action, rhost, rpath) AS (VALUES {rules_table}),
u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
listed AS (SELECT DISTINCT host AS lhost FROM u WHERE host <> '' AND regexp_matches(host, '(^|[.-])({labels})([.-]|$)')),
hosts AS (
  SELECT host, bool_or(host = lhost OR ends_with(host, '.' || lhost)) AS on_list
  FROM (SELECT DISTINCT host FROM u) JOIN listed ON true GROUP BY host),
fits AS (
  SELECT page_id, u.host, path, rhost || rpath AS rule, action,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
  FROM u JOIN rules ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(path, rpath))
SELECT u.page_id, u.host, u.path, rule,
  coalesce(action, CASE WHEN coalesce(on_list, false) THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fits ON fits.page_id = u.page_id AND k = 1 LEFT JOIN hosts ON hosts.host = u.host
"""


_WARC = f"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> first THEN first END AS refers_to, true AS intact
FROM f
"""


def _mixing_sql() -> str:
    u = f"CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{mixing.SEED}:' || part), 1, 13) AS BIGINT) AS DOUBLE) / {1 << 52}.0"
    return f"""
WITH RECURSIVE sizes AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS size FROM documents GROUP BY source),
shares AS (SELECT source, size, CASE WHEN size > 0 THEN pow(CAST(size AS DOUBLE), {mixing.TEMPERATURE}) ELSE 0 END AS share FROM sizes),
rates AS (
  SELECT source, CASE WHEN size > 0 THEN {mixing.EPOCHS} * share / (SELECT sum(share) FROM shares) * CAST((SELECT sum(size) FROM shares) AS DOUBLE) / size ELSE {mixing.EPOCHS} END AS rate
  FROM shares),
means AS (SELECT source, greatest(1, CAST(ceil(rate / {mixing.CHUNK}) AS INTEGER)) AS parts, rate / greatest(1, CAST(ceil(rate / {mixing.CHUNK}) AS INTEGER)) AS mean FROM rates),
cdf AS (
  SELECT source, parts, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM means
  UNION ALL
  SELECT source, parts, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM cdf WHERE k + 1 < ceil(mean + 12 * sqrt(mean) + 20)),
draws AS (SELECT DISTINCT doc_id, source, unnest(range(1, parts + 1)) AS part FROM documents JOIN means USING (source)),
counts AS (
  SELECT doc_id, source, sum(n) AS n FROM (
    SELECT d.doc_id, d.source, part, (SELECT count(*) FROM cdf WHERE cdf.source = d.source AND cdf.c <= d.u) AS n
    FROM (SELECT *, {u} AS u FROM draws) d) GROUP BY ALL),
copies AS (SELECT documents.*, unnest(range(1, CAST(n AS BIGINT) + 1)) AS copy FROM documents JOIN counts USING (doc_id, source))
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
  md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':{mixing.SEED}:copy:' || copy) AS shuffle_key
FROM copies
"""
