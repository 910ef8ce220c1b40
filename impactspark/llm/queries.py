"""Registered queries of this subpackage and their DuckDB SQL.

``opN_<name>`` applies operator N to its whole table; where SQL cannot state
the result, ``tests/llm`` holds the query against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (bpe_codec, embedding_dedup, exact_dedup, html_extract, importance_sampling, mixing, ngram_join,
               pii_extraction, quality, secret_scan, token_alignment, token_counts, toxicity)
from .common import prepare, read, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str, **given) -> DataFrame:
            return fn(prepare(spark), sf_dir, **given)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return wrap


@query("op1_html_extract")
def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).withColumn("n_chars", F.length("text").cast("bigint"))


@query("op2_bpe_codec")
def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    coded = bpe_codec.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text")
    decoded = bpe_codec.decode(coded, path)
    return decoded.select("doc_id", F.expr("cast(octet_length(token_ids) / 4 as bigint)").alias("n_tokens"),
                          F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned from the labelled rows outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.held_out(F.col("doc_id"), 5, 0)
    weights = quality.train(docs, read(spark, sf_dir, "labels").where(~out), "quality")
    return quality.score(docs, weights).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op4_exact_dedup", """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    return exact_dedup.mark(read(spark, sf_dir, "documents"))


_REACH = """
r AS (
  SELECT id, id AS m FROM ids
  UNION
  SELECT r.id, e.v FROM r JOIN (SELECT u, v FROM links UNION ALL SELECT v, u FROM links) e ON r.m = e.u),
c AS (SELECT id, min(m) AS component_id FROM r GROUP BY id)"""


@query("op5_ngram_join", f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
g AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
s AS (SELECT doc_id, unnest(g) AS s, len(g) AS n FROM g),
links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
ids AS (SELECT doc_id AS id FROM d),
{_REACH}
SELECT doc_id, len(g)::BIGINT AS n_shingles, component_id FROM g JOIN c ON doc_id = id
""")
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return ngram_join.link_components(read(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document."""
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"))
    counted = token_counts.count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


def _span_sql(number: int) -> str:
    kind, pattern, group, least = secret_scan.RULES[number]
    rx = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {number} AS rule, '{kind}' AS kind, gaps, hits, counted, unnest(range(1, len(hits) + 1)) AS i, {least} AS least
  FROM (SELECT doc_id, string_split_regex(t, '{rx}') AS gaps, regexp_extract_all(t, '{rx}', 0) AS hits,
               regexp_extract_all(t, '{rx}', {group}) AS counted FROM d)"""


@query("op7_secret_scan", f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_span_sql(k) for k in range(len(secret_scan.RULES)))}),
p AS (
  SELECT doc_id, rule, kind, length(hits[i]) AS size,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
  FROM m WHERE length(counted[i]) >= least),
s AS (
  SELECT doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access,
         count(*) FILTER (rule = 2) AS n_hex,
         string_agg(kind || ':' || start::BIGINT || ':' || (start + size)::BIGINT, ',' ORDER BY start, rule) AS spans
  FROM p GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (doc_id)
""")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document through a ledger: the session's, or a new one that every distinct text enters once."""
    found = secret_scan.scan_ledger(read(spark, sf_dir, "documents"), secret_scan.ledger_path(spark))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query("op8_embedding_dedup", f"""
WITH RECURSIVE x AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: c::DOUBLE) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM x a JOIN x b ON a.label = b.label AND a.vec_id < b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
n AS (SELECT u AS id, count(*) AS n FROM (SELECT u FROM links UNION ALL SELECT v FROM links) GROUP BY u),
ids AS (SELECT vec_id AS id FROM x),
{_REACH}
SELECT c.id AS vec_id, coalesce(n, 0) AS n_links, component_id, c.id = component_id AS kept FROM c LEFT JOIN n ON c.id = n.id
""")
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    return embedding_dedup.link_components(read(spark, sf_dir, "embeddings"))


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str, domain: str = "lang") -> DataFrame:
    """Rates that bring the domains' token totals halfway (power 0.5) from their shares to equal weights.

    The labelled table is the ``domain`` (``lang``, or ``source``) of the rows that ``labels`` covers.
    """
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", domain)
    labelled = docs.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", F.col(domain).alias("domain"))
    mixed, _ = mixing.mix(docs.select("doc_id", "text"), labelled, tokens=tokenizer_path("byte_bpe_50k.json"), keep_text=False)
    return mixed.select("doc_id", "n_tokens", "domain", F.round("membership", 6).alias("membership"),
                        F.round("rate", 6).alias("rate"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; learned from the labelled rows outside the held-out fold."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = quality.held_out(F.col("doc_id"), 4, 2)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").where(~out))
    return toxicity.score(docs, model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).docs


_GRAMS = """
  SELECT {key} AS id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM {table}"""


@query("op12_importance_sampling", f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS c),
d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
own AS ({_GRAMS.format(key="doc_id", table="d")}),
target AS ({_GRAMS.format(key="item_id", table="b")}),
seen AS (SELECT DISTINCT f, hex(f) AS x FROM (SELECT f FROM own UNION SELECT f FROM target)),
coded AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
    lambda v, y: xor(v // 256, c[1 + xor(v, y) % 256])), 4294967295) % 10000 AS bucket FROM seen, crc),
s AS (SELECT bucket, count(*) AS s FROM own JOIN coded USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target JOIN coded USING (f) GROUP BY bucket),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM own) + 10000)
    / ((s + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (
  SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM own JOIN coded USING (f) JOIN g USING (bucket) GROUP BY id),
scored AS (
  SELECT doc_id, len(w) AS words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
  FROM d LEFT JOIN m ON doc_id = id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN k <= 25 * (SELECT count(*) FROM r) // 100 THEN k END AS rank
FROM scored LEFT JOIN r USING (doc_id)
""")
def op12_importance_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the benchmark's distribution of words and word pairs."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return importance_sampling.resample(docs, read(spark, sf_dir, "benchmark"))


@query("op13_pii_extraction")
def op13_pii_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base patterns, and what contexts of theirs discover."""
    return pii_extraction.extract(read(spark, sf_dir, "documents").select("doc_id", "text")).docs


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over ``documents``."""
    return corpus_pipeline.run(spark, sf_dir)


query("pipeline", corpus_pipeline.ORACLE_SQL)(_pipeline)
