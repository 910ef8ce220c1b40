"""The corpus pipeline: documents in, tokenised documents out, in five stages.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of
``docs``; the last adds ``n_tokens``, ``token_ids`` (little-endian unsigned
32-bit, binary) and ``round_trip``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from impactspark.llm import bpe_codec, exact_dedup, mixing, ngram_join, toxicity
from impactspark.llm.common import free_name, prepare, read, staged, tokenizer_path

#: Target weights are the shares of the languages to this power; no document gets a rate below 1.
MIX_POWER, MIX_LEAST = 0.7, 1.0


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; learned from the labelled rows among them."""
    prepare(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = toxicity.score(docs, model, out=score, keep_text=True)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the largest ``doc_id``."""
    prepare(spark)
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the smallest ``doc_id``."""
    prepare(spark)
    return ngram_join.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as their rate says (at least once), so that the languages' token totals reach
    their target weights; memberships are learned from the language of labelled rows."""
    prepare(spark)
    labelled = docs.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", F.col("lang").alias("domain"))
    return mixing.resample(docs, labelled, power=MIX_POWER, least=MIX_LEAST, tokens=tokenizer_path("byte_bpe_50k.json"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again to prove the round trip."""
    prepare(spark)
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    ids, back = "token_ids", free_name(docs, "decoded")
    coded = bpe_codec.encode_and_decode(docs, path, ids=ids, out=back)
    same = F.coalesce(F.col("text"), F.lit("")).cast("binary") == F.col(back)
    return coded.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_tokens", ids, "round_trip")],
                        F.expr(f"cast(octet_length({ids}) / 4 as bigint)").alias("n_tokens"), ids,
                        same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe_encoding", tokenise),
]

#: Classifiers, components and tokenizers are beyond SQL; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
