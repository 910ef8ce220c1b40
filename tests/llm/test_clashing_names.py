"""Columns whose names differ from a result's only by case are replaced, as Spark's names ignore case."""

import pytest

import corpus_pipeline as P
from impactspark.llm import bpe_codec, html_extract, quality, token_counts, toxicity
from impactspark.llm.common import prepare, tokenizer_path

from .helpers import docs

RANKS = tokenizer_path("byte_bpe_50k.tiktoken")


def model(spark):
    return toxicity.Model({}, frozenset(), toxicity.PRIOR.copy())


CASES = {
    "html": ("Text", lambda s, d: html_extract.extract(d.selectExpr("doc_id", "lang AS html", "Text"))),
    "encode": ("TOKEN_IDS", lambda s, d: bpe_codec.encode(d, RANKS)),
    "decode": ("Decoded", lambda s, d: bpe_codec.decode(d.selectExpr("*", "cast(null AS binary) AS token_ids"), RANKS)),
    "both": ("Decoded", lambda s, d: bpe_codec.encode_and_decode(d, RANKS)),
    "counts": ("N_Tokens", lambda s, d: token_counts.count_tokens(d, tokenizer_path("byte_bpe_50k.json"))),
    "quality": ("SCORE", lambda s, d: quality.score(d, quality.np.zeros((1 << quality.BITS) + 1))),
    "toxicity": ("SCORE", lambda s, d: toxicity.score(d, model(s))),
    "pipeline": ("N_TOKENS", lambda s, d: P.tokenise(s, d, "")),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_other_case_is_replaced(spark, name):
    prepare(spark)
    column, run = CASES[name]
    df = docs(spark, ["some text", None, ""])
    df = df.drop("text").selectExpr("*", "7 AS Text") if column == "Text" else df.selectExpr("*", f"7 AS {column}")
    out = run(spark, df)
    assert len([c for c in out.columns if c.lower() == column.lower()]) == 1
    assert len(out.collect()) == 3
