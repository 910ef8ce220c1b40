"""Registered queries over the smallest tables: against DuckDB or brute force; the pipeline stage by stage."""

import hashlib
import os
import zlib

import numpy as np
import pytest

import corpus_pipeline as P
from impactspark.llm import queries, toxicity
from impactspark.llm.common import read, staged, tokenizer_path
from tools.oracle_check import TABLES, digest

from .helpers import DOCS, components, docs, jaccard_links, lower

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_operator_has_one_query():
    for n in range(1, 14):
        assert len([q for q in queries.QUERIES if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in queries.QUERIES and 4 <= len(P.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rel = duck.execute(queries.ORACLE[name])
    cols = [d[0] for d in rel.description]
    want = rel.fetchall()
    assert sorted(cols) == sorted(df.columns)
    got = [tuple(r) for r in df.collect()]
    assert digest(df.columns, got)[1] == digest(cols, want)[1]


def test_extracted_pages_are_the_articles(spark):
    import html as h
    import re

    pages = {r["page_id"]: r["html"] for r in read(spark, SF, "pages").collect()}
    for r in queries.QUERIES["op1_html_extract"](spark, SF).collect():
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        want = " ".join(h.unescape(re.sub("</?(?:h1|p|br)>", " ", re.sub("</?b>", "", article))).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_codec_and_counts_equal_the_libraries(spark):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("tokenizers")
    from impactspark.llm.bpe_codec import PATTERN, read_ranks

    ranks = {t: i for i, t in enumerate(read_ranks(tokenizer_path("byte_bpe_50k.tiktoken")))}
    coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    counter = tokenizers.Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in read(spark, SF, "documents").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = queries.QUERIES["op2_bpe_codec"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = coder.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert r["decoded_sha256"] == sha(texts[r["doc_id"]].encode())
    rows = queries.QUERIES["op6_token_counts"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(counter.encode(texts[r["doc_id"]], add_special_tokens=False))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 1024)


@pytest.mark.parametrize("name,folds,fold", [("op3_quality", 5, 0), ("op10_toxicity", 4, 2)])
def test_scores_cover_all_documents(spark, name, folds, fold):
    rows = queries.QUERIES[name](spark, SF).collect()
    assert len(rows) == read(spark, SF, "documents").count()
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == fold)


def test_rates_cover_all_documents(spark):
    rows = queries.QUERIES["op9_mixing"](spark, SF).collect()
    assert len(rows) == read(spark, SF, "documents").count() and all(r["rate"] >= 0 for r in rows)


def test_pipeline_equals_brute_force_stage_by_stage(spark):
    got = read(P.prepare(spark), SF, "documents")
    columns = got.columns
    for name, stage in P.STAGES:
        docs_, rows = got, [(r["doc_id"], r["text"]) for r in got.collect()]
        before = dict(rows)
        got = staged(stage(spark, got, SF), "test-stage")
        after = [r["doc_id"] for r in got.select("doc_id").collect()]
        if name != P.STAGES[-1][0]:
            assert got.columns == columns
        if name == "toxicity":
            labels = read(spark, SF, "labels")
            scored = toxicity.score(docs_, toxicity.fit(docs_, labels)).collect()
            assert sorted(after) == sorted(r["doc_id"] for r in scored if r["score"] < toxicity.THRESHOLD)
            clean = {r["doc_id"] for r in labels.where("toxic = 0").collect()}
            assert len(clean - set(after)) <= 0.02 * len(clean)
        elif name == "exact_dedup":
            groups = {}
            for i, t in before.items():
                groups.setdefault(lower(t), []).append(i)
            assert sorted(after) == sorted(max(g) for g in groups.values())
        elif name == "ngram_jaccard_join":
            assert sorted(after) == sorted(set(components(before, jaccard_links(before)).values()))
        elif name == "mixing":
            assert set(after) == set(before) and len(after) >= len(before)
        else:
            assert sorted(after) == sorted(i for i, _ in rows) and {r["round_trip"] for r in got.collect()} == {True}


def test_pipeline_survives_odd_rows(spark):
    text = "some words that make up a text of more than five words"
    rows = [(None, None), (None, text), (1, ""), (1, ""), (2, text), (3, text.upper()), (4, "x " * 5000)]
    got = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).selectExpr("*", "1 AS score", "2 AS _rate")
    for _, stage in P.STAGES:
        got = staged(stage(spark, got, SF), "test-odd")
    assert {r["doc_id"] for r in got.collect()} >= {1, 3, 4} and {"score", "_rate", "token_ids"} <= set(got.columns)
    got = docs(spark, [])
    for _, stage in P.STAGES:
        got = staged(stage(spark, got, SF), "test-empty")
    assert got.count() == 0
