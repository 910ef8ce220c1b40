import itertools
import json
import random

import pytest

from impactspark.llm import token_counts as C
from impactspark.llm.common import prepare, tokenizer_path
from impactspark.llm.rank_merges import merge_ranks

from .helpers import docs

pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: len(t.encode(text or "", add_special_tokens=False))


def counters():
    spec = C.read_tokenizer(PATH)
    ranked, plain = C.Counter(spec, merge_ranks(spec)), C.Counter(spec)
    assert ranked.ranked is not None and plain.ranked is None
    return ranked, plain


@pytest.mark.parametrize("counter", counters())
def test_whole_texts_equal_the_library(library, counter):
    texts = ["".join(x) for x in itertools.product("a ,.'\n", repeat=5)]
    texts += ["", "<|endoftext|> a <|endoftext|>", "don't. 's ll,..  x", "日本, 語.x y é ß", "1,2.3 4 ,5 \t6"]
    assert counter.whole(texts) == [library(t) for t in texts]
    assert counter.whole([]) == []


@pytest.mark.parametrize("counter", counters())
def test_splice_places_are_token_starts(library, counter):
    text = "naïve  don't stop, \n日本 語 a <|endoftext|> b 12 345  x. y" * 20
    for low in range(0, len(text) - 40, 7):
        a, b, n = counter.chunk(text, (low, low + 40), (len(text), len(text)))
        assert a < 0 or (low <= a < low + 40 and text[a] == " " and n == library(text[a:]) and library(text[:a]) + n == library(text))
        assert b == len(text)


@pytest.mark.parametrize("chunk,overlap", [(64, 8), (50, 2), (300, 40)])
def test_chunks_splice_to_whole_counts(spark, library, chunk, overlap):
    prepare(spark)
    rng = random.Random(chunk)
    texts = [" ".join("".join(rng.choice("abcé'.,1 \n") for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(80)))
             for _ in range(25)]
    texts += [None, "", "x" * 1000, "word " * 400, "word " * 400, "a <|endoftext|> b" * 60]
    out = C.count_tokens(docs(spark, texts), PATH, chunk=chunk, overlap=overlap).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in out} == {i: library(t) for i, t in enumerate(texts)}
    assert len(out) == len(texts)


def test_repeated_rows_extra_and_clashing_columns(spark, library):
    prepare(spark)
    df = docs(spark, ["long text of words " * 30, "short"]).selectExpr("*", "7 AS n_tokens", "8 AS _digest")
    out = C.count_tokens(df.unionByName(df), PATH, chunk=100, overlap=20)
    assert sorted(r["n_tokens"] for r in out.collect()) == sorted(2 * [library("long text of words " * 30), library("short")])
    assert "_digest" in out.columns and "lang" in out.columns
    other = C.count_tokens(docs(spark, ["short"]).selectExpr("*", "7 AS N_Tokens"), PATH)
    assert [c for c in other.columns if c.lower() == "n_tokens"] == ["n_tokens"]
    assert other.first()["n_tokens"] == library("short")


def test_empty_table(spark):
    prepare(spark)
    assert C.count_tokens(docs(spark, []), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        C.read_tokenizer(tokenizer_path("word_bpe_49k.json"))


def test_special_strings_that_need_the_own_library(library):
    spec = json.loads(C.read_tokenizer(PATH))
    assert C.special_tokens(json.dumps(spec)) == {"<|endoftext|>": 50256}
    spec["added_tokens"].append(dict(spec["added_tokens"][0], content="<|end", id=50257))
    assert C.special_tokens(json.dumps(spec)) is None
    spec["added_tokens"][1] |= {"content": "other", "special": False}
    assert C.special_tokens(json.dumps(spec)) is None
    assert C.Counter(json.dumps(spec), {b"a": 0}).ranked is None
