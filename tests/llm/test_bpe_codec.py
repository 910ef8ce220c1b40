import base64
import random

import numpy as np
import pytest

from impactspark.llm import bpe_codec as B
from impactspark.llm.common import prepare, tokenizer_path

from .helpers import docs

pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = tokenizer_path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    tokens = B.read_ranks(PATH)
    return B.Codec(tokens, B.PerfectHash(tokens))


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}).encode_ordinary


def test_pattern_is_the_public_one():
    import public_tokenizers

    assert public_tokenizers.PATTERN == B.PATTERN


def test_perfect_hash_is_minimal_and_rejects_strangers(codec):
    assert (codec.table.find(codec.tokens) == np.arange(len(codec.tokens))).all()
    assert sorted(codec.table.key_of.tolist()) == list(range(len(codec.tokens)))
    assert codec.table.find([b"not a token of it", b""]).tolist()[0] == -1


@pytest.mark.parametrize("keys", [[b"a"], [b"a", b"b"], [bytes([i]) for i in range(256)]])
def test_perfect_hash_of_few_keys(keys):
    assert B.PerfectHash(keys).find(keys).tolist() == list(range(len(keys)))


def test_same_ids_as_the_library(codec, reference):
    rng = random.Random(4)
    letters = "abcdeABC  \n\t.,!'’é日本語 ß0123456789🙂​́\x1c"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(200))) for _ in range(400)]
    texts += ["", " ", "   ", "it's we'll\t\n ok", "a" * 3000, "<|endoftext|>", "x" + " " * 500 + "y"]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == reference(text)
        assert codec.decode(ids) == text.encode()


def test_memo_generations_keep_results(codec, reference, monkeypatch):
    monkeypatch.setattr(B, "MEMO", 3)
    small = B.Codec(codec.tokens, codec.table)
    texts = [f" zqx{i}vv kkqj{i % 5}" for i in range(60)] * 2
    assert [np.frombuffer(x, "<u4").tolist() for x in small.encode(texts)] == [reference(t) for t in texts]
    for t in texts:
        assert np.frombuffer(small.encode([t])[0], "<u4").tolist() == reference(t)


def test_table_round_trip_nulls_repeats_and_clashing_columns(spark, reference):
    prepare(spark)
    df = docs(spark, [None, "", "Hello world", "Hello world", "ß é 🙂" * 50]).selectExpr("*", "1 AS token_ids", "2 AS decoded")
    out = B.decode(B.encode(df, PATH), PATH)
    rows = out.collect()
    assert len(rows) == 5 and set(df.columns) == set(out.columns)
    for r in rows:
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == reference(r["text"] or "")


def test_empty_table(spark):
    prepare(spark)
    assert B.decode(B.encode(docs(spark, []), PATH), PATH).count() == 0


def test_other_vocabulary(tmp_path):
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"abab", b"ba"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens)))
    read = B.read_ranks(str(path))
    assert read == tokens
    own = tiktoken.Encoding("t", pat_str=B.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    codec = B.Codec(read, B.PerfectHash(read))
    for text in ("ababab", "bababa", "aabbaabb", "abababababab" * 9):
        assert np.frombuffer(codec.encode([text])[0], "<u4").tolist() == own.encode_ordinary(text)
