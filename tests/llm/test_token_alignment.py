import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest

from impactspark.llm import token_alignment as A
from impactspark.llm.common import prepare, tokenizer_path

from .helpers import DOCS, docs

PATH_A, PATH_B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B), ByteLevel()


def brute(texts, libraries):
    """Every text by plain loops over whole encodings."""
    a, b, _ = libraries
    chars = {}
    n = 0
    for x in range(256):  # the public rule of byte-level vocabularies
        shown = 33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255
        chars[chr(x) if shown else chr(256 + n)] = x
        n += not shown
    found, links = [], Counter()
    for t in texts:
        left, right = [], []
        if t:
            for i in a.encode(" " + t, add_special_tokens=False).ids:
                left.append((i, bytes(chars[c] for c in a.id_to_token(i))))
            for i in b.encode(t):
                p = b.id_to_piece(i)
                right.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
            raw = (" " + t).encode()
            if b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
                left = right = []
        groups, own = [], []
        ends = [sum(len(x) for _, x in right[:k + 1]) for k in range(len(right))] if len(right) < 400 else None
        if ends is None:
            ends, at = [], 0
            for _, x in right:
                at += len(x)
                ends.append(at)
        where, at, ga, last = {e: k for k, e in enumerate(ends)}, 0, [], 0
        for i, x in left:
            at += len(x)
            ga.append(i)
            if at in where:
                k = where[at]
                groups.append(",".join(map(str, ga)) + "|" + ",".join(str(right[m][0]) for m in range(last, k + 1)))
                own.append((i, right[k][0]))
                ga, last = [], k + 1
        links.update(own)
        found.append((len(left), len(right), groups, own))
    most = {}
    for (_, j), c in links.items():
        most[j] = max(most.get(j, 0), c)
    return [(na, nb, len(g), len(own), sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for na, nb, g, own in found], links


def odd_texts(seed, n):
    rng = random.Random(seed)
    parts = ["the", " ", "  ", "\n", "naïve", "Straße", "日本語", "🙂", "don't", "1234567", "<|endoftext|>", "<s>", "▁", "x" * 30, "é", " ",
             "\t", "ing", "Einverständnis", ".", "...", "!?", "\u0000", "ﬁ", "Á"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(n)]


def test_equal_to_plain_loops(spark, libraries, monkeypatch):
    prepare(spark)
    texts = [None, "", " ", "a", "▁", *odd_texts(1, 400), *["a hot line of copied words, with digits 12345"] * 60]
    out = A.align(docs(spark, texts), PATH_A, PATH_B)
    want, links = brute(texts, libraries)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in out.docs.collect()}
    assert got == dict(enumerate(want))
    assert {(r["a"], r["b"]): r["n"] for r in out.pairs.collect()} == links
    assert any(x[2] < min(x[0], x[1]) for x in want), "some groups are irregular"


def test_given_documents_equal_plain_loops(spark, libraries):
    from impactspark.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute([r["text"] for r in rows], libraries)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_token_alignment"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {r["doc_id"]: w for r, w in zip(rows, want, strict=True)}


def test_segments_and_small_blocks_change_nothing(spark, libraries, monkeypatch):
    rng = random.Random(5)
    long = " ".join(rng.choice(["Wörter", "of", "a  b", "x.", "日本", "(1)", "\n"]) for _ in range(20_000))
    pair = A.Pair(open(PATH_A, encoding="utf-8").read(), open(PATH_B, "rb").read())
    assert pair.cuts and len(pair.segments(long)) > 1
    cut = pair.encode([long])[0]
    monkeypatch.setattr(A, "SEGMENT", 1 << 30)
    whole = pair.encode([long])[0]
    assert len(pair.segments(long)) == 1
    assert all((x == y).all() for x, y in zip(cut, whole, strict=True)) and len(whole[0]) > 20_000
    monkeypatch.undo()
    prepare(spark)
    texts = [long, *odd_texts(2, 30)]
    want, _ = brute(texts, libraries)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in A.align(docs(spark, texts), PATH_A, PATH_B).docs.collect()}
    assert got == dict(enumerate(want))


def test_ranks_replace_merges_only_where_proven(libraries):
    spec = open(PATH_A, encoding="utf-8").read()
    ranks = A.merge_ranks(spec)
    assert ranks and len(ranks) == 50_256
    model = open(PATH_B, "rb").read()
    fast, slow = A.Pair(spec, model, ranks), A.Pair(spec, model)
    texts = [*odd_texts(8, 300), *["".join(map(chr, range(k, k + 64))) for k in range(0, 0xD800, 64)]]
    for x, y in zip(fast.encode(texts), slow.encode(texts), strict=True):
        assert (x[0] == y[0]).all() and (x[1] == y[1]).all()
    other = json.loads(spec)
    merges = other["model"]["merges"]
    merges[10], merges[11] = merges[11], merges[10]
    assert A.merge_ranks(json.dumps(other)) is None, "ids out of the merges' order"
    small = {chr_: i for i, chr_ in enumerate(A.byte_of_char())}
    small |= {"bc": 256, "ab": 257, "abc": 258}
    bpe = {"model": {"type": "BPE", "vocab": small, "merges": [["b", "c"], ["a", "b"], ["ab", "c"]]}}
    assert A.merge_ranks(json.dumps(bpe)) is None, "a product whose bytes merge another way"
    bpe["model"]["merges"][2] = ["a", "bc"]
    assert len(A.merge_ranks(json.dumps(bpe))) == 259


def test_blocks_close_when_full():
    block = A._Block(3)
    at, n = block.add(A.np.array([5, 9, 5]))
    assert at == [0, 1] and n.tolist() == [2, 1]
    at, _ = block.add(A.np.array([9, 7]))
    assert at == [2, 1] or sorted(at) == [1, 2]
    assert sum(block.n) == 5 and not block.full
    block.docs = A.BLOCK_DOCS
    assert block.full


def test_identity_map_prefers_pieces_and_digits():
    assert A.identity_map([b"a", b"", b"zz"], [b"a", b"b", b"a"]).tolist() == [2, -1, -1]
    cells = A._digits(120)
    assert [bytes(c[c > 0]) for c in cells] == [str(k).encode() for k in range(120)]
    spec = json.load(open(PATH_A, encoding="utf-8"))
    assert len(A.byte_of_char()) == 256 and len(spec["model"]["vocab"]) <= len(A.bytes_a(json.dumps(spec)))


def test_nulls_repeats_clashes_extra_columns_and_empty_tables(spark):
    prepare(spark)
    rows = [(1, "some text", None, "s", 3), (1, "some text", None, "s", 3), (None, "some text", "x", None, None), (2**60 + 1, None, "y", "z", 1)]
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "7 AS N_A", "8 AS _block", "9 AS block", "array(1, 2) AS pair")
    got = A.align(df, PATH_A, PATH_B).docs
    assert [c for c in got.columns if c.lower() == "n_a"] == ["n_a"]
    out = got.collect()
    assert len(out) == 4 and sorted(r["n_a"] for r in out) == [0, 2, 2, 2]
    assert {r["doc_id"] for r in out} == {1, None, 2**60 + 1}
    assert all(r["_block"] == 8 and r["block"] == 9 and r["pair"] == [1, 2] for r in out)
    none = A.align(docs(spark, []), PATH_A, PATH_B)
    assert none.docs.count() == 0 and none.pairs.count() == 0
    assert public_tokenizers.PATTERN
