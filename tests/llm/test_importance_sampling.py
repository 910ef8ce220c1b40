import hashlib
import math
import random
import re
import zlib

import numpy as np
import xxhash

from impactspark.llm import importance_sampling as S
from impactspark.llm.common import prepare

from .helpers import DOCS, docs, lower

COLUMNS = ["n_features", "weight", "score", "rank"]


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return len(w), w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute(texts, targets):
    """``{id: (n_features, weight, score, rank)}`` by plain loops."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = [0] * 10_000, [0] * 10_000
    for total, many in ((s, texts.values()), (t, targets)):
        for x in many:
            for f in features(x)[1]:
                total[bucket(f)] += 1
    a, b = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((y + 1) * (a + 10_000) / ((x + 1) * (b + 10_000)))) for x, y in zip(s, t)]
    out, able = {}, []
    for i, x in texts.items():
        n, fs = features(x)
        weight = sum(gain[bucket(f)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out[i] = [len(fs), weight, score, None]
        if n >= 20:
            able.append((-score, i))
    for k, (_, i) in enumerate(sorted(able)[:25 * len(able) // 100]):
        out[i][3] = k + 1
    return {i: tuple(x) for i, x in out.items()}


def noisy(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Été", "日本", "ÀB", "x" * 40, "MiXed", "a1b2", "\u0000", "'", "-", "🙂"]
    return [rng.choice([" ", ", ", "\n"]).join(rng.choice(words) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_equal_to_plain_loops(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(S, "BATCH_BYTES", 2_000)
    texts = [None, "", "--", "word", "word", *noisy(1, 300), *["the same hot text of a third of all rows " * 4] * 150]
    texts.append(" ".join(noisy(2, 900)))
    target = [*noisy(3, 20), "the same hot text", None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    out = S.resample(docs(spark, texts), df).collect()
    want = brute(dict(enumerate(texts)), target)
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in out} == want
    drawn = [w[3] for w in want.values() if w[3]]
    assert len(drawn) > 60 and sorted(drawn) == list(range(1, len(drawn) + 1))


def test_other_sizes_and_no_target(spark):
    prepare(spark)
    texts = ["a b c d", "b c", "x"]
    got = S.resample(docs(spark, texts), spark.createDataFrame([], "text string"), size=3, least_words=1, percent=100).collect()
    assert {r["doc_id"]: r["n_features"] for r in got} == {0: 9, 1: 3, 2: 1}
    assert sorted(r["rank"] for r in got) == [1, 2, 3]


def test_slots_are_verified_by_bytes(monkeypatch):
    texts = noisy(4, 50)
    grams = S.Ngrams(texts, 2)
    raw = grams.flat.tobytes()
    own = [raw[a:b] for a, b in zip(grams.start.tolist(), grams.end.tolist())]
    assert sorted(own) == sorted(f.encode() for t in texts for f in features(t)[1])

    def holds(table):
        by_slot = {}
        for f, s in zip(own, table.slots.tolist()):
            assert by_slot.setdefault(s, f) == f
        assert len(by_slot) == len(set(own)) == (table.owner >= 0).sum()
        for s, f in by_slot.items():
            assert table.count[s] == own.count(f) and table.bucket[s] == zlib.crc32(f) % 97

    holds(S.Table(grams, 97))
    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda b: len(b) % 3)  # nearly all keys collide
    holds(S.Table(grams, 97))


def test_empty_batches_and_words_of_every_length():
    assert len(S.Table(S.Ngrams([], 2), 5).slots) == 0 and len(S.Table(S.Ngrams(["", " ,"], 2), 5).slots) == 0
    texts = [" ".join(c * k for k in range(1, 40) for c in "ab")] * 2
    grams = S.Ngrams(texts, 1)
    assert len(set(S.Table(grams, 11).slots.tolist())) == 78 and grams.words.tolist() == [78, 78]
    a, b = np.array([0]), np.array([9])
    words = np.lib.stride_tricks.as_strided(np.frombuffer(b"abcdefgh-abcdefgX" + bytes(8), np.uint8), (18, 8), (1, 1))
    assert S._equal(words, a, b, np.array([7])).all() and not S._equal(words, a, b, np.array([8])).any()


def test_nulls_repeats_ties_clashes_and_empty_tables(spark):
    prepare(spark)
    text = "word " * 30
    rows = [(1, text), (1, text), (None, text), (2, None), (3, text), (4, text), (5, text), (6, text), (7, text)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).selectExpr("*", "5 AS SCORE", "6 AS _words", "array(1) AS x")
    target = spark.createDataFrame([("word",)], "text string")
    out = S.resample(df, target, keep_text=True)
    got = out.collect()
    assert len(got) == 9 and all(r["_words"] == 6 and r["x"] == [1] for r in got) and "text" in out.columns
    assert [c for c in out.columns if c.lower() == "score"] == ["score"]
    assert {r["doc_id"]: r["score"] for r in got}[None] is None
    assert sorted(r["rank"] for r in got if r["rank"]) == [1]  # a quarter of the seven rows that have an id and 20 words
    none = S.resample(docs(spark, []), target)
    assert none.count() == 0 and set(COLUMNS) <= set(none.columns)
