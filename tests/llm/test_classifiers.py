import random
import zlib

import numpy as np

from impactspark.llm import quality as Q
from impactspark.llm import toxicity as X
from impactspark.llm.common import prepare

from .helpers import DOCS, docs


def labelled(spark, n=160, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        ws = [f"{rng.choice('abcdefgh')}{rng.choice('aeiou')}{rng.choice('klmnpr')}" for _ in range(rng.randrange(10, 60))]
        bad, toxic = rng.random() < 0.3, rng.random() < 0.3
        if bad:
            ws = [w.upper() + "!!" for w in ws]
        if toxic:
            for w in rng.sample(["scoundrel", "blockhead", "nitwits"], 2):
                ws.insert(rng.randrange(len(ws)), w)
        rows.append((i, " ".join(ws), "en", "s", 0))
        labels.append((i, int(not bad), int(toxic)))
    return (spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
            {i: (q, t) for i, q, t in labels})


def test_held_out_fold_is_crc32_of_the_id_as_text(spark):
    got = spark.range(200).select("id", Q.held_out(Q.F.col("id"), 5, 0).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_features_have_length_one_and_ignore_batching():
    texts = ["", "a b c", "SHOUT!! SHOUT!! now", "é ü 日本 *** ***", "x " * 30_000]
    together, alone = Q.features(texts), [Q.features([t])[0] for t in texts]
    for (k, v), (k2, v2) in zip(together, alone, strict=True):
        assert (k == k2).all() and np.allclose(v, v2)
        assert not len(v) or abs((v.astype(float) ** 2).sum() - 1) < 1e-4


def test_quality_learns_held_out_rows(spark):
    prepare(spark)
    df, labels, truth = labelled(spark)
    out = Q.held_out(Q.F.col("doc_id"), 5, 0)
    w = Q.train(df, labels.where(~out), "quality")
    got = {r["doc_id"]: r["score"] for r in Q.score(df, w).collect()}
    test = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == truth[i][0] for i in test) / len(test) > 0.9
    assert all(0 <= s <= 1 for s in got.values())


def test_quality_of_odd_rows(spark):
    prepare(spark)
    df, labels, _ = labelled(spark, 60)
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, None)], labels.schema))
    w = Q.train(df.unionByName(df), labels, "quality")
    odd = docs(spark, [None, "", "word " * 20_000, "same", "same"], 500).selectExpr("*", "1 AS score", "2 AS weights")
    got = {r["doc_id"]: r["score"] for r in Q.score(odd, w).collect()}
    assert got[500] == got[501] == 1 / (1 + np.exp(-w[-1])) and got[503] == got[504]
    assert Q.score(odd.limit(0), w).count() == 0
    none = Q.train(df, labels.limit(0), "quality")
    assert {r["score"] for r in Q.score(df, none).collect()} == {0.5}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = random.Random(7)
    terms = [(t, 5.0) for t in ("idiot", "scum", "worthless", "disgusting", "moron", "lowei*", "trash")]
    lexicon = X.Lexicon(terms)
    tokens = {"".join(rng.choice("idotmrnscuwhle") for _ in range(rng.randrange(1, 9))) for _ in range(3000)}
    for t, _ in terms:
        word = t.rstrip("*")
        for _ in range(300):
            s = list(word)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(s) + 1)
                s[k:k + rng.randrange(2)] = [rng.choice("idot0*zé")] * rng.randrange(2)
            tokens.add("".join(s))
    for token in tokens:
        want = None
        for number, (t, _) in enumerate(terms):
            if t.endswith("*"):
                if token.startswith(t[:-1]):
                    want = min(want or (9, 9), (0, number))
            else:
                d, limit = edits(t, token), 0 if len(t) < 5 else 1 if len(t) < 10 else 2
                if d <= limit:
                    want = min(want or (9, 9), (d, number))
        got = lexicon.match(token)
        assert (got is None) == (want is None), token
        assert got is None or got[1] == want[0], token


def test_toxicity_learns_terms_and_catches_misspellings(spark):
    prepare(spark)
    df, labels, truth = labelled(spark, 300)
    model = X.fit(df, labels)
    assert {t for t, _ in model.terms} == {"scoundrel", "blockhead", "nitwits"}
    got = {r["doc_id"]: r["score"] for r in X.score(df, model).collect()}
    assert all((got[i] >= X.THRESHOLD) == t for i, (_, t) in truth.items())
    plain = "bak lem dok " * 20
    texts = [plain, plain + "you sc0undrel and bl*ckhead", plain + 'the word "scoundrel" means a rogue', None, "", "scoundrel!",
             plain + "scoundrel " * 3]
    got = [r["score"] for r in X.score(docs(spark, texts), model).orderBy("doc_id").collect()]
    assert got[1] >= X.THRESHOLD and got[5] >= X.THRESHOLD and got[6] >= X.THRESHOLD
    assert got[2] < X.THRESHOLD and got[0] < X.THRESHOLD and got[3] == got[4] < X.THRESHOLD


def test_lexicon_keeps_rare_terms_of_large_samples_and_quoted_ones(spark):
    prepare(spark)
    rng = random.Random(4)
    code = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k * 7919 % 100000:05d}")
    rows = []
    for i in range(12_000):
        ws = [f"{rng.choice('klmn')}{rng.choice('aeiou')}{rng.choice('rst')}" for _ in range(12)] + [f"z{i}"]
        toxic = i % 4 == 0
        if toxic:  # 150 rare terms, each in 20 of 3,000 toxic rows (0.67%)
            ws.insert(3, code(i // 4 % 150) + "ux")
        if toxic and rng.random() < 0.3:
            ws.insert(5, "scoundrel")
        if not toxic and rng.random() < 0.02:
            ws[5:5] = ["wrote", '"scoundrel"']
        rows.append((i, " ".join(ws), int(toxic)))
    sample = spark.createDataFrame(rows, "id long, text string, label int")
    terms = dict(X.learn_lexicon(sample))
    assert sum(any(w == t or t.endswith("*") and w.startswith(t[:-1]) for t in terms)
               for w in (code(k) + "ux" for k in range(150))) == 150
    assert X.LEAST_RATIO < terms["scoundrel"] < X.FULL_RATIO


def test_one_clean_row_does_not_make_a_misspelling_ordinary(spark):
    prepare(spark)
    rows = [(f"you sc0undrel {k}", 1) for k in range(5)] + [(f"an scoundrels {k}", 0) for k in range(3)]
    rows += [("you scoundrol", 1), ("a scoundrol", 1), ("he wrote sc0undrel", 0), ("scoundrol", 0), ("it is sco*ndrel sco*ndrel", 0)] + [(f"plain {k}", 0) for k in range(20)]
    sample = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, text string, label int")
    assert X.ordinary_forms(sample, [("scoundrel", 5.0)]) == {"scoundrels"}
    assert X.ordinary_forms(sample, []) == frozenset()


def test_toxicity_of_odd_tables(spark):
    prepare(spark)
    df, labels, _ = labelled(spark, 40)
    model = X.fit(df, labels.limit(0))
    assert model.terms == []
    odd = docs(spark, [None, "", "x" * 100_000, "a a", "a a"]).selectExpr("*", "1 AS score", "2 AS low")
    out = X.score(odd, model)
    assert out.count() == 5 and "low" in out.columns
    assert X.score(odd.limit(0), model).count() == 0


def test_quality_query_equals_plain_loops(spark):
    """The registered query against follow-the-regularised-leader written coordinate by coordinate over dictionaries."""
    import math
    import zlib

    from pyspark.sql import functions as F

    from impactspark.llm import quality as Q
    from impactspark.llm.common import read
    from impactspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in read(spark, sf, "documents").collect()}
    rows = read(spark, sf, "labels").where("quality is not null").select(
        "doc_id", "quality", F.xxhash64("doc_id", F.lit(5)).alias("turn")).collect()
    rows = [r for r in rows if r["doc_id"] in texts and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    coded = {i: [(int(k), float(v)) for k, v in zip(*Q.features([t])[0])] + [(-1, 1.0)] for i, t in texts.items()}

    def weight(state, k):
        z, n = state.get(k, (0.0, 0.0))
        return 0.0 if abs(z) <= Q.L1 else -(z - math.copysign(Q.L1, z)) / ((Q.BETA + math.sqrt(n)) / Q.ALPHA + Q.L2)

    total = {}
    for _ in range(Q.ROUNDS):
        shards = []
        for shard in range(Q.SHARDS):
            own = sorted((r for r in rows if r["turn"] % Q.SHARDS == shard), key=lambda r: r["turn"])
            state = dict(total)
            for r in own:
                x = coded[r["doc_id"]]
                ws = [weight(state, k) for k, _ in x]
                p = 1 / (1 + math.exp(-sum(w * v for w, (_, v) in zip(ws, x))))
                for w, (k, v) in zip(ws, x):
                    z, n = state.get(k, (0.0, 0.0))
                    g = (p - r["quality"]) * v
                    state[k] = (z + g - (math.sqrt(n + g * g) - math.sqrt(n)) / Q.ALPHA * w, n + g * g)
            if own:
                shards.append(state)
        total = {k: tuple(sum(s.get(k, (0.0, 0.0))[j] for s in shards) / len(shards) for j in (0, 1)) for k in set().union(*shards)}
    got = QUERIES["op3_quality"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        x = sum(weight(total, k) * v for k, v in coded[r["doc_id"]])
        assert abs(r["score"] - 1 / (1 + math.exp(-x))) < 1e-6
