import hashlib
import random

from impactspark.llm import exact_dedup as D
from impactspark.llm.common import prepare

from .helpers import DOCS, docs, lower


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(lower(text), []).append(i)
    return groups


def test_marks_every_row_like_brute_force(spark):
    prepare(spark)
    rng = random.Random(1)
    texts = [rng.choice(["Alpha", "alpha", "ÄB", "äB", "Äb", "", None, "x y", "X Y", f"u{i}"]) for i in range(300)]
    got = {r["doc_id"]: r for r in D.mark(docs(spark, texts)).collect()}
    groups = brute(enumerate(texts))
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own = groups[lower(t)]
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(own), len(own), i == max(own))
        assert r["text_sha256"] == hashlib.sha256(lower(t).encode()).hexdigest()


def test_kept_documents_keep_all_columns(spark):
    prepare(spark)
    df = docs(spark, ["a", "A", "b", None, ""]).selectExpr("*", "1 AS _digest", "2 AS _again", "3 AS _rank", "4 AS cell")
    out = D.exact_dedup(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2, 4]


def test_repeated_rows_and_null_ids(spark):
    prepare(spark)
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "B"), (2, "c")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    marked = D.mark(df).collect()
    assert len(marked) == 6 and sum(r["kept"] for r in marked) == 3
    assert all(r["group_size"] == 3 and r["keep_id"] == 1 for r in marked if r["text_sha256"] == hashlib.sha256(b"a").hexdigest())
    assert sorted(lower(r["text"]) for r in D.exact_dedup(df).collect()) == ["a", "b", "c"]


def test_result_does_not_depend_on_the_filter(spark, monkeypatch):
    prepare(spark)
    df = docs(spark, [f"t{i % 70}" for i in range(200)])
    want = sorted(map(tuple, D.mark(df).collect()))
    monkeypatch.setattr(D, "MIN_CELLS", 64)  # almost every row tests positive
    monkeypatch.setattr(D, "MAX_CELLS", 64)
    monkeypatch.setattr(D, "BROADCAST_BYTES", 0)  # joined by shuffle
    assert sorted(map(tuple, D.mark(df).collect())) == want


def test_empty_table_and_long_text(spark):
    prepare(spark)
    assert D.mark(docs(spark, [])).count() == 0 and D.exact_dedup(docs(spark, [])).count() == 0
    long = "Word " * 200_000
    assert [r["group_size"] for r in D.mark(docs(spark, [long, long.lower()])).collect()] == [2, 2]


def test_no_python_in_the_plan(spark):
    prepare(spark)
    for df in (D.mark(docs(spark, ["a", "a"])), D.exact_dedup(docs(spark, ["a", "a"]))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan
