import hashlib
import random
import re

from impactspark.llm import secret_scan as S
from impactspark.llm.common import prepare

from .helpers import DOCS, docs

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))


def noisy(seed, n):
    rng = random.Random(seed)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", ":", "=", " = ", '"', "'", "AKIA", "ABCDEF0123456789",
             "deadbeef" * 4, "0123456789abcdef", " ", "\n", "é", "🙂", "abc", "short", "verylongvalue1", "-", "x"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_spans_equal_brute_force(spark):
    prepare(spark)
    texts = [*noisy(1, 300), None, "", "token=secret:abcdefghij", "token: secret=abcdefghij", "password=" + "a" * 100_000]
    out, _ = S.scan(docs(spark, texts))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        want = brute(t)
        r = rows[i]
        assert r["spans"] == want
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        kinds = [x.split(":")[0] for x in want.split(",")]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))


def test_ledger_scans_only_what_it_has_not_seen(spark, tmp_path):
    prepare(spark)
    first, second = noisy(2, 40), noisy(3, 40)
    path = str(tmp_path / "ledger")
    _, rows = S.scan(docs(spark, first), S.read_ledger(spark))
    S.update_ledger(spark, path, rows)
    ledger = S.read_ledger(spark, path)
    assert {r["blob"] for r in ledger.collect()} == {hashlib.sha256(t.encode()).hexdigest() for t in first}
    both = docs(spark, first + second)
    new = {hashlib.sha256(t.encode()).hexdigest() for t in second} - {hashlib.sha256(t.encode()).hexdigest() for t in first}
    assert {r["blob"] for r in S.unseen_blobs(both, ledger).collect()} == new
    out, more = S.scan(both, ledger)
    assert {r["doc_id"]: r["spans"] for r in out.collect()} == {i: brute(t) for i, t in enumerate(first + second)}
    assert {r["blob"] for r in more.collect()} == new


def test_a_second_run_scans_nothing(spark, tmp_path, monkeypatch):
    """Findings come from the ledger; only blobs that it lacks are scanned, repeated and null rows included."""
    prepare(spark)
    scanned, real = [], S.scan_blobs

    def counted(blobs, *args):
        scanned.append(blobs.count())
        return real(blobs, *args)

    monkeypatch.setattr(S, "scan_blobs", counted)
    path, first, second = str(tmp_path / "ledger"), [*noisy(5, 30), None, "", "token=abcdefghij"], noisy(6, 20)
    new = len({t or "" for t in first})
    spans = lambda texts: {r["doc_id"]: r["spans"] for r in S.scan_ledger(docs(spark, texts), path).collect()}
    assert spans(first * 2) == {i: brute(t) for i, t in enumerate(first * 2)} and scanned == [new]
    assert spans(first * 2) == {i: brute(t) for i, t in enumerate(first * 2)} and scanned == [new]
    both = first + second
    assert spans(both) == {i: brute(t) for i, t in enumerate(both)}
    assert scanned == [new, len({t or "" for t in second} - {t or "" for t in first})]
    again = spark.read.parquet(path).where("n_assign = 1").limit(1).withColumn("rule_version", S.F.lit(S.RULE_VERSION))
    again.write.mode("append").parquet(path)  # a row that two runs appended
    assert len(S.scan_ledger(docs(spark, both), path).collect()) == len(both)
    assert S.scan_ledger(docs(spark, []), str(tmp_path / "other")).count() == 0


def test_the_query_goes_on_with_the_sessions_ledger(spark, tmp_path):
    from impactspark.llm.queries import QUERIES

    path = str(tmp_path / "ledger")
    spark.conf.set(S.LEDGER_SETTING, path)
    try:
        one = sorted(QUERIES["op7_secret_scan"](spark, "/root/testdata/sf0.001").collect())
        rows = spark.read.parquet(path).count()
        assert sorted(QUERIES["op7_secret_scan"](spark, "/root/testdata/sf0.001").collect()) == one
        assert spark.read.parquet(path).count() == rows, "nothing was appended again"
    finally:
        spark.conf.unset(S.LEDGER_SETTING)
    assert S.ledger_path(spark) != path


def test_another_rule_version_scans_again(spark):
    prepare(spark)
    df = docs(spark, ["token=abcdefghij"])
    _, rows = S.scan(df, S.read_ledger(spark))
    old = rows.selectExpr("blob", "'older' AS rule_version", "n_assign", "n_access", "n_hex", "spans", "base_sha256")
    assert S.unseen_blobs(df, old).count() == 1


def test_copies_repeated_rows_null_ids_and_clashing_columns(spark):
    prepare(spark)
    rows = [(1, "token=abcdefghij"), (1, "token=abcdefghij"), (None, "token=abcdefghij"), (2, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).selectExpr("*", "9 AS n_hex", "8 AS _blob")
    out, _ = S.scan(df)
    got = out.collect()
    assert len(got) == 4 and sorted(r["n_assign"] for r in got) == [0, 1, 1, 1] and all(r["n_hex"] == 0 for r in got)
    assert all(r["_blob"] == 8 for r in got)


def test_empty_table_and_native_plan(spark):
    prepare(spark)
    out, rows = S.scan(docs(spark, []))
    assert out.count() == 0 and rows.count() == 0
    plan = S.scan(docs(spark, ["a"]))[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
