import hashlib
import random
import re
from collections import defaultdict

import pytest

from impactspark.llm import pii_extraction as S
from impactspark.llm.common import prepare

from .helpers import DOCS, docs

COLUMNS = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base(text):
    """The base patterns as they are written, by plain regular expressions."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((0, m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


def brute(texts):
    """Columns of every text and the patterns that count, by plain loops."""
    seen, edges = [], {}
    for row, t in enumerate(texts):
        t = t or ""
        own = base(t)
        for seed, spans in ((True, own), (False, S.candidates(t, own))):
            for k, a, b in spans:
                v = S.value_hash(t[a:b])
                seen.append((row, k, a, b, v, seed))
                for p in S.patterns(t, a, b):
                    for kind in range(4) if seed else [k]:
                        w = 1.0 if seed and kind == k else 0.0
                        edges[kind, p, v] = max(edges.get((kind, p, v), 0.0), w)
    known = {}
    while True:
        by = defaultdict(list)
        for (kind, p, v), w in edges.items():
            by[kind, p].append(w)
        good = {kp: sum(ws) / (len(ws) + 1) for kp, ws in by.items() if sum(ws) >= S.SUPPORT and sum(ws) >= S.PRECISION * len(ws)}
        miss = defaultdict(lambda: 1.0)
        for (kind, p, v), w in edges.items():
            if w == 0 and (kind, p) in good:
                miss[kind, v] *= 1 - good[kind, p]
        new = {kv: 1 - m for kv, m in miss.items() if 1 - m >= S.ACCEPT}
        if not new:
            break
        known.update(new)
        for kind, p, v in edges:
            edges[kind, p, v] = max(edges[kind, p, v], new.get((kind, v), 0.0))
    out = []
    for row, t in enumerate(texts):
        own, best = base(t), {}
        for r, k, a, b, v, seed in seen:
            if r == row and not seed and (k, v) in known:
                best[a, b] = max(best.get((a, b), (0, 0)), (known[k, v], -k))
        more = [(-k, a, b) for (a, b), (_, k) in best.items()]
        text = lambda spans: ",".join(f"{S.KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
        out.append((*[sum(x[0] == k for x in own) for k in range(4)], hashlib.sha256(text(own).encode()).hexdigest(), text(own + more)))
    return out, set(good)


def noisy(seed, n):
    rng = random.Random(seed)
    parts = ["a.b", "@", "x@y.zz", "mail", ".", "..", "com", " ", "\n", "-", "+1", "+", "(", ")", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "10.0.0.1", "300.1.1.1", "1.2.3.4.5.6.7.8", "0001.2.3.4", "555", "0", "12345678", "é", "🙂", "%", "_", "tel:", "ext =", "::", "fe80:0:1:2",
             " (at) ", "[dot]", "token"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(n)]


def contexts(seed):
    """Texts whose contexts give away numbers and addresses that the base patterns do not take."""
    rng = random.Random(seed)
    out = []
    for k in range(30):
        out.append(f"please call me at +1 {rng.randrange(200, 999)} 555 {rng.randrange(1000, 9999)} before noon")
        out.append(f"write to me via u{k}@example{k}.com or post")
    out += ["please call me at 0171 555 0199 before noon", "he said 0171 555 0199 and left", "Order 12345678 was sent",
            "write to me via jane (at) example (dot) org or post", "a (at) b", "please call me at noon",
            "please call me at 0999 888 777 after", "tel: 0171 555 0199 ok"]
    return out


@pytest.mark.parametrize("texts", [[None, "", "@", *noisy(1, 500)], contexts(2) + noisy(3, 60)])
def test_equal_to_plain_loops(spark, texts):
    prepare(spark)
    found = S.extract(docs(spark, texts))
    want, good = brute(texts)
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in found.docs.collect()}
    assert got == dict(enumerate(want))
    assert {(r["kind"], r["pattern"]) for r in found.patterns.collect()} == good


def test_contexts_discover_unseen_identifiers(spark):
    prepare(spark)
    texts = contexts(4)
    rows = {r["doc_id"]: r for r in S.extract(docs(spark, texts)).docs.collect()}
    at = {t: rows[k] for k, t in enumerate(texts)}
    hit = at["please call me at 0171 555 0199 before noon"]
    assert hit["spans"] == "phone:18:31" and hit["n_phone"] == 0, "base counts stay"
    assert at["he said 0171 555 0199 and left"]["spans"] == "phone:8:21", "an accepted value counts wherever it stands"
    assert at["write to me via jane (at) example (dot) org or post"]["spans"] == "email:16:43"
    for t in ("Order 12345678 was sent", "a (at) b", "please call me at noon"):
        assert at[t]["spans"] == ""


def test_discovery_goes_on_in_rounds(spark):
    """A pattern of the second round counts only by values that the first one accepted."""
    prepare(spark)
    texts = [f"please call me at +1 200 555 {k:04d} before noon" for k in range(30)]
    texts += [f"please call me at 0171 555 01{k:02d} before noon" for k in range(6)]
    texts += [f"the old number 0171 555 01{k:02d} still works" for k in range(6)] + ["the old number 0888 777 666 still works"]
    found = S.extract(docs(spark, texts))
    assert found.rounds >= 3
    assert {r["doc_id"]: r["spans"] for r in found.docs.collect()}[len(texts) - 1] == "phone:15:27"


def test_mixed_contexts_and_copies_discover_nothing(spark):
    prepare(spark)
    texts = ["see +1 200 555 1234 now"] * 50 + ["see 12345678 now"] * 50
    for k in range(30):
        texts += [f"it is u{k}@mail.com here", f"it is 10.0.0.{k} here", f"it is +1 200 555 {k:04d} here", f"it is {10**15 + k} here"]
    got = S.extract(docs(spark, texts))
    assert got.patterns.count() == 0
    assert {r["doc_id"]: r["spans"] for r in got.docs.collect()}[len(texts) - 1] in ("", "card:6:22")


def test_given_documents_equal_plain_loops(spark):
    from impactspark.llm.queries import QUERIES

    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want, _ = brute([r["text"] for r in rows])
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_pii_extraction"](spark, "/root/testdata/sf0.01").collect()}
    assert got == {r["doc_id"]: w for r, w in zip(rows, want, strict=True)}


def test_long_runs_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "1 -" * 100_000, "a:" * 150_000, "." * 300_000 + "@x.y"):
        spans = S.base_spans(t)
        S.candidates(t, spans)
    assert S.base_spans("x" * 200_000 + "@mail.com") == [(0, 0, 200_009)]


def test_nulls_repeats_clashes_and_empty_tables(spark):
    prepare(spark)
    rows = [(1, "+1 200 555 1234"), (1, "+1 200 555 1234"), (None, "12345678"), (2, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).selectExpr("*", "5 AS N_CARD", "6 AS _row", "array(1) AS kind")
    out = S.extract(df).docs
    got = out.collect()
    assert len(got) == 4 and sorted(r["n_phone"] for r in got) == [0, 0, 1, 1] and all(r["_row"] == 6 and r["kind"] == [1] for r in got)
    assert [c for c in out.columns if c.lower() == "n_card"] == ["n_card"]
    assert S.extract(docs(spark, [])).docs.count() == 0
