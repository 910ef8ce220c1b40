import random

import numpy as np
import pytest

from impactspark.llm import mixing as M
from impactspark.llm.common import prepare

from .helpers import docs

SHARES = {"red": 0.7, "green": 0.2, "blue": 0.1}


def corpus(spark, n=200, seed=3):
    rng = random.Random(seed)
    texts, domains = [], []
    for _ in range(n):
        d = rng.choices(list(SHARES), SHARES.values())[0]
        texts.append(" ".join(f"{d}{rng.randrange(30)}" for _ in range(rng.randrange(5, 60))))
        domains.append(d)
    df = docs(spark, texts)
    return df, spark.createDataFrame(list(enumerate(domains))[::2], "doc_id long, domain string"), domains


def test_expected_totals_reach_the_targets(spark):
    prepare(spark)
    df, labelled, domains = corpus(spark)
    targets = {"red": 0.4, "green": 0.35, "blue": 0.25}
    mixed, solved = M.mix(df, labelled, targets)
    rows = mixed.collect()
    assert [r["domain"] for r in sorted(rows, key=lambda r: r["doc_id"])] == domains
    assert all(r["rate"] >= 0 and r["n_tokens"] == len(r["text"].split()) for r in rows)
    assert np.allclose(solved.reached, [targets[d] for d in solved.domains], atol=2e-3)
    total = sum(r["n_tokens"] for r in rows)
    for d, w in targets.items():
        assert abs(sum(r["n_tokens"] * r["rate"] for r in rows if r["domain"] == d) / total - w) < 0.02


def solved_locally(monkeypatch, p, n, targets=None, **given):
    """The solver over arrays, with as many sums as it took."""
    calls = []

    def totals(slim, history, least, size):
        calls.append(len(history))
        return (n * M._unfold(p, history, least)) @ p

    monkeypatch.setattr(M, "_totals", totals)
    return M.solve(None, [f"d{k}" for k in range(p.shape[1])], targets, **{"power": 0.5, **given}), len(calls)


@pytest.mark.parametrize("least", [0.0, 0.4])
def test_rates_minimise_the_stated_objective(monkeypatch, least):
    """Targets out of reach: no rate can be moved within its bound so that the weighted squares fall."""
    rng = np.random.default_rng(5)
    p = rng.dirichlet([4.0, 4.0, 4.0], size=60)
    n = rng.integers(1, 500, 60).astype(float)
    u = n / n.sum()
    solved, _ = solved_locally(monkeypatch, p, n, {"d0": 0.9, "d1": 0.05, "d2": 0.05}, least=least, steps=3000)
    r, share = solved.rates(p), u @ p
    assert not solved.met and (r >= least).all() and np.allclose((u * r) @ p, solved.reached)
    slope = p @ ((solved.reached - solved.target) / share)
    assert np.abs(slope[r > least + 1e-9]).max(initial=0.0) < 1e-3 and slope[r <= least + 1e-9].min(initial=0.0) > -1e-3
    cost = lambda r: (((u * r) @ p - solved.target) ** 2 / share).sum()
    for _ in range(500):
        assert cost(np.maximum(least, r + rng.normal(size=60) * rng.choice([1e-3, 1e-1, 1]))) >= cost(r) - 1e-6


def test_steps_are_those_of_plain_projected_gradient():
    """Without momentum the unfolded rates are the plain iteration, kept as an array."""
    rng = np.random.default_rng(1)
    p, n = rng.dirichlet([1.0, 1.0], size=30), rng.integers(1, 9, 30).astype(float)
    u, rate, history = n / n.sum(), np.ones(30), []
    target, share = np.array([0.8, 0.2]), (n / n.sum()) @ p
    for _ in range(12):
        weight = ((u * rate) @ p - target) / share
        history.append((weight, 0.0))
        rate = np.maximum(0.1, rate - p @ weight)
        assert np.allclose(M._unfold(p, history, 0.1), rate)


def test_totals_are_those_of_a_tokenizer(spark):
    prepare(spark)
    from tokenizers import Tokenizer

    from impactspark.llm.common import read, tokenizer_path
    from impactspark.llm.queries import QUERIES

    sf, library = "/root/testdata/sf0.001", Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in read(spark, sf, "documents").collect()}
    for by in ("lang", "source"):
        rows = QUERIES["op9_mixing"](spark, sf, domain=by).collect()
        assert {r["doc_id"]: r["n_tokens"] for r in rows} == {i: len(library.encode(t, add_special_tokens=False)) for i, t in texts.items()}
        assert {r["domain"] for r in rows} <= {r[by] for r in read(spark, sf, "documents").select(by).distinct().collect()}


def test_query_equals_the_solver_over_arrays(spark, monkeypatch):
    """The registered query against the same steps over collected memberships."""
    from impactspark.llm.common import read
    from impactspark.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op9_mixing"](spark, sf).collect()
    docs_ = read(spark, sf, "documents").select("doc_id", "text", "lang")
    labelled = docs_.join(read(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").selectExpr("doc_id", "lang AS domain")
    model = M.fit_domains(docs_, labelled)
    texts = {r["doc_id"]: r["text"] for r in docs_.collect()}
    _, p = model.of([texts[r["doc_id"]] or "" for r in rows])
    n = np.array([float(r["n_tokens"]) for r in rows])
    solved, _ = solved_locally(monkeypatch, p, n, power=0.5)
    assert solved.met
    assert np.allclose([r["rate"] for r in rows], np.where(n > 0, solved.rates(p), 1.0), atol=2e-6)


def test_rare_domains_reach_their_targets(monkeypatch):
    for small in (1e-3, 1e-4, 1e-6):
        n = np.array([0.8, 0.15, 0.05 - small, small]) * 1e9
        for given in ({"power": 0.5}, {"power": 0.0}, {"power": 0.7, "least": 1.0}):
            solved, calls = solved_locally(monkeypatch, np.eye(4), n, **given)
            assert solved.met and calls < 10, (small, given, calls)
            assert np.abs(solved.reached / solved.target - 1).max() <= 1e-3, (small, given)


def test_soft_and_unreachable_targets(monkeypatch):
    rng = np.random.default_rng(2)
    p = np.exp(rng.normal(size=(4000, 12)) * 4 + np.linspace(0, 9, 12))
    p /= p.sum(axis=1, keepdims=True)
    solved, calls = solved_locally(monkeypatch, p, rng.integers(1, 900, 4000).astype(float), power=0.5)
    assert solved.met and calls < 60 and np.abs(solved.reached / solved.target - 1).max() <= 1e-3
    solved, calls = solved_locally(monkeypatch, np.array([[0.6, 0.4], [0.7, 0.3]]), np.array([900.0, 90.0]), power=-3.0)
    assert not solved.met and calls <= M.STEPS + 1


def test_missed_targets_are_reported(spark):
    prepare(spark)
    mixed = docs(spark, ["red1 blue1"] * 4)
    labelled = spark.createDataFrame([(0, "red"), (1, "blue")], "doc_id long, domain string")
    with pytest.warns(UserWarning, match="targets not met"):
        M.mix(mixed, labelled, {"red": 0.9, "blue": 0.1})


def test_rare_domains_are_sampled_and_unknown_targets_raise(spark):
    prepare(spark)
    texts = [f"red{k % 30} red{k % 7}" for k in range(600)] + ["blue1 blue2 blue3", "blue1 blue3"]
    df = docs(spark, texts)
    labelled = spark.createDataFrame([(k, "red" if k < 600 else "blue") for k in range(602)] + [(9000, "gone")],
                                     "doc_id long, domain string")
    model = M.fit_domains(df, labelled, max_rows=20)
    assert model.domains == ["red", "blue"]
    assert (model.of(["blue2 blue3", "red1 red2"])[1].argmax(axis=1) == [1, 0]).all()
    assert M._parts({"a": 1000, "b": 100, "c": 2}, 102) == {"c": 1.0, "b": 0.5, "a": 0.05}
    with pytest.raises(ValueError, match="green"):
        M.mix(df, labelled, {"red": 0.5, "green": 0.5})
    assert M.mix(df.limit(0), labelled, {"red": 0.5, "green": 0.5})[0].count() == 0


def test_no_document_falls_below_the_least_rate(spark):
    prepare(spark)
    df, labelled, _ = corpus(spark)
    out = M.resample(df.selectExpr("*", "1 AS rate", "2 AS _copies"), labelled, power=0.5, least=1.0)
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert set(ids) == set(range(200)) and len(ids) > 220
    assert out.columns == [*df.columns, "rate", "_copies"]


def test_odd_tables(spark):
    prepare(spark)
    df, labelled, _ = corpus(spark, 30)
    odd = docs(spark, [None, "", "   ", "red1 red2 green3", "red1 red2 green3", "word " * 20_000], 100)
    mixed, _ = M.mix(odd.selectExpr("*", "0 AS rate", "'z' AS domain"), labelled)
    rows = {r["doc_id"]: r for r in mixed.collect()}
    assert len(rows) == 6 and rows[100]["rate"] == rows[101]["rate"] == 1.0 and rows[103]["rate"] == rows[104]["rate"]
    nulls = spark.createDataFrame([(None, "red"), (1, None)], "doc_id long, domain string")
    alone, solved = M.mix(odd, nulls)
    assert solved.domains == ["all"] and alone.count() == 6
    assert M.mix(odd.limit(0), labelled)[0].count() == 0 and M.resample(odd.limit(0), labelled).count() == 0
