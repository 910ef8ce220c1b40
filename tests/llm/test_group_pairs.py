"""Pairs of heads of a long list: few, whichever of its heads has the smallest id, and met once for each pivot."""

import random

import pytest

from impactspark.llm import ngram_join


def _edited(i, places, base):
    words = list(base)
    for p in places:
        words[p] = f"x{i}at{p}"
    return " ".join(words)


def _shingles(text):
    words = text.split()
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def _components(docs):
    """Brute force: the smallest id reachable by links."""
    sets = {i: _shingles(t) for i, t in docs}
    to = {i: i for i in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((to[a], to[b]))
                to = {i: low if c == high else c for i, c in to.items()}
    return to


@pytest.mark.parametrize("odd", [0, 99])
def test_an_odd_head_does_not_decide_the_pairs_of_a_long_list(spark, monkeypatch, odd):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(131)]
    docs = [(i, _edited(i, rng.sample(range(4, 127), 2), base)) for i in range(1, 41)]
    docs.append((odd, _edited(odd, [15, 40, 65, 90, 115], base)))    # one shingle of its prefix, at most, is in a list
    made = []
    whole = ngram_join._group_pairs

    def counted(*a, **k):
        out = whole(*a, **k)
        made.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_group_pairs", counted)
    out = ngram_join.link_components(spark.createDataFrame(docs, "doc_id bigint, text string"))
    assert {r["doc_id"]: r["component_id"] for r in out.collect()} == _components(docs)
    assert made[0] <= 3 * len(docs)


@pytest.mark.parametrize("few", [0, 4, 1000])
def test_heads_of_many_common_lists_meet_once(spark, monkeypatch, few):
    heads, tokens, n = 8, 30, 140
    rows = [(100 + t, i, n, heads, tokens, i, 0, 29 - t, False) for t in range(tokens) for i in range(heads)]
    # a pair whose common shingle is too far behind, one of sizes apart, one in a list of its own
    rows += [(7, 20, n, 2, tokens, 20, 20, 3, False), (7, 21, n, 2, tokens, 21, 20, 3, False)]
    rows += [(8, 30, n, 2, tokens, 30, 30, 29, False), (8, 31, 2 * n, 2, tokens, 31, 30, 57, False)]
    rows += [(9, 40, n, 2, tokens, 40, 40, 29, False), (9, 41, n, 2, tokens, 41, 40, 29, False)]
    staged, stored = ngram_join.staged, {}

    def noted(df, name):
        stored[name] = staged(df, name)
        return stored[name]

    monkeypatch.setattr(ngram_join, "staged", noted)
    monkeypatch.setattr(ngram_join, "FEW", few)
    posts = spark.createDataFrame(
        rows, "token bigint, id bigint, n bigint, heads bigint, shared bigint, label bigint, pivot bigint, rest bigint, of_family boolean")
    got = sorted(tuple(r) for r in ngram_join._group_pairs(posts, 80).collect())
    assert got == sorted([(a, b) for a in range(heads) for b in range(a + 1, heads)] + [(40, 41)])
    assert stored["join-heads"].count() == heads + 6
