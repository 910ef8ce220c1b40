import random

import numpy as np
import pytest

from impactspark.llm import ngram_join as J
from impactspark.llm.common import prepare
from impactspark.llm.components import connected_components
from impactspark.llm.texthash import shingle_sets

from .helpers import DOCS, components, docs, jaccard_links, shingles, words


def corpus(seed, families=12, copies=6):
    """Families of near copies, exact copies, shared passages and unrelated texts."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    out = [None, "", "   ", "one two", "One  Two", "one two three four five", "x"]
    for _ in range(families):
        base = words(rng, rng.randrange(8, 120))
        for _ in range(rng.randrange(1, copies)):
            own = list(base)
            for _ in range(rng.randrange(5)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                own += passage
            out.append(" ".join(own) if rng.random() < 0.8 else "\t".join(own).upper())
    rng.shuffle(out)
    return out


def test_hashed_sets_match_real_ones():
    texts = corpus(0, 40)
    for t, s in zip(texts, shingle_sets([t or "" for t in texts]), strict=True):
        assert len(s) == len(shingles(t)) and (np.diff(s.astype(object)) > 0).all()
    a, b = shingle_sets(["A b  c\nd e f", "a B c d e f"])
    assert (a == b).all()
    assert not set(shingle_sets(["a b c d e"])[0].tolist()) & set(shingle_sets(["a b c d"])[0].tolist())


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    prepare(spark)
    texts = dict(enumerate(corpus(seed, 25)))
    got = {r["doc_id"]: r for r in J.link_components(docs(spark, list(texts.values()))).collect()}
    want = components(texts, jaccard_links(texts))
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(shingles(t)) for i, t in texts.items()}


def test_links_that_the_first_pass_leaves_out_are_found(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(J, "FIRST_SHARE", 10.0)  # the first pass makes no pairs
    monkeypatch.setattr(J, "BROADCAST_BYTES", 0)
    texts = dict(enumerate(corpus(5, 15)))
    got = {r["doc_id"]: r["component_id"] for r in J.link_components(docs(spark, list(texts.values()))).collect()}
    assert got == components(texts, jaccard_links(texts))


def near_family(n, seed=1, size=100, changes=3):
    """Distinct near copies: one to three of a hundred words changed."""
    rng = random.Random(seed)
    base, out = [f"b{i}" for i in range(size)], {}
    while len(out) < n:
        own = list(base)
        for _ in range(rng.randrange(1, changes + 1)):
            own[rng.randrange(size)] = f"n{rng.randrange(10**9)}"
        out[" ".join(own)] = None
    return list(out)


def test_a_family_costs_pairs_in_proportion(spark, monkeypatch):
    """Pairs, sets that are read again and edges of distinct near copies grow with their number, not its square."""
    prepare(spark)
    made, real = {}, J.staged

    def counted(df, name):
        out = real(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(J, "staged", counted)
    seen = {}
    for n in (400, 1600):
        made.clear()
        texts = dict(enumerate(near_family(n)))
        got = {r["doc_id"]: r["component_id"] for r in J.link_components(docs(spark, list(texts.values()))).collect()}
        if n == 400:
            assert got == components(texts, jaccard_links(texts))
        seen[n] = dict(made)
    for name in ("join-pairs", "join-sets", "join-links", "join-delta-pairs"):
        assert seen[1600][name] < 10 * seen[400][name], name
    assert sum(seen[1600][k] for k in ("join-pairs", "join-sets", "join-links", "join-delta-pairs")) < 20 * 1600


@pytest.mark.parametrize("direct", [1, 2])
def test_families_alone_find_all_links(spark, monkeypatch, direct):
    """With hardly any list paired directly, every link comes through differences from a pivot."""
    prepare(spark)
    monkeypatch.setattr(J, "DIRECT", direct)
    texts = dict(enumerate(corpus(11, 20) + near_family(60, 5, 40, 6) + near_family(40, 6, 30, 9)))
    got = {r["doc_id"]: r["component_id"] for r in J.link_components(docs(spark, list(texts.values()))).collect()}
    assert got == components(texts, jaccard_links(texts))


def test_groups_of_equal_prefixes_are_expanded(spark):
    """Sets of one prefix and size that differ behind it: only their head is in the lists."""
    prepare(spark)
    rng = random.Random(9)
    texts = []
    for f in range(4):
        head, tail = [f"h{f}x{k}" for k in range(30)], [f"t{f}x{k}" for k in range(120)]
        for _ in range(12):
            own = head + list(tail)
            for _ in range(rng.randrange(6)):
                own[30 + rng.randrange(120)] = f"t{f}x{rng.randrange(120)}"
            texts.append(" ".join(own))
    texts = dict(enumerate(texts))
    got = {r["doc_id"]: r["component_id"] for r in J.link_components(docs(spark, list(texts.values()))).collect()}
    assert got == components(texts, jaccard_links(texts))


def test_one_document_of_each_group_stays_with_all_columns(spark):
    prepare(spark)
    base = [f"w{i}" for i in range(60)]
    near = base[:-1] + ["other"]
    rows = [(5, " ".join(base)), (3, " ".join(near)), (None, " ".join(base)), (9, None), (None, None), (7, "alone here")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS).selectExpr("*", "1 AS _id", "2 AS rep")
    out = J.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in out.select("doc_id").collect() if r["doc_id"]) == \
        [(False, 3), (False, 7), (False, 9)]
    assert out.where("doc_id is null").count() == 2


def test_repeated_rows_and_empty_table(spark):
    prepare(spark)
    text = " ".join(f"w{i}" for i in range(30))
    df = docs(spark, [text, "other words"])
    got = J.link_components(df.unionByName(df)).collect()
    assert len(got) == 4 and all(r["component_id"] == r["doc_id"] for r in got)
    assert J.link_components(docs(spark, [])).count() == 0


def test_connected_components(spark):
    prepare(spark)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 30)] + [(rng.randrange(40, 90), rng.randrange(40, 90)) for _ in range(40)]
    df = spark.createDataFrame([*links, (5, 5), (None, 3), (1, 0)], "u long, v long")
    want = {i: c for i, c in components(range(100), links).items() if any(i in e and e[0] != e[1] for e in links)}
    assert {r["id"]: r["component"] for r in connected_components(df).collect()} == want
    assert connected_components(df.where("u > 1000")).count() == 0


def crossed_groups(f, head=5, common=20, tail=75, fillers=4):
    """Two groups of two sets with one prefix each: the heads link, and so do the others, but no group within itself."""
    part = lambda name, n: [f"{name}{f}x{k}" for k in range(n)]
    p, q, c, x, y = part("p", head), part("q", head), part("c", common), part("x", tail), part("y", tail)
    out = [p + c + x, q + c + x, p + c + y, q + c + y]
    # the tails are frequent, so that the prefixes do not hold them
    out += [part(f"f{k}", 300) + c[-4:] + x + part(f"g{k}", 300) + c[-4:] + y for k in range(fillers)]
    return [" ".join(t) for t in out]


def test_groups_whose_heads_are_connected_still_link_their_other_sets(spark):
    """Sets that are not heads linked with nothing where the heads of their lists were connected already."""
    prepare(spark)
    texts = dict(enumerate(t for f in range(3) for t in crossed_groups(f)))
    got = {r["doc_id"]: r["component_id"] for r in J.link_components(docs(spark, list(texts.values()))).collect()}
    want = components(texts, jaccard_links(texts))
    assert want[2] == want[3] == 2 and want[0] == want[1] == 0
    assert {i: got[i] for i in range(4)} == {i: want[i] for i in range(4)}
    assert got == want
