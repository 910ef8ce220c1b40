import numpy as np
import pytest

from impactspark.llm import embedding_dedup as E
from impactspark.llm.common import prepare

from .helpers import components

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    good = {}
    for i, e, label in rows:
        if e is None or label is None or not len(e) or any(x is None for x in e):
            continue
        v = np.array(e, np.float32).astype(float)
        if np.isfinite(v).all() and np.linalg.norm(v) > 0:
            good[i] = (label, v / np.linalg.norm(v))
    links = [(a, b) for a in good for b in good if a < b and good[a][0] == good[b][0]
             and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= cosine]
    n = {i: 0 for i, _, _ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = components([i for i, _, _ in rows], links)
    return {i: (n[i], comp[i], comp[i] == i) for i, _, _ in rows}


def vectors(seed, dim, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(2, n // 8), dim))
    out = []
    for i in range(n):
        c = centres[rng.integers(len(centres))] * rng.uniform(0.5, 3)
        out.append((i, [float(x) for x in np.float32(c + rng.normal(size=dim) * rng.choice([0, 0.1, 0.25, 0.4]))], int(rng.integers(3))))
    return out


@pytest.mark.parametrize("dim,n", [(16, 240), (3, 120)])
def test_links_and_components_equal_brute_force(spark, dim, n):
    prepare(spark)
    rows = vectors(dim, dim, n)
    got = E.link_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows)


def test_tiles_and_pair_batches_do_not_change_links(spark, monkeypatch):
    prepare(spark)
    rows = vectors(9, 12, 150)
    monkeypatch.setattr(E, "TILE", 16)
    monkeypatch.setattr(E, "PAIRS", 7)
    got = E.link_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows)


def test_bad_vectors_copies_and_nulls(spark):
    prepare(spark)
    one = [1.0, 0.0, 0.0, 0.0]
    rows = [(1, one, 0), (2, one, 0), (3, [2.0, 0.0, 0.0, 0.0], 0), (4, one, None), (5, None, 0), (6, [0.0] * 4, 0),
            (7, [float("nan"), 1.0, 0.0, 0.0], 0), (8, [float("inf"), 1.0, 0.0, 0.0], 0), (9, [], 0),
            (10, [None, 1.0, 0.0, 0.0], 0), (11, one, 1), (12, [1.0, 0.0], 0), (13, [-1.0, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rep", "2 AS key")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.link_components(df).collect()}
    assert got == brute(rows)
    assert got[1] == (2, 1, True) and got[3] == (2, 1, False)
    null = E.link_components(spark.createDataFrame([(None, one, 0), (2, one, 0)], SCHEMA)).collect()
    assert sorted((r["vec_id"] is None, r["n_links"], r["kept"]) for r in null) == [(False, 0, True), (True, 0, False)]


def test_repeated_rows_and_empty_table(spark):
    prepare(spark)
    df = spark.createDataFrame([(1, [1.0, 0.5], 0), (1, [1.0, 0.5], 0)], SCHEMA)
    assert [(r["n_links"], r["component_id"]) for r in E.link_components(df).collect()] == [(1, 1), (1, 1)]
    assert E.link_components(df.where("vec_id > 5")).count() == 0


def test_blocks_share_the_distance():
    rng = np.random.default_rng(1)
    rot = E.Rotation(rng.normal(size=(200, 20)) * np.linspace(3, 0.1, 20), 20, 0.93)
    assert np.allclose(rot.axes.T @ rot.axes, np.eye(20)) and abs(rot.limit.sum() - 0.14) < 1e-6
    assert rot.cuts[0][0] == 0 and rot.cuts[-1][1] == 20 and (np.diff(rot.limit) <= 0).all()


def test_what_is_written_grows_with_the_input_not_with_a_label(spark, monkeypatch):
    """Vectors are stored once, however many tiles their label has (stored in up to 18 cells each before)."""
    prepare(spark)
    monkeypatch.setattr(E, "TILE", 128)
    stored, real = [], E.staged

    def counted(df, name):
        out = real(df, name)
        stored.append(E.stored_bytes(out))
        return out

    monkeypatch.setattr(E, "staged", counted, raising=False)
    monkeypatch.setattr(E, "stored_bytes", lambda df: int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()), raising=False)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(np.float32(rng.normal(size=(2000, 64))))]
    assert E.link_components(spark.createDataFrame(rows, SCHEMA).repartition(1)).where("kept").count() == 2000
    assert sum(stored) < 2.5 * 2000 * 64 * 4


def test_labels_of_many_tiles_with_text_labels_doubles_and_two_lengths(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(E, "TILE", 32)
    monkeypatch.setattr(E, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(E, "ROWS", 5)
    monkeypatch.setattr(E, "COLUMNS", 9)
    rows = [(i, e, f"l{k % 2}") for i, e, k in vectors(21, 16, 260)]
    rows += [(1000 + i, e, f"l{k % 2}") for i, e, k in vectors(22, 5, 90)]
    rows += [(2000 + i, rows[7][1], "l0") for i in range(40)] + [(3000 + i, rows[i][1], f"own{i}") for i in range(20)]
    got = E.link_components(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got} == brute(rows)
