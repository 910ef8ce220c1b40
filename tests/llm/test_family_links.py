"""A dense family is connected by stars, and not by all links between its members."""

from impactspark.llm import ngram_join
from impactspark.llm.components import connected_components


def test_stars_connect_a_family_in_which_all_link(spark):
    size, n, d = 40, 90, 11
    w = 180 * d - 20 * n
    # one difference that all share (enough to link any two), one with each neighbour, the others their own
    rows = [(0, i + 1, n, d, w, [7, 1000 + i, 1001 + i, *range(10_000 + 8 * i, 10_008 + 8 * i)]) for i in range(size)]
    families = spark.createDataFrame(rows, "pivot bigint, id bigint, n int, d int, w int, delta array<bigint>")
    none = spark.createDataFrame([], "id bigint, component bigint")
    assert ngram_join._far_links(families, none, 80).count() == size * (size - 1) // 2
    stars = ngram_join._far_links(families, none, 80, star=True)
    assert stars.count() <= 3 * size
    known = connected_components(stars)
    assert {r["component"] for r in known.collect()} == {1} and known.count() == size
    assert ngram_join._far_links(families, known, 80).count() == 0


def test_whole_join_lists_few_links_of_a_dense_family(spark, monkeypatch):
    listed = []
    whole = ngram_join._far_links

    def counted(*a, **k):
        out = whole(*a, **k)
        listed.append(k.get("star", False))
        return out

    monkeypatch.setattr(ngram_join, "_far_links", counted)
    words = [f"w{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"x{i}"])) for i in range(6)], "doc_id bigint, text string")
    out = {r["doc_id"]: r["component_id"] for r in ngram_join.link_components(docs).collect()}
    assert listed == [True, False] and set(out.values()) == {0}
