"""Smaller operators and loaders not covered elsewhere."""

import pytest
from pyspark.sql import functions as F

from impactspark import functions as fx
from impactspark import operators as op
from impactspark.plans import earnings as earn

from .conftest import rows
from .test_pipelines import rich_frame, write_csv


def test_replace_values_blank_and_floor_div(spark):
    df = spark.createDataFrame([("a@exmaple.org", " ", -7), ("b@x.org", None, 7)], "e string, s string, n int")
    r = df.select(fx.replace_values("e", {"a@exmaple.org": "a@example.org"}).alias("e"),
                  fx.is_blank("s").alias("blank"), fx.floor_div("n", F.lit(2)).alias("q")).collect()
    assert [tuple(x) for x in r] == [("a@example.org", True, -4), ("b@x.org", True, 3)]


def test_enrich_checked_reports_fan_out(spark):
    fact = spark.createDataFrame([("a",), ("b",)], "k string")
    dim = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    out, dups = op.enrich_checked(fact, dim, "k")
    assert rows(dups) == [("a", 2)]
    assert out.count() == 3                      # the guard is what tells you this happened


def test_resolve_ids_dedups_dimension_and_reports_unresolved(spark):
    facts = spark.createDataFrame([("111",), ("222",), ("x@y.org",)], "idn string")
    dim = spark.createDataFrame([("111", "a@x.org", 1), ("111", "b@x.org", 2)], "id_number string, e string, lid int")
    ok, bad = op.resolve_ids(facts, "idn", dim, "id_number", "e", "email", order_col="lid")
    assert rows(ok) == [("111", "b@x.org")]
    assert rows(bad, "idn") == [("222",), ("x@y.org",)]


def test_align_full_fills_zero(spark):
    a = spark.createDataFrame([("Apr", 1.0)], "m string, a double")
    b = spark.createDataFrame([("May", 2.0)], "m string, b double")
    assert rows(op.align_full(a, b, "m", "a", "b")) == [("Apr", 1.0, 0.0), ("May", 0.0, 2.0)]


def test_offenders_and_count_rows(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "id int, v string")
    chk = op.Check("s", "v present", F.col("v").isNull())
    assert [r.id for r in op.offenders(df, chk, limit=1, order=[F.col("id")]).collect()] == [1]
    assert rows(op.count_rows(df, "v")) == [(None, 2), ("x", 1)]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert op.select_contract(df, ["c", "a"]).columns == ["c", "a"]
    with pytest.raises(ValueError):
        op.select_contract(df, ["z"])
    assert op.rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    assert op.drop_if_present(df, ["b", "zz"]).columns == ["a", "c"]
    assert op.all_but(df, ["a"]).columns == ["b", "c"]
    assert op.column_gaps(df, ["a", "q"], allowed=["a", "b"]) == (["q"], ["c"])
    nn = spark.createDataFrame([(1, None), (None, None), (None, 2)], "a int, b int")
    assert op.drop_null_any(nn, ["a"]).count() == 1 and op.drop_null_all(nn, ["a", "b"]).count() == 2


def test_id_keyed_and_partnership_loaders(spark, tmp_path):
    base = str(tmp_path)
    write_csv(f"{base}/finance/sheet=0/f.csv", [
        ["title"], ["#", "ID", "Amount", "Date", "Cohort", "Info", "Name", "Type"],
        ["1", "8001015009087", "R 500", "03/05/2026", "C", "", "Milestone", "Impact gig"],
        ["2", "a@example.org", "100", "04/05/2026", "C", "", "Milestone", "Impact gig"],   # e-mail in id column (T15)
        ["3", "", "100", "04/05/2026", "C", "", "Milestone", "Impact gig"]])
    entries, unresolved = earn.load_id_keyed(spark, f"{base}/finance", "finance", 3, rich_frame(spark),
                                             resolve_emails=False)          # parity: e-mail never resolves
    assert rows(entries, "umuzi_email", "payment") == [("b@example.org", 500.0)]
    assert rows(unresolved, "id_number") == [("a@example.org",)]
    entries, unresolved = earn.load_id_keyed(spark, f"{base}/finance", "finance", 3, rich_frame(spark))
    assert rows(entries, "umuzi_email", "payment") == [("a@example.org", 100.0), ("b@example.org", 500.0)]
    assert unresolved.count() == 0
    for sheet in (0, 1):
        write_csv(f"{base}/partners/sheet={sheet}/f.csv", [
            ["title"], ["#", "Email", "Pay", "Date", "Cohort", "Info", "Type", "Name"],
            ["1", f" p{sheet}@example.org ", " 1,000 ", "05/05/2026", " C ", "", "", "Gig"],
            ["2", "z@example.org", "50", "", "C", "", "", "Gig"],                  # no date: dropped
            ["3", "y@example.org", "50", "06/05/2026", "C", "", "", ""]])           # no type and no name
    p = earn.load_partnerships(spark, f"{base}/partners", "partners", 4, sheets=(0, 1))
    assert rows(p, "umuzi_email", "payment", "cohort") == [("p0@example.org", 1000.0, "C"),
                                                            ("p1@example.org", 1000.0, "C")]


def test_read_state_missing_path_is_empty(spark, tmp_path):
    from impactspark.sources import read_state
    df = read_state(spark, str(tmp_path / "nothing-here"), earn.STATE_SCHEMA)
    assert df.count() == 0 and df.columns == [f.name for f in earn.STATE_SCHEMA.fields]


def test_grid_chain_map_window_interleave(spark):
    import datetime as dt
    df = spark.createDataFrame([("p", 1.0)], "p string, `April (Payment)` double")
    g = op.grid(df, "p", ["April (Payment)", "May (Payment)"], fill=0.0)
    assert g.columns == ["p", "April (Payment)", "May (Payment)"] and tuple(g.first()) == ("p", 1.0, 0.0)
    fact = spark.createDataFrame([(1, 10), (2, 99)], "id int, city int")
    cities = spark.createDataFrame([(10, "Metro")], "cid int, name string")
    out = op.left_chain(fact, [(cities, "city", "cid", {"name": "nearest_metro"})])
    assert rows(out, "id", "nearest_metro") == [(1, "Metro"), (2, None)]
    labels = spark.createDataFrame([("a", "A"), ("a", "A")], "k string, v string")
    mapped = op.join_map(fact.withColumn("k", F.lit("a")), "k", labels, "k", "v", "label")
    assert mapped.count() == 2 and {r.label for r in mapped.collect()} == {"A"}
    ts = spark.createDataFrame([(dt.datetime(2026, 3, 31),), (dt.datetime(2026, 4, 2),), (None,)], "d timestamp_ntz")
    assert op.in_window(ts, "d", "2026-04-01", "2026-07-01").count() == 1
    pairs = spark.createDataFrame([("p", 1, 2, 3, 4)], "p string, v1 int, g1 int, v2 int, g2 int")
    assert op.interleave(pairs, "p", [("v2", "g2"), ("v1", "g1")]).columns == ["p", "v2", "g2", "v1", "g1"]
