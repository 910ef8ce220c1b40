"""Sinks: idempotent CSV extract, multi-table report, rolling state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from impactspark.functions import covers_through
from impactspark.operators import preview, sort_output, worst
from impactspark.sources import (identify, read_report, read_sorted, read_state, write_csv, write_report, write_sorted,
                                 write_state)

from .conftest import rows


def test_write_csv_is_idempotent_and_renders_lists(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"], "src")], "k string, services array<string>, source string")
    out = str(tmp_path / "out")
    write_csv(df, out, single_file=True)
    write_csv(df, out, single_file=True)          # re-run overwrites, never appends
    back = spark.read.option("header", True).option("escape", '"').csv(out)   # quotes are doubled, as other CSV tools write them
    assert back.columns == ["k", "services"]
    assert rows(back) == [("a", '["x","y"]')]


def test_report_create_then_append(spark, tmp_path):
    base = str(tmp_path / "report")
    t = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(RuntimeError):
        write_report({"later": t}, base, create=False, required=["five"])
    write_report({"five": t, "six": t}, base, create=True)
    write_report({"summary": t}, base, create=False, required=["five", "six"])
    assert sorted(read_report(spark, base)) == ["five", "six", "summary"]


def test_a_failed_report_leaves_the_last_version(spark, tmp_path):
    base = str(tmp_path / "report")
    one, two = spark.createDataFrame([(1,)], "n int"), spark.createDataFrame([(2,)], "n int")
    write_report({"a": one, "b": one}, base, create=True)
    broken = two.select(F.raise_error(F.lit("no")).alias("n"))
    with pytest.raises(Exception, match="no"):
        write_report({"a": two, "b": broken}, base, create=True)
    assert {k: rows(v) for k, v in read_report(spark, base).items()} == {"a": [(1,)], "b": [(1,)]}
    write_report({"a": two}, base, create=True)
    assert {k: rows(v) for k, v in read_report(spark, base).items()} == {"a": [(2,)]}


def test_a_rerun_replaces_the_whole_state(spark, tmp_path):
    """A corrected run that no longer has rows for a month removes it; the old version is not read again."""
    path = str(tmp_path / "state")
    schema = StructType([StructField("e", StringType()), StructField("month", StringType())])
    both = spark.createDataFrame([("a", "April"), ("b", "May")], schema)
    may = spark.createDataFrame([("b", "May")], schema)
    assert write_state(both, path) == 1
    assert write_state(may, path) == 2
    assert rows(read_state(spark, path, schema), "e", "month") == [("b", "May")]
    assert rows(read_state(spark, path, schema, before=2), "e", "month") == [("a", "April"), ("b", "May")]
    write_state(may, path, version=2)                       # a retry
    assert rows(read_state(spark, path, schema), "e", "month") == [("b", "May")]
    assert read_state(spark, path, schema, before=1).count() == 0
    assert read_state(spark, str(tmp_path / "nothing"), schema).count() == 0


def test_a_failed_state_leaves_the_last_one(spark, tmp_path):
    path = str(tmp_path / "state")
    schema = StructType([StructField("e", StringType()), StructField("month", StringType())])
    write_state(spark.createDataFrame([("a", "May")], schema), path)
    with pytest.raises(Exception, match="no"):
        write_state(spark.createDataFrame([("b", "May")], schema).withColumn("e", F.raise_error(F.lit("no")).cast("string")), path)
    assert rows(read_state(spark, path, schema), "e") == [("a",)]


def test_identity_does_not_depend_on_the_layout(spark, tmp_path, monkeypatch):
    from impactspark.sources import sinks

    monkeypatch.setattr(sinks, "_EQUAL_ROWS", 4)
    data = [("a", None)] * 11 + [("a", "")] * 2 + [(None, None), ("b", "x")]
    schema = StructType([StructField("e", StringType()), StructField("t", StringType())])
    one = identify(spark.createDataFrame(data, schema).repartition(1))
    many = identify(spark.createDataFrame(data[::-1], schema).repartition(7))
    assert rows(one) == rows(many) and one.count() == len(data)
    assert sorted(r["entry_no"] for r in one.filter("e = 'a' AND t IS NULL").collect()) == list(range(11))
    assert one.select("entry_hash").distinct().count() == 4
    assert identify(spark.createDataFrame([], schema)).count() == 0


def test_survivors_are_the_same_after_the_state_is_laid_out_anew(spark, tmp_path):
    """Two rows of one key that differ in their type only: keep-first picks the same one from any layout."""
    from impactspark.plans import earnings as earn

    day = dt.datetime(2026, 5, 3)
    data = [(f"p{k}@x.org", 10.0, day, "C", None, t, "Gig") for k in range(40) for t in ("Impact gig", "Placement", "Learnership")]
    rich = spark.createDataFrame([("1", "z@y.org", "z@x.org")], "learner_id string, email string, umuzi_email string")
    cfg = earn.EarningsConfig(report_start="2026-04-01", as_of="2026-07-01", covered_through="2026-05-31", fy_start_year=2026,
                              cohort_map={"C": "C"})
    kept = []
    for k, (order, parts) in enumerate(((1, 1), (-1, 6))):
        path = str(tmp_path / f"layout{k}")
        spark.createDataFrame(data[::order], earn.STATE_SCHEMA).repartition(parts).write.parquet(path)
        entries, _ = earn.clean_entries([earn.load_prior(spark, path)], rich, cfg)
        kept.append(rows(entries, "umuzi_email", "earning_opportunity_type"))
    assert kept[0] == kept[1] and len(kept[0]) == 40
    state = str(tmp_path / "state")
    write_state(spark.createDataFrame(data, earn.STATE_SCHEMA).withColumn("month", F.lit("May")), state)
    entries, _ = earn.clean_entries([earn.load_prior(spark, state)], rich, cfg)
    assert len(rows(entries, "umuzi_email")) == 40
    first = rows(entries, "umuzi_email", "earning_opportunity_type")
    spark.read.parquet(f"{state}/v=1").repartition(5).sortWithinPartitions(F.col("payment").desc()).write.partitionBy("month").parquet(f"{state}/v=2")
    spark.createDataFrame([(2, "state", "v=2")], "v bigint, table string, folder string").write.mode("append").partitionBy("v").parquet(f"{state}/_manifest")
    entries, _ = earn.clean_entries([earn.load_prior(spark, state)], rich, cfg)
    assert rows(entries, "umuzi_email", "earning_opportunity_type") == first


def test_sort_output_nulls_last_like_postgres(spark):
    df = spark.createDataFrame([(None,), (2,), (1,)], "d int")
    assert [r[0] for r in sort_output(df, ["d"]).collect()] == [1, 2, None]
    assert [r[0] for r in sort_output(df, ["d"], nulls_first=True).collect()] == [None, 1, 2]


def test_worst_and_preview(spark):
    df = spark.createDataFrame([("Apr", 1.0), ("May", -5.0)], "m string, diff double")
    assert tuple(worst(df, "m", "diff").first()) == ("May", 5.0)
    many = spark.range(500).withColumn("t", F.lit("x"))
    one, two = (rows(preview(many.repartition(n), 9, seed=3)) for n in (1, 7))
    assert one == two and len(one) == 9 and one != rows(preview(many, 9, seed=4))


def test_csv_cells_survive_quotes_and_breaks(spark, tmp_path):
    from impactspark.sources import read_header_csv

    df = spark.createDataFrame([("a", ["x", 'y "z"']), ('b, "c"\nd', None)], "k string, l array<string>")
    write_csv(df, str(tmp_path / "out"))
    back = read_header_csv(spark, str(tmp_path / "out"))
    assert rows(back, "k", "l") == [("a", '["x","y \\"z\\""]'), ('b, "c"\nd', None)]


def test_sorted_files_are_the_sorted_table(spark, tmp_path):
    """A hot key is dealt over several files; equal rows and NULLs keep a defined place."""
    data = [(None if k % 11 == 0 else "hot" if k % 3 == 0 else f"k{k % 50:02d}", k % 7, k) for k in range(600)] + [("hot", 0, 0)] * 3
    df = spark.createDataFrame(data, "k string, n long, id long")
    path = str(tmp_path / "sorted")
    write_sorted(df, path, ["k", "n"], descending=["n"], files=8)
    got = [(r["k"], int(r["n"])) for r in sorted(read_sorted(spark, path).collect(), key=lambda r: r["position"])]
    assert got == sorted(((k, n) for k, n, _ in data), key=lambda t: (t[0] is None, t[0] or "", -t[1]))
    sizes = [r["count"] for r in spark.read.option("header", True).csv(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 250
    first = rows(read_sorted(spark, path))
    write_sorted(df.repartition(5), path, ["k", "n"], descending=["n"], files=8)
    assert rows(read_sorted(spark, path)) == first


def test_a_report_that_breaks_an_error_rule_stays_invisible(spark, tmp_path):
    from impactspark.operators import Check, ValidationError
    from impactspark.operators.quality import ERROR, WARN

    base = str(tmp_path / "report")
    rules = {"a": [Check("s", "positive", F.col("n") <= 0, ERROR, "not positive"), Check("s", "small", F.col("n") > 1, WARN, "large")]}
    good, bad = spark.createDataFrame([(1,), (2,)], "n int"), spark.createDataFrame([(0,), (None,)], "n int")
    table = write_report({"a": good, "b": good}, base, create=True, checks=rules)
    assert rows(table, "check", "status", "offenders") == [("positive", "PASS", 0), ("small", "WARN", 1)]
    assert rows(read_report(spark, base)["written_checks"]) == rows(table)
    with pytest.raises(ValidationError, match=r"positive \(1\)"):
        write_report({"a": bad, "b": bad}, base, create=True, checks=rules)
    assert rows(read_report(spark, base)["a"]) == [(1,), (2,)]
    empty = write_report({"a": good.limit(0)}, base, create=True, checks=rules)
    assert [r["offenders"] for r in empty.collect()] == [0, 0] and read_report(spark, base)["a"].count() == 0


def test_a_check_while_writing_reads_nothing_twice(spark, tmp_path):
    from impactspark.operators import Check, stage_checked

    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(count, "id long")
    table, checks = stage_checked(df, "t", [Check("s", "even", F.col("id") % 2 == 1)])
    assert checks.first()["offenders"] == 500 and table.count() == 1000
    assert reads.value == 1000
    gone = spark.range(10).filter("id > 100")
    assert stage_checked(gone, "t", [Check("s", "none", F.col("id") > 0)])[1].first()["status"] == "PASS"


def test_covers_through():
    assert covers_through("2026-06") == "2026-05-31"
    assert covers_through("2026-03-15") == "2026-02-28"
