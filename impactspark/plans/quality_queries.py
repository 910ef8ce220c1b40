"""Checks, guards and exports (DQ-1/3, JN-3, SNK-1/2, SRT-1..7) and the plain cell rules that only builders use."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import (Check, ValidationError, column_gaps, drop_if_present, drop_null_all, drop_null_any, enrich_counted,
                         offenders_by_check, preview, union_all)
from ..operators.quality import ERROR, WARN
from ..session import stage_folder
from ..sources import read_report, read_sorted, write_csv, write_report, write_sorted, write_template
from . import consolidated as cons
from . import model as m
from .catalog import query

_RULES = (("total is not negative", "o_totalprice < 0", ERROR), ("total is above one thousand", "o_totalprice < 1000", WARN),
          ("order is dated before 1999", "o_orderdate >= TIMESTAMP '1999-01-01'", WARN),
          ("status is final", "o_orderstatus = 'P'", WARN), ("urgent orders are large", "o_orderpriority = '1-URGENT' AND o_totalprice < 50000", WARN))


def _checks(level=None):
    return [Check("orders", n, F.expr(rule.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")), level or lv, f"rows against: {n}")
            for n, rule, lv in _RULES]


@query("checked_report", f"""
WITH rules AS (
  {" UNION ALL ".join(f"SELECT '{n}' AS name, '{lv}' AS level, count(*) FILTER ({rule}) AS offenders FROM orders" for n, rule, lv in _RULES)})
SELECT 'first' AS attempt, name AS "check", CASE WHEN offenders = 0 THEN 'PASS' WHEN level = 'error' THEN 'FAIL' ELSE 'WARN' END AS status,
  offenders, (SELECT count(*) FROM orders) AS visible_rows, 'first' AS visible FROM rules
UNION ALL
SELECT 'second', name, CASE WHEN offenders = 0 THEN 'PASS' ELSE 'FAIL' END, offenders, (SELECT count(*) FROM orders), 'first'
FROM rules WHERE (SELECT sum(offenders) FROM rules) > 0
""")
def checked_report(spark, sf_dir):
    """DQ-1 / DQ-3 / SNK-2: a report whose checks the writing jobs count; one that breaks an error rule stays invisible.

    The first version has warnings only; the second makes every rule an
    error and is refused, so readers still see the first.
    """
    orders = m.Tables(spark, sf_dir).orders
    base = stage_folder(spark, "report")
    table = lambda name: {"orders": orders.withColumn("version", F.lit(name))}
    first = write_report(table("first"), base, create=True, checks={"orders": _checks()})
    refused = None
    try:
        write_report(table("second"), base, create=True, checks={"orders": _checks(ERROR)})
    except ValidationError as e:
        refused = e.table
    tables = read_report(spark, base)
    seen = tables["orders"].agg(F.count(F.lit(1)).alias("n"), F.max("version").alias("v")).first()      # the report as readers see it
    rows = tables["written_checks"].select(F.lit("first").alias("attempt"), "check", "status", "offenders")
    assert first is not None
    if refused is not None:
        rows = rows.unionByName(refused.select(F.lit("second").alias("attempt"), "check", "status", "offenders"))
    return rows.withColumns({"visible_rows": F.lit(seen["n"]).cast("bigint"), "visible": F.lit(seen["v"])})


@query("fan_out_guard", """
WITH dim AS (
  SELECT c_custkey AS k, c_mktsegment AS segment FROM customer
  UNION ALL SELECT c_custkey, 'again' FROM customer WHERE c_custkey % 97 = 0),
j AS (SELECT count(*) AS rows_after FROM orders LEFT JOIN dim ON k = o_custkey)
SELECT k AS o_custkey, count(*) AS n, (SELECT count(*) FROM orders) AS rows_before, (SELECT rows_after FROM j) AS rows_after
FROM dim WHERE k IN (SELECT o_custkey FROM orders) GROUP BY k HAVING count(*) > 1
""")
def fan_out_guard(spark, sf_dir):
    """JN-3: a dimension with repeated keys; rows counted by the join's own job, the keys named because they differ."""
    t = m.Tables(spark, sf_dir)
    c = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))
    dim = c.unionByName(c.filter("k % 97 = 0").withColumn("segment", F.lit("again")))
    got = enrich_counted(t.orders.select("o_orderkey", "o_custkey"), dim, "o_custkey", "k")
    none = spark.createDataFrame([], "o_custkey bigint, n bigint")
    return (none if got.repeated is None else got.repeated).select(
        "o_custkey", "n", F.lit(got.rows_before).cast("bigint").alias("rows_before"), F.lit(got.rows_after).cast("bigint").alias("rows_after"))


_SORTED = ("o_orderkey", "note", "day", "o_orderpriority")


@query("ordered_export", """
WITH x AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority || ', "' || o_orderstatus || '"' END AS note,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, o_orderpriority FROM orders)
SELECT row_number() OVER (ORDER BY note ASC NULLS LAST, day DESC NULLS LAST, o_orderkey) AS position,
  o_orderkey::VARCHAR AS o_orderkey, note, day, o_orderpriority FROM x
""")
def ordered_export(spark, sf_dir):
    """SRT-1..3 / SNK-1 / RSH: a globally sorted extract as numbered files, read back with its positions."""
    o, k = m.Tables(spark, sf_dir).orders, F.col("o_orderkey")
    df = o.select(k, F.when(k % 7 != 0, F.concat("o_orderpriority", F.lit(', "'), "o_orderstatus", F.lit('"'))).alias("note"),
                  F.when(k % 5 != 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"), "o_orderpriority",
                  F.lit("kept inside").alias("source"))
    path = f"{stage_folder(spark, 'export')}/sorted"
    write_sorted(df, path, ["note", "day", "o_orderkey"], descending=["day"], files=6)
    return read_sorted(spark, path).select("position", *_SORTED)


@query("check_offenders", f"""
WITH broken AS (
  {" UNION ALL ".join(f"SELECT '{n}' AS name, o_orderkey, o_totalprice FROM orders WHERE {rule}" for n, rule, _ in _RULES)})
SELECT name AS "check", row_number() OVER (PARTITION BY name ORDER BY md5(o_orderkey::VARCHAR)) AS place, o_orderkey, o_totalprice
FROM broken QUALIFY place <= 20
""")
def check_offenders(spark, sf_dir):
    """DQ-3 / SRT-5 / SRT-7: twenty offenders of every check in one pass, the same on any partitioning."""
    o = m.Tables(spark, sf_dir).orders
    return offenders_by_check(o, _checks(), 20, F.md5(F.col("o_orderkey").cast("string"))).select(
        "check", F.col("place").cast("bigint").alias("place"), "o_orderkey", "o_totalprice")


@query("review_preview", """
SELECT o_orderkey FROM orders ORDER BY md5('7:{"o_orderkey":' || o_orderkey::VARCHAR || '}') LIMIT 25
""")
def review_preview(spark, sf_dir):
    """SRT-7: a seeded sample of a fixed size for human review (its limit is the feature)."""
    return preview(m.Tables(spark, sf_dir).orders.select("o_orderkey"), 25, seed=7)


_CELLS_SQL = """
cells AS (
  SELECT event_id AS k, user_id AS u, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS a,
    CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN '' WHEN event_id % 4 = 2 THEN ' ' || chr(160) ELSE 'b' END AS b, ts
  FROM events)"""


def _cells(t):
    k = F.col("event_id")
    return t.events.select(k.alias("k"), F.col("user_id").alias("u"), F.when(k % 3 != 0, F.col("event_type")).alias("a"),
                           F.when(k % 4 == 1, "").when(k % 4 == 2, "  ").when(k % 4 == 3, "b").alias("b"), "ts")


@query("null_filters", m.with_ctes(_CELLS_SQL, body="""
SELECT 'any' AS rule, k, a, b, NULL::VARCHAR AS gap FROM cells WHERE a IS NOT NULL AND b IS NOT NULL
UNION ALL SELECT 'all', k, a, b, NULL FROM cells WHERE a IS NOT NULL OR b IS NOT NULL
UNION ALL SELECT 'blank', k, a, b, NULL FROM cells WHERE coalesce(regexp_replace(b, '[\\s\\x{00A0}]', '', 'g'), '') = ''
UNION ALL SELECT 'gap', k, NULL, NULL, unnest(['missing c', 'extra b']) FROM (SELECT min(k) AS k FROM cells)
"""))
def null_filters(spark, sf_dir):
    """FLT-1 / FLT-2 / STR-11 / PRJ-4 / SET-3: rows without gaps, rows that are not empty, blank cells, column gaps."""
    df = drop_if_present(_cells(m.Tables(spark, sf_dir)), ["u", "ts", "never there"])
    missing, extra = column_gaps(df, ["k", "a", "c"], ["k", "a", "c"])
    none = F.lit(None).cast("string")
    parts = [drop_null_any(df, ["a", "b"]).select(F.lit("any").alias("rule"), "k", "a", "b", none.alias("gap")),
             drop_null_all(df, ["a", "b"]).select(F.lit("all").alias("rule"), "k", "a", "b", none.alias("gap")),
             df.filter(fx.is_blank("b")).select(F.lit("blank").alias("rule"), "k", "a", "b", none.alias("gap"))]
    gaps = [f"missing {c}" for c in missing] + [f"extra {c}" for c in extra]
    first = df.agg(F.min("k").alias("k")).select(F.lit("gap").alias("rule"), "k", none.alias("a"), none.alias("b"),
                                                 F.explode(F.array(*[F.lit(g) for g in gaps])).alias("gap"))
    return union_all([*parts, first])


_CORRECTIONS = {"click": "tap", "view": "look", "error": "view"}
_RUN_MONTH = "2024-02"


@query("cell_rules", m.with_ctes(_CELLS_SQL, body="""
SELECT k, CASE k % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M') || ':00' WHEN 1 THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS stamp,
  CASE a WHEN 'click' THEN 'tap' WHEN 'view' THEN 'look' WHEN 'error' THEN 'view' ELSE a END AS corrected,
  CASE WHEN a IS NULL OR b IS NULL THEN 'person ' || u::VARCHAR ELSE a || ' ' || b END AS name,
  CASE WHEN coalesce(u % 2 = 0, FALSE) THEN 'even' ELSE 'odd' END AS label,
  ts::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-31' AS in_days,
  ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-31' AS in_instants,
  ts::DATE <= DATE '2024-01-31' AS covered
FROM cells
"""))
def cell_rules(spark, sf_dir):
    """STR-6 / STR-7 / STR-10 / CASE-2 / FLT-4 / DT-9: completed times, corrections, names with a fallback, labels,
    a period with and without its last day, and what the prior state covers."""
    df, k = _cells(m.Tables(spark, sf_dir)), F.col("k")
    typed = (F.when(k % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm")).when(k % 3 == 1, F.date_format("ts", "yyyy-MM-dd"))
             .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return df.select(
        "k", fx.complete_seconds(typed).alias("stamp"), fx.replace_values("a", _CORRECTIONS).alias("corrected"),
        fx.full_name("a", "b", F.concat(F.lit("person "), F.col("u").cast("string"))).alias("name"),
        fx.flag_label(F.col("u") % 2 == 0, "even", "odd").alias("label"),
        fx.in_period("ts", "2024-01-10", "2024-01-31").alias("in_days"),
        fx.in_period("ts", "2024-01-10", "2024-01-31", whole_last_day=False).alias("in_instants"),
        fx.in_period("ts", "1900-01-01", fx.covers_through(_RUN_MONTH)).alias("covered"))


@query("list_export", """
SELECT user_id::VARCHAR AS user_id, '[' || array_to_string(list_transform(list_sort(list_distinct(list(event_type))),
  lambda x: '"' || x || '"'), ',') || ']' AS kinds, count(*)::VARCHAR AS n
FROM events GROUP BY user_id
""")
def list_export(spark, sf_dir):
    """JSON-1 / SNK-1: an extract whose list cells are JSON text, written and read back."""
    e = m.Tables(spark, sf_dir).events
    df = e.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("kinds"), F.count(F.lit(1)).alias("n"))
    path = f"{stage_folder(spark, 'export')}/lists"
    write_csv(df.withColumn("source", F.lit("internal")), path)
    from ..sources import read_header_csv
    return read_header_csv(spark, path).select("user_id", "kinds", "n")


@query("contract_load", m.with_ctes("""
x AS (SELECT event_id, 'c' || user_id::VARCHAR || '@learn.example.org' AS umuzi_email, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events)""",
                                    body="""
SELECT 'row' AS part, umuzi_email, event_type AS service_used, day AS date_service_accessed, NULL::VARCHAR AS "check", 1::BIGINT AS n
FROM x WHERE event_id % 2 = 0
UNION ALL SELECT 'check', NULL, NULL, NULL, c, CASE c WHEN 'db: columns beyond the contract' THEN 2 ELSE 0 END
FROM (SELECT unnest(['db: at least one row was read', 'db: columns beyond the contract']) AS c)
UNION ALL SELECT 'refused', NULL, NULL, NULL, 'service_name', 1
"""))
def contract_load(spark, sf_dir):
    """LD-15 / SET-3: an extract with columns beyond the contract is read without them; one that lacks a column is refused."""
    e = m.Tables(spark, sf_dir).events.filter("event_id % 2 = 0")
    cells = {"umuzi_email": F.concat(F.lit("c"), F.col("user_id").cast("string"), F.lit("@learn.example.org")),
             "service_used": F.col("event_type"), "date_service_accessed": F.date_format("ts", "yyyy-MM-dd")}
    names = [*cons.IND7_COLS, "mood", "weather"]
    base, none = stage_folder(spark, "contract"), F.lit(None).cast("string")
    row = [cells.get(c, none if c in cons.IND7_COLS else F.lit("x")).alias(f"c{i}") for i, c in enumerate(names)]
    write_template(e.select(*row), f"{base}/db", (",".join(names),), 3)
    short = [c for c in cons.IND7_COLS if c != "service_name"]
    write_template(e.select(*[cells.get(c, none).alias(f"c{i}") for i, c in enumerate(short)]), f"{base}/short", (",".join(short),), 1)
    df, checks = cons.load_ind7(spark, f"{base}/db", "db", 1)
    try:
        cons.load_ind7(spark, f"{base}/short", "short", 2)
        refused = []
    except ValueError as err:
        refused = [c for c in cons.IND7_COLS if f"'{c}'" in str(err)]
    text = lambda c: none.alias(c)
    return union_all([
        df.select(F.lit("row").alias("part"), "umuzi_email", "service_used", "date_service_accessed", text("check"), F.lit(1).cast("bigint").alias("n")),
        checks.select(F.lit("check").alias("part"), text("umuzi_email"), text("service_used"), text("date_service_accessed"), "check",
                      F.col("offenders").alias("n")),
        spark.createDataFrame([("refused", c, 1) for c in refused], "part string, check string, n bigint").select(
            "part", text("umuzi_email"), text("service_used"), text("date_service_accessed"), "check", "n")])
