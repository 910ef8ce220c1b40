"""Queries for the report tables: pivots, reconciliation, checks, export."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import (Check, count_lit, pivot, per_key_diff, reconcile,
                         run_checks, split_drops, worst)
from ..operators.quality import ERROR, WARN
from . import model as m
from . import reports as rp
from .catalog import query

FY_START, FY_END = "1996-04-01", "1997-03-31 23:59:59"
_WINDOW_SQL = f"""
win AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         strftime(o_orderdate, '%B') AS month
  FROM orders
  WHERE o_orderdate BETWEEN TIMESTAMP '{FY_START}' AND TIMESTAMP '{FY_END}'
)"""


def _win(t):
    o = t.orders.filter(F.col("o_orderdate").between(F.lit(FY_START).cast("timestamp_ntz"),
                                                     F.lit(FY_END).cast("timestamp_ntz")))
    return o.withColumn("month", fx.month_name("o_orderdate"))


def _q(name):
    return '"' + name + '"'


# ------------------------------------------------------------ RSH-3, AGG-3
def _two_metric_cols(label=lambda mo, me: f"{mo} ({me})", rnd=False):
    cols = []
    for mo in rp.FY_MONTHS:
        pay = (f"CAST(COALESCE(SUM(CASE WHEN month = '{mo}' THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0)"
               f" AS DOUBLE)")
        cnt = f"CAST(COUNT(CASE WHEN month = '{mo}' THEN 1 END) AS BIGINT)"
        if rnd:
            pay, cnt = f"ROUND({pay}, 2)", f"CAST({cnt} AS INTEGER)"
        cols.append(f"{pay} AS {_q(label(mo, 'Payment'))}")
        cols.append(f"{cnt} AS {_q(label(mo, 'Count'))}")
    return ",\n  ".join(cols)


@query("month_pivot_two_metrics", m.with_ctes(_WINDOW_SQL, body=f"""
SELECT o_custkey,
  {_two_metric_cols()}
FROM win GROUP BY o_custkey
"""))
def month_pivot_two_metrics(spark, sf_dir):
    """RSH-3 / AGG-3 (PIPE-10): per person, payment and count for each fiscal month."""
    w = _win(m.Tables(spark, sf_dir))
    return rp.month_pivot(w, "o_custkey", "month",
                          {"Payment": fx.money_sum("o_totalprice"), "Count": count_lit()})


@query("result_export", m.with_ctes(_WINDOW_SQL, body=f"""
SELECT o_custkey,
  {_two_metric_cols(rnd=True)}
FROM win GROUP BY o_custkey
"""))
def result_export(spark, sf_dir):
    """SNK-5: the monthly summary with money rounded to cents and counts as int."""
    return rp.result_export(month_pivot_two_metrics(spark, sf_dir))


# ------------------------------------------------------ RSH-2, WIN-1, PRJ-9
_FIELDS = {"payment": "o_totalprice", "date": "o_orderdate", "type": "o_orderpriority",
           "name": "o_orderstatus"}


def _wide_cols():
    return ",\n  ".join(f"max(CASE WHEN month = '{mo}' THEN {src} END) AS {_q(f'{mo}_{f}')}"
                        for mo in rp.FY_MONTHS for f, src in _FIELDS.items())


@query("entries_wide", m.with_ctes(_WINDOW_SQL, body=f"""
SELECT o_custkey, row_id,
  {_wide_cols()}
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY o_custkey, month ORDER BY o_orderkey) - 1 AS INTEGER)
                AS row_id FROM win)
GROUP BY o_custkey, row_id
"""))
def entries_wide(spark, sf_dir):
    """RSH-2 / WIN-1 / PRJ-9 (PIPE-9): n-th entry per person and month on row n."""
    w = _win(m.Tables(spark, sf_dir)).select(
        "o_custkey", "o_orderkey", "month", *[F.col(s).alias(f) for f, s in _FIELDS.items()])
    return rp.entries_wide(w, "o_custkey", "month", ["o_orderkey"], list(_FIELDS), skew_safe=True)


# ------------------------------------------------------------ RSH-4, RSH-6
# Driver mapping of the breakdown: person = customer, opportunity type =
# order status, opportunity name = order priority, one cohort per person.
_RANKS = (1, 2, 3, 4, 5)
_PARTNER_YEAR = 1996
_BREAKDOWN_SQL = """
entries AS (
  SELECT o_custkey, o_orderstatus AS earning_opportunity_type, o_orderpriority AS name,
         'cohort-' || CAST(o_custkey % 3 AS VARCHAR) AS cohort, o_orderdate, o_totalprice, month
  FROM win
)""", """
numbered AS (
  SELECT o_custkey, earning_opportunity_type, name,
         row_number() OVER (PARTITION BY o_custkey, earning_opportunity_type
                            ORDER BY started, name) AS op_num
  FROM (SELECT o_custkey, earning_opportunity_type, name, min(o_orderdate) AS started
        FROM entries GROUP BY o_custkey, earning_opportunity_type, name)
)""", """
first_dates AS (
  SELECT o_custkey, earning_opportunity_type, min(o_orderdate) AS first_date FROM entries GROUP BY ALL
)""", """
keyed AS (
  SELECT e.*, r.op_num, f.first_date FROM entries e
  JOIN numbered r USING (o_custkey, earning_opportunity_type, name)
  JOIN first_dates f USING (o_custkey, earning_opportunity_type)
)"""


def _ranked_cols(header=lambda h: h):
    cols = []
    for mo in rp.FY_MONTHS:
        for r in _RANKS:
            hit = f"month = '{mo}' AND op_num = {r}"
            cols.append(f"CAST(COALESCE(SUM(CASE WHEN {hit} THEN CAST(o_totalprice AS DECIMAL(18,2)) END), 0)"
                        f" AS DOUBLE) AS {_q(header(rp.value_header(mo, r)))}")
            cols.append(f"CAST(COUNT(CASE WHEN {hit} THEN 1 END) AS BIGINT) AS {_q(header(rp.gig_header(mo, r)))}")
    return ",\n  ".join(cols)


def _ranked_sql(header=lambda h: h):
    return m.with_ctes(_WINDOW_SQL, *_BREAKDOWN_SQL, body=f"""
SELECT o_custkey, first_date AS {_q(header('first_date'))},
  earning_opportunity_type AS {_q(header('earning_opportunity_type'))}, cohort AS {_q(header('cohort'))},
  {_ranked_cols(header)}
FROM keyed
GROUP BY o_custkey, first_date, earning_opportunity_type, cohort
""")


@query("ranked_pivot", _ranked_sql())
def ranked_pivot(spark, sf_dir):
    """RSH-4 / RSH-6 / AGG-9 / WIN-2 (PIPE-11): opportunities numbered by first
    date within (person, type), then value and gig columns per (month, number)."""
    w = _win(m.Tables(spark, sf_dir)).select(
        "o_custkey", F.col("o_orderstatus").alias("earning_opportunity_type"),
        F.col("o_orderpriority").alias("name"),
        F.concat(F.lit("cohort-"), (F.col("o_custkey") % 3).cast("string")).alias("cohort"),
        "o_orderdate", "o_totalprice", "month")
    # rows reduce to one per (person, type, name, cohort, month) map-side, before anything is ranked or joined
    keys = ["o_custkey", "earning_opportunity_type"]
    cells = w.groupBy(*keys, "name", "cohort", "month").agg(
        F.min("o_orderdate").alias("first"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"),
        F.count(F.lit(1)).alias("n"))
    eon = cells.groupBy(*keys, "name").agg(F.min("first").alias("started"))
    span = Window.partitionBy(*keys)
    eon = eon.select(*keys, "name", F.row_number().over(span.orderBy("started", "name")).alias("op_num"),
                     F.min("started").over(span).alias("first_date"))
    j = cells.join(eon, keys + ["name"])
    return rp.ranked_pivot(j, ["o_custkey", "first_date", "earning_opportunity_type", "cohort"],
                           "month", "op_num", F.col("v"), _RANKS, gigs=F.col("n"))


@query("partner_projection", _ranked_sql(lambda h: rp.partner_headers(_PARTNER_YEAR).get(h, h)))
def partner_projection(spark, sf_dir):
    """SNK-4 / PRJ-2 / PRJ-10: the breakdown with partner headers (only
    opportunity 1 of each month carries the year)."""
    return rp.partner_export(ranked_pivot(spark, sf_dir), _PARTNER_YEAR)


# --------------------------------------------------------------- RSH-5, AGG-1
@query("source_month_grid", """
SELECT o_orderpriority AS source,
  """ + ",\n  ".join(f"CAST(COUNT(CASE WHEN strftime(o_orderdate, '%B') = '{mo}' THEN 1 END) AS BIGINT) AS {_q(mo)}"
                     for mo in rp.FY_MONTHS) + """
FROM orders GROUP BY o_orderpriority
""")
def source_month_grid(spark, sf_dir):
    """RSH-5 / AGG-1: rows per source and month, missing = 0."""
    o = m.Tables(spark, sf_dir).orders
    d = o.select(F.col("o_orderpriority").alias("source"), fx.month_name("o_orderdate").alias("month"))
    return pivot(d, "source", "month", list(rp.FY_MONTHS), {"n": count_lit()},
                 name=lambda mo, _: mo, fill=0)


# ------------------------------------------------------------ REC-1/2, JN-11
_REC_SQL = """
a AS (
  SELECT date_trunc('month', o_orderdate) AS month,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v, CAST(count(*) AS BIGINT) AS n
  FROM orders GROUP BY 1
),
parts AS (
  SELECT o_custkey, o_orderpriority, date_trunc('month', o_orderdate) AS month,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS v, count(*) AS n
  FROM orders WHERE o_orderkey % 50 <> 0 GROUP BY ALL
),
b AS (SELECT month, CAST(SUM(v) AS DOUBLE) AS v, CAST(SUM(n) AS BIGINT) AS n FROM parts GROUP BY month)"""


def _rec_sides(t):
    o = t.orders.withColumn("month", fx.month_bucket("o_orderdate"))
    a = o.groupBy("month").agg(fx.money_sum("o_totalprice").alias("v"), F.count(F.lit(1)).alias("n"))
    parts = (o.filter(F.col("o_orderkey") % 50 != 0)
              .groupBy("o_custkey", "o_orderpriority", "month")
              .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"), F.count(F.lit(1)).alias("n")))
    b = parts.groupBy("month").agg(F.sum("v").cast("double").alias("v"), F.sum("n").alias("n"))
    return a, b


@query("reconcile_months", m.with_ctes(_REC_SQL, body="""
SELECT COALESCE(a.month, b.month) AS month,
  COALESCE(a.v, 0.0) AS a_value, COALESCE(b.v, 0.0) AS b_value,
  COALESCE(a.n, 0) AS a_count, COALESCE(b.n, 0) AS b_count,
  ROUND(COALESCE(a.v, 0.0) - COALESCE(b.v, 0.0), 2) AS diff,
  abs(COALESCE(a.v, 0.0) - COALESCE(b.v, 0.0)) <= 0.01 AND COALESCE(a.n, 0) = COALESCE(b.n, 0) AS ok
FROM a FULL OUTER JOIN b ON a.month = b.month
"""))
def reconcile_months(spark, sf_dir):
    """REC-1 / JN-11: monthly totals vs the roll-up of a 3-key breakdown that
    excludes stipend rows; per month the difference and an ok flag."""
    a, b = _rec_sides(m.Tables(spark, sf_dir))
    return reconcile(a, b, "month", "v", count="n").select(
        "month", "a_value", "b_value", "a_count", "b_count", "diff", "ok")


@query("worst_month", m.with_ctes(_REC_SQL, body="""
SELECT arg_max(month, abs(diff)) AS month, max(abs(diff)) AS max_abs_diff FROM (
  SELECT COALESCE(a.month, b.month) AS month,
         ROUND(COALESCE(a.v, 0.0) - COALESCE(b.v, 0.0), 2) AS diff
  FROM a FULL OUTER JOIN b ON a.month = b.month)
"""))
def worst_month(spark, sf_dir):
    """SRT-6: the month with the largest reconciliation difference."""
    return worst(reconcile_months(spark, sf_dir), "month", "diff")


@query("per_person_diff", m.with_ctes(_REC_SQL, """
bad AS (
  SELECT COALESCE(a.month, b.month) AS month FROM a FULL OUTER JOIN b ON a.month = b.month
  ORDER BY abs(ROUND(COALESCE(a.v, 0.0) - COALESCE(b.v, 0.0), 2)) DESC, 1 LIMIT 1
)""", """
sums AS (
  SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS a_value,
    CAST(SUM(CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS b_value
  FROM orders JOIN bad ON date_trunc('month', o_orderdate) = bad.month GROUP BY o_custkey
)""", body="""
SELECT o_custkey, a_value, b_value, ROUND(a_value - b_value, 2) AS diff FROM sums WHERE abs(a_value - b_value) > 0.005
"""))
def per_person_diff(spark, sf_dir):
    """REC-2: people whose two totals differ by more than half a cent, in the month that reconciles worst."""
    t = m.Tables(spark, sf_dir)
    month = worst_month(spark, sf_dir).select("month")
    o = t.orders.withColumn("month", fx.month_bucket("o_orderdate")).join(F.broadcast(month), "month")   # one row
    a = o.groupBy("o_custkey").agg(fx.money_sum("o_totalprice").alias("v"))
    b = o.filter(F.col("o_orderkey") % 50 != 0).groupBy("o_custkey").agg(fx.money_sum("o_totalprice").alias("v"))
    return per_key_diff(a, b, "o_custkey", "v", tol=0.005)


# ---------------------------------------------------------------- DQ-1..4
_CHECKS = (
    ("orders", "order date present", "o_orderdate IS NULL", ERROR, "rows without an order date"),
    ("orders", "no future dates", "o_orderdate > TIMESTAMP '2001-06-01'", ERROR, "dates after the as-of day"),
    ("orders", "price positive", "o_totalprice IS NULL OR o_totalprice <= 0", ERROR, "non-positive totals"),
    ("orders", "status settled", "o_orderstatus NOT IN ('F', 'O')", WARN, "pending orders present"),
    ("orders", "within period", "o_orderdate < TIMESTAMP '1995-06-01'", WARN, "dates before the period"),
    ("customers", "segment present", "c_mktsegment IS NULL", WARN, "customers without a segment"),
)


def _check_sql():
    parts = []
    for stage, name, pred, level, detail in _CHECKS:
        table = "orders" if stage == "orders" else "customer"
        n = f"CAST(count_if(COALESCE({pred}, FALSE)) AS BIGINT)"
        parts.append(
            f"SELECT '{stage}' AS stage, '{name}' AS \"check\", "
            f"CASE WHEN {n} = 0 THEN 'PASS' WHEN '{level}' = 'error' THEN 'FAIL' ELSE 'WARN' END AS status, "
            f"'{level}' AS level, CASE WHEN {n} = 0 THEN '' ELSE '{detail}' END AS detail, "
            f"{n} AS offenders FROM {table}")
    return "\nUNION ALL\n".join(parts)


@query("check_summary", _check_sql())
def check_summary(spark, sf_dir):
    """DQ-1/2: the check table -- one aggregate per checked frame."""
    t = m.Tables(spark, sf_dir)
    frames = {"orders": t.orders, "customers": t.customer}
    out = None
    for stage, frame in frames.items():
        specs = [Check(s, n, F.expr(p.replace("TIMESTAMP '", "TIMESTAMP_NTZ '")), lv, d)
                 for s, n, p, lv, d in _CHECKS if s == stage]
        r = run_checks(frame, specs)
        out = r if out is None else out.unionByName(r)
    return out


_DROP_RULES = (
    ("future date", "o_orderdate > TIMESTAMP '2001-06-01'"),
    ("pending", "o_orderstatus = 'P'"),
    ("low priority", "o_orderpriority = '5-LOW'"),
)


@query("drop_log", """
SELECT reason, o_orderstatus, CAST(count(*) AS BIGINT) AS n_dropped FROM (
  SELECT o_orderstatus, CASE """ + " ".join(f"WHEN {p} THEN '{r}'" for r, p in _DROP_RULES) + """ END AS reason
  FROM orders)
WHERE reason IS NOT NULL
GROUP BY reason, o_orderstatus
""")
def drop_log(spark, sf_dir):
    """DQ-4: every dropped row counted by its first matching reason and status."""
    o = m.Tables(spark, sf_dir).orders
    rules = [(r, F.expr(p.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))) for r, p in _DROP_RULES]
    _, log = split_drops(o, rules, by=["o_orderstatus"])
    return log
