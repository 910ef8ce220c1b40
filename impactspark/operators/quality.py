"""Data-quality checks, drop logs and reconciliation (DQ-1..4, REC-1/2).

Every check over a frame is one ``count_if`` inside a single aggregate, so
a whole catalogue costs one pass -- or none: ``observed`` attaches the counts
to a frame, and the job that writes it collects them (``measured``).  The
check table is a DataFrame; the only driver-side steps are ``gate``, which
reads the (few) failed check rows, and the counts of a written frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage_table
from ._keys import listify

ERROR, WARN, REPORT = "error", "warn", "report"


@dataclass(frozen=True)
class Check:
    """DQ-1: a named rule; ``offending`` is true for every row that breaks it."""
    stage: str
    name: str
    offending: Column
    level: str = ERROR
    detail: str = ""


class ValidationError(AssertionError):
    """A failed gate; ``table`` is the check table it stood before."""

    def __init__(self, message: str, table: DataFrame | None = None):
        super().__init__(message)
        self.table = table


def run_checks(df: DataFrame, checks) -> DataFrame:
    """DQ-1/DQ-2: evaluate all checks in one aggregate -> check table.

    Columns: stage, check, status (PASS/FAIL/WARN), level, detail, offenders.
    """
    checks = list(checks)
    counts = df.agg(*[F.count_if(F.coalesce(c.offending, F.lit(False))).alias(f"c{i}")
                      for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.stage).alias("stage"), F.lit(c.name).alias("check"),
                              F.lit(c.level).alias("level"), F.lit(c.detail).alias("detail_text"),
                              F.col(f"c{i}").cast("bigint").alias("offenders"))
                     for i, c in enumerate(checks)])
    t = counts.select(F.inline(rows))
    status = (F.when(F.col("offenders") == 0, F.lit("PASS"))
               .when(F.col("level") == ERROR, F.lit("FAIL")).otherwise(F.lit("WARN")))
    return t.select("stage", "check", status.alias("status"), "level",
                    F.when(F.col("offenders") == 0, F.lit("")).otherwise(F.col("detail_text")).alias("detail"),
                    "offenders")


CHECK_SCHEMA = "stage string, check string, status string, level string, detail string, offenders bigint"


def observed(df: DataFrame, checks) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also counts its rows and every check's offenders.

    Observe the frame that is written: its last stage counts each row once,
    also when tasks are tried again.
    """
    seen = Observation()
    counts = [F.count_if(F.coalesce(c.offending, F.lit(False))).alias(f"c{i}") for i, c in enumerate(checks)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def counts_of(seen: Observation) -> dict:
    """What an observed frame's action counted; empty where the optimizer left the frame out, as it does when it has no rows."""
    try:
        return seen.get
    except Py4JJavaError:
        return {}


def measured(spark: SparkSession, seen: Observation, checks) -> DataFrame:
    """DQ-1: the check table of an observed frame whose action has run; nothing is read."""
    got, rows = counts_of(seen), []
    for i, c in enumerate(checks):
        n = int(got.get(f"c{i}") or 0)
        status = "PASS" if not n else "FAIL" if c.level == ERROR else "WARN"
        rows.append((c.stage, c.name, status, c.level, c.detail if n else "", n))
    return spark.createDataFrame(rows, CHECK_SCHEMA)


def stage_checked(df: DataFrame, name: str, checks) -> tuple[DataFrame, DataFrame]:
    """``df`` stored (see ``session.stage_table``) and its check table, measured by the job that stores it."""
    checks = list(checks)
    watched, seen = observed(df, checks)
    return stage_table(watched, name), measured(df.sparkSession, seen, checks)


def row_hash(df: DataFrame, seed: int = 0) -> Column:
    """An order of a frame's rows that no partitioning changes: a hash of their content."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def offenders(df: DataFrame, check: Check, limit: int = 20, order=None) -> DataFrame:
    """DQ-3 / SRT-5: ``limit`` offending rows, the first in ``order`` (by content when none is given)."""
    order = listify(order) if order is not None else [row_hash(df)]
    return df.filter(F.coalesce(check.offending, F.lit(False))).orderBy(*order).limit(limit)


def offenders_by_check(df: DataFrame, checks, limit: int = 20, order: Column | None = None) -> DataFrame:
    """DQ-3 / SRT-5: ``limit`` offending rows of every check in one pass, with ``check`` and ``place``.

    A row is handed out once for each check that it breaks; every task keeps
    its first ``limit`` of a check before they are exchanged (a partial group
    limit), so a check that a third of all rows break costs no more.
    """
    own = row_hash(df) if order is None else order
    broken = F.array_compact(F.array(*[F.when(F.coalesce(c.offending, F.lit(False)), F.lit(c.name)) for c in checks]))
    each = df.withColumn("__order", own).withColumn("check", F.explode(broken))
    first = Window.partitionBy("check").orderBy("__order")
    return (each.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= limit).drop("__order"))


def gate(check_table: DataFrame, stage: str | None = None) -> None:
    """DQ-3: raise if any error-level check failed (optionally for one stage)."""
    t = check_table.filter(F.col("status") == "FAIL")
    if stage is not None:
        t = t.filter(F.col("stage") == stage)
    failed = t.select("stage", "check", "detail", "offenders").collect()
    if failed:
        lines = "; ".join(f"{r.stage}::{r.check} ({r.offenders}) {r.detail}" for r in failed)
        raise ValidationError(f"{len(failed)} validation failure(s): {lines}", check_table)


def split_drops(df: DataFrame, rules, by=None):
    """DQ-4: apply ordered drop rules ``[(reason, predicate), ...]``.

    Returns ``(kept, log)``; a row is dropped for the first rule it meets and
    the log counts drops per reason (and per ``by``).
    """
    reason = None
    for name, pred in rules:
        p = F.coalesce(pred, F.lit(False))
        reason = F.when(p, F.lit(name)) if reason is None else reason.when(p, F.lit(name))
    tagged = df.withColumn("__reason", reason)
    kept = tagged.filter(F.col("__reason").isNull()).drop("__reason")
    log = (tagged.filter(F.col("__reason").isNotNull())
                 .groupBy(F.col("__reason").alias("reason"), *listify(by))
                 .agg(F.count(F.lit(1)).alias("n_dropped")))
    return kept, log


def reconcile(a: DataFrame, b: DataFrame, keys, value: str, count: str | None = None,
              tol: float = 0.01) -> DataFrame:
    """REC-1: align two aggregates by key (full outer, missing = 0) and diff them.

    Output: keys, ``a_value``, ``b_value``, ``diff``, ``ok`` (|diff| <= tol and
    counts equal when ``count`` is given).
    """
    keys = listify(keys)
    sa = a.select(*keys, F.col(value).alias("a_value"),
                  *( [F.col(count).alias("a_count")] if count else []))
    sb = b.select(*keys, F.col(value).alias("b_value"),
                  *( [F.col(count).alias("b_count")] if count else []))
    j = sa.join(sb, keys, "full_outer")
    fill = {"a_value": F.coalesce("a_value", F.lit(0.0)), "b_value": F.coalesce("b_value", F.lit(0.0))}
    if count:
        fill.update({"a_count": F.coalesce("a_count", F.lit(0)).cast("bigint"),
                     "b_count": F.coalesce("b_count", F.lit(0)).cast("bigint")})
    j = j.withColumns(fill).withColumn("diff", F.round(F.col("a_value") - F.col("b_value"), 2))
    ok = F.abs(F.col("a_value") - F.col("b_value")) <= tol
    if count:
        ok = ok & (F.col("a_count") == F.col("b_count"))
    return j.withColumn("ok", ok)


def per_key_diff(a: DataFrame, b: DataFrame, keys, value: str, tol: float = 0.005) -> DataFrame:
    """REC-2: keys whose two values differ by more than ``tol``."""
    r = reconcile(a, b, keys, value, tol=tol)
    return r.filter(F.abs(F.col("a_value") - F.col("b_value")) > tol).select(
        *listify(keys), "a_value", "b_value", "diff")
