"""One month's earnings run: clean, build, check, then write report and state.

Nothing is written before every error-level check has passed (``gate``), so
a failed month leaves last month's report and state as they were.  A re-run
writes the same tables again as a new report version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import union_all
from ..operators.quality import gate, stage_checked
from ..session import drop_stages, staged_count, stage_table
from ..sources import write_report, write_state
from . import earnings as earn
from . import reports as rp


def review_lists(entries: DataFrame, demo: DataFrame) -> dict[str, DataFrame]:
    """Report-level reviews: people without a phone, entries without a person's name, stipend rows left out."""
    people = demo.groupBy("umuzi_email").agg(
        F.max("cellphone_number").alias("cellphone_number"), F.max("first_name").alias("first_name"))
    stipends = entries.filter(F.col("earning_opportunity_name").isin(*earn.STIPEND_NAMES))
    return {
        "review_no_phone": people.filter(F.col("cellphone_number").isNull()).select("umuzi_email"),
        "review_no_name": people.filter(F.col("first_name").isNull()).select("umuzi_email"),
        "review_stipends": stipends.groupBy("earning_opportunity_name").agg(F.count(F.lit(1)).alias("n_rows")),
    }


def build_month(frames, rich: DataFrame, fields: DataFrame, baseline: DataFrame, names: DataFrame,
                cfg: earn.EarningsConfig) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """``(tables, checks, state)``; the frames that feed several tables are stored once, and counted by the job that stores them."""
    entries, logs = earn.clean_entries(frames, rich, cfg, row_checks=False)
    entries, entry_t = stage_checked(entries, "entries", earn.entry_rules(cfg))
    entries = entries.drop("__raw_cohort")
    demo = stage_table(earn.demographics(entries, rich, fields), "demographics")
    summary = stage_table(earn.summarized(entries), "summary")
    brk, brk_t = stage_checked(earn.breakdown(entries, demo, baseline, names), "breakdown", earn.breakdown_rules())
    recon = stage_table(earn.reconcile_tables(summary, brk), "reconciliation")
    checks = stage_table(union_all([entry_t, earn.repeat_check(entries), logs["checks"], brk_t,
                                    earn.report_checks(entries, summary, brk, recon, row_checks=False)]), "checks")
    tables = {
        "summary": rp.result_export(summary), "breakdown": rp.partner_export(brk, cfg.fy_start_year),
        "entries_wide": earn.entries_wide(entries), "one_per_learner": earn.singles(demo),
        "learner_demographics": earn.learner_demographics(summary, rich), "reconciliation": recon,
        "person_differences": earn.person_diff(summary, brk), "checks": checks,
        **{k: logs[k] for k in ("drops", "backfills", "unmatched", "unmapped_cohorts")},
        **review_lists(entries, demo),
    }
    return tables, checks, entries.select(*earn.CANON_COLS, "month")


def run_month(frames, rich: DataFrame, fields: DataFrame, baseline: DataFrame, names: DataFrame,
              cfg: earn.EarningsConfig, report: str, state: str) -> list[str]:
    """Build, gate and write one month; returns the names of the report's tables.

    ``state`` is a folder for this month's state alone (never the one read).
    The run's stored tables are deleted at its end, also when it fails.
    """
    spark = rich.sparkSession
    before = staged_count(spark)
    try:
        tables, checks, entries = build_month(frames, rich, fields, baseline, names, cfg)
        gate(checks)
        write_report(tables, report, create=True, required=())
        write_state(entries, state)
        return sorted(tables)
    finally:
        drop_stages(spark, keep=before)
