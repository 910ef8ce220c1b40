"""Monthly drops processed by a file stream: state carried forward, re-reads dropped."""

import datetime as dt

from impactspark.plans import earnings as earn
from impactspark.streaming import latest_state, run_available

from .conftest import rows
from .test_pipelines import rich_frame


def test_monthly_drops_carry_state_forward(spark, tmp_path):
    landing, state, ckpt = (str(tmp_path / p) for p in ("landing", "state", "ckpt"))
    may = [("a@example.org", 100.0, dt.datetime(2026, 5, 3), "C", None, "Impact gig", "Gig A")]
    # June's extract re-sends May's row (a re-read) and adds one new row
    june = may + [("b@example.org", 50.0, dt.datetime(2026, 6, 2), "C", None, "Impact gig", "Gig B")]
    spark.createDataFrame(may, earn.STATE_SCHEMA).coalesce(1).write.parquet(f"{landing}/2026-05")
    cfg = earn.EarningsConfig(report_start="2026-04-01", as_of="2026-07-01", covered_through="2026-05-31",
                              fy_start_year=2026, cohort_map={"C": "C"})
    run_available(spark, landing, state, ckpt, rich_frame(spark), cfg)
    assert rows(latest_state(spark, state), "umuzi_email") == [("a@example.org",)]
    spark.createDataFrame(june, earn.STATE_SCHEMA).coalesce(1).write.parquet(f"{landing}/2026-06")
    run_available(spark, landing, state, ckpt, rich_frame(spark), cfg)
    assert rows(latest_state(spark, state), "umuzi_email", "payment") == [
        ("a@example.org", 100.0), ("b@example.org", 50.0)]


def test_a_retried_batch_does_not_read_its_own_output(spark, tmp_path):
    from impactspark.streaming.monthly import process_drop

    state = str(tmp_path / "state")
    drop = spark.createDataFrame(
        [("a@example.org", 100.0, dt.datetime(2026, 5, 3), "EX", None, "Impact gig", "Gig A")] * 2, earn.STATE_SCHEMA)
    cfg = earn.EarningsConfig(report_start="2026-04-01", as_of="2026-07-01", covered_through="2026-05-31",
                              fy_start_year=2026, cohort_map={"EX": "EX"}, exempt_cohort="EX", protect_exempt=True)
    process_drop(drop, 1, state, rich_frame(spark), cfg)
    first = rows(latest_state(spark, state), "umuzi_email", "payment")
    process_drop(drop, 1, state, rich_frame(spark), cfg)
    assert rows(latest_state(spark, state), "umuzi_email", "payment") == first and len(first) == 2
