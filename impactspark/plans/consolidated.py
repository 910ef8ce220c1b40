"""PIPE-4..6: consolidated services sheet, supported people, participants.

One union of the contract-checked inputs, one identity-map join, one
re-enrichment join (nameless rows only get dimension values, in the same
pass), one exact-dedup aggregate and one aggregate per learner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import (Check, cross_source_repeats, duplicate_report, first_non_null_cols,
                         highest_per_key, keep_first, lookup_join, remap_identity, run_checks,
                         sorted_distinct, split_drops, union_all)
from ..operators.quality import ERROR, WARN
from ..session import stage_table
from ..sources import ORDER_COLS, read_header_csv, tag
from .template_services import FINAL_COLUMNS

# The indicator-7 contract (the services fact without cohort).
IND7_COLS = tuple(c for c in FINAL_COLUMNS if c != "cohort_name")
# Columns a nameless row keeps when it is re-enriched.
SERVICE_KEEP = ("umuzi_email", "service_used", "service_name", "date_service_accessed",
                "age_service_accessed", "month_of_service_accessed", "age_range", "source")
PARTICIPANT_COLS = ("first_name", "last_name", "id_number", "date_service_accessed", "service_name",
                    "cellphone_number", "age_service_accessed", "nearest_metro", "province", "race",
                    "gender")


def load_ind7(spark: SparkSession, path: str, name: str, priority: int, drop_cohort: bool = False):
    """LD-15: headered extract checked against the contract -> ``(frame, checks)``.

    Missing contract columns raise (nothing may be unioned NaN-filled);
    extra columns are reported and dropped.
    """
    df = read_header_csv(spark, path)
    if drop_cohort and "cohort_name" in df.columns:
        df = df.drop("cohort_name")
    cols = [c for c in df.columns if c not in ("_file", "_row")]
    missing = [c for c in IND7_COLS if c not in cols]
    extra = [c for c in cols if c not in IND7_COLS]
    if missing:
        raise ValueError(f"{name}: missing contract columns {missing}")
    out = tag(df.select(*IND7_COLS, "_file", "_row"), name, priority)
    n = out.agg(F.count(F.lit(1)).alias("n"))
    checks = n.select(
        F.lit("load").alias("stage"), F.lit(f"{name}: at least one row was read").alias("check"),
        F.when(F.col("n") > 0, "PASS").otherwise("WARN").alias("status"), F.lit(WARN).alias("level"),
        F.when(F.col("n") > 0, "").otherwise("nothing was read").alias("detail"),
        F.when(F.col("n") > 0, 0).otherwise(1).cast("bigint").alias("offenders"))
    if extra:
        checks = checks.unionByName(spark.createDataFrame(
            [("load", f"{name}: columns beyond the contract", "WARN", WARN, f"dropped: {sorted(extra)}", len(extra))],
            "stage string, check string, status string, level string, detail string, offenders bigint"))
    return out, checks


def learner_dimension(rich_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dimension unique on the canonical e-mail (highest learner_id) and the
    personal -> canonical map (T3)."""
    rich = rich_raw.withColumns({"umuzi_email": fx.normalize_email("umuzi_email"),
                                 "email": fx.normalize_email("email"),
                                 "learner_id": F.col("learner_id").cast("long")})
    rich = highest_per_key(rich, ["umuzi_email"], "learner_id")
    emap = highest_per_key(rich.filter(F.col("email").isNotNull()), ["email"], "learner_id") \
        .select("email", "umuzi_email")
    return rich, emap


def consolidate(parts, rich_raw: DataFrame, report_start: str, as_of: str):
    """PIPE-4: returns ``(combined, checks, drop_log, dedup_report)``."""
    rich, emap = learner_dimension(rich_raw)
    data = union_all(parts)
    data = remap_identity(data.withColumn("umuzi_email", fx.normalize_email("umuzi_email")), "umuzi_email", emap,
                          "email", "umuzi_email")
    data = data.withColumns({
        "date_of_birth": fx.parse_dates("date_of_birth"),
        "date_service_accessed": fx.parse_dates("date_service_accessed"),
        "age_service_accessed": F.col("age_service_accessed").try_cast("double").cast("long")})
    d = F.col("date_service_accessed")
    data, drop_log = split_drops(data, [("no parseable service date", d.isNull()),
                                        ("before the reporting window", d < F.lit(report_start).cast("timestamp_ntz"))],
                                 by=["source"])
    data = data.withColumn("month_of_service_accessed", fx.month_name(d))
    data = stage_table(refill_nameless(data, rich), "consolidated")     # read by the dedup, its report and the checks
    dedup_report = duplicate_report(data.drop(*[c for c in ORDER_COLS if c != "_src_priority"])
                                    .drop("_src_priority"), "source")
    data = stage_table(keep_first_exact(data), "consolidated-rows")
    checks = run_checks(data, [
        Check("dates", "services not dated after the run", d > F.lit(as_of).cast("timestamp_ntz"), ERROR,
              "service dates later than the run's as-of day"),
        Check("enrich", "every row has a learner name",
              F.col("first_name").isNull() & F.col("last_name").isNull(), WARN,
              "missing from the dimension; shipped nameless"),
        Check("final", "id numbers have thirteen characters",
              F.col("id_number").isNotNull() & (F.length("id_number") != 13), WARN, "id numbers of another length than 13")])
    near = cross_source_repeats(data, ["umuzi_email", "service_used", "service_name", "date_service_accessed"])
    near_t = near.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("dedup").alias("stage"), F.lit("no event is sent by two sources").alias("check"),
        F.when(F.col("n") == 0, "PASS").otherwise("WARN").alias("status"), F.lit(WARN).alias("level"),
        F.when(F.col("n") == 0, "").otherwise("verify double reporting with the data owners").alias("detail"),
        F.col("n").cast("bigint").alias("offenders"))
    return data, checks.unionByName(near_t), drop_log, dedup_report


def refill_nameless(data: DataFrame, rich: DataFrame) -> DataFrame:
    """PIPE-4b: rows with neither name take every non-service column from the
    dimension (NULL if absent); ages are recomputed where missing and a birth
    date is now known (days // 365 bands)."""
    fill = [c for c in IND7_COLS if c not in SERVICE_KEEP]
    types = dict(data.dtypes)
    dim = rich.withColumn("date_of_birth", fx.parse_dates(F.col("date_of_birth").cast("string")))
    dim = dim.select(F.col("umuzi_email").alias("__u"),
                     *[F.col(c).cast(types[c]).alias("__d_" + c) for c in fill])
    nameless = F.col("first_name").isNull() & F.col("last_name").isNull()
    j = lookup_join(data.withColumn("__nameless", nameless), dim, "umuzi_email", "__u")
    j = j.withColumns({c: F.when(F.col("__nameless"), F.col("__d_" + c)).otherwise(F.col(c)) for c in fill})
    needs = F.col("age_service_accessed").isNull() & F.col("date_of_birth").isNotNull()
    age = fx.age_days365("date_service_accessed", "date_of_birth")
    j = j.withColumns({"age_service_accessed": F.when(needs, age).otherwise(F.col("age_service_accessed")),
                       "age_range": F.when(needs, fx.band_days365(age)).otherwise(F.col("age_range"))})
    return j.drop("__nameless", *["__d_" + c for c in fill])


def keep_first_exact(data: DataFrame) -> DataFrame:
    """DED-3: identical rows (``source`` included) collapse to their first copy."""
    business = [c for c in data.columns if c not in ORDER_COLS]
    return keep_first(data, business, [F.col(c) for c in ORDER_COLS])


def supported_people(combined: DataFrame) -> DataFrame:
    """PIPE-5 (indicator 6): one row per learner -- first non-NULL value per
    column in input order, sorted distinct service list, latest date and the
    month of that date -- in a single aggregate (one shuffle, combined map-side)."""
    combined = combined.filter(F.col("umuzi_email").isNotNull())   # pandas groupby drops NULL keys
    order = F.struct(*[F.col(c) for c in ORDER_COLS])
    firsts = [c for c in IND7_COLS if c not in ("umuzi_email", "service_name", "date_service_accessed",
                                                "month_of_service_accessed")]
    out = combined.groupBy("umuzi_email").agg(
        *first_non_null_cols(order, firsts),
        sorted_distinct("service_name").alias("service_name"),
        F.max("date_service_accessed").alias("date_service_accessed"))
    out = out.withColumn("month_of_service_accessed", fx.month_name("date_service_accessed"))
    return out.select(*IND7_COLS)


def people_checks(combined: DataFrame, ind6: DataFrame) -> DataFrame:
    both = (combined.select(F.lit("c").alias("__m"), "umuzi_email")
                    .unionByName(ind6.select(F.lit("i").alias("__m"), "umuzi_email")))
    counts = both.agg(F.count_distinct(F.when(F.col("__m") == "c", F.col("umuzi_email"))).alias("p"),
                      F.count_if(F.col("__m") == "i").alias("r"))
    return counts.select(
        F.lit("ind6").alias("stage"), F.lit("one row per supported learner").alias("check"),
        F.when(F.col("p") == F.col("r"), "PASS").otherwise("FAIL").alias("status"),
        F.lit(ERROR).alias("level"),
        F.when(F.col("p") == F.col("r"), "").otherwise("row count differs from distinct learners").alias("detail"),
        F.abs(F.col("p") - F.col("r")).cast("bigint").alias("offenders"))


def participants(combined: DataFrame) -> DataFrame:
    """PIPE-6: participants list."""
    return combined.select(*PARTICIPANT_COLS)


def registration_checks(five: DataFrame) -> DataFrame:
    """Indicator-5 extract passed through: it must have rows (error) and
    should hold no duplicate rows (warning)."""
    n = five.agg(F.count(F.lit(1)).alias("rows"))
    dup = five.groupBy(*five.columns).agg(F.count(F.lit(1)).alias("c")) \
              .agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("dups"))
    t1 = n.select(F.lit("ind5").alias("stage"), F.lit("indicator 5 extract contains rows").alias("check"),
                  F.when(F.col("rows") > 0, "PASS").otherwise("FAIL").alias("status"),
                  F.lit(ERROR).alias("level"),
                  F.when(F.col("rows") > 0, "").otherwise("the extract is empty").alias("detail"),
                  F.when(F.col("rows") > 0, 0).otherwise(1).cast("bigint").alias("offenders"))
    t2 = dup.select(F.lit("ind5").alias("stage"), F.lit("indicator 5 has no duplicate rows").alias("check"),
                    F.when(F.col("dups") == 0, "PASS").otherwise("WARN").alias("status"),
                    F.lit(WARN).alias("level"),
                    F.when(F.col("dups") == 0, "").otherwise("duplicates passed through as-is").alias("detail"),
                    F.col("dups").cast("bigint").alias("offenders"))
    return t1.unionByName(t2)


def names_review(combined: DataFrame, rich_raw: DataFrame) -> DataFrame:
    """JN-9 after consolidation: canonical e-mails with no dimension row, per source."""
    rich, _ = learner_dimension(rich_raw)
    from ..operators import unmatched
    return unmatched(combined, rich, "umuzi_email", by=["source"])
