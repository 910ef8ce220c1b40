"""PIPE-3: template services -- seven team templates into one services fact.

Plan shape: one lazy scan+shape per source, one ``unionByName``, one join to
the identity map, one anti-join for the review list, one join to the
learner dimension, then one aggregate per check stage.  The dimension and
the identity map are one row per learner; AQE broadcasts them when their
measured size allows, otherwise they are sort-merge joined (no forced
broadcast).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import (Check, duplicate_members, flag_members, highest_per_key, key_violations,
                         lookup_join, map_label, remap_identity, run_checks, split_explode, union_all)
from ..operators.quality import ERROR, WARN
from ..session import stage_table
from ..sources import ORDER_COLS, load_all

# The loader contract and the output layout of the services fact.
LOADER_COLUMNS = ("umuzi_email", "cohort_name", "service_used", "service_name", "date_service_accessed")
FINAL_COLUMNS = (
    "learner_id", "application_id", "umuzi_email",
    "first_name", "last_name", "cohort_name", "cellphone_number",
    "id_number", "gender", "date_of_birth", "age_service_accessed", "age_range", "race",
    "residential_area_type", "has_disability_or_differently_abled",
    "application_date", "nearest_metro", "province", "date_service_accessed",
    "month_of_service_accessed", "service_used", "service_name",
)
# Cohort labels set by programme-name patterns on the platform export.
PATHWAY_COHORT = "SAP Program(Not Listed on Retool)"
VENDOR_COHORT = "Accenture: Skill Advancement"


@dataclass
class ServicesConfig:
    period_start: str
    period_end: str
    as_of: str
    corrections: dict = field(default_factory=dict)        # STR-7 typo fixes
    unreportable: tuple = ()                               # FLT-3 exclusions
    unmatched_policy: str = "halt"                         # or "drop"
    platform_cohorts: dict = field(default_factory=dict)   # programme -> cohort
    platform_drop: tuple = ()                              # programmes of employed learners
    whole_last_day: bool = False                           # T9 parity: midnight end bound


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("date_service_accessed", fx.parse_dates("date_service_accessed"))


def _explode_emails(df: DataFrame, pattern: str) -> DataFrame:
    return split_explode(df, "umuzi_email", pattern).filter(F.col("umuzi_email").isNotNull())


# ------------------------------------------------------------- LD-1 .. LD-7
def shape_connection(spark, spec, df, **_):
    """LD-1 / LD-6: comma e-mail list per row."""
    return _finish(_explode_emails(df, spec.constants.get("split", r",\s*")))


def shape_general(spark, spec, df, **_):
    """LD-2: comma e-mails x comma services, constant cohort."""
    df = split_explode(df, "service_name", r",\s*")
    df = _explode_emails(df, r",\s*")
    return _finish(df.withColumn("service_name", fx.strip("service_name"))
                     .withColumn("cohort_name", F.lit(spec.constants["cohort"])))


def shape_platform(spark, spec, df, cfg: ServicesConfig = None, **_):
    """LD-3: learning-platform export; completed courses only, cohort from the
    programme (vendor > pathway > map precedence)."""
    df = df.filter(F.col("Completion Time").isNotNull()).select(
        F.col("Email").alias("umuzi_email"),
        fx.strip("Course").alias("service_name"),
        fx.strip("Program Name").alias("service_used"),
        fx.parse_dates(fx.complete_seconds(F.col("Completion Time"))).alias("date_service_accessed"),
        *ORDER_COLS, "source")
    df = df.filter(fx.not_in("service_used", cfg.platform_drop))
    cohort = fx.ordered_override(
        map_label("service_used", cfg.platform_cohorts),
        [(fx.contains_ci("service_used", "Accenture"), VENDOR_COHORT),
         (fx.contains_ci("service_used", "Pathway"), PATHWAY_COHORT)])
    return df.withColumn("cohort_name", cohort)


def shape_checkins(spark, spec, df, **_):
    """LD-4: comma e-mails, cohort trimmed."""
    df = _explode_emails(df, ",")
    return _finish(df.withColumn("cohort_name", fx.strip("cohort_name")))


def shape_placements(spark, spec, df, **_):
    """LD-5: two sheets, ``,`` or ``;`` separated e-mails, cohort trimmed."""
    df = _explode_emails(df, r"\s*[,;]\s*")
    return _finish(df.withColumn("cohort_name", fx.strip("cohort_name")))


def shape_single(spark, spec, df, **_):
    """LD-7: one e-mail per row."""
    return _finish(df.filter(F.col("umuzi_email").isNotNull()))


SHAPERS = {"connection": shape_connection, "general": shape_general, "platform": shape_platform,
           "checkins": shape_checkins, "placements": shape_placements, "single": shape_single}


def unmapped_programmes(df: DataFrame) -> DataFrame:
    """LD-3 coverage: programmes that got no cohort (error-level check)."""
    return df.filter(F.col("cohort_name").isNull()).groupBy("service_used").agg(
        F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ stages
def dimension(rich: DataFrame) -> DataFrame:
    """Learner dimension with both e-mail columns normalised (STR-1)."""
    return rich.withColumns({"umuzi_email": fx.normalize_email("umuzi_email"),
                             "email": fx.normalize_email("email")})


def identity_map(rich: DataFrame) -> DataFrame:
    """Personal -> canonical e-mail (T3: NULL keys dropped, highest learner wins)."""
    m = rich.filter(F.col("email").isNotNull())
    return highest_per_key(m, ["email"], "learner_id").select("email", "umuzi_email")


def load_sources(spark: SparkSession, specs, cfg: ServicesConfig):
    """Stage ``load``: shaped sources, per-source checks, period trim."""
    frames = load_all(spark, specs, SHAPERS, cfg=cfg)
    checks, kept = [], []
    by_name = {s.name: s for s in specs}
    for name, df in frames.items():
        missing = [c for c in LOADER_COLUMNS if c not in df.columns]
        if missing:
            raise ValueError(f"{name}: loader contract columns missing: {missing}")
        specs_ = [Check("load", f"{name}: service dates readable",
                        F.col("date_service_accessed").isNull(), ERROR,
                        "unparseable service dates (expected DD/MM/YYYY)")]
        if by_name[name].kind == "platform":
            specs_.append(Check("load", f"{name}: programmes have a cohort",
                                F.col("cohort_name").isNull(), ERROR,
                                "add the programme to the cohort map or the drop list"))
        t = run_checks(df, specs_)
        rows = df.agg(F.count(F.lit(1)).alias("n"))
        t = t.unionByName(rows.select(
            F.lit("load").alias("stage"), F.lit(f"{name}: at least one row was read").alias("check"),
            F.when(F.col("n") > 0, "PASS").otherwise("WARN").alias("status"), F.lit(WARN).alias("level"),
            F.when(F.col("n") > 0, "").otherwise("nothing was read").alias("detail"),
            F.when(F.col("n") > 0, 0).otherwise(1).cast("bigint").alias("offenders")))
        checks.append(t)
        if by_name[name].filter_to_period:
            df = df.filter(fx.in_period("date_service_accessed", cfg.period_start, cfg.period_end,
                                        cfg.whole_last_day))
        kept.append(df.select("source", *LOADER_COLUMNS, *ORDER_COLS))
    return union_all(kept), union_all(checks)


def canonicalise(data: DataFrame, rich: DataFrame, cfg: ServicesConfig):
    """Stage ``match``: normalise, correct, exclude, remap; returns
    ``(matched, review, excluded_log)``."""
    d = data.withColumn("umuzi_email", fx.replace_values(fx.normalize_email("umuzi_email"), cfg.corrections))
    bad = F.col("umuzi_email").isin(list(cfg.unreportable)) if cfg.unreportable else F.lit(False)
    excluded = (d.filter(bad).groupBy("source")
                 .agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("umuzi_email").alias("people")))
    d = d.filter(~bad)
    d = remap_identity(d, "umuzi_email", rich, "email", "umuzi_email", id_col="learner_id")
    known = rich.filter(F.col("umuzi_email").isNotNull())
    flagged = flag_members(d, ["umuzi_email"], known, "__matched")
    review = (flagged.filter(~F.col("__matched")).groupBy("source", "umuzi_email")
                     .agg(F.count(F.lit(1)).alias("rows")))
    if cfg.unmatched_policy == "drop":
        flagged = flagged.filter(F.col("__matched"))
    return flagged.drop("__matched"), review, excluded


def enrich(data: DataFrame, rich: DataFrame) -> DataFrame:
    """Stage ``merge``: left join on the canonical e-mail (unique by check) and
    the derived fields of section 8."""
    dim = rich.drop("email").withColumnRenamed("umuzi_email", "__u")
    j = lookup_join(data, dim, "umuzi_email", "__u")
    d, dob = F.col("date_service_accessed"), fx.parse_dates(F.col("date_of_birth").cast("string"))
    age = fx.age_days365(d, dob)
    return j.withColumns({
        "learner_id": F.col("learner_id").cast("long"),
        "id_number": fx.pad_id("id_number"),
        "age_service_accessed": age,
        "age_range": fx.band_days365(age),
        "month_of_service_accessed": fx.month_year(d),
    })


def merge_checks(rich: DataFrame, data: DataFrame, enriched: DataFrame) -> DataFrame:
    dup = key_violations(rich, ["umuzi_email"])
    t1 = dup.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("merge").alias("stage"), F.lit("the dimension has one row for each address").alias("check"),
        F.when(F.col("n") == 0, "PASS").otherwise("FAIL").alias("status"), F.lit(ERROR).alias("level"),
        F.when(F.col("n") == 0, "").otherwise("addresses with several rows would multiply service rows")
         .alias("detail"), F.col("n").cast("bigint").alias("offenders"))
    t2 = run_checks(enriched, [
        Check("merge", "no service row without a learner", F.col("learner_id").isNull(), ERROR,
              "learners that the dimension does not hold"),
        Check("merge", "birth dates known", F.col("date_of_birth").isNull(), WARN,
              "no age can be derived for these rows")])
    return t1.unionByName(t2)


def final_checks(final: DataFrame, cfg: ServicesConfig) -> DataFrame:
    d = F.col("date_service_accessed")
    dup_keys = ["learner_id", "service_used", "service_name", "date_service_accessed"]
    dups = duplicate_members(final, dup_keys).agg(F.count(F.lit(1)).alias("n"))
    t = run_checks(final, [
        Check("final", "services not dated after the run", d > F.lit(cfg.as_of).cast("timestamp_ntz"), ERROR,
              "service dates later than the run's as-of day"),
        Check("final", "services dated inside the period",
              ~fx.in_period(d, cfg.period_start, cfg.period_end, cfg.whole_last_day), WARN,
              "rows outside the reporting period"),
        Check("final", "id numbers have thirteen characters",
              F.col("id_number").isNotNull() & (F.length("id_number") != 13), ERROR,
              "id numbers of another length than 13 after padding"),
        Check("final", "id numbers known", F.col("id_number").isNull(), WARN,
              "rows without an ID number"),
        Check("final", "ages between 15 and 80",
              F.col("age_service_accessed").isNotNull() & ~F.col("age_service_accessed").between(15, 80),
              WARN, "rows with another age"),
        Check("final", "cohorts known", fx.is_blank("cohort_name"), WARN,
              "rows without a cohort")])
    d2 = dups.select(F.lit("final").alias("stage"), F.lit("one row for each learner, service and date").alias("check"),
                     F.when(F.col("n") == 0, "PASS").otherwise("WARN").alias("status"),
                     F.lit(WARN).alias("level"),
                     F.when(F.col("n") == 0, "").otherwise("same learner, service and date twice").alias("detail"),
                     F.col("n").cast("bigint").alias("offenders"))
    return t.unionByName(d2)


def build(spark: SparkSession, specs, rich_raw: DataFrame, cfg: ServicesConfig):
    """PIPE-3 lazily: returns ``(final, checks, review)``.

    ``final`` has ``source`` + the 22 output columns; ``checks`` is the whole
    check table (stages load, match, merge, final); ``review`` lists the
    e-mails that still do not match the dimension.
    """
    rich = dimension(rich_raw)
    data, load_t = load_sources(spark, specs, cfg)
    data = stage_table(data, "template-rows")          # read by the match, merge and final checks
    matched, review, _ = canonicalise(data, rich, cfg)
    review_n = review.agg(F.count(F.lit(1)).alias("n"))
    match_t = review_n.select(
        F.lit("match").alias("stage"), F.lit("addresses known to the database").alias("check"),
        F.when(F.col("n") == 0, "PASS").when(F.lit(cfg.unmatched_policy) == "halt", "FAIL")
         .otherwise("WARN").alias("status"),
        F.lit(ERROR if cfg.unmatched_policy == "halt" else WARN).alias("level"),
        F.when(F.col("n") == 0, "").otherwise("unmatched e-mails: correct, exclude or add them").alias("detail"),
        F.col("n").cast("bigint").alias("offenders"))
    matched = stage_table(matched, "template-matched")
    enriched = stage_table(enrich(matched, rich), "template-enriched")
    final = enriched.select("source", *FINAL_COLUMNS)
    checks = union_all([load_t, match_t, merge_checks(rich, matched, enriched), final_checks(final, cfg)])
    return final, checks, review
