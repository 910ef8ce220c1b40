"""PIPE-7..13: earning opportunities -- cleaned entries (rolling state) and the
five report tables, reconciled before anything is written.

The cleaned entries feed five outputs; ``materialise`` cuts their lineage
with a table written to the shared checkpoint folder (``spark.checkpoint.dir``)
so the five consumers and any task retry after a lost executor re-read it
instead of recomputing the whole cleaning chain.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampNTZType

from .. import functions as fx
from ..operators import (Check, Identifier, blocks_to_rows, count_once, drop_covered, enrich_tiers,
                         flag_members, highest_per_key, keep_first, keep_first_passes, map_label, rank_within,
                         remap_identity, resolve_identifiers, run_checks, split_drops, union_all, unmatched)
from ..operators.quality import ERROR, WARN
from ..operators.reshape import BLOCK_FIELDS
from ..sources import ORDER_COLS, read_blocks, read_sheets, read_state, tag
from . import reports as rp

# The canonical entry columns, the resubmission key (type is
# not part of it) and the text columns that are stripped.
CANON_COLS = ("umuzi_email", "payment", "date_service_accessed", "cohort",
              "earning_opportunity_extra_info", "earning_opportunity_type", "earning_opportunity_name")
KEY = ("umuzi_email", "payment", "date_service_accessed", "cohort",
       "earning_opportunity_extra_info", "earning_opportunity_name")
STRING_COLS = ("umuzi_email", "cohort", "earning_opportunity_extra_info",
               "earning_opportunity_type", "earning_opportunity_name")
DEMO_FIELDS = ("cellphone_number", "id_number", "race", "gender", "date_of_birth", "nearest_metro",
               "has_disability_or_differently_abled", "province", "residential_area_type",
               "first_name", "last_name", "learner_id")
# Opportunity type -> partner status.
STATUS_MAP = {"Development pathway": "Active", "Placement": "Placement", "Placed by Umuzi": "Placement",
              "Impact gig": "Active", "Experience gig": "Active", "Learnership": "Active"}
STIPEND_NAMES = ("Data Stipend", "Data Stipend, Exam stipend")
FIRST_MARK, COUNTED_MARK = "1", "Counted"

STATE_SCHEMA = StructType([
    StructField("umuzi_email", StringType()), StructField("payment", DoubleType()),
    StructField("date_service_accessed", TimestampNTZType()), StructField("cohort", StringType()),
    StructField("earning_opportunity_extra_info", StringType()),
    StructField("earning_opportunity_type", StringType()),
    StructField("earning_opportunity_name", StringType())])


@dataclass
class EarningsConfig:
    report_start: str                 # first day of the fiscal year
    as_of: str                        # "now" of the run, explicit for determinism
    covered_through: str              # last day the prior state covers
    fy_start_year: int
    exempt_cohort: str | None = None  # genuine repeat payments (DED-4 exemption)
    cohort_map: dict = field(default_factory=dict)   # LKP-2 remap
    idempotent_remap: bool = True     # T10: keep labels that are already targets
    exclusion_rules: tuple = ()       # FLT-15 predicates
    corrections: dict = field(default_factory=dict)
    whole_last_day: bool = False      # T9: the covered period ends at the last day's midnight, or with its last instant
    protect_exempt: bool = False      # T8: exempt cohort also spared by the exact-duplicate pass


# ------------------------------------------------------------ LD-8 .. LD-14
def load_wide(spark: SparkSession, path: str, name: str, priority: int, lead_rows: int = 1,
              first_col: int = 1) -> DataFrame:
    """LD-8: self-sizing repeating-block workbook (SRC-5 + RSH-1)."""
    df, k = read_blocks(spark, path, lead_rows, first_col=first_col)
    df = df.filter(F.col("umuzi_email").isNotNull())
    rows = blocks_to_rows(df, ["umuzi_email", "cohort", "_file", "_row", "_blocks"], list(BLOCK_FIELDS), k,
                          keep_if="payment", block_col="__b")
    # a file's own number of blocks spaces its rows
    rows = rows.withColumns({"payment": fx.clean_money("payment"),
                             "date_service_accessed": fx.parse_dates("date_service_accessed"),
                             "_row": F.col("_row") * F.col("_blocks") + F.col("__b")})
    rows = rows.filter(F.col("payment").isNotNull())
    return tag(rows.select(*CANON_COLS, "_file", "_row"), name, priority)


_ID_NAMES = ("id_number", "payment", "date_service_accessed", "cohort", "earning_opportunity_extra_info",
             "earning_opportunity_name", "earning_opportunity_type")
_EMAIL_NAMES = ("umuzi_email", "payment", "date_service_accessed", "cohort",
                "earning_opportunity_extra_info", "earning_opportunity_name", "earning_opportunity_type")
_PARTNER_NAMES = ("umuzi_email", "payment", "date_service_accessed", "cohort",
                  "earning_opportunity_extra_info", "earning_opportunity_type", "earning_opportunity_name")


def person_identifiers(rich: DataFrame) -> list[Identifier]:
    """What the identifier column of the templates may hold: a national id, or an e-mail address.

    An address resolves to the canonical one, as a personal address first
    and as the canonical address itself next.
    """
    people = rich.withColumn("umuzi_email", fx.normalize_email("umuzi_email"))
    by = lambda key: (people, key, "umuzi_email", "learner_id")
    text = lambda c: F.coalesce(fx.strip(c), F.lit(""))
    return [
        Identifier("id number", lambda c: text(c).rlike("^[0-9]{1,13}$"), lambda c: fx.pad_id(fx.strip(c)), (by("id_number"),)),
        Identifier("e-mail", lambda c: text(c).contains("@"), fx.normalize_email, (by("email"), by("umuzi_email")))]


def load_id_keyed(spark: SparkSession, path: str, name: str, priority: int, rich: DataFrame,
                  sheets=None, lead_rows: int = 2, resolve_emails: bool = True):
    """LD-9 / LD-13: rows keyed by national id, resolved to the canonical e-mail.

    The template column takes an e-mail *or* an id (T15); both resolve
    through one join (``resolve_identifiers``).  With ``resolve_emails`` an
    address that no learner has is used as it is (it is canonicalised
    downstream like every other); ``False`` is the parity mode where
    addresses never resolve.  Returns ``(entries, unresolved)``: what does
    not resolve is reported with its outcome, not dropped silently.
    """
    df = read_sheets(spark, path, sheets or {0: range(1, 8)}, _ID_NAMES, lead_rows)
    df = df.filter(F.col("id_number").isNotNull() & F.col("date_service_accessed").isNotNull())
    kinds = person_identifiers(rich)
    found = resolve_identifiers(df, "id_number", kinds if resolve_emails else kinds[:1], "umuzi_email")
    if resolve_emails:
        address = F.when(F.col("outcome") == "unknown e-mail", fx.strip("id_number"))
        found = found.withColumn("umuzi_email", F.coalesce("umuzi_email", address))
    ok = found.filter(F.col("umuzi_email").isNotNull()).withColumns(
        {"date_service_accessed": fx.parse_dates("date_service_accessed"), "payment": fx.clean_money("payment")})
    bad = found.filter(F.col("umuzi_email").isNull())
    return tag(ok.select(*CANON_COLS, "_file", "_row"), name, priority), bad.select("id_number", "outcome", "_file", "_row")


def load_partnerships(spark: SparkSession, path: str, name: str, priority: int, sheets=range(5),
                      lead_rows: int = 2) -> DataFrame:
    """LD-10: several same-layout sheets, renamed by position per sheet, stripped."""
    df = read_sheets(spark, path, {s: range(1, 8) for s in sheets}, _PARTNER_NAMES, lead_rows)
    df = fx.strip_columns(df, list(STRING_COLS) + ["payment", "date_service_accessed"])
    df = df.withColumn("date_service_accessed", fx.parse_dates("date_service_accessed"))
    df = df.filter(F.col("date_service_accessed").isNotNull() & F.col("payment").isNotNull())
    df = df.withColumn("payment", fx.clean_money("payment")).filter(F.col("payment").isNotNull())
    df = df.filter(F.col("earning_opportunity_type").isNotNull() | F.col("earning_opportunity_name").isNotNull())
    return tag(df.select(*CANON_COLS, "_file", "_row"), name, priority)


def load_flat(spark: SparkSession, path: str, name: str, priority: int, lead_rows: int = 2,
              ordinals=range(1, 8), names=_EMAIL_NAMES) -> DataFrame:
    """LD-11 / LD-12 (and the disabled LD-14): flat CSV templates."""
    from ..sources import read_positional
    df = read_positional(spark, path, ordinals, names, lead_rows)
    df = df.withColumns({"payment": fx.clean_money("payment"),
                         "date_service_accessed": fx.parse_dates("date_service_accessed")})
    return tag(df.select(*CANON_COLS, "_file", "_row"), name, priority)


def load_prior(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """SRC-7: last month's cleaned entries; first in concat order (priority 0), by their own identity among themselves."""
    return tag(read_state(spark, path, STATE_SCHEMA, before=before, ordered=True), "prev_combined", 0)


# ------------------------------------------------------------------ PIPE-7
def entry_rules(cfg: EarningsConfig) -> list[Check]:
    """What every cleaned entry must hold; ``__raw_cohort`` is the label before the remap."""
    d = F.col("date_service_accessed")
    return [
        Check("clean", "dates in window", (d < F.lit(cfg.report_start).cast("timestamp_ntz"))
              | (d > F.lit(cfg.as_of).cast("timestamp_ntz")), ERROR, "pre-window or future date survived"),
        Check("clean", "type filled", F.col("earning_opportunity_type").isNull(), ERROR, "type backfill failed"),
        Check("clean", "cohort mapped", F.col("cohort").isNull() & F.col("__raw_cohort").isNotNull(), WARN,
              "cohort labels without a map entry became NULL")]


def repeat_check(entries: DataFrame) -> DataFrame:
    """No entry twice: a check row from one aggregate over the (stored) entries."""
    dups = (entries.groupBy(*CANON_COLS, "month", "source").agg(F.count(F.lit(1)).alias("n"))
                   .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n")))
    return _count_check(dups, "clean", "no duplicates", ERROR)


def clean_entries(frames, rich_raw: DataFrame, cfg: EarningsConfig, checkpoint: bool = True, row_checks: bool = True):
    """PIPE-7: union -> strip/normalise/remap -> window -> backfill type ->
    DED-3 -> FLT-15 -> DED-4 -> FLT-14 -> LKP-2 -> DED-4 -> DED-5 (contract order).

    The three keep-first passes are one exchange (``keep_first_passes``; DED-3 stands alone where exclusion rules
    follow it).  The coverage pass splits state from live rows, so with
    ``checkpoint`` its input is written once to the checkpoint folder, and so
    is that of the passes where exempt rows are read apart: every consumer
    and every task retry reads it back instead of recomputing the chain above.

    Returns ``(entries, logs)``; ``logs`` holds the drop log, the back-fills,
    the unmatched e-mails and the check table.  Without ``row_checks`` the entries
    keep ``__raw_cohort`` and the check table leaves out ``entry_rules`` and
    ``repeat_check``: the caller has them counted where it stores the entries.
    """
    cut = materialise if checkpoint else (lambda df: df)
    rich = rich_raw.withColumns({"umuzi_email": fx.normalize_email("umuzi_email"),
                                 "email": fx.normalize_email("email")})
    data = union_all([f.select(*CANON_COLS, "source", *ORDER_COLS) for f in frames])
    data = fx.strip_columns(data, list(STRING_COLS))
    email = fx.replace_values(fx.normalize_email("umuzi_email", nfkc_fold=True), cfg.corrections)
    data = remap_identity(data.withColumn("umuzi_email", email), "umuzi_email", rich, "email", "umuzi_email",
                          id_col="learner_id")
    unmatched_emails = unmatched(data, rich, "umuzi_email")
    d = F.col("date_service_accessed")
    data, log1 = split_drops(data, [
        ("no parseable date", d.isNull()),
        ("outside reporting window", (d < F.lit(cfg.report_start).cast("timestamp_ntz"))
         | (d > F.lit(cfg.as_of).cast("timestamp_ntz")))], by=["source"])
    data = data.withColumn("earning_opportunity_type", fx.backfill_type("earning_opportunity_type",
                                                                       "earning_opportunity_name"))
    order = list(ORDER_COLS)
    business = [*CANON_COLS, "source"]                      # the month follows from the date
    spared = lambda c: F.col(c).eqNullSafe(F.lit(cfg.exempt_cohort)) if cfg.exempt_cohort else None
    rules = [(f"exclusion rule {i + 1}", r) for i, r in enumerate(cfg.exclusion_rules)]   # FLT-15
    log2 = None
    if rules:
        data = keep_first(data.withColumn("month", fx.month_name(d)), business, order,
                          exempt=spared("cohort") if cfg.protect_exempt else None)        # DED-3
        data, log2 = split_drops(data, rules, by=["source"])
    if rules or (cfg.exempt_cohort and cfg.protect_exempt):
        data = cut(data)                                    # rows that every pass spares are read apart
    data = data.withColumn("__raw_cohort", F.col("cohort")).withColumn(
        "cohort", map_label("cohort", cfg.cohort_map, keep_targets=cfg.idempotent_remap))   # LKP-2
    raw = lambda keys: ["__raw_cohort" if k == "cohort" else k for k in keys]
    unpaid = [("zero payment", F.col("payment") == 0),                               # FLT-14
              ("missing payment", F.col("payment").isNull() | F.isnan("payment"))]
    # the payment belongs to the key, so what FLT-14 drops between the passes is spared by the last
    gone = F.coalesce(unpaid[0][1], F.lit(False)) | unpaid[1][1]
    passes = [(raw(business) + ["cohort"], spared("__raw_cohort") if cfg.protect_exempt else None),   # DED-3
              (raw(KEY) + ["cohort"], spared("__raw_cohort")),                       # DED-4
              (list(KEY), gone | spared("cohort") if cfg.exempt_cohort else gone)]   # DED-4 again
    data = keep_first_passes(data, passes[1:] if rules else passes, order)
    data, log3 = split_drops(data, unpaid, by=["source"])
    data = cut(data.withColumn("month", fx.month_name(d)))
    in_period = d <= F.lit(cfg.covered_through + (" 23:59:59.999999" if cfg.whole_last_day else "")).cast("timestamp_ntz")
    prev = data.filter(F.col("source") == "prev_combined")                            # DED-5
    live = data.filter(F.col("source") != "prev_combined")
    # a key is left with one row of each source and type, unless exempt copies stay
    kept_live, resubmitted = drop_covered(
        live, prev, list(KEY), order, skew_safe=cfg.protect_exempt,
        covered=in_period)
    unmapped_cohorts = (kept_live.unionByName(prev)
                        .filter(F.col("cohort").isNull() & F.col("__raw_cohort").isNotNull())
                        .groupBy(F.col("__raw_cohort").alias("cohort")).agg(F.count(F.lit(1)).alias("rows")))
    entries = prev.unionByName(kept_live)
    backfills = (kept_live.filter(in_period)
                          .groupBy("source", "cohort").agg(F.count(F.lit(1)).alias("rows")))
    logs = [l for l in (log1, log2, log3) if l is not None]
    # T18: month keys carry no year, so a window longer than one fiscal year
    # would merge two Aprils in the monthly tables
    import datetime as _dt
    span = (_dt.date.fromisoformat(cfg.as_of[:10]) - _dt.date.fromisoformat(cfg.report_start[:10])).days
    window_t = entries.sparkSession.createDataFrame(
        [("clean", "window within one fiscal year", "PASS" if span <= 365 else "WARN", WARN,
          "" if span <= 365 else f"window spans {span} days; month columns would merge years",
          0 if span <= 365 else 1)],
        "stage string, check string, status string, level string, detail string, offenders bigint")
    checks = window_t
    if row_checks:
        checks = union_all([run_checks(entries, entry_rules(cfg)), repeat_check(entries), window_t])
        entries = entries.drop("__raw_cohort")
    return entries, {"drops": union_all(logs), "backfills": backfills, "resubmitted": resubmitted.drop("__raw_cohort"),
                     "unmatched": unmatched_emails, "unmapped_cohorts": unmapped_cohorts, "checks": checks}


def _count_check(counts: DataFrame, stage: str, name: str, level: str, detail: str = "") -> DataFrame:
    """A check row from a one-row frame holding the offender count ``n``."""
    failed = "FAIL" if level == ERROR else "WARN"
    return counts.select(F.lit(stage).alias("stage"), F.lit(name).alias("check"),
                         F.when(F.col("n") == 0, "PASS").otherwise(failed).alias("status"),
                         F.lit(level).alias("level"),
                         F.when(F.col("n") == 0, "").otherwise(detail).alias("detail"),
                         F.col("n").cast("bigint").alias("offenders"))


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a table written to the shared checkpoint folder (see ``session.stage_table``)."""
    from ..session import stage_table
    return stage_table(df)


# ------------------------------------------------------------------ PIPE-8
def demographics(entries: DataFrame, rich_raw: DataFrame, fields_raw: DataFrame, then_first_per: Column | None = None) -> DataFrame:
    """PIPE-8 (JN-6 + DED-8 + DT-2/4/5): keep-first on six columns, three-tier
    demographic match with per-column fallback, age and month label.

    The match adds columns and no rows, so the first rows are found before it, among narrow ones.
    ``then_first_per`` is a Column over those six: its keep-first pass over the table follows that on the six
    columns in the same exchange (``keep_first_passes``), where only the first row of each is read.
    """
    norm = {"umuzi_email": fx.normalize_email("umuzi_email"), "email": fx.normalize_email("email")}
    rich = highest_per_key(rich_raw.withColumns(norm), ["umuzi_email"], "learner_id")
    fields = fields_raw.withColumns(norm)
    by_personal = highest_per_key(fields.filter(F.col("email").isNotNull()), ["email"], "learner_id")
    by_canon = highest_per_key(fields, ["umuzi_email"], "learner_id")
    six = ["umuzi_email", "earning_opportunity_extra_info", "earning_opportunity_type",
           "earning_opportunity_name", "date_service_accessed", "payment"]
    order = [F.col(c) for c in ORDER_COLS]
    if then_first_per is None:
        first = keep_first(entries, six, order)
    else:
        first = keep_first_passes(entries.withColumn("__per", then_first_per), [(six, None), (["__per"], None)], order).drop("__per")
    e = first.withColumn("__k", F.col("umuzi_email"))
    out = enrich_tiers(e, [(rich, "__k", "umuzi_email"), (by_personal, "__k", "email"),
                           (by_canon, "__k", "umuzi_email")], list(DEMO_FIELDS)).drop("__k")
    dob = fx.parse_dates(F.col("date_of_birth").cast("string"))
    age = fx.age_days365("date_service_accessed", dob)
    return out.withColumns({"learner_id": F.col("learner_id").cast("long"),
                            "age_service_accessed": age, "age_range": fx.band_days365(age),
                            "month_of_service_accessed": fx.month_year("date_service_accessed")})


def singles(demo: DataFrame) -> DataFrame:
    """PIPE-8 sheet "One Per Learner": stipend rows excluded (FLT-3)."""
    return demo.filter(fx.not_in("earning_opportunity_name", STIPEND_NAMES))


# ---------------------------------------------------------------- PIPE-9/10
def entries_wide(entries: DataFrame) -> DataFrame:
    """PIPE-9: n-th entry of a person in a month on row n, per cohort row."""
    ranked = rank_within(entries, ["umuzi_email", "month"], list(ORDER_COLS), out="row_id", skew_safe=True)
    fields = ["payment", "earning_opportunity_type", "earning_opportunity_name", "earning_opportunity_extra_info"]
    from ..operators import pivot
    p = pivot(ranked, ["umuzi_email", "cohort", "row_id"], "month", list(rp.FY_MONTHS),
              {f: F.max(F.col(f)) for f in fields}, name=lambda mo, f: f"{mo}_{f}")
    return p.drop("row_id")


def summarized(entries: DataFrame) -> DataFrame:
    """PIPE-10: per person, payment total and count for each fiscal month."""
    return rp.month_pivot(entries.filter(F.col("umuzi_email").isNotNull()), "umuzi_email", "month",
                          {"Payment": fx.money_sum("payment"), "Count": F.count("payment")})


# ------------------------------------------------------------------ PIPE-11
def person_key() -> Column:
    """Whom a row of the demographics stands for in the breakdown (DED-9)."""
    return fx.normalize_email("umuzi_email", nfkc_fold=True)


def breakdown_long(entries: DataFrame) -> DataFrame:
    """AGG-9 / WIN-2 / AGG-4: opportunity numbers and the 5-key long form, one row per cell of the table with its
    ``payment`` and ``n`` entries.

    A number stands for one name of a person and type, so the entries are summed per name first and the
    numbers and first dates are found among, and joined to, those sums.
    Keys may be NULL (pandas ``dropna=False``), so the two joins back are NULL-safe.
    """
    from ..operators import null_safe_join
    pk = ["umuzi_email", "earning_opportunity_type"]
    # stored: the numbers, the first dates and the long form read it
    sums = materialise(entries.withColumn("cohort", F.coalesce("cohort", F.lit("Missing Cohort Info")))
                       .groupBy(*pk, "earning_opportunity_name", "cohort", "month")
                       .agg(F.sum(F.col("payment").cast("decimal(18,2)")).alias("payment"), F.count(F.lit(1)).alias("n"),
                            F.min("date_service_accessed").alias("__first")))
    eon = sums.groupBy(*pk, "earning_opportunity_name").agg(F.min("__first").alias("first_eon_date"))
    eon = rank_within(eon, pk, [F.col("first_eon_date"), F.col("earning_opportunity_name")], out="op_num")
    firsts = sums.groupBy(*pk).agg(F.min("__first").alias("first_date"))
    j = null_safe_join(sums.drop("__first"), eon.drop("first_eon_date"), pk + ["earning_opportunity_name"], "inner")
    return null_safe_join(j, firsts, pk, "inner")


def breakdown(entries: DataFrame, demo: DataFrame, baseline: DataFrame, programme_names: DataFrame,
              ranks=None, trim: bool = True) -> DataFrame:
    """PIPE-11: earning opportunities secured, with partner columns.

    ``ranks`` are the opportunity numbers (None: all that the data hold); a
    list that leaves one out is refused, since its money would be lost.
    """
    index = ["umuzi_email", "first_date", "earning_opportunity_type", "cohort"]
    # stored: the largest number, the live pairs and the pivot read it
    cells = materialise(breakdown_long(entries).select(*index, "month", "op_num", "payment", "n"))
    wide = rp.ranked_pivot(cells, index, "month", "op_num", F.col("payment"), ranks, trim=trim, gigs=F.col("n"))
    d = keep_first(demo.withColumn("umuzi_email", person_key()), ["umuzi_email"], [F.col(c) for c in ORDER_COLS])   # DED-9
    d = d.select(F.col("umuzi_email").alias("__e"), "id_number", "cellphone_number", "nearest_metro",
                 "province", "race", "gender", "first_name", "last_name")
    b = wide.join(d, wide["umuzi_email"] == F.col("__e"), "left").drop("__e")
    names = programme_names.select(F.col("slug").alias("__s"), F.col("name").alias("Programme"))
    b = b.join(names, b["cohort"] == F.col("__s"), "left").drop("__s")
    b = b.withColumns({
        "Full Name": fx.full_name("first_name", "last_name", F.col("umuzi_email")),
        "Programme": F.coalesce("Programme", F.lit("Not Provided")),                # LKP-4
        "Current Status": map_label("earning_opportunity_type", STATUS_MAP)}).drop("first_name", "last_name")
    b = flag_members(b, ["umuzi_email"], baseline, "Counted Y1")                    # JN-8
    b = count_once(b, "umuzi_email", ["first_date", "earning_opportunity_type", "cohort"],
                   baseline=baseline, out="Youth Count (1 vs Counted)")            # WIN-3
    pair_cols = [c for c in wide.columns if c.startswith("Earning Opportunity ") or c.startswith("# of Gig ")]
    head = ["umuzi_email", "Full Name", "id_number", "first_date", "Youth Count (1 vs Counted)", "Counted Y1",
            "Current Status", "cellphone_number", "nearest_metro", "province", "cohort", "Programme",
            "race", "gender", "earning_opportunity_type"]
    return b.select(*[F.col(f"`{c}`") for c in head + pair_cols])


def programme_names(programmes: DataFrame, cohorts: DataFrame, manual: DataFrame) -> DataFrame:
    """LKP-1 + LKP-5: slug -> name for the cohorts in use; the database wins,
    the manual map fills gaps."""
    from ..operators import merge_maps
    used = programmes.join(cohorts.select(F.col("cohort").alias("slug")).distinct(), "slug", "left_semi")
    return merge_maps(manual, used.select("slug", "name"), "slug", "name")


# ---------------------------------------------------------------- PIPE-12/13
def learner_demographics(summary: DataFrame, rich_raw: DataFrame) -> DataFrame:
    """PIPE-12: summary people with their dimension row (dimension deduplicated)."""
    rich = highest_per_key(rich_raw.withColumn("umuzi_email", fx.normalize_email("umuzi_email")),
                           ["umuzi_email"], "learner_id")
    cols = ["umuzi_email", "cellphone_number", "id_number", "gender", "race", "residential_area_type",
            "province", "nearest_metro", "has_disability_or_differently_abled", "date_of_birth"]
    return summary.select("umuzi_email").join(rich.select(*cols), "umuzi_email", "left")


def reconcile_tables(summary: DataFrame, brk: DataFrame, tol: float = 0.01) -> DataFrame:
    """PIPE-13 / REC-1 / AGG-13: the two tables as shipped, their month columns
    summed and compared; money that either table lost shows as a difference."""
    from ..operators import reconcile
    a = rp.summary_long(summary).groupBy("month").agg(fx.money_sum("v").alias("v"), F.sum("n").alias("n"))
    b = rp.breakdown_long(brk).groupBy("month").agg(fx.money_sum("v").alias("v"), F.sum("n").alias("n"))
    return reconcile(a, b, "month", "v", count="n", tol=tol)


def person_diff(summary: DataFrame, brk: DataFrame, month: str | None = None, tol: float = 0.005) -> DataFrame:
    """REC-2: people whose totals in the two shipped tables differ in ``month``
    (None: the month with the largest difference)."""
    from ..operators import per_key_diff, worst
    if month is None:
        top = worst(reconcile_tables(summary, brk), "month", "diff").first()
        month = top["month"] if top else None
    side = lambda df: (df.filter(F.col("month") == month).groupBy("umuzi_email")
                       .agg(fx.money_sum("v").alias("v")))
    return per_key_diff(side(rp.summary_long(summary)), side(rp.breakdown_long(brk)), "umuzi_email", "v", tol=tol)


def breakdown_rules() -> list[Check]:
    """What every row of the breakdown must hold."""
    return [
        Check("report", "status mapped", F.col("`Current Status`").isNull(), WARN, "types without a status mapping"),
        Check("report", "pivot keys non-null", F.col("first_date").isNull() | F.col("earning_opportunity_type").isNull()
              | F.col("cohort").isNull(), ERROR, "NULL in a pivot index key")]


def report_checks(entries: DataFrame, summary: DataFrame, brk: DataFrame, recon: DataFrame, row_checks: bool = True) -> DataFrame:
    """Count-once invariant, same people in both tables, months reconcile; with ``row_checks`` also ``breakdown_rules``."""
    marks = brk.select(F.col("umuzi_email"), F.col("`Youth Count (1 vs Counted)`").alias("m"),
                       F.col("`Counted Y1`").alias("y"), F.lit("b").alias("t"))
    s = summary.select("umuzi_email", F.lit(None).cast("string").alias("m"),
                       F.lit(None).cast("boolean").alias("y"), F.lit("s").alias("t"))
    u = marks.unionByName(s)
    agg = u.agg(
        F.count_if((F.col("t") == "b") & (F.col("m") == FIRST_MARK)).alias("ones"),
        F.count_distinct(F.when((F.col("t") == "b") & ~F.col("y"), F.col("umuzi_email"))).alias("new_people"),
        F.count_distinct(F.when(F.col("t") == "b", F.col("umuzi_email"))).alias("b_people"),
        F.count_distinct(F.when(F.col("t") == "s", F.col("umuzi_email"))).alias("s_people"))
    bad = recon.agg(F.count_if(~F.col("ok")).alias("bad_months"))
    # every entry must reach the long form (inner joins to its op_num and first date)
    counted = union_all([breakdown_long(entries).select((-F.col("n")).alias("s")),
                         entries.select(F.lit(1).cast("bigint").alias("s"))])
    op_t = _count_check(counted.agg(F.sum("s").alias("n")), "report", "opportunity number assigned",
                        ERROR, "entries without an op_num")
    t1 = agg.select(F.lit("report").alias("stage"), F.lit("count-once equals non-baseline people").alias("check"),
                    F.when(F.col("ones") == F.col("new_people"), "PASS").otherwise("FAIL").alias("status"),
                    F.lit(ERROR).alias("level"), F.lit("").alias("detail"),
                    F.abs(F.col("ones") - F.col("new_people")).cast("bigint").alias("offenders"))
    t2 = agg.select(F.lit("report").alias("stage"), F.lit("same people in both tables").alias("check"),
                    F.when(F.col("b_people") == F.col("s_people"), "PASS").otherwise("FAIL").alias("status"),
                    F.lit(ERROR).alias("level"), F.lit("").alias("detail"),
                    F.abs(F.col("b_people") - F.col("s_people")).cast("bigint").alias("offenders"))
    t3 = _count_check(bad.select(F.col("bad_months").alias("n")), "report", "tables reconcile", ERROR,
                      "months whose totals differ")
    return union_all([t1, t2, t3, op_t, *([run_checks(brk, breakdown_rules())] if row_checks else [])])
