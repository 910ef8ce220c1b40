"""The earnings cleaning chain (PIPE-7) over entries derived from ``orders``.

Every order is an earning entry of its customer: the personal e-mail (with
case and blank noise) as the person, the total as the payment (some zero,
some missing), the priority as a cohort label (aliases, one canonical label
that is the exempt cohort, one missing), the status as extra info, and a
type/name pair with gaps for the type backfill.  Three sources are stacked
in concat order: last month's state (half of the entries up to 1996, first),
the live re-export of everything, and a re-sent copy of every fifth entry.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import stage_table
from ..sources import tag
from . import earnings as earn
from . import model as m
from . import registrations as reg
from . import reports as rp
from .catalog import query

# Fixed parameters of this query.
REPORT_START, AS_OF, COVERED_THROUGH = "1995-01-01", "2001-06-30", "1996-12-31"
EXEMPT = "Cohort L"
COHORT_MAP = {"urg": "Cohort U", "high": "Cohort H", "med": "Cohort M", "Cohort L": "Cohort L"}


def _base(t):
    o = t.orders
    k = F.col("o_orderkey")
    personal = F.concat(F.lit("customer"), (F.col("o_custkey") % 1000).cast("string"), F.lit("@example.org"))
    noisy = F.concat(F.lit("  Customer"), (F.col("o_custkey") % 1000).cast("string"), F.lit("@Example.org "))
    pr = F.col("o_orderpriority")
    return o.select(
        k.alias("_row"),
        F.when(k % 4 == 0, noisy).otherwise(personal).alias("umuzi_email"),
        F.when(k % 23 == 0, F.lit(0.0)).when(k % 29 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("payment"),
        F.col("o_orderdate").alias("date_service_accessed"),
        F.when(pr == "1-URGENT", "urg").when(pr == "2-HIGH", "high").when(pr == "3-MEDIUM", "med")
         .when(pr == "5-LOW", EXEMPT).alias("cohort"),
        F.when(k % 6 == 0, F.lit(None)).otherwise(F.col("o_orderstatus")).alias("earning_opportunity_extra_info"),
        F.when(k % 7 == 0, F.lit(None)).when(F.col("o_orderstatus") == "F", "Placement")
         .otherwise("Impact gig").alias("earning_opportunity_type"),
        F.when(k % 3 == 0, "Internship").when(k % 3 == 1, F.lit(None))
         .otherwise(F.concat(F.lit("Gig "), pr)).alias("earning_opportunity_name"))


def _sources(t):
    b = _base(t)
    prev = b.filter((F.col("date_service_accessed") <= F.lit(COVERED_THROUGH).cast("timestamp_ntz"))
                    & (F.col("_row") % 2 == 0))
    resend = b.filter(F.col("_row") % 5 == 0)
    return [tag(prev.withColumn("_file", F.lit("state")), "prev_combined", 0),
            tag(b.withColumn("_file", F.lit("live")), "live", 1),
            tag(resend.withColumn("_file", F.lit("resend")), "resend", 2)]


def _rich(t):
    return m.learners(t).withColumnRenamed("id", "learner_id")


_BASE_SQL = f"""
base AS (
  SELECT o_orderkey AS rowk, o_orderdate,
    CASE WHEN o_orderkey % 4 = 0 THEN '  Customer' || CAST(o_custkey % 1000 AS VARCHAR) || '@Example.org '
         ELSE 'customer' || CAST(o_custkey % 1000 AS VARCHAR) || '@example.org' END AS email_raw,
    CASE WHEN o_orderkey % 23 = 0 THEN 0.0 WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_totalprice END AS payment,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'urg' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'med'
                         WHEN '5-LOW' THEN '{EXEMPT}' END AS cohort,
    CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderstatus END AS extra,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Placement' ELSE 'Impact gig' END AS etype,
    CASE o_orderkey % 3 WHEN 0 THEN 'Internship' WHEN 1 THEN NULL ELSE 'Gig ' || o_orderpriority END AS ename
  FROM orders
)""", f"""
stacked AS (
  SELECT 0 AS prio, 'prev_combined' AS source, * FROM base
   WHERE o_orderdate <= TIMESTAMP '{COVERED_THROUGH}' AND rowk % 2 = 0
  UNION ALL SELECT 1 AS prio, 'live' AS source, * FROM base
  UNION ALL SELECT 2 AS prio, 'resend' AS source, * FROM base WHERE rowk % 5 = 0
)""", """
idmap AS (
  SELECT email, umuzi_email FROM (
    SELECT email, umuzi_email, row_number() OVER (PARTITION BY email ORDER BY id DESC) AS rn
    FROM learners WHERE email IS NOT NULL) WHERE rn = 1
)""", """
normed AS (
  SELECT s.*, COALESCE(mm.umuzi_email, s.e) AS em FROM (
    SELECT *, lower(regexp_replace(email_raw, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g')) AS e FROM stacked) s
  LEFT JOIN idmap mm ON mm.email = s.e
)""", f"""
typed AS (
  SELECT *, strftime(o_orderdate, '%B') AS month,
    CASE WHEN etype IS NULL AND ename IS NOT DISTINCT FROM 'Internship' THEN 'Placement'
         WHEN etype IS NULL THEN 'Experience gig' ELSE etype END AS etype2
  FROM normed
  WHERE o_orderdate IS NOT NULL AND o_orderdate >= TIMESTAMP '{REPORT_START}'
    AND o_orderdate <= TIMESTAMP '{AS_OF}'
)""", """
exact AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY em, payment, o_orderdate, cohort, extra, etype2, ename, month, source
                                 ORDER BY prio, rowk) AS rn3 FROM typed) WHERE rn3 = 1
)""", f"""
resub1 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY em, payment, o_orderdate, cohort, extra, ename
                                 ORDER BY prio, rowk) AS rn4 FROM exact)
  WHERE rn4 = 1 OR cohort IS NOT DISTINCT FROM '{EXEMPT}'
)""", """
paid AS (SELECT * FROM resub1 WHERE payment IS NOT NULL AND NOT isnan(payment) AND payment <> 0)""", """
mapped AS (
  SELECT * REPLACE (COALESCE(
    CASE cohort WHEN 'urg' THEN 'Cohort U' WHEN 'high' THEN 'Cohort H' WHEN 'med' THEN 'Cohort M'
                WHEN 'Cohort L' THEN 'Cohort L' END,
    CASE WHEN cohort IN ('Cohort U', 'Cohort H', 'Cohort M', 'Cohort L') THEN cohort END) AS cohort)
  FROM paid
)""", f"""
resub2 AS (
  SELECT * FROM (
    SELECT * EXCLUDE (rn4), row_number() OVER (PARTITION BY em, payment, o_orderdate, cohort, extra, ename
                                               ORDER BY prio, rowk) AS rn4 FROM mapped)
  WHERE rn4 = 1 OR cohort IS NOT DISTINCT FROM '{EXEMPT}'
)""", """
prev AS (SELECT * FROM resub2 WHERE source = 'prev_combined')""", """
counts AS (SELECT em, payment, o_orderdate, cohort, extra, ename, count(*) AS c FROM prev GROUP BY ALL)""", f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY em, payment, o_orderdate, cohort, extra, ename, cand
                               ORDER BY prio, rowk) - 1 AS rk
  FROM (SELECT *, o_orderdate <= TIMESTAMP '{COVERED_THROUGH}' AS cand
        FROM resub2 WHERE source <> 'prev_combined')
)""", """
kept AS (
  SELECT r.* FROM ranked r LEFT JOIN counts k
    ON r.em IS NOT DISTINCT FROM k.em AND r.payment IS NOT DISTINCT FROM k.payment
   AND r.o_orderdate IS NOT DISTINCT FROM k.o_orderdate AND r.cohort IS NOT DISTINCT FROM k.cohort
   AND r.extra IS NOT DISTINCT FROM k.extra AND r.ename IS NOT DISTINCT FROM k.ename
  WHERE NOT (r.cand AND r.rk < COALESCE(k.c, 0))
)"""

_OUT = """em AS umuzi_email, payment, o_orderdate AS date_service_accessed, cohort,
  extra AS earning_opportunity_extra_info, etype2 AS earning_opportunity_type,
  ename AS earning_opportunity_name, source, month"""


@query("earnings_entries", m.with_ctes(m.LEARNERS_SQL, *_BASE_SQL, body=f"""
SELECT {_OUT} FROM prev
UNION ALL
SELECT {_OUT} FROM kept
"""))
def earnings_entries(spark, sf_dir):
    """PIPE-7: the cleaned entries -- normalise and remap e-mails, window,
    backfill types, exact dedup, keep-first with the exempt cohort, drop zero
    and missing payments, remap cohorts, keep-first again, drop what the prior
    state already covers (multiset, NULL-safe keys)."""
    return _entries(spark, sf_dir).select(*earn.CANON_COLS, "source", "month")


def _entries(spark, sf_dir):
    t = m.Tables(spark, sf_dir)
    cfg = earn.EarningsConfig(report_start=REPORT_START, as_of=AS_OF, covered_through=COVERED_THROUGH,
                              fy_start_year=1996, exempt_cohort=EXEMPT, cohort_map=COHORT_MAP)
    entries, _ = earn.clean_entries(_sources(t), _rich(t), cfg)
    return entries


# ---------------------------------------------------------------- PIPE-8..13
# The reports over those entries.  Dimension: eligible learners first, then all learners by
# personal and by canonical e-mail; baseline: every fourth learner; two cohorts have a programme.
PROGRAMMES = (("Cohort U", "Urgent lab"), ("Cohort H", "High lab"))

_ALL_SQL = """
cleaned AS (
  SELECT prio, rowk, em, payment, o_orderdate, cohort, extra, etype2, ename, month FROM prev
  UNION ALL SELECT prio, rowk, em, payment, o_orderdate, cohort, extra, etype2, ename, month FROM kept
)"""
_CHAIN = (m.LEARNERS_SQL, *_BASE_SQL, _ALL_SQL)
_MONTHS_SQL = "fiscal AS (SELECT unnest([" + ", ".join(f"'{mo}'" for mo in rp.FY_MONTHS) + "]) AS month)"


def _people(spark, t):
    apps = reg.applications_to_use(m.applications(t), m.application_status(spark))
    return reg.enrichment_dimension(m.learners(t), apps, m.cities(t), m.provinces(t), m.area_types(t))


def _all_people(t):
    metro = m.cities(t).select(F.col("id").alias("nearest_city"), F.col("name").alias("nearest_metro"))
    return (m.learners(t).join(metro, "nearest_city", "left").drop("province")
            .withColumnRenamed("id", "learner_id"))


_MATCHED = ("""
known AS (
  SELECT l.id, l.email, l.umuzi_email, l.first_name, l.last_name, l.race, l.gender, l.date_of_birth, metro.n_name AS metro,
    coalesce(l.umuzi_email, l.email) AS main_email,
    (coalesce(l.is_south_african_citizen, FALSE) OR coalesce(l.nationality = 'South African', FALSE))
      AND coalesce(NOT l.is_currently_employed AND NOT l.test_account, FALSE) AS eligible
  FROM learners l LEFT JOIN nation metro ON metro.n_nationkey = l.nearest_city
)""", """
tiers AS (
  SELECT 1 AS tier, main_email AS key, max(id) AS id FROM known WHERE eligible GROUP BY 2
  UNION ALL SELECT 2, email, max(id) FROM known GROUP BY 2
  UNION ALL SELECT 3, umuzi_email, max(id) FROM known GROUP BY 2
)""", """
matched AS (
  SELECT key, arg_min(first_name, tier) FILTER (first_name IS NOT NULL) AS first_name,
    arg_min(last_name, tier) FILTER (last_name IS NOT NULL) AS last_name,
    arg_min(race, tier) FILTER (race IS NOT NULL) AS race, arg_min(gender, tier) FILTER (gender IS NOT NULL) AS gender,
    arg_min(date_of_birth, tier) FILTER (date_of_birth IS NOT NULL) AS dob,
    arg_min(metro, tier) FILTER (metro IS NOT NULL) AS metro, arg_min(known.id, tier) AS learner_id
  FROM tiers JOIN known USING (id) WHERE key IS NOT NULL GROUP BY key
)""")


@query("earnings_demographics", m.with_ctes(*_CHAIN, *_MATCHED, """
once AS (
  SELECT * FROM cleaned QUALIFY row_number() OVER (
    PARTITION BY em, extra, etype2, ename, o_orderdate, payment ORDER BY prio, rowk) = 1
)""", """
aged AS (
  SELECT *, CAST(floor(date_diff('day', CAST(dob AS DATE), CAST(o_orderdate AS DATE)) / 365) AS BIGINT) AS age
  FROM once LEFT JOIN matched ON key = em
)""", body="""
SELECT em AS umuzi_email, payment, o_orderdate AS date_service_accessed, cohort, ename AS earning_opportunity_name,
  CAST(learner_id AS DOUBLE) AS learner_id, first_name, race, gender, metro AS nearest_metro,
  CAST(age AS DOUBLE) AS age_service_accessed,
  CASE WHEN age <= 17 THEN '17 and below' WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35'
       WHEN age > 35 THEN '36+' END AS age_range,
  strftime(o_orderdate, '%B %Y') AS month_of_service_accessed
FROM aged
"""))
def earnings_demographics(spark, sf_dir):
    """PIPE-8 / JN-6 / DED-8: three-tier demographics with per-column fallback, one row per six columns."""
    t = m.Tables(spark, sf_dir)
    out = earn.demographics(_entries(spark, sf_dir), _people(spark, t), _all_people(t))
    return out.select("umuzi_email", "payment", "date_service_accessed", "cohort", "earning_opportunity_name",
                      F.col("learner_id").cast("double").alias("learner_id"), "first_name", "race", "gender",
                      "nearest_metro", F.col("age_service_accessed").cast("double").alias("age_service_accessed"),
                      "age_range", "month_of_service_accessed")


def _shipped(spark, sf_dir, entries=None, broken=None):
    """The stored summary and breakdown tables (PIPE-10, PIPE-11), opportunity numbers from the data.

    ``broken`` are the entries that the breakdown is built from, where they differ from the summary's.
    """
    t = m.Tables(spark, sf_dir)
    entries = stage_table(_entries(spark, sf_dir), "entries") if entries is None else entries
    # only the breakdown reads these demographics, and of each person the first row (DED-9)
    demo = earn.demographics(entries, _people(spark, t), _all_people(t), then_first_per=earn.person_key())
    baseline = _all_people(t).filter("learner_id % 4 = 0 AND umuzi_email IS NOT NULL").select("umuzi_email")
    names = spark.createDataFrame(list(PROGRAMMES), "slug string, name string")
    brk = earn.breakdown(entries if broken is None else broken, demo, baseline, names)
    return stage_table(earn.summarized(entries), "summary"), stage_table(brk, "breakdown")


_SHIPPED_KEYS = ("first_date", "Youth Count (1 vs Counted)", "Counted Y1", "Current Status", "cohort", "Programme",
                 "earning_opportunity_type", "Full Name")


@query("earnings_breakdown", m.with_ctes(*_CHAIN, *_MATCHED, """
numbered AS (
  SELECT em, etype2, ename, row_number() OVER (PARTITION BY em, etype2 ORDER BY min(o_orderdate), ename NULLS FIRST) AS number
  FROM cleaned GROUP BY em, etype2, ename
)""", """
cells AS (
  SELECT c.em, c.etype2, coalesce(cohort, 'Missing Cohort Info') AS cohort, month, number,
    CAST(sum(CAST(payment AS DECIMAL(18,2))) AS DOUBLE) AS v, count(*) AS n
  FROM cleaned c JOIN numbered x ON x.em IS NOT DISTINCT FROM c.em AND x.etype2 = c.etype2 AND x.ename IS NOT DISTINCT FROM c.ename
  GROUP BY ALL
)""", """
started AS (SELECT em, etype2, min(o_orderdate) AS first_date FROM cleaned GROUP BY ALL)""", """
lines AS (
  SELECT em, etype2, cohort, first_date, em IN (SELECT umuzi_email FROM learners WHERE id % 4 = 0 AND umuzi_email IS NOT NULL) AS old,
    row_number() OVER (PARTITION BY em ORDER BY first_date, etype2, cohort) AS place
  FROM (SELECT DISTINCT em, etype2, cohort FROM cells) JOIN started USING (em, etype2)
)""", body="""
SELECT em AS umuzi_email, coalesce(first_name || ' ' || last_name, em) AS full_name, first_date,
  CASE WHEN place = 1 AND NOT old THEN '1' ELSE 'Counted' END AS mark, old AS baseline,
  CASE etype2 WHEN 'Placement' THEN 'Placement' ELSE 'Active' END AS status, cohort,
  CASE cohort WHEN 'Cohort U' THEN 'Urgent lab' WHEN 'Cohort H' THEN 'High lab' ELSE 'Not Provided' END AS programme,
  etype2 AS earning_opportunity_type, month, number, v, n
FROM cells JOIN lines USING (em, etype2, cohort) LEFT JOIN matched ON key = em
"""))
def earnings_breakdown(spark, sf_dir):
    """PIPE-11 / RSH-4 / DED-9 / JN-8 / WIN-2/3 / STR-10: the shipped breakdown, its month and number columns unpivoted again."""
    _, brk = _shipped(spark, sf_dir)
    long = rp.breakdown_long(brk, keep=_SHIPPED_KEYS).filter("n > 0")
    return long.select("umuzi_email", F.col("Full Name").alias("full_name"), "first_date", F.col(f"`{_SHIPPED_KEYS[1]}`").alias("mark"),
                       F.col(f"`{_SHIPPED_KEYS[2]}`").alias("baseline"), F.col(f"`{_SHIPPED_KEYS[3]}`").alias("status"),
                       "cohort", F.col("Programme").alias("programme"), "earning_opportunity_type", "month", "number", "v", "n")


@query("earnings_reconcile", m.with_ctes(*_CHAIN, _MONTHS_SQL, """
sums AS (
  SELECT month, CAST(sum(CAST(payment AS DECIMAL(18,2))) AS DOUBLE) AS v, count(*) AS n FROM cleaned GROUP BY month
)""", body="""
SELECT month, coalesce(v, 0.0) AS a_value, coalesce(v, 0.0) AS b_value, coalesce(n, 0) AS a_count, coalesce(n, 0) AS b_count,
  CAST(0 AS DOUBLE) AS diff, TRUE AS ok
FROM fiscal LEFT JOIN sums USING (month)
"""))
def earnings_reconcile(spark, sf_dir):
    """PIPE-13 / REC-1 / AGG-13: the shipped summary against the shipped breakdown, month by month."""
    summary, brk = _shipped(spark, sf_dir)
    return earn.reconcile_tables(summary, brk).select("month", "a_value", "b_value", "a_count", "b_count", "diff", "ok")


@query("earnings_losses", m.with_ctes(*_CHAIN, _MONTHS_SQL, """
left_out AS (SELECT *, ename = 'Internship' AND cohort = 'Cohort H' AND month IN ('March', 'June') AS lost FROM cleaned)""", """
sums AS (
  SELECT month, CAST(sum(CAST(payment AS DECIMAL(18,2))) AS DOUBLE) AS a, count(*) AS an,
    CAST(sum(CAST(payment AS DECIMAL(18,2))) FILTER (lost IS NOT TRUE) AS DOUBLE) AS b, count(*) FILTER (lost IS NOT TRUE) AS bn
  FROM left_out GROUP BY month
)""", body="""
SELECT month, coalesce(a, 0.0) AS a_value, coalesce(b, 0.0) AS b_value, coalesce(an, 0) AS a_count, coalesce(bn, 0) AS b_count,
  round(coalesce(a, 0.0) - coalesce(b, 0.0), 2) AS diff, abs(coalesce(a, 0.0) - coalesce(b, 0.0)) <= 0.01 AND coalesce(an, 0) = coalesce(bn, 0) AS ok
FROM fiscal LEFT JOIN sums USING (month)
"""))
def earnings_losses(spark, sf_dir):
    """PIPE-13 / REC-1: a breakdown that lost the rows of one cohort in two months; the reconciliation shows where and how much."""
    entries = stage_table(_entries(spark, sf_dir), "entries")
    lost = (F.col("earning_opportunity_name") == "Internship") & (F.col("cohort") == "Cohort H") & F.col("month").isin("March", "June")
    summary, brk = _shipped(spark, sf_dir, entries, entries.filter(F.coalesce(~lost, F.lit(True))))
    return earn.reconcile_tables(summary, brk).select("month", "a_value", "b_value", "a_count", "b_count", "diff", "ok")


@query("earnings_learners", m.with_ctes(*_CHAIN, """
known AS (
  SELECT coalesce(umuzi_email, email) AS key, max(id) AS id FROM learners
  WHERE (coalesce(is_south_african_citizen, FALSE) OR coalesce(nationality = 'South African', FALSE))
    AND coalesce(NOT is_currently_employed AND NOT test_account, FALSE) GROUP BY 1
)""", body="""
SELECT em AS umuzi_email, l.id_number, l.gender, l.race, l.date_of_birth
FROM (SELECT DISTINCT em FROM cleaned) LEFT JOIN known ON key = em LEFT JOIN learners l ON l.id = known.id
"""))
def earnings_learners(spark, sf_dir):
    """PIPE-12 / JN-12: the summary's people with their row of the deduplicated dimension."""
    t = m.Tables(spark, sf_dir)
    dim = _people(spark, t)
    out = earn.learner_demographics(earn.summarized(_entries(spark, sf_dir)), dim)
    return out.select("umuzi_email", "id_number", "gender", "race", "date_of_birth")
