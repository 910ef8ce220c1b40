"""Queries for identity resolution, enrichment and deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import (count_once, cross_source_repeats, drop_covered, drop_exact_duplicates,
                         duplicate_members, duplicate_report, duplicate_rows, enrich_tiers,
                         fill_where, first_non_null_cols, flag_members, highest_per_key, keep_first,
                         key_violations, rank_within, remap_identity, sorted_distinct, unmatched)
from .. import functions as fx
from . import model as m
from .catalog import query


# -------------------------------------------------------------------- JN-5
def _order_emails(t):
    k = F.col("o_orderkey")
    e = (F.when(k % 3 == 0, F.concat(F.lit("unknown"), F.col("o_custkey").cast("string"), F.lit("@example.org")))
          .otherwise(F.concat(F.lit("customer"), (F.col("o_custkey") % 1000).cast("string"), F.lit("@example.org"))))
    return t.orders.select("o_orderkey", e.alias("email"))


@query("identity_remap", m.with_ctes(m.LEARNERS_SQL, """
idmap AS (
  SELECT email, umuzi_email FROM (
    SELECT email, umuzi_email, row_number() OVER (PARTITION BY email ORDER BY id DESC) AS rn
    FROM learners WHERE email IS NOT NULL) WHERE rn = 1
)""", """
facts AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 3 = 0 THEN 'unknown' || CAST(o_custkey AS VARCHAR) || '@example.org'
         ELSE 'customer' || CAST(o_custkey % 1000 AS VARCHAR) || '@example.org' END AS email
  FROM orders
)""", body="""
SELECT f.o_orderkey, f.email, COALESCE(mm.umuzi_email, f.email) AS resolved
FROM facts f LEFT JOIN idmap mm ON mm.email = f.email
"""))
def identity_remap(spark, sf_dir):
    """JN-5 / T3: personal -> canonical e-mail; duplicate personal e-mails resolve
    to the highest learner id; unknown e-mails stay as they are."""
    t = m.Tables(spark, sf_dir)
    return remap_identity(_order_emails(t), "email", m.learners(t), "email", "umuzi_email",
                          id_col="id", out="resolved")


# -------------------------------------------------------------------- JN-9
@query("unmatched_review", """
SELECT e.event_type, e.user_id, CAST(count(*) AS BIGINT) AS n_rows
FROM events e
WHERE e.user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey % 3 <> 0 AND c.c_custkey = e.user_id)
GROUP BY e.event_type, e.user_id
""")
def unmatched_review(spark, sf_dir):
    """JN-9: event users with no row in the (partial) person dimension, by type."""
    t = m.Tables(spark, sf_dir)
    dim = t.customer.filter(F.col("c_custkey") % 3 != 0)
    return unmatched(t.events, dim, "user_id", "c_custkey", by=["event_type"])


# -------------------------------------------------------------------- JN-6
_TIERS_SQL = """
tier1 AS (
  SELECT c_custkey AS k,
    CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS name,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS nation,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS balance
  FROM customer WHERE c_custkey % 10 <> 3
),
tier2 AS (
  SELECT s_suppkey AS k, s_name AS name, s_nationkey AS nation,
    CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS balance
  FROM supplier
),
tier3 AS (SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer)"""


@query("enrich_three_tier", m.with_ctes(_TIERS_SQL, body="""
SELECT o.o_orderkey,
  COALESCE(t1.name, t2.name, t3.name) AS name,
  COALESCE(t1.nation, t2.nation, t3.nation) AS nation,
  COALESCE(t1.balance, t2.balance, t3.balance) AS balance
FROM orders o
LEFT JOIN tier1 t1 ON t1.k = o.o_custkey
LEFT JOIN tier2 t2 ON t2.k = o.o_custkey % 100
LEFT JOIN tier3 t3 ON t3.k = o.o_custkey + 1
"""))
def enrich_three_tier(spark, sf_dir):
    """JN-6: per-column fallback across three dimensions (combine_first)."""
    t = m.Tables(spark, sf_dir)
    k = F.col("c_custkey")
    t1 = (t.customer.filter(k % 10 != 3)
           .select(k.alias("k"), F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
                   F.when(k % 7 == 0, F.lit(None)).otherwise(F.col("c_nationkey")).alias("nation"),
                   F.when(k % 4 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("balance")))
    t2 = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"),
                           F.col("s_nationkey").alias("nation"),
                           F.when(F.col("s_suppkey") % 3 == 0, F.lit(None))
                            .otherwise(F.col("s_acctbal")).alias("balance"))
    t3 = t.customer.select(k.alias("k"), F.col("c_name").alias("name"),
                           F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    fact = t.orders.select("o_orderkey", "o_custkey", (F.col("o_custkey") % 100).alias("k2"),
                           (F.col("o_custkey") + 1).alias("k3"))
    out = enrich_tiers(fact, [(t1, "o_custkey", "k"), (t2, "k2", "k"), (t3, "k3", "k")],
                       ["name", "nation", "balance"])
    return out.select("o_orderkey", "name", "nation", "balance")


# ------------------------------------------------------------------ PIPE-4b
@query("nameless_refill", m.with_ctes(m.LEARNERS_SQL, """
ev AS (
  SELECT event_id, user_id,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'Evt' || CAST(user_id AS VARCHAR) END AS first_name,
    CASE WHEN event_id % 4 = 0 OR event_id % 6 = 0 THEN NULL ELSE 'Lst' || CAST(user_id AS VARCHAR) END AS last_name,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'unknown' END AS cellphone_number
  FROM events
)""", """
dim AS (SELECT id, first_name, last_name, cellphone_number FROM learners WHERE id % 3 <> 0)""", body="""
SELECT e.event_id, e.user_id,
  CASE WHEN e.first_name IS NULL AND e.last_name IS NULL THEN d.first_name ELSE e.first_name END AS first_name,
  CASE WHEN e.first_name IS NULL AND e.last_name IS NULL THEN d.last_name ELSE e.last_name END AS last_name,
  CASE WHEN e.first_name IS NULL AND e.last_name IS NULL THEN d.cellphone_number ELSE e.cellphone_number END
    AS cellphone_number
FROM ev e LEFT JOIN dim d ON d.id = e.user_id
"""))
def nameless_refill(spark, sf_dir):
    """PIPE-4b: rows with neither name re-enriched from the dimension, in one join."""
    t = m.Tables(spark, sf_dir)
    k = F.col("event_id")
    ev = t.events.select(
        "event_id", "user_id",
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("Evt"), F.col("user_id").cast("string"))).alias("first_name"),
        F.when((k % 4 == 0) | (k % 6 == 0), F.lit(None))
         .otherwise(F.concat(F.lit("Lst"), F.col("user_id").cast("string"))).alias("last_name"),
        F.when(k % 4 == 0, F.lit(None)).otherwise(F.lit("unknown")).alias("cellphone_number"))
    dim = m.learners(t).filter(F.col("id") % 3 != 0)
    nameless = F.col("first_name").isNull() & F.col("last_name").isNull()
    return fill_where(ev, nameless, dim, "user_id", ["first_name", "last_name", "cellphone_number"],
                      dim_key="id")


# ------------------------------------------------------------- DED-3, AGG-11
_LI_COLS = ("l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
            "l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate")
_TAGGED_SQL = f"""
tagged AS (
  SELECT 'main' AS source, {_LI_COLS} FROM lineitem
  UNION ALL SELECT 'main' AS source, {_LI_COLS} FROM lineitem WHERE l_orderkey % 10 = 0
  UNION ALL SELECT 'extra' AS source, {_LI_COLS} FROM lineitem WHERE l_orderkey % 10 = 5
)"""


def _tagged(t):
    li = t.lineitem
    return (li.withColumn("source", F.lit("main"))
              .unionByName(li.filter(F.col("l_orderkey") % 10 == 0).withColumn("source", F.lit("main")))
              .unionByName(li.filter(F.col("l_orderkey") % 10 == 5).withColumn("source", F.lit("extra"))))


@query("exact_dedup_report", m.with_ctes(_TAGGED_SQL, body=f"""
SELECT source, CAST(SUM(n - 1) AS BIGINT) AS duplicates_removed
FROM (SELECT source, {_LI_COLS}, count(*) AS n FROM tagged GROUP BY ALL)
GROUP BY source
"""))
def exact_dedup_report(spark, sf_dir):
    """DED-3 report: exact copies removed per source (source is part of the row)."""
    return duplicate_report(_tagged(m.Tables(spark, sf_dir)), "source")


@query("exact_dedup_rows", m.with_ctes(_TAGGED_SQL, body="SELECT DISTINCT * FROM tagged"))
def exact_dedup_rows(spark, sf_dir):
    """DED-3 / DED-10: exact duplicates collapse; cross-source copies survive."""
    return drop_exact_duplicates(_tagged(m.Tables(spark, sf_dir)))


@query("duplicate_row_count", m.with_ctes(_TAGGED_SQL, body=f"""
SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT {_LI_COLS}, source, count(*) AS n FROM tagged GROUP BY ALL)
"""))
def duplicate_row_count(spark, sf_dir):
    """AGG-11: surplus copies of identical rows."""
    return duplicate_rows(_tagged(m.Tables(spark, sf_dir)))


# -------------------------------------------------------------------- DED-4
_EV_SQL = """
ev AS (
  SELECT event_id, user_id,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS cohort,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS value,
    date_trunc('day', ts) AS day
  FROM events
)"""


def _ev(t):
    k = F.col("event_id")
    return t.events.select(
        "event_id", "user_id",
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("cohort"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))


EXEMPT_COHORT = "purchase"


@query("keep_first_exempt", m.with_ctes(_EV_SQL, """
resubmitted AS (
  SELECT 1 AS src, * FROM ev
  UNION ALL SELECT 2 AS src, * FROM ev WHERE event_id % 4 = 0
  UNION ALL SELECT 3 AS src, event_id + 1000000000, user_id, cohort, value, day FROM ev WHERE event_id % 6 = 0
)""", body=f"""
SELECT src, event_id, user_id, cohort, value, day FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, value, day ORDER BY src, event_id) AS rn
  FROM resubmitted)
WHERE rn = 1 OR cohort IS NOT DISTINCT FROM '{EXEMPT_COHORT}'
"""))
def keep_first_exempt(spark, sf_dir):
    """DED-4 / T1: keep-first on a NULL-safe business key; the exempt cohort's
    repeats are genuine and all kept (a NULL cohort is not exempt)."""
    ev = _ev(m.Tables(spark, sf_dir))
    rows = (ev.withColumn("src", F.lit(1))
              .unionByName(ev.filter(F.col("event_id") % 4 == 0).withColumn("src", F.lit(2)))
              .unionByName(ev.filter(F.col("event_id") % 6 == 0)
                             .withColumn("event_id", F.col("event_id") + 1000000000)
                             .withColumn("src", F.lit(3))))
    out = keep_first(rows, ["user_id", "value", "day"], ["src", "event_id"],
                     exempt=F.col("cohort").eqNullSafe(F.lit(EXEMPT_COHORT)), skew_safe=True)
    return out.select("src", "event_id", "user_id", "cohort", "value", "day")


# -------------------------------------------------------------------- DED-5
COVERED_THROUGH = "2024-01-15"
_KEY = ["user_id", "cohort", "value", "day"]


@query("drop_covered", m.with_ctes(_EV_SQL, f"""
state AS (SELECT * FROM ev WHERE day <= TIMESTAMP '{COVERED_THROUGH}')""", """
live AS (
  SELECT 1 AS copy, * FROM ev
  UNION ALL SELECT 2 AS copy, * FROM ev WHERE event_id % 7 = 0
)""", """
counts AS (SELECT user_id, cohort, value, day, count(*) AS c FROM state GROUP BY ALL)""", f"""
cand AS (
  SELECT l.*, row_number() OVER (PARTITION BY l.user_id, l.cohort, l.value, l.day
                                 ORDER BY l.copy, l.event_id) - 1 AS rnk
  FROM live l WHERE l.day <= TIMESTAMP '{COVERED_THROUGH}'
)""", body=f"""
SELECT c.copy, c.event_id, c.user_id, c.cohort, c.value, c.day
FROM cand c LEFT JOIN counts k
  ON c.user_id IS NOT DISTINCT FROM k.user_id AND c.cohort IS NOT DISTINCT FROM k.cohort
 AND c.value IS NOT DISTINCT FROM k.value AND c.day IS NOT DISTINCT FROM k.day
WHERE c.rnk >= COALESCE(k.c, 0)
UNION ALL
SELECT copy, event_id, user_id, cohort, value, day FROM live WHERE NOT (day <= TIMESTAMP '{COVERED_THROUGH}')
"""))
def drop_covered_q(spark, sf_dir):
    """DED-5 / SET-4 / JN-7: drop live rows already in the prior state (multiset,
    NULL-safe keys); second copies of covered rows survive as back-fills."""
    ev = _ev(m.Tables(spark, sf_dir))
    through = F.lit(COVERED_THROUGH).cast("timestamp_ntz")
    state = ev.filter(F.col("day") <= through)
    live = (ev.withColumn("copy", F.lit(1))
              .unionByName(ev.filter(F.col("event_id") % 7 == 0).withColumn("copy", F.lit(2))))
    kept, _ = drop_covered(live, state, _KEY, ["copy", "event_id"],
                           covered=F.col("day") <= through, skew_safe=True)
    return kept.select("copy", "event_id", "user_id", "cohort", "value", "day")


# ------------------------------------------------------------------ DED-6/7
_SOURCES_SQL = """
sourced AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS source, event_id, user_id, cohort, day FROM ev
  UNION ALL SELECT 'c' AS source, event_id, user_id, cohort, day FROM ev WHERE event_id % 5 = 0
)"""


def _sourced(t):
    ev = _ev(t)
    a = ev.select(F.when(F.col("event_id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("source"),
                  "event_id", "user_id", "cohort", "day")
    c = ev.filter(F.col("event_id") % 5 == 0).select(F.lit("c").alias("source"), "event_id",
                                                     "user_id", "cohort", "day")
    return a.unionByName(c)


@query("cross_source_near_dups", m.with_ctes(_EV_SQL, _SOURCES_SQL, body="""
SELECT user_id, cohort, day, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT source) AS BIGINT) AS n_sources
FROM sourced WHERE user_id IS NOT NULL AND cohort IS NOT NULL AND day IS NOT NULL
GROUP BY user_id, cohort, day
HAVING count(*) > 1 AND count(DISTINCT source) > 1
"""))
def cross_source_near_dups(spark, sf_dir):
    """DED-6: the same (person, cohort, day) reported by more than one source."""
    return cross_source_repeats(_sourced(m.Tables(spark, sf_dir)), ["user_id", "cohort", "day"])


@query("duplicate_listing", m.with_ctes(_EV_SQL, _SOURCES_SQL, body="""
SELECT s.* FROM sourced s
WHERE EXISTS (
  SELECT 1 FROM (SELECT user_id, cohort, day FROM sourced GROUP BY ALL HAVING count(*) > 1) d
  WHERE d.user_id IS NOT DISTINCT FROM s.user_id AND d.cohort IS NOT DISTINCT FROM s.cohort
    AND d.day IS NOT DISTINCT FROM s.day)
"""))
def duplicate_listing(spark, sf_dir):
    """DED-7: every member of a repeated key (NULL keys compare equal)."""
    return duplicate_members(_sourced(m.Tables(spark, sf_dir)), ["user_id", "cohort", "day"])


# -------------------------------------------------------------- DED-2 / 11
@query("highest_id_per_key", """
SELECT c_nationkey, segment, c_custkey, c_name FROM (
  SELECT c_nationkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END AS segment,
         c_custkey, c_name,
         row_number() OVER (PARTITION BY c_nationkey,
                            CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_mktsegment END
                            ORDER BY c_custkey DESC NULLS LAST) AS rn
  FROM customer)
WHERE rn = 1
""")
def highest_id_per_key(spark, sf_dir):
    """DED-2: highest id per (nation, segment); the NULL segment is one group."""
    c = m.Tables(spark, sf_dir).customer
    d = c.select("c_nationkey",
                 F.when(F.col("c_custkey") % 10 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"),
                 "c_custkey", "c_name")
    return highest_per_key(d, ["c_nationkey", "segment"], "c_custkey")


@query("key_violations", m.with_ctes(m.LEARNERS_SQL, body="""
SELECT email, CAST(count(*) AS BIGINT) AS n FROM learners GROUP BY email HAVING count(*) > 1
"""))
def key_violations_q(spark, sf_dir):
    """DED-11: personal e-mails that map to more than one learner."""
    return key_violations(m.learners(m.Tables(spark, sf_dir)), ["email"])


# ------------------------------------------------------------ AGG-6/7/8
@query("person_rollup", """
WITH ev AS (
  SELECT user_id, ts, event_id, event_type,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'a' || CAST(event_id AS VARCHAR) END AS note,
    CASE WHEN event_id % 5 <> 0 THEN NULL ELSE value END AS score
  FROM events
)
SELECT user_id,
  arg_min(note, struct_pack(t := ts, i := event_id)) FILTER (WHERE note IS NOT NULL) AS note,
  arg_min(score, struct_pack(t := ts, i := event_id)) FILTER (WHERE score IS NOT NULL) AS score,
  string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS event_types,
  max(ts) AS last_ts,
  strftime(max(ts), '%B') AS last_month
FROM ev GROUP BY user_id
""")
def person_rollup(spark, sf_dir):
    """AGG-6/7/8 (PIPE-5): per person the first non-NULL value of each column,
    the sorted distinct type list as text, and the latest month."""
    e = m.Tables(spark, sf_dir).events
    k = F.col("event_id")
    ev = e.select("user_id", "ts", "event_id", "event_type",
                  F.when(k % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("a"), k.cast("string"))).alias("note"),
                  F.when(k % 5 != 0, F.lit(None)).otherwise(F.col("value")).alias("score"))
    out = ev.groupBy("user_id").agg(
        *first_non_null_cols(F.struct("ts", "event_id"), ["note", "score"]),
        F.array_join(sorted_distinct("event_type"), ", ").alias("event_types"),
        F.max("ts").alias("last_ts"))
    return out.withColumn("last_month", fx.month_name("last_ts"))


# ------------------------------------------------------------- AGG-9, WIN-2
@query("opportunity_rank", """
WITH firsts AS (
  SELECT user_id, event_type, 'opp-' || CAST(event_id % 4 AS VARCHAR) AS name, min(ts) AS first_date
  FROM events GROUP BY ALL
)
SELECT user_id, event_type, name, first_date,
  CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY first_date, name) AS INTEGER) AS op_num
FROM firsts
""")
def opportunity_rank(spark, sf_dir):
    """AGG-9 / WIN-2: first date per (person, type, name), ranked within (person, type)."""
    e = m.Tables(spark, sf_dir).events
    f = (e.withColumn("name", F.concat(F.lit("opp-"), (F.col("event_id") % 4).cast("string")))
          .groupBy("user_id", "event_type", "name").agg(F.min("ts").alias("first_date")))
    return rank_within(f, ["user_id", "event_type"], [F.col("first_date"), F.col("name")], out="op_num")


# ------------------------------------------------------------- WIN-3, JN-8
@query("count_once", """
WITH base AS (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0),
flagged AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate,
         EXISTS (SELECT 1 FROM base b WHERE b.c_custkey = o.o_custkey) AS in_baseline
  FROM orders o
)
SELECT o_orderkey, o_custkey, in_baseline,
  CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
        AND NOT in_baseline THEN '1' ELSE 'Counted' END AS count_marker
FROM flagged
""")
def count_once_q(spark, sf_dir):
    """WIN-3 / JN-8: first row per person marked '1' unless already counted last year."""
    t = m.Tables(spark, sf_dir)
    base = t.customer.filter(F.col("c_custkey") % 10 == 0).select("c_custkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    o = flag_members(o, ["o_custkey"], base, "in_baseline", member_keys=["c_custkey"])
    out = count_once(o, "o_custkey", ["o_orderdate", "o_orderkey"], baseline=base,
                     baseline_key="c_custkey")
    return out.select("o_orderkey", "o_custkey", "in_baseline", "count_marker")
