"""Queries for the cleaning functions: dates, money, e-mails, ids, labels, lists."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import functions as fx
from ..operators import (blocks_to_rows, block_names, field_lookup, map_label, merge_maps,
                         split_explode, unmapped_values, value_frequency)
from ..operators.reshape import BLOCK_FIELDS, ID_FIELDS
from . import model as m
from .catalog import query

# --------------------------------------------------------------------- DT-1
# Every order date is rendered as text in one of nine shapes (six accepted
# layouts, a month-first one, junk, an unpadded ISO one), then parsed back.
_TS = "o_orderdate + to_seconds(CAST((o_orderkey * 37) % 86400 AS BIGINT))"


def _date_texts(t):
    k = F.col("o_orderkey")
    ts = F.timestamp_add("SECOND", (k * 37) % 86400, F.col("o_orderdate"))
    micros = F.lpad((k % 1000000).cast("string"), 6, "0")
    milli = F.lpad((k % 1000).cast("string"), 3, "0")
    raw = (F.when(k % 9 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("."), micros))
            .when(k % 9 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(k % 9 == 2, F.date_format(ts, "yyyy-MM-dd"))
            .when(k % 9 == 3, F.concat(F.date_format(ts, "dd/MM/yyyy HH:mm:ss"), F.lit("."), milli))
            .when(k % 9 == 4, F.date_format(ts, "d/M/yyyy H:m:s"))
            .when(k % 9 == 5, F.date_format(ts, "dd/MM/yyyy"))
            .when(k % 9 == 6, F.date_format(ts, "MM/dd/yyyy"))
            .when(k % 9 == 7, F.when(k % 2 == 0, F.lit("not a date")).otherwise(F.lit("")))
            .otherwise(F.date_format(ts, "yyyy-M-d")))
    return t.orders.select("o_orderkey", raw.alias("raw"))


_DATE_TEXTS_SQL = f"""
date_texts AS (
  SELECT o_orderkey,
    CASE o_orderkey % 9
      WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0')
      WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 2 THEN strftime(ts, '%Y-%m-%d')
      WHEN 3 THEN strftime(ts, '%d/%m/%Y %H:%M:%S') || '.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
      WHEN 4 THEN CAST(day(ts) AS VARCHAR) || '/' || CAST(month(ts) AS VARCHAR) || '/' || strftime(ts, '%Y')
                  || ' ' || CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) || ':'
                  || CAST(second(ts) AS VARCHAR)
      WHEN 5 THEN strftime(ts, '%d/%m/%Y')
      WHEN 6 THEN strftime(ts, '%m/%d/%Y')
      WHEN 7 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'not a date' ELSE '' END
      ELSE strftime(ts, '%Y') || '-' || CAST(month(ts) AS VARCHAR) || '-' || CAST(day(ts) AS VARCHAR)
    END AS raw
  FROM (SELECT o_orderkey, {_TS} AS ts FROM orders)
)"""


@query("date_parse_mix", m.with_ctes(_DATE_TEXTS_SQL, body="""
SELECT o_orderkey, raw,
  COALESCE(try_strptime(raw, '%Y-%m-%d %H:%M:%S.%f'), try_strptime(raw, '%Y-%m-%d %H:%M:%S'),
           try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%d/%m/%Y %H:%M:%S.%f'),
           try_strptime(raw, '%d/%m/%Y %H:%M:%S'), try_strptime(raw, '%d/%m/%Y')) AS parsed,
  COALESCE(try_strptime(raw, '%Y-%m-%d %H:%M:%S.%f'), try_strptime(raw, '%Y-%m-%d %H:%M:%S'),
           try_strptime(raw, '%Y-%m-%d'), try_strptime(raw, '%d/%m/%Y %H:%M:%S.%f'),
           try_strptime(raw, '%d/%m/%Y %H:%M:%S'), try_strptime(raw, '%d/%m/%Y')) IS NULL
  AND COALESCE(try_strptime(raw, '%m/%d/%Y %H:%M:%S'), try_strptime(raw, '%m/%d/%Y %H:%M'),
               try_strptime(raw, '%m/%d/%Y')) IS NOT NULL AS suspect
FROM date_texts
"""))
def date_parse_mix(spark, sf_dir):
    """DT-1 / T4: six layouts in order; month-first-only values flagged, not parsed."""
    d = _date_texts(m.Tables(spark, sf_dir))
    return d.select("o_orderkey", "raw", fx.parse_dates("raw").alias("parsed"),
                    fx.suspect_date("raw").alias("suspect"))


# -------------------------------------------------------------------- NUM-1
def _money_texts(t):
    k = F.col("o_orderkey")
    s = F.col("o_totalprice").cast("string")
    raw = (F.when(k % 37 == 0, F.lit(None).cast("string"))
            .when(k % 10 == 0, F.concat(F.lit("R"), s))
            .when(k % 10 == 1, F.concat(F.lit("R "), s))
            .when(k % 10 == 2, F.concat(F.lit("1,"), s))
            .when(k % 10 == 3, F.concat(s, F.lit(" ")))
            .when(k % 10 == 4, F.concat(F.lit("\u00a0"), s))
            .when(k % 10 == 5, F.lit("Done"))
            .when(k % 10 == 6, F.lit(""))
            .when(k % 10 == 7, F.lit("12d"))
            .when(k % 10 == 8, F.lit("inf"))
            .otherwise(F.lit("0")))
    return t.orders.select("o_orderkey", raw.alias("raw"))


_MONEY_TEXTS_SQL = """
money_texts AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 37 = 0 THEN NULL
         WHEN o_orderkey % 10 = 0 THEN 'R' || CAST(o_totalprice AS VARCHAR)
         WHEN o_orderkey % 10 = 1 THEN 'R ' || CAST(o_totalprice AS VARCHAR)
         WHEN o_orderkey % 10 = 2 THEN '1,' || CAST(o_totalprice AS VARCHAR)
         WHEN o_orderkey % 10 = 3 THEN CAST(o_totalprice AS VARCHAR) || ' '
         WHEN o_orderkey % 10 = 4 THEN chr(160) || CAST(o_totalprice AS VARCHAR)
         WHEN o_orderkey % 10 = 5 THEN 'Done'
         WHEN o_orderkey % 10 = 6 THEN ''
         WHEN o_orderkey % 10 = 7 THEN '12d'
         WHEN o_orderkey % 10 = 8 THEN 'inf'
         ELSE '0' END AS raw
  FROM orders
),
money_parsed AS (
  SELECT o_orderkey, raw,
    CASE WHEN regexp_full_match(regexp_replace(raw, '[R,\\s\\x{00A0}]', '', 'g'),
                                '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?')
         THEN TRY_CAST(regexp_replace(raw, '[R,\\s\\x{00A0}]', '', 'g') AS DOUBLE) END AS payment
  FROM money_texts
)"""


@query("money_clean", m.with_ctes(_MONEY_TEXTS_SQL, body="SELECT o_orderkey, raw, payment FROM money_parsed"))
def money_clean(spark, sf_dir):
    """NUM-1: currency text -> number; junk, blanks and infinities -> NULL."""
    d = _money_texts(m.Tables(spark, sf_dir))
    return d.select("o_orderkey", "raw", fx.clean_money("raw").alias("payment"))


@query("money_unparseable", m.with_ctes(_MONEY_TEXTS_SQL, body="""
SELECT raw, CAST(count(*) AS BIGINT) AS n_rows FROM money_parsed
WHERE raw IS NOT NULL AND payment IS NULL GROUP BY raw
"""))
def money_unparseable(spark, sf_dir):
    """AGG-12: frequency of raw payment values that do not parse."""
    d = _money_texts(m.Tables(spark, sf_dir)).withColumn("payment", fx.clean_money("raw"))
    return value_frequency(d, "raw", F.col("raw").isNotNull() & F.col("payment").isNull())


# -------------------------------------------------------------------- STR-1
def _email_texts(t):
    k = F.col("c_custkey")
    base = F.concat(F.lit("customer"), k.cast("string"), F.lit("@example.org"))
    raw = (F.when(k % 6 == 0, F.concat(F.lit("Customer"), k.cast("string"), F.lit("@Example.org")))
            .when(k % 6 == 1, F.concat(F.lit("  "), base, F.lit("  ")))
            .when(k % 6 == 2, F.concat(F.lit("\u00a0"), F.upper(base), F.lit("\u00a0")))
            .when(k % 6 == 3, F.concat(F.lit("\t"), base, F.lit("\n")))
            .when(k % 6 == 4, F.lit(None).cast("string"))
            .when(k % 12 == 5, F.concat(F.lit("\ufb01rst"), k.cast("string"), F.lit("\uff20example.org")))
            .otherwise(base))
    return t.customer.select("c_custkey", raw.alias("raw"))


@query("email_normalise", """
WITH email_texts AS (
  SELECT c_custkey,
    CASE c_custkey % 6
      WHEN 0 THEN 'Customer' || CAST(c_custkey AS VARCHAR) || '@Example.org'
      WHEN 1 THEN '  customer' || CAST(c_custkey AS VARCHAR) || '@example.org  '
      WHEN 2 THEN chr(160) || upper('customer' || CAST(c_custkey AS VARCHAR) || '@example.org') || chr(160)
      WHEN 3 THEN chr(9) || 'customer' || CAST(c_custkey AS VARCHAR) || '@example.org' || chr(10)
      WHEN 4 THEN NULL
      ELSE CASE WHEN c_custkey % 12 = 5 THEN chr(64257) || 'rst' || CAST(c_custkey AS VARCHAR) || chr(65312) || 'example.org'
                ELSE 'customer' || CAST(c_custkey AS VARCHAR) || '@example.org' END END AS raw
  FROM customer
)
SELECT c_custkey, raw, CASE WHEN c_custkey % 12 = 5 THEN 'first' || CAST(c_custkey AS VARCHAR) || '@example.org'
  ELSE lower(regexp_replace(raw, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g')) END AS email
FROM email_texts
""")
def email_normalise(spark, sf_dir):
    """STR-1/3: strip every Unicode blank, lower-case, NFKC (a ligature and a full-width sign in the input)."""
    d = _email_texts(m.Tables(spark, sf_dir))
    return d.select("c_custkey", "raw", fx.normalize_email("raw", nfkc_fold=True).alias("email"))


# -------------------------------------------------------------------- STR-5
@query("pad_id", m.with_ctes(m.LEARNERS_SQL, body="""
SELECT id AS learner_id, id_number,
  CASE WHEN length(TRIM(id_number)) < 13 THEN lpad(TRIM(id_number), 13, '0')
       ELSE TRIM(id_number) END AS id_padded
FROM learners
"""))
def pad_id(spark, sf_dir):
    """STR-5 / T5: pad short ids to 13 digits, never truncate long ones."""
    lr = m.learners(m.Tables(spark, sf_dir))
    return lr.select(F.col("id").alias("learner_id"), "id_number",
                     fx.pad_id(F.trim("id_number")).alias("id_padded"))


# ----------------------------------------------------------------- DT-5..8
@query("month_labels", """
SELECT o_orderkey,
  strftime(o_orderdate, '%B') AS month_name,
  strftime(o_orderdate, '%B %Y') AS month_year,
  rpad(strftime(o_orderdate, '%B'), 9, ' ') || ' ' || strftime(o_orderdate, '%Y') AS month_year_padded,
  CAST(((month(o_orderdate) - 4 + 12) % 12) + 1 AS INTEGER) AS fy_rank,
  CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS INTEGER) AS fy_start_year,
  date_trunc('month', o_orderdate) AS month_start
FROM orders
""")
def month_labels(spark, sf_dir):
    """DT-5/6/7/8: month labels, padded TO_CHAR label, April-first rank and year."""
    o = m.Tables(spark, sf_dir).orders
    d = F.col("o_orderdate")
    return o.select("o_orderkey", fx.month_name(d).alias("month_name"),
                    fx.month_year(d).alias("month_year"),
                    fx.month_year_padded(d).alias("month_year_padded"),
                    fx.fy_rank(d).alias("fy_rank"), fx.fy_start_year(d).alias("fy_start_year"),
                    fx.month_bucket(d).alias("month_start"))


# ------------------------------------------------------------------ ARR-1/2
def _lists(t):
    k = F.col("c_custkey")
    a = F.concat(F.lit("a"), k.cast("string"), F.lit("@example.org"))
    b = F.concat(F.lit("b"), k.cast("string"), F.lit("@example.org"))
    emails = (F.when(k % 5 == 0, F.concat(a, F.lit(", "), b))
               .when(k % 5 == 1, F.concat(a, F.lit(", "), b, F.lit(",")))
               .when(k % 5 == 2, F.lit(None).cast("string"))
               .when(k % 5 == 3, a)
               .otherwise(F.concat(a, F.lit(";"), b)))
    services = (F.when(k % 3 == 0, F.lit("Mentoring, Coaching"))
                 .when(k % 3 == 1, F.lit("Coaching")).otherwise(F.lit(None).cast("string")))
    return t.customer.select("c_custkey", emails.alias("emails"), services.alias("services"))


@query("split_explode_pairs", """
WITH lists AS (
  SELECT c_custkey,
    CASE c_custkey % 5
      WHEN 0 THEN 'a' || CAST(c_custkey AS VARCHAR) || '@example.org, b' || CAST(c_custkey AS VARCHAR) || '@example.org'
      WHEN 1 THEN 'a' || CAST(c_custkey AS VARCHAR) || '@example.org, b' || CAST(c_custkey AS VARCHAR) || '@example.org,'
      WHEN 2 THEN NULL
      WHEN 3 THEN 'a' || CAST(c_custkey AS VARCHAR) || '@example.org'
      ELSE 'a' || CAST(c_custkey AS VARCHAR) || '@example.org;b' || CAST(c_custkey AS VARCHAR) || '@example.org' END AS emails,
    CASE c_custkey % 3 WHEN 0 THEN 'Mentoring, Coaching' WHEN 1 THEN 'Coaching' END AS services
  FROM customer
)
SELECT l.c_custkey, e.email, trim(s.service) AS service
FROM lists l,
  LATERAL (SELECT unnest(COALESCE(string_split_regex(l.emails, '\\s*[,;]\\s*'), [NULL::VARCHAR])) AS email) e,
  LATERAL (SELECT unnest(COALESCE(string_split_regex(l.services, ','), [NULL::VARCHAR])) AS service) s
""")
def split_explode_pairs(spark, sf_dir):
    """ARR-1/2: explode e-mail and service lists (trailing empties kept; NULL list -> one row)."""
    d = _lists(m.Tables(spark, sf_dir))
    d = split_explode(d, "emails", r"\s*[,;]\s*", out="email")
    d = split_explode(d, "services", ",", out="service")
    return d.select("c_custkey", "email", F.trim("service").alias("service"))


# ------------------------------------------------------------ RSH-1, SRC-5
def _wide_blocks(t):
    """All line items widened into rows of 2 + 5n columns, n being the largest line number (one aggregate).

    An order may repeat a line number, so each repeat (``copy``) of an order
    gets its own wide row; the copy number becomes the cohort id.
    """
    li = t.lineitem
    n_blocks = li.agg(F.max("l_linenumber")).first()[0] or 0
    w = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*_LINE_ORDER)
    li = li.withColumn("copy", F.row_number().over(w))
    aggs = []
    for i in range(1, n_blocks + 1):
        hit = F.col("l_linenumber") == i
        pay = F.when(hit & ((F.col("l_orderkey") + i) % 7 != 0), F.col("l_extendedprice"))
        aggs += [F.max(pay).alias(f"payment_{i}"),
                 F.max(F.when(hit, F.col("l_shipdate"))).alias(f"date_service_accessed_{i}"),
                 F.max(F.when(hit, F.col("l_returnflag"))).alias(f"earning_opportunity_extra_info_{i}"),
                 F.max(F.when(hit, F.col("l_linestatus"))).alias(f"earning_opportunity_type_{i}"),
                 F.max(F.when(hit, F.concat(F.lit("part-"), F.col("l_partkey").cast("string"))))
                  .alias(f"earning_opportunity_name_{i}")]
    wide = li.groupBy("l_orderkey", "copy").agg(*aggs)
    wide = wide.select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string"), F.lit("@example.org")).alias("umuzi_email"),
                       F.concat(F.lit("copy-"), F.col("copy").cast("string")).alias("cohort"),
                       *[c for c in wide.columns if c not in ("l_orderkey", "copy")])
    names = block_names(len(wide.columns))      # validates the 2 + 5k layout
    return wide.toDF(*names), (len(names) - 2) // 5


_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]


@query("blocks_to_rows", """
SELECT 'o' || CAST(l_orderkey AS VARCHAR) || '@example.org' AS umuzi_email,
       'copy-' || CAST(row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                    l_returnflag, l_linestatus, l_shipdate) AS VARCHAR) AS cohort,
       l_extendedprice AS payment, l_shipdate AS date_service_accessed,
       l_returnflag AS earning_opportunity_extra_info, l_linestatus AS earning_opportunity_type,
       'part-' || CAST(l_partkey AS VARCHAR) AS earning_opportunity_name,
       l_linenumber AS block
FROM lineitem
QUALIFY (l_orderkey + l_linenumber) % 7 <> 0
""")
def blocks_to_rows_q(spark, sf_dir):
    """RSH-1 / SRC-5: wide repeating blocks -> one row per filled block."""
    wide, k = _wide_blocks(m.Tables(spark, sf_dir))
    return blocks_to_rows(wide, list(ID_FIELDS), list(BLOCK_FIELDS), k, keep_if="payment",
                          block_col="block")


# ----------------------------------------------------------------- LKP-2..6
# Fixed value: the label map used by the label queries.
PRIORITY_LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium"}
_PRIORITY_SQL = """
priorities AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN 'High'
         ELSE o_orderpriority END AS priority
  FROM orders
),
label_map AS (
  SELECT * FROM (VALUES ('1-URGENT', 'Urgent'), ('2-HIGH', 'High'), ('3-MEDIUM', 'Medium')) AS t(k, v)
)"""


def _priorities(t):
    k = F.col("o_orderkey")
    p = (F.when(k % 13 == 0, F.lit(None).cast("string")).when(k % 7 == 0, F.lit("High"))
          .otherwise(F.col("o_orderpriority")))
    return t.orders.select("o_orderkey", p.alias("priority"))


@query("label_map_strict", m.with_ctes(_PRIORITY_SQL, body="""
SELECT p.o_orderkey, p.priority,
  COALESCE(lm.v, CASE WHEN p.priority IN (SELECT v FROM label_map) THEN p.priority END) AS label
FROM priorities p LEFT JOIN label_map lm ON lm.k = p.priority
"""))
def label_map_strict(spark, sf_dir):
    """LKP-2/3 / T10: unmapped -> NULL; labels that are already targets keep themselves."""
    p = _priorities(m.Tables(spark, sf_dir))
    return p.select("o_orderkey", "priority",
                    map_label("priority", PRIORITY_LABELS, keep_targets=True).alias("label"))


@query("label_map_default", m.with_ctes(_PRIORITY_SQL, body="""
SELECT p.o_orderkey, p.priority, COALESCE(lm.v, 'Not Provided') AS label
FROM priorities p LEFT JOIN label_map lm ON lm.k = p.priority
"""))
def label_map_default(spark, sf_dir):
    """LKP-4/6: unmapped -> a default label."""
    p = _priorities(m.Tables(spark, sf_dir))
    return p.select("o_orderkey", "priority",
                    map_label("priority", PRIORITY_LABELS, default="Not Provided").alias("label"))


@query("label_unmapped", m.with_ctes(_PRIORITY_SQL, body="""
SELECT priority, CAST(count(*) AS BIGINT) AS n_rows FROM priorities
WHERE priority IS NOT NULL AND priority NOT IN (SELECT k FROM label_map)
GROUP BY priority
"""))
def label_unmapped(spark, sf_dir):
    """SET-2 / coverage warning: labels with no map entry and how often they occur."""
    return unmapped_values(_priorities(m.Tables(spark, sf_dir)), "priority", PRIORITY_LABELS)


@query("merge_maps", """
WITH base AS (SELECT n_nationkey AS k, n_name AS v FROM nation),
override AS (
  SELECT n_nationkey AS k, 'Override ' || n_name AS v FROM nation WHERE n_regionkey = 1
  UNION ALL
  SELECT n_nationkey + 100 AS k, 'Extra ' || n_name AS v FROM nation WHERE n_regionkey = 2
)
SELECT COALESCE(b.k, o.k) AS k, COALESCE(o.v, b.v) AS v
FROM base b FULL OUTER JOIN override o ON b.k = o.k
""")
def merge_maps_q(spark, sf_dir):
    """LKP-5: database map merged with a manual map, manual side wins."""
    n = m.Tables(spark, sf_dir).nation
    base = n.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("v"))
    over = (n.filter("n_regionkey = 1")
             .select(F.col("n_nationkey").alias("k"), F.concat(F.lit("Override "), "n_name").alias("v"))
             .unionByName(n.filter("n_regionkey = 2")
                          .select((F.col("n_nationkey") + 100).alias("k"),
                                  F.concat(F.lit("Extra "), "n_name").alias("v"))))
    return merge_maps(base, over, "k", "v")


# ------------------------------------------------------------------ CASE-1/3
COHORT_MAP = {"click": "Cohort A", "view": "Cohort B", "signup": "Cohort C"}


@query("backfill_type", """
WITH ev AS (
  SELECT event_id, user_id, event_type,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS type,
    CASE event_id % 3 WHEN 0 THEN 'Internship' WHEN 1 THEN NULL ELSE 'Gig ' || event_type END AS name,
    'Prog ' || event_type || ' ' || CAST(user_id % 4 AS VARCHAR) AS programme
  FROM events
)
SELECT event_id, type, name,
  CASE WHEN type IS NULL AND name IS NOT DISTINCT FROM 'Internship' THEN 'Placement'
       WHEN type IS NULL THEN 'Experience gig' ELSE type END AS type_filled,
  CASE WHEN lower(programme) LIKE '%purchase%' THEN 'Vendor cohort'
       WHEN lower(programme) LIKE '% 3%' THEN 'Pathway cohort'
       ELSE CASE event_type WHEN 'click' THEN 'Cohort A' WHEN 'view' THEN 'Cohort B'
                            WHEN 'signup' THEN 'Cohort C' END END AS cohort
FROM ev
""")
def backfill_type(spark, sf_dir):
    """CASE-1 (type from name) and CASE-3 (vendor > pathway > map precedence)."""
    e = m.Tables(spark, sf_dir).events
    k = F.col("event_id")
    ev = e.select(
        "event_id", "user_id", "event_type",
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("type"),
        F.when(k % 3 == 0, F.lit("Internship")).when(k % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Gig "), "event_type")).alias("name"),
        F.concat(F.lit("Prog "), "event_type", F.lit(" "), (F.col("user_id") % 4).cast("string")).alias("programme"))
    cohort = fx.ordered_override(map_label("event_type", COHORT_MAP),
                                 [(fx.contains_ci("programme", "purchase"), "Vendor cohort"),
                                  (fx.contains_ci("programme", " 3"), "Pathway cohort")])
    return ev.select("event_id", "type", "name", fx.backfill_type("type", "name").alias("type_filled"),
                     cohort.alias("cohort"))


# -------------------------------------------------------------------- LKP-1
@query("field_lookup", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def field_lookup_q(spark, sf_dir):
    """LKP-1: rows whose every filtered field is in its list (pushed to the scan)."""
    o = m.Tables(spark, sf_dir).orders
    return field_lookup(o, {"o_orderstatus": ["F", "O"], "o_orderpriority": ["1-URGENT", "2-HIGH"]},
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


# --------------------------------------------------------------- FLT-3/14/15
@query("exclusion_rules", """
WITH li AS (
  SELECT l_orderkey, l_linenumber, l_quantity,
    CASE WHEN l_orderkey % 8 = 0 THEN NULL ELSE l_returnflag END AS flag,
    CASE WHEN l_orderkey % 9 = 0 THEN 0.0 WHEN l_orderkey % 10 = 1 THEN NULL
         ELSE l_extendedprice END AS payment
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, flag, payment FROM li
WHERE COALESCE(flag NOT IN ('R'), TRUE)
  AND payment IS NOT NULL AND payment <> 0
  AND NOT COALESCE(flag = 'A' AND l_quantity > 45, FALSE)
""")
def exclusion_rules(spark, sf_dir):
    """FLT-3 (pandas NOT IN keeps NULL), FLT-14 (zero/NULL payment), FLT-15 (rule table)."""
    li = m.Tables(spark, sf_dir).lineitem
    k = F.col("l_orderkey")
    d = li.select("l_orderkey", "l_linenumber", "l_quantity",
                  F.when(k % 8 == 0, F.lit(None).cast("string")).otherwise(F.col("l_returnflag")).alias("flag"),
                  F.when(k % 9 == 0, F.lit(0.0)).when(k % 10 == 1, F.lit(None).cast("double"))
                   .otherwise(F.col("l_extendedprice")).alias("payment"))
    rule = (F.col("flag") == "A") & (F.col("l_quantity") > 45)
    return (d.filter(fx.not_in("flag", ["R"]))
             .filter(F.col("payment").isNotNull() & (F.col("payment") != 0))
             .filter(~F.coalesce(rule, F.lit(False)))
             .select("l_orderkey", "l_linenumber", "flag", "payment"))
