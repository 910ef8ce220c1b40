"""The reference's relational model, derived from the shared test tables.

The reference reads learners, applications, statuses, bootcamp slots,
programme enrolments and course certificates from a database we do not
have.  The test tables are TPC-H-like, so every query derives those
entities from them with fixed, deterministic rules: a learner is a
customer, an application is an order, a bootcamp RSVP is an order, a
programme enrolment is an event, a certificate is a line item.  NULLs,
blanks, malformed ids and duplicate e-mails are injected by key arithmetic
so that every trap in the reference is exercised.

Each entity is written twice -- once as a Spark DataFrame, once as a SQL
CTE for the DuckDB oracle -- next to each other, so the two can be read
against one another.  Everything scales with the input tables: each entity
is a projection (no shuffle) of one or two scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed parameters of the derived model.
CUTOFF = "1998-01-01"            # reporting cutoff (params CTE of the reference)
DOB_BASE = "1935-01-01"          # birth dates spread over 1935..1989
DOB_SPREAD = 20089
STATUS_LABELS = ((1, "Accepted"), (2, "Pending"), (3, None))   # id 9 never resolves


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy access to the shared parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name):
        if name in TABLES:
            return read(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def _days(c, n):
    """timestamp + n days."""
    return F.timestamp_add("DAY", n, c)


# ---------------------------------------------------------------- learners
def learners(t: Tables) -> DataFrame:
    c = t.customer
    k = F.col("c_custkey")
    dob = F.date_add(F.lit(DOB_BASE).cast("date"), ((k * 7919) % DOB_SPREAD).cast("int"))
    id13 = F.concat(F.date_format(dob, "yyMMdd"), F.lpad((k % 10000).cast("string"), 4, "0"),
                    F.when(k % 6 == 0, F.lit("1")).otherwise(F.lit("0")),
                    F.lit("8"), (k % 10).cast("string"))
    idn = (F.when(k % 10 == 0, F.lit(None).cast("string"))
            .when(k % 10 == 1, F.substring(id13, 2, 12))
            .when(k % 10 == 2, F.concat(id13, F.lit("7")))
            .when(k % 10 == 3, F.concat(F.lit(" "), id13, F.lit(" ")))
            .otherwise(id13))
    return c.select(
        k.alias("id"),
        F.when(k % 9 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("customer"), (k % 1000).cast("string"), F.lit("@example.org"))).alias("email"),
        F.when(k % 8 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("c"), k.cast("string"), F.lit("@learn.example.org"))).alias("umuzi_email"),
        F.when(k % 19 == 0, F.lit(None)).otherwise(F.concat(F.lit("First"), k.cast("string"))).alias("first_name"),
        F.when(k % 29 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("Last"), F.col("c_nationkey").cast("string"))).alias("last_name"),
        F.concat(F.lit("0"), (k + 600000000).cast("string")).alias("cellphone_number"),
        idn.alias("id_number"),
        F.col("c_mktsegment").alias("race"),
        F.when(k % 3 == 0, F.lit("Female")).when(k % 3 == 1, F.lit("Male")).alias("gender"),
        dob.cast("timestamp_ntz").alias("date_of_birth"),
        (F.col("c_acctbal") < 0).alias("has_disability_or_differently_abled"),
        F.col("c_nationkey").alias("nearest_city"),
        F.when(k % 11 == 0, F.lit("")).otherwise((F.col("c_nationkey") % 5).cast("string")).alias("province"),
        (k % 7).cast("int").alias("residential_area_type_id"),
        F.when(k % 4 == 0, F.lit(True)).when(k % 4 == 1, F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)).alias("is_south_african_citizen"),
        F.when(F.col("c_nationkey") % 5 == 0, F.lit("South African"))
         .when(F.col("c_nationkey") % 5 == 1, F.lit(None)).otherwise(F.lit("Other")).alias("nationality"),
        F.when(k % 13 == 0, F.lit(None).cast("boolean"))
         .otherwise(F.col("c_mktsegment") == "MACHINERY").alias("is_currently_employed"),
        F.when(k % 23 == 0, F.lit(None).cast("boolean")).otherwise(k % 50 == 7).alias("test_account"),
    )


LEARNERS_SQL = f"""
learners AS (
  SELECT
    c_custkey AS id,
    CASE WHEN c_custkey % 9 = 0 THEN NULL
         ELSE 'customer' || CAST(c_custkey % 1000 AS VARCHAR) || '@example.org' END AS email,
    CASE WHEN c_custkey % 8 = 0 THEN NULL
         ELSE 'c' || CAST(c_custkey AS VARCHAR) || '@learn.example.org' END AS umuzi_email,
    CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'First' || CAST(c_custkey AS VARCHAR) END AS first_name,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE 'Last' || CAST(c_nationkey AS VARCHAR) END AS last_name,
    '0' || CAST(c_custkey + 600000000 AS VARCHAR) AS cellphone_number,
    CASE c_custkey % 10
      WHEN 0 THEN NULL
      WHEN 1 THEN substring(id13, 2, 12)
      WHEN 2 THEN id13 || '7'
      WHEN 3 THEN ' ' || id13 || ' '
      ELSE id13 END AS id_number,
    c_mktsegment AS race,
    CASE c_custkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' END AS gender,
    CAST(dob AS TIMESTAMP) AS date_of_birth,
    c_acctbal < 0 AS has_disability_or_differently_abled,
    c_nationkey AS nearest_city,
    CASE WHEN c_custkey % 11 = 0 THEN '' ELSE CAST(c_nationkey % 5 AS VARCHAR) END AS province,
    CAST(c_custkey % 7 AS INTEGER) AS residential_area_type_id,
    CASE c_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN NULL ELSE FALSE END AS is_south_african_citizen,
    CASE c_nationkey % 5 WHEN 0 THEN 'South African' WHEN 1 THEN NULL ELSE 'Other' END AS nationality,
    CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment = 'MACHINERY' END AS is_currently_employed,
    CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey % 50 = 7 END AS test_account
  FROM (
    SELECT *,
      strftime(dob, '%y%m%d') || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
        || CASE WHEN c_custkey % 6 = 0 THEN '1' ELSE '0' END
        || '8' || CAST(c_custkey % 10 AS VARCHAR) AS id13
    FROM (SELECT *, DATE '{DOB_BASE}' + CAST((c_custkey * 7919) % {DOB_SPREAD} AS INTEGER) AS dob
          FROM customer)
  )
)"""


# ------------------------------------------------------------- applications
def applications(t: Tables) -> DataFrame:
    o = t.orders
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    status_id = (F.when(k % 17 == 0, F.lit(9))
                  .when(F.col("o_orderstatus") == "F", F.lit(1))
                  .when(F.col("o_orderstatus") == "O", F.lit(2)).otherwise(F.lit(3)))
    return o.select(
        k.alias("id"),
        F.col("o_custkey").alias("learner_id"),
        status_id.cast("int").alias("application_status_id"),
        F.when(k % 4 == 0, _days(d, F.lit(2))).alias("registration_date"),
        F.when(k % 11 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(d).alias("date_created"),
        _days(d, (k % 30).cast("int")).alias("date_updated"),
    )


APPLICATIONS_SQL = """
applications AS (
  SELECT
    o_orderkey AS id,
    o_custkey AS learner_id,
    CAST(CASE WHEN o_orderkey % 17 = 0 THEN 9
              WHEN o_orderstatus = 'F' THEN 1
              WHEN o_orderstatus = 'O' THEN 2 ELSE 3 END AS INTEGER) AS application_status_id,
    CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 2 DAY END AS registration_date,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS date_created,
    o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) AS date_updated
  FROM orders
)"""


def application_status(spark: SparkSession) -> DataFrame:
    """Fixed three-row lookup (a literal table: size bound is its length)."""
    return spark.createDataFrame(list(STATUS_LABELS), "id int, staus string")


APPLICATION_STATUS_SQL = """
application_status AS (
  SELECT * FROM (VALUES (1, 'Accepted'), (2, 'Pending'), (3, CAST(NULL AS VARCHAR))) AS s(id, staus)
)"""

# cities = nation, provinces = region, residential area types = region (ids 0..4; 5, 6 unresolved)


def cities(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))


def provinces(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))


def area_types(t: Tables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("id"),
                           F.concat(F.lit("area-"), F.lower("r_name")).alias("name"))


LOOKUPS_SQL = """
cities AS (SELECT n_nationkey AS id, n_name AS name FROM nation),
provinces AS (SELECT r_regionkey AS id, r_name AS name FROM region),
area_types AS (SELECT r_regionkey AS id, 'area-' || lower(r_name) AS name FROM region)"""


# ------------------------------------------------------------ service facts
def bootcamp_rsvps(t: Tables) -> DataFrame:
    """learners_bootcamps_slots ⋈ slots ⋈ bootcamp, flattened: one order = one RSVP."""
    o = t.orders
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("learner_id"),
        F.col("o_orderdate").alias("rsvp_date"),
        _days(F.col("o_orderdate"), F.lit(7)).alias("start_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit(2))
         .when(F.col("o_orderstatus") == "O", F.lit(1)).otherwise(F.lit(3)).alias("bootcamp_result_id"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(k % 5).alias("rejection_reason_id"),
        F.col("o_orderpriority").alias("bootcamp_name"),
    )


BOOTCAMP_SQL = """
bootcamp_rsvps AS (
  SELECT o_custkey AS learner_id, o_orderdate AS rsvp_date,
         o_orderdate + INTERVAL 7 DAY AS start_date,
         CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 3 END AS bootcamp_result_id,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 5 END AS rejection_reason_id,
         o_orderpriority AS bootcamp_name
  FROM orders
)"""


def enrolments(t: Tables) -> DataFrame:
    """learners_programmes_pathways ⋈ programmes: one event = one enrolment."""
    e = t.events
    return e.select(
        F.col("user_id").alias("learner_id"),
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("ts")).alias("start_date"),
        F.when(F.col("event_id") % 9 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Programme "), F.col("event_type"))).alias("name"),
    )


ENROLMENTS_SQL = """
enrolments AS (
  SELECT user_id AS learner_id,
         CASE WHEN event_id % 10 = 0 THEN NULL ELSE ts END AS start_date,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'Programme ' || event_type END AS name
  FROM events
)"""


def certificates(t: Tables) -> DataFrame:
    """learners_courses_certificates: a line item is a certificate of its order's customer."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.col("o_custkey").alias("learner_id"), F.col("l_partkey").alias("course_id"),
                    F.col("l_shipdate").alias("certificate_uploaded_at"))


def courses(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("name"))


def pathway_courses(t: Tables) -> DataFrame:
    """pathways_courses ⋈ pathways: every course sits on two pathways (fan-out)."""
    p = t.part
    a = p.select(F.col("p_partkey").alias("course_id"),
                 F.concat(F.lit("pathway-"), (F.col("p_size") % 4).cast("string")).alias("pathway"))
    b = p.select(F.col("p_partkey").alias("course_id"),
                 F.concat(F.lit("pathway-"), (F.col("p_partkey") % 3 + 4).cast("string")).alias("pathway"))
    return a.unionByName(b)


CERTIFICATES_SQL = """
certificates AS (
  SELECT o_custkey AS learner_id, l_partkey AS course_id, l_shipdate AS certificate_uploaded_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
courses AS (SELECT p_partkey AS id, p_type AS name FROM part),
pathway_courses AS (
  SELECT p_partkey AS course_id, 'pathway-' || CAST(p_size % 4 AS VARCHAR) AS pathway FROM part
  UNION ALL
  SELECT p_partkey AS course_id, 'pathway-' || CAST(p_partkey % 3 + 4 AS VARCHAR) AS pathway FROM part
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body
