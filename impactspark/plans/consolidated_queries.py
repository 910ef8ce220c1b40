"""The consolidation chain (PIPE-4..6) over service rows derived from ``events``.

Every event is a service row as a team would submit it: text columns, the
person by personal e-mail (with case and blank noise) or canonical e-mail,
every fifth row without a name (and then without birth date and age), every
eleventh with a date that does not parse.  The first source also repeats
every tenth row, the second re-sends every fourth.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import tag
from . import consolidated as cons
from . import model as m
from .catalog import query
from .earnings_queries import _people

AS_OF = "2100-01-01"


def _rows(t):
    k, u = F.col("event_id"), F.col("user_id").cast("string")
    none = F.lit(None).cast("string")
    nameless = k % 5 == 0
    cells = {
        "learner_id": u,
        "umuzi_email": F.when(k % 3 == 0, F.concat(F.lit("  Customer"), (F.col("user_id") % 1000).cast("string"),
                                                   F.lit("@Example.org "))).otherwise(
            F.concat(F.lit("c"), u, F.lit("@learn.example.org"))),
        "first_name": F.when(~nameless, F.concat(F.lit("First"), u)), "last_name": F.when(~nameless, F.lit("Last")),
        "id_number": F.when(k % 2 == 0, F.lit("0123456789012")), "date_of_birth": F.when(~nameless, F.lit("1990-06-15")),
        "age_service_accessed": F.when(~nameless, F.lit("25")), "age_range": F.when(~nameless, F.lit("18-25")),
        "date_service_accessed": F.when(k % 11 == 0, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd")),
        "service_used": F.col("event_type"), "service_name": F.concat(F.lit("svc-"), (k % 7).cast("string")),
    }
    return t.events.select(*[cells.get(c, none).alias(c) for c in cons.IND7_COLS], k.alias("_row"))


def _combined(spark, sf_dir):
    t = m.Tables(spark, sf_dir)
    rows = _rows(t)
    again = rows.filter("_row % 10 = 0").withColumn("_row", F.col("_row") + 1_000_000_000)
    parts = [tag(rows.unionByName(again).withColumn("_file", F.lit("db")), "db", 1),
             tag(rows.filter("_row % 4 = 0").withColumn("_file", F.lit("team")), "team", 2)]
    combined, *_ = cons.consolidate(parts, _people(spark, t), m.CUTOFF, AS_OF)
    return combined


_SQL = m.with_ctes(m.LEARNERS_SQL, f"""
known AS (
  SELECT id, email, coalesce(umuzi_email, email) AS main, first_name, last_name, id_number, date_of_birth
  FROM learners
  WHERE (coalesce(is_south_african_citizen, FALSE) OR coalesce(nationality = 'South African', FALSE))
    AND coalesce(NOT is_currently_employed AND NOT test_account, FALSE)
  QUALIFY row_number() OVER (PARTITION BY main ORDER BY id DESC) = 1
)""", """
mails AS (SELECT email, arg_max(main, id) AS main FROM known WHERE email IS NOT NULL GROUP BY email)""", f"""
sent AS (
  SELECT 1 AS prio, 'db' AS source, event_id AS place, * FROM events
  UNION ALL SELECT 1, 'db', event_id + 1000000000, * FROM events WHERE event_id % 10 = 0
  UNION ALL SELECT 2, 'team', event_id, * FROM events WHERE event_id % 4 = 0
)""", f"""
dated AS (
  SELECT s.*, date_trunc('day', ts)::TIMESTAMP AS day, coalesce(mails.main, typed) AS em
  FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'customer' || (user_id % 1000)::VARCHAR || '@example.org'
                       ELSE 'c' || user_id::VARCHAR || '@learn.example.org' END AS typed FROM sent) s
  LEFT JOIN mails ON mails.email = typed
  WHERE event_id % 11 <> 0 AND date_trunc('day', ts) >= TIMESTAMP '{m.CUTOFF}'
)""", """
filled AS (
  SELECT prio, place, source, em AS umuzi_email, day AS date_service_accessed,
    strftime(day, '%B') AS month_of_service_accessed, event_type AS service_used,
    'svc-' || (event_id % 7)::VARCHAR AS service_name,
    CASE WHEN event_id % 5 = 0 THEN k.id::VARCHAR ELSE user_id::VARCHAR END AS learner_id,
    CASE WHEN event_id % 5 = 0 THEN k.first_name ELSE 'First' || user_id::VARCHAR END AS first_name,
    CASE WHEN event_id % 5 = 0 THEN k.last_name ELSE 'Last' END AS last_name,
    CASE WHEN event_id % 5 = 0 THEN k.id_number WHEN event_id % 2 = 0 THEN '0123456789012' END AS id_number,
    CASE WHEN event_id % 5 = 0 THEN k.date_of_birth ELSE TIMESTAMP '1990-06-15' END AS date_of_birth,
    CASE WHEN event_id % 5 = 0 THEN date_diff('day', k.date_of_birth::DATE, day::DATE) // 365 ELSE 25 END AS age
  FROM dated LEFT JOIN known k ON k.main = em
)""", """
combined AS (
  SELECT * FROM filled QUALIFY row_number() OVER (
    PARTITION BY source, umuzi_email, date_service_accessed, service_used, service_name, learner_id, first_name,
                 last_name, id_number, date_of_birth, age ORDER BY prio, place) = 1
)""", body="{}")
_BAND = """CASE WHEN age <= 17 THEN '17 and below' WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35'
     WHEN age > 35 THEN '36+' END"""


@query("consolidated_services", _SQL.replace("{}", f"""
SELECT source, umuzi_email, learner_id, first_name, last_name, id_number, date_of_birth,
  age::DOUBLE AS age_service_accessed, {_BAND} AS age_range, date_service_accessed, month_of_service_accessed,
  service_used, service_name
FROM combined
"""))
def consolidated_services(spark, sf_dir):
    """PIPE-4 / PIPE-4b / DED-3: the consolidated services of both sources."""
    return _combined(spark, sf_dir).select(
        "source", "umuzi_email", "learner_id", "first_name", "last_name", "id_number", "date_of_birth",
        F.col("age_service_accessed").cast("double").alias("age_service_accessed"), "age_range",
        "date_service_accessed", "month_of_service_accessed", "service_used", "service_name")


@query("supported_people", _SQL.replace("{}", """
SELECT umuzi_email, arg_min(learner_id, [prio, place]) FILTER (learner_id IS NOT NULL) AS learner_id,
  arg_min(first_name, [prio, place]) FILTER (first_name IS NOT NULL) AS first_name,
  arg_min(id_number, [prio, place]) FILTER (id_number IS NOT NULL) AS id_number,
  array_to_string(list_sort(list_distinct(list(service_name))), ', ') AS services,
  max(date_service_accessed) AS date_service_accessed,
  strftime(max(date_service_accessed), '%B') AS month_of_service_accessed
FROM combined GROUP BY umuzi_email
"""))
def supported_people(spark, sf_dir):
    """PIPE-5 / AGG-6..8: one row per supported learner."""
    out = cons.supported_people(_combined(spark, sf_dir))
    return out.select("umuzi_email", "learner_id", "first_name", "id_number",
                      F.array_join("service_name", ", ").alias("services"), "date_service_accessed",
                      "month_of_service_accessed")


@query("participants", _SQL.replace("{}", """
SELECT first_name, last_name, id_number, date_service_accessed, service_name, age::DOUBLE AS age_service_accessed
FROM combined
"""))
def participants(spark, sf_dir):
    """PIPE-6: the participants list."""
    return cons.participants(_combined(spark, sf_dir)).select(
        "first_name", "last_name", "id_number", "date_service_accessed", "service_name",
        F.col("age_service_accessed").cast("double").alias("age_service_accessed"))
