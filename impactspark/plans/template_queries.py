"""The file-driven builders over template extracts that are written first and read back.

Each query derives team templates from ``events`` or ``orders``, writes them
as the files teams submit (lead rows, sheet folders, layouts of several
widths, blank-padded and quoted cells with line breaks, mixed date layouts)
to the shared folder, and reads them through the loaders.  The SQL states the
result from the tables, without the files.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import highest_per_key, resolve_identifiers
from ..session import stage_folder, stored_bytes
from ..sources import SourceSpec, tag, write_state, write_template
from . import earnings as earn
from . import earnings_queries as eq
from . import model as m
from . import template_services as ts
from .catalog import query

# Fixed parameters of these queries: the reporting period and the cohorts of the platform's programmes.
PERIOD_START, PERIOD_END, AS_OF = "2024-01-01", "2024-02-15", "2100-01-01"
COHORTS = {"Prog X": "Cohort X", "Prog Z": "Cohort Z"}
DROPPED = ("Dropped Prog",)
FILES = 3
# Bytes of the stored orders that add a file to each of their templates.
FILE_BYTES = 16 << 20

# ------------------------------------------------------------------ services
# Cells of the extracts, built when a session is there.
def _k():
    return F.col("event_id")


def _i():
    return F.floor(F.col("event_id") / 6)


def _user():
    return F.col("user_id").cast("string")


def _personal():
    return F.concat(F.lit("  Customer"), (F.col("user_id") % 1000).cast("string"), F.lit("@Example.org "))


def _canonical():
    return F.concat(F.lit("c"), _user(), F.lit("@learn.example.org"))


def _next():
    return F.concat(F.lit("c"), (F.col("user_id") + 1).cast("string"), F.lit("@learn.example.org"))


def _date():
    return (F.when(_i() % 3 == 0, F.date_format("ts", "dd/MM/yyyy")).when(_i() % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
         .otherwise(F.date_format("ts", "yyyy-MM-dd")))


def _group():
    return F.concat(F.lit(" Group "), (F.col("user_id") % 5).cast("string"), F.lit(" "))


def _name():
    return F.concat("event_type", F.lit(', said "ok"\nline 2'))


def _none():
    return F.lit(None).cast("string")


def _write_services(t):
    """Six sources of one event each, by ``event_id`` modulo 6; returns their specs."""
    spark, e = t.spark, t.events
    base = stage_folder(spark, "templates")
    part = lambda k: e.filter(_k() % 6 == k)
    put = lambda df, cells, folder, lead: write_template(df.select(*[c.alias(f"c{n}") for n, c in enumerate(cells)]),
                                                         f"{base}/{folder}", lead, FILES)
    number = _k().cast("string")
    put(part(0), [number, _none(), F.when(_i() % 5 != 0, F.concat(_personal(), F.lit(", "), _canonical())), _group(), _none(), F.lit("Connection"),
                  _name(), _date()], "connection", ("Connection sessions", "#,x,Emails,Cohort,x,Used,Name,Date"))
    put(part(1), [number, _none(), F.concat(_canonical(), F.lit(","), _next()), _none(), F.lit("Support"),
                  F.concat("event_type", F.lit(", Coaching ")), _date()], "general", ("General", "note", "#,x,Emails,x,Used,Names,Date"))
    programme = (F.when(_i() % 5 == 0, "Prog X").when(_i() % 5 == 1, "Some Pathway Y").when(_i() % 5 == 2, "Accenture pathway")
                 .when(_i() % 5 == 3, "Dropped Prog").otherwise("Prog Z"))
    done = F.when(_i() % 4 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm"))
    put(part(2), [F.lit("Name"), _canonical(), F.concat(F.lit(" "), "event_type", F.lit(" ")), programme, done], "platform",
        ("Name,Email,Course,Program Name,Completion Time",))
    both = F.concat(_personal(), F.when(_i() % 2 == 0, "; ").otherwise(" ,"), _canonical())
    cells = [both, _group(), F.lit("Placement"), F.col("event_type"), _date()]
    put(part(3).filter(_i() % 2 == 0), [number, *cells], "placements/sheet=0", ("Placements", "h"))
    put(part(3).filter(_i() % 2 == 1), [number, _none(), *cells], "placements/sheet=1", ("Placements", "h"))
    put(part(4), [number, F.concat(_canonical(), F.lit(","), _next(), F.lit(",")), _group(), F.lit("Check-in"), F.col("event_type"), _date()],
        "checkins", ("#,Emails,Cohort,Used,Name,Date",))
    put(part(5), [number, F.when(_i() % 7 != 0, _personal()), _group(), F.lit("Single"), F.col("event_type"), _date()], "single", ("title",))
    names = ("umuzi_email", "cohort_name", "service_used", "service_name", "date_service_accessed")
    return [
        SourceSpec("connection", f"{base}/connection", (2, 3, 5, 6, 7), names, 2, kind="connection", priority=1),
        SourceSpec("general", f"{base}/general", (2, 4, 5, 6), (names[0], *names[2:]), 3, kind="general", priority=2,
                   constants={"cohort": "Green LB3"}),
        SourceSpec("platform", f"{base}/platform", header=True, kind="platform", priority=3, filter_to_period=True),
        SourceSpec("placements", f"{base}/placements", names=names, lead_rows=2, kind="placements", priority=4,
                   sheets={0: range(1, 6), 1: range(2, 7)}),
        SourceSpec("checkins", f"{base}/checkins", range(1, 6), names, 1, kind="checkins", priority=5),
        SourceSpec("single", f"{base}/single", range(1, 6), names, 1, kind="single", priority=6),
        SourceSpec("stopped", f"{base}/nothing", kind="single", enabled=False)]


def _config(policy: str) -> ts.ServicesConfig:
    return ts.ServicesConfig(period_start=PERIOD_START, period_end=PERIOD_END, as_of=AS_OF, unmatched_policy=policy,
                             platform_cohorts=COHORTS, platform_drop=DROPPED, whole_last_day=True,
                             corrections={"c3@learn.example.org": "c5@learn.example.org"},
                             unreportable=("c7@learn.example.org",))


_LOADED_SQL = f"""
e AS (
  SELECT *, event_id // 6 AS i, '  Customer' || (user_id % 1000)::VARCHAR || '@Example.org ' AS personal,
    'c' || user_id::VARCHAR || '@learn.example.org' AS canonical, 'c' || (user_id + 1)::VARCHAR || '@learn.example.org' AS nxt,
    'Group ' || (user_id % 5)::VARCHAR AS grp,
    CASE WHEN (event_id // 6) % 3 = 1 THEN date_trunc('second', ts) ELSE date_trunc('day', ts) END AS day
  FROM events
)""", f"""
loaded AS (
  SELECT 'connection' AS source, unnest(['  Customer' || (user_id % 1000)::VARCHAR || '@Example.org ', canonical]) AS em,
    ' ' || grp || ' ' AS cohort, 'Connection' AS used, event_type || ', said "ok"' || chr(10) || 'line 2' AS name, day
  FROM e WHERE event_id % 6 = 0 AND i % 5 <> 0
  UNION ALL
  SELECT 'general', em, 'Green LB3', 'Support', unnest([event_type, 'Coaching']), day
  FROM (SELECT *, unnest([canonical, nxt]) AS em FROM e WHERE event_id % 6 = 1)
  UNION ALL
  SELECT 'platform', canonical, CASE i % 5 WHEN 0 THEN 'Cohort X' WHEN 1 THEN '{ts.PATHWAY_COHORT}' WHEN 2 THEN '{ts.VENDOR_COHORT}' ELSE 'Cohort Z' END,
    CASE i % 5 WHEN 0 THEN 'Prog X' WHEN 1 THEN 'Some Pathway Y' WHEN 2 THEN 'Accenture pathway' ELSE 'Prog Z' END, event_type,
    date_trunc('minute', ts)
  FROM e WHERE event_id % 6 = 2 AND i % 4 <> 0 AND i % 5 <> 3
    AND ts::DATE BETWEEN DATE '{PERIOD_START}' AND DATE '{PERIOD_END}'
  UNION ALL
  SELECT 'placements', unnest([CASE WHEN i % 2 = 0 THEN rtrim(personal) ELSE rtrim(personal) END, canonical]), grp, 'Placement', event_type, day
  FROM e WHERE event_id % 6 = 3
  UNION ALL
  SELECT 'checkins', unnest([canonical, nxt, '']), grp, 'Check-in', event_type, day FROM e WHERE event_id % 6 = 4
  UNION ALL
  SELECT 'single', personal, ' ' || grp || ' ', 'Single', event_type, day FROM e WHERE event_id % 6 = 5 AND i % 7 <> 0
)"""


@query("template_loaders", m.with_ctes(*_LOADED_SQL, body="""
SELECT source, em AS umuzi_email, cohort AS cohort_name, used AS service_used, name AS service_name, day AS date_service_accessed
FROM loaded
"""))
def template_loaders(spark, sf_dir):
    """LD-1..7 / SRC-1..4 / SRC-9 / ARR-1/2 / FLT-4: six shaped sources, read back from their files."""
    data, _ = ts.load_sources(spark, _write_services(m.Tables(spark, sf_dir)), _config("drop"))
    return data.select("source", *ts.LOADER_COLUMNS)


def _built(spark, sf_dir):
    t = m.Tables(spark, sf_dir)
    rich = highest_per_key(eq._people(spark, t), ["umuzi_email"], "learner_id")
    return ts.build(spark, _write_services(t), rich, _config("drop"))


_SERVICES_SQL = (m.LEARNERS_SQL, *_LOADED_SQL, """
known AS (
  SELECT id, email, coalesce(umuzi_email, email) AS main, first_name, id_number, date_of_birth FROM learners
  WHERE (coalesce(is_south_african_citizen, FALSE) OR coalesce(nationality = 'South African', FALSE))
    AND coalesce(NOT is_currently_employed AND NOT test_account, FALSE)
  QUALIFY row_number() OVER (PARTITION BY main ORDER BY id DESC) = 1
)""", """
mails AS (SELECT email, arg_max(main, id) AS main FROM known WHERE email IS NOT NULL GROUP BY email)""", """
matched AS (
  SELECT l.*, coalesce(mails.main, typed) AS person
  FROM (SELECT *, CASE lower(trim(em)) WHEN 'c3@learn.example.org' THEN 'c5@learn.example.org' ELSE lower(trim(em)) END AS typed FROM loaded) l
  LEFT JOIN mails ON mails.email = typed
  WHERE typed <> 'c7@learn.example.org'
)""", """
final AS (
  SELECT m.*, k.id, k.first_name, CASE WHEN length(k.id_number) < 13 THEN lpad(k.id_number, 13, '0') ELSE k.id_number END AS id_number,
    date_diff('day', k.date_of_birth::DATE, day::DATE) // 365 AS age, k.date_of_birth
  FROM matched m JOIN known k ON k.main = person
)""")


@query("template_services", m.with_ctes(*_SERVICES_SQL, body="""
SELECT source, id::DOUBLE AS learner_id, person AS umuzi_email, first_name, id_number, cohort AS cohort_name,
  age::DOUBLE AS age_service_accessed, CASE WHEN age <= 17 THEN '17 and below' WHEN age <= 25 THEN '18-25' WHEN age <= 35 THEN '26-35'
    WHEN age > 35 THEN '36+' END AS age_range, day AS date_service_accessed, strftime(day, '%B %Y') AS month_of_service_accessed,
  used AS service_used, name AS service_name
FROM final
"""))
def template_services(spark, sf_dir):
    """PIPE-3: template files to the services fact -- typed corrections, exclusions, remapped and enriched people."""
    final, _, _ = _built(spark, sf_dir)
    return final.select("source", F.col("learner_id").cast("double").alias("learner_id"), "umuzi_email", "first_name", "id_number",
                        "cohort_name", F.col("age_service_accessed").cast("double").alias("age_service_accessed"), "age_range",
                        "date_service_accessed", "month_of_service_accessed", "service_used", "service_name")


# ------------------------------------------------------------------ earnings
def _o():
    return F.col("o_orderkey")


def _j():
    return F.floor(F.col("o_orderkey") / 4)


def _odate():
    return (F.when(_j() % 2 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))


def _paid():
    return F.concat(F.lit("R "), F.format_number("o_totalprice", 2))


def _type():
    return F.when(_j() % 3 != 0, F.lit("Impact gig"))


def _people_of(t):
    """Every learner, for resolving identifiers."""
    return eq._all_people(t)


def _identifier(t):
    """What a team typed as the person: an id number, a personal or a canonical address, or something else."""
    ids = t.customer.select(F.col("c_custkey").alias("o_custkey")).join(
        m.learners(t).select(F.col("id").alias("o_custkey"), F.col("id_number").alias("__id")), "o_custkey")
    typed = (F.when(_j() % 5 == 0, F.concat(F.lit(" Customer"), (F.col("o_custkey") % 1000).cast("string"), F.lit("@Example.org")))
             .when(_j() % 5 == 1, F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@learn.example.org")))
             .when(_j() % 5 == 2, F.lit("see list")).otherwise(F.col("__id")))
    return t.orders.join(ids, "o_custkey").withColumn("typed", typed)


def _write_earnings(t):
    """Wide blocks, id-keyed rows, five sheets and a flat file, by ``o_orderkey`` modulo 4; returns their folder.

    A template has ``FILES`` files, more where the orders are many: a file is written by one task.
    """
    base = stage_folder(t.spark, "templates")
    o = t.orders
    files = FILES + stored_bytes(o) // FILE_BYTES
    put = lambda df, cells, folder, lead: write_template(df.select(*[c.alias(f"c{n}") for n, c in enumerate(cells)]),
                                                         f"{base}/{folder}", lead, files)
    email = F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@learn.example.org"))
    wide = o.filter(_o() % 4 == 0)
    for folder, even, k in (("two", 0, 2), ("four", 1, 4)):
        cells = [_o().cast("string"), email, F.lit("Cohort U")]
        for b in range(1, k + 1):
            pay = F.when((_j() + b) % 3 != 0, F.concat(F.lit("R "), F.format_number(F.col("o_totalprice") * b, 2)))
            day = F.date_format(F.date_add(F.to_date("o_orderdate"), b), "yyyy-MM-dd")
            cells += [pay, day, F.lit(f'info "{b}"'), F.lit("Impact gig"), F.concat(F.lit(f"Gig {b}, "), F.col("o_orderpriority"))]
        put(wide.filter(_j() % 2 == even), cells, f"wide/{folder}", ("#,person,cohort" + ",h" * 5 * k,))
    rest = [_paid(), _odate(), F.lit("Cohort H"), F.col("o_orderstatus"), F.col("o_orderpriority"), _type()]
    put(_identifier(t).filter(_o() % 4 == 1), [_o().cast("string"), F.col("typed"), *rest], "ids/sheet=0", ("Ids", "h"))
    partner = [F.concat(email, F.lit(" ")), F.when(_j() % 7 != 0, _paid()), _odate(), F.lit(" Cohort P "), F.col("o_orderstatus"),
               _type(), F.when(_j() % 2 == 0, F.concat(F.col("o_orderpriority"), F.lit(" ")))]
    for s in range(5):
        put(o.filter((_o() % 4 == 2) & (_j() % 5 == s)), [_o().cast("string"), *partner], f"partners/sheet={s}", ("Partner", "h"))
    put(o.filter(_o() % 4 == 3), [_o().cast("string"), email, *rest], "flat", ("Flat", "h"))
    return base


_IDS_SQL = """
people AS (
  SELECT id, email, umuzi_email, trim(id_number) AS idn FROM learners WHERE umuzi_email IS NOT NULL
)""", """
by_id AS (
  SELECT CASE WHEN length(idn) < 13 THEN lpad(idn, 13, '0') ELSE idn END AS key, arg_max(umuzi_email, id) AS person
  FROM people WHERE idn IS NOT NULL GROUP BY 1
)""", """
by_mail AS (
  SELECT key, arg_min(person, tier) AS person FROM (
    SELECT email AS key, 1 AS tier, arg_max(umuzi_email, id) AS person FROM people WHERE email IS NOT NULL GROUP BY 1
    UNION ALL SELECT umuzi_email, 2, arg_max(umuzi_email, id) FROM people GROUP BY 1) GROUP BY key
)""", """
typed AS (
  SELECT o.*, (o_orderkey // 4) AS j, CASE (o_orderkey // 4) % 5
      WHEN 0 THEN ' Customer' || (o_custkey % 1000)::VARCHAR || '@Example.org'
      WHEN 1 THEN 'c' || o_custkey::VARCHAR || '@learn.example.org' WHEN 2 THEN 'see list' ELSE l.id_number END AS typed
  FROM orders o JOIN learners l ON l.id = o_custkey
)""", """
resolved AS (
  SELECT t.*, CASE WHEN regexp_matches(trim(typed), '^[0-9]{1,13}$') THEN a.person WHEN typed LIKE '%@%' THEN b.person END AS person,
    CASE WHEN coalesce(trim(typed), '') = '' THEN 'missing'
         WHEN regexp_matches(trim(typed), '^[0-9]{1,13}$') THEN CASE WHEN a.person IS NULL THEN 'unknown id number' ELSE 'id number' END
         WHEN typed LIKE '%@%' THEN CASE WHEN b.person IS NULL THEN 'unknown e-mail' ELSE 'e-mail' END ELSE 'unreadable' END AS outcome
  FROM typed t LEFT JOIN by_id a ON a.key = lpad(trim(typed), 13, '0') AND length(trim(typed)) <= 13
  LEFT JOIN by_mail b ON b.key = lower(trim(typed))
)"""


@query("typed_identifiers", m.with_ctes(m.LEARNERS_SQL, *_IDS_SQL, body="""
SELECT o_orderkey, typed, person, outcome FROM resolved
"""))
def typed_identifiers(spark, sf_dir):
    """JN-4 / LD-9 / LD-13 / T15: identifiers of three kinds resolved in one join, with an outcome for each row."""
    t = m.Tables(spark, sf_dir)
    return resolve_identifiers(_identifier(t), "typed", earn.person_identifiers(_people_of(t)), "person").select(
        "o_orderkey", "typed", "person", "outcome")


_ENTRY = """payment, day AS date_service_accessed, cohort, extra AS earning_opportunity_extra_info,
  etype AS earning_opportunity_type, ename AS earning_opportunity_name"""


@query("earnings_loaders", m.with_ctes(m.LEARNERS_SQL, *_IDS_SQL, """
o AS (
  SELECT *, o_orderkey // 4 AS j, 'c' || o_custkey::VARCHAR || '@learn.example.org' AS em, date_trunc('day', o_orderdate) AS day,
    CASE WHEN (o_orderkey // 4) % 3 <> 0 THEN 'Impact gig' END AS etype
  FROM orders
)""", body=f"""
SELECT 'wide' AS source, em AS umuzi_email, round(o_totalprice * b, 2) AS payment, day + to_days(b::INTEGER) AS date_service_accessed,
  'Cohort U' AS cohort, 'info "' || b::VARCHAR || '"' AS earning_opportunity_extra_info, 'Impact gig' AS earning_opportunity_type,
  'Gig ' || b::VARCHAR || ', ' || o_orderpriority AS earning_opportunity_name
FROM (SELECT *, unnest(range(1, CASE WHEN j % 2 = 0 THEN 3 ELSE 5 END)) AS b FROM o WHERE o_orderkey % 4 = 0) WHERE (j + b) % 3 <> 0
UNION ALL
SELECT 'ids', coalesce(person, CASE WHEN outcome = 'unknown e-mail' THEN trim(typed) END), o_totalprice, date_trunc('day', o_orderdate), 'Cohort H',
  o_orderstatus, CASE WHEN j % 3 <> 0 THEN 'Impact gig' END, o_orderpriority
FROM resolved WHERE o_orderkey % 4 = 1 AND outcome IN ('id number', 'e-mail', 'unknown e-mail')
UNION ALL
SELECT 'partners', em, o_totalprice, day, 'Cohort P', o_orderstatus, etype, CASE WHEN j % 2 = 0 THEN o_orderpriority END
FROM o WHERE o_orderkey % 4 = 2 AND j % 7 <> 0 AND (etype IS NOT NULL OR j % 2 = 0)
UNION ALL
SELECT 'flat', em, o_totalprice, day, 'Cohort H', o_orderstatus, etype, o_orderpriority FROM o WHERE o_orderkey % 4 = 3
"""))
def earnings_loaders(spark, sf_dir):
    """LD-8..14 / SRC-2..5 / RSH-1 / JN-4: four earnings sources read back from files of two and four blocks, sheets and rows."""
    t = m.Tables(spark, sf_dir)
    base = _write_earnings(t)
    ids, _ = earn.load_id_keyed(spark, f"{base}/ids", "ids", 2, _people_of(t))
    parts = [earn.load_wide(spark, f"{base}/wide/*", "wide", 1), ids, earn.load_partnerships(spark, f"{base}/partners", "partners", 3),
             earn.load_flat(spark, f"{base}/flat", "flat", 4)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("source", *earn.CANON_COLS)


@query("earnings_rolling_state", m.with_ctes(m.LEARNERS_SQL, *eq._BASE_SQL, body=f"""
SELECT {eq._OUT} FROM prev
UNION ALL
SELECT {eq._OUT} FROM kept
"""))
def earnings_rolling_state(spark, sf_dir):
    """SRC-7 / SNK-3 / DED-5: last month's state written as a version, read back in its own order, and cleaned against."""
    t = m.Tables(spark, sf_dir)
    prev, live, again = eq._sources(t)
    state = stage_folder(spark, "state")
    write_state(prev.filter("_row % 3 = 0").select(*earn.CANON_COLS).withColumn("month", F.lit("older")), state)
    write_state(prev.select(*earn.CANON_COLS).withColumn("month", F.date_format("date_service_accessed", "MMMM")), state)
    cfg = earn.EarningsConfig(report_start=eq.REPORT_START, as_of=eq.AS_OF, covered_through=eq.COVERED_THROUGH, fy_start_year=1996,
                              exempt_cohort=eq.EXEMPT, cohort_map=eq.COHORT_MAP)
    entries, _ = earn.clean_entries([earn.load_prior(spark, state), tag(live, "live", 1), tag(again, "resend", 2)], eq._rich(t), cfg)
    return entries.select(*earn.CANON_COLS, "source", "month")
