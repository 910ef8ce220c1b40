"""The passes of the earnings chain share exchanges and keep the rows that they keep one by one."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from impactspark import session
from impactspark.operators import drop_covered, keep_first, keep_first_passes
from impactspark.plans import earnings as earn
from impactspark.plans import earnings_queries
from impactspark.sources import tag

from .conftest import rows

ORDER = ["p", "r"]
ENTRY = ("umuzi_email string, payment double, date_service_accessed timestamp_ntz, cohort string, "
         "earning_opportunity_extra_info string, earning_opportunity_type string, earning_opportunity_name string, "
         "_file string, _row bigint")


def _plan(df):
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("spare_all", [False, True])
def test_passes_in_one_exchange_keep_what_they_keep_in_turn(spark, spare_all):
    rnd = random.Random(spare_all)
    data = [(rnd.choice(["a", "b", None]), rnd.choice(["x", "y", "z", None]), rnd.choice(["u", None]), rnd.randint(0, 1), i) for i in range(120)]
    df = spark.createDataFrame(data, "k string, c string, t string, p int, r bigint").withColumn(
        "m", F.when(F.col("c") == "x", "y").when(F.col("c") == "z", "x").otherwise(F.col("c")))
    raw, now = F.col("c") == "x", F.col("m") == "x"
    passes = [(["k", "c", "m", "t"], raw if spare_all else None), (["k", "c", "m"], raw), (["k", "m"], now)]
    turn = df
    for keys, exempt in passes:
        turn = keep_first(turn, keys, ORDER, exempt=exempt)
    once = keep_first_passes(df, passes, ORDER)
    assert rows(once) == rows(turn)
    assert _plan(once).count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in _plan(once)
    spared = passes + [(["k"], F.lit(True))] if not spare_all else [(k, F.lit(True)) for k, _ in passes]
    assert rows(keep_first_passes(df, spared, ORDER)) == rows(df if spare_all else turn)


def test_few_rows_of_a_key_meet_the_state_in_one_exchange(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice(["a", "b", None]), rnd.choice([1.0, None, float("nan")]), rnd.random() < 0.3, rnd.random() < 0.7) for i in range(150)]
    df = spark.createDataFrame(data, "r bigint, k1 string, k2 double, old boolean, early boolean")
    state, live = df.filter("old"), df.filter("NOT old")
    kept, dropped = drop_covered(live, state, ["k1", "k2"], ["r"], covered=F.col("early"))
    safe = drop_covered(live, state, ["k1", "k2"], ["r"], covered=F.col("early"), skew_safe=True)
    assert kept.columns == live.columns and rows(dropped, "r")
    assert rows(kept, "r") == rows(safe[0], "r") and rows(dropped, "r") == rows(safe[1], "r")
    assert _plan(kept).count("Exchange hashpartitioning") == 1 and "Join" not in _plan(kept)


def _entries(spark, seed, n=260):
    rnd, day = random.Random(seed), dt.datetime(2024, 5, 1)
    one = lambda: (rnd.choice(["a@x.org", "b@x.org", None]), rnd.choice([5.0, 0.0, None]), rnd.choice([day, dt.datetime(2024, 6, 1)]),
                   rnd.choice(["EX", "was", "alias", "C", None]), rnd.choice(["i", None]), rnd.choice(["t", "u"]), "name")
    return [(*one(), "f", i) for i in range(n)]


def _turned(data, cfg):
    """The passes one after another over ``(source, priority, row)``: entries and drops."""
    first = lambda seen, k: not (k in seen or seen.add(k))
    out = sorted(data, key=lambda t: (t[1], t[2][8]))
    passes = [set(), set(), set()]
    if cfg.protect_exempt:
        out = [t for t in out if first(passes[0], (t[0], *t[2][:7])) or t[2][3] == "EX"]
    else:
        out = [t for t in out if first(passes[0], (t[0], *t[2][:7]))]
    key = lambda e: (*e[:5], e[6])
    out = [t for t in out if first(passes[1], key(t[2])) or t[2][3] == "EX"]
    drops = {}
    for s, _, e in out:
        if not e[1]:
            why = ("zero payment" if e[1] == 0 else "missing payment", s)
            drops[why] = drops.get(why, 0) + 1
    out = [(s, p, (*e[:3], cfg.cohort_map.get(e[3], e[3] if e[3] in cfg.cohort_map.values() else None), *e[4:])) for s, p, e in out if e[1]]
    out = [t for t in out if first(passes[2], key(t[2])) or t[2][3] == "EX"]
    held = {}
    for s, _, e in out:
        if s == "prev_combined":
            held[key(e)] = held.get(key(e), 0) + 1
    kept = []
    for s, _, e in out:
        if s != "prev_combined" and e[2] <= dt.datetime(2024, 5, 31) and held.get(key(e), 0):
            held[key(e)] -= 1
        else:
            kept.append((s, e[8]))
    return sorted(kept), sorted((*k, n) for k, n in drops.items())


@pytest.mark.parametrize("protect", [False, True])
def test_entries_pass_one_window_and_stay_the_same(spark, protect):
    cfg = earn.EarningsConfig(report_start="2024-04-01", as_of="2024-07-01", covered_through="2024-05-31", fy_start_year=2024,
                              exempt_cohort="EX", protect_exempt=protect, cohort_map={"was": "EX", "EX": "D", "alias": "C", "C": "C"})
    if protect:
        cfg.cohort_map["EX"] = "EX"
    frames, data = [], []
    for p, name in enumerate(["prev_combined", "live", "again"]):
        own = _entries(spark, 10 * protect + p)
        frames.append(tag(spark.createDataFrame(own, ENTRY), name, p))
        data += [(name, p, e) for e in own]
    people = spark.createDataFrame([(1, "q@x.org", "c@x.org")], "learner_id bigint, email string, umuzi_email string")
    plans = []
    session.on_stage.append(lambda name, df: plans.append(_plan(df)) if name == "stage" else None)
    try:
        entries, logs = earn.clean_entries(frames, people, cfg)
    finally:
        session.on_stage.clear()
    want, drops = _turned(data, cfg)
    assert rows(entries, "source", "_row") == want
    assert rows(logs["drops"], "reason", "source", "n_dropped") == drops
    if not protect:
        assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning(") == 1


def test_breakdown_sums_entries_before_it_numbers_them(spark):
    data = [("a@x.org", 1.5, dt.datetime(2024, 5, d), None, "i", "t", n, "f", d) for d, n in [(3, "y"), (1, "x"), (2, "y"), (4, None), (5, None)]]
    data += [(None, 2.0, dt.datetime(2024, 5, 9), "C", "i", "t", "x", "f", 9)]
    entries = spark.createDataFrame(data, ENTRY).withColumn("month", F.lit("May"))
    long = earn.breakdown_long(entries)
    assert rows(long.select("umuzi_email", "earning_opportunity_name", "cohort", "op_num", F.col("payment").cast("double"), "n", F.dayofmonth("first_date"))) == [
        (None, "x", "C", 1, 2.0, 1, 9), ("a@x.org", None, "Missing Cohort Info", 3, 3.0, 2, 1),
        ("a@x.org", "x", "Missing Cohort Info", 1, 1.5, 1, 1), ("a@x.org", "y", "Missing Cohort Info", 2, 3.0, 2, 1)]


def _people_and_entries(spark, n=90):
    rnd = random.Random(3)
    one = lambda i: (rnd.choice(["a@x.org", "A@x.org", "\uff41@x.org", "b@x.org", "c@x.org", None]), rnd.choice([5.0, 7.5]), dt.datetime(2024, 5, rnd.randint(1, 3)),
                     rnd.choice(["C", None]), rnd.choice(["i", None]), rnd.choice(["Placement", "Impact gig"]), rnd.choice(["n", "m", None]), "f", i)
    entries = tag(spark.createDataFrame([one(i) for i in range(n)], ENTRY), "live", 1).withColumn("month", F.lit("May"))
    people = spark.createDataFrame([(1, "a@x.org", "p@x.org", "Ann"), (2, "c@x.org", "b@x.org", "Bo"), (3, None, "a@x.org", "Cy")],
                                   "learner_id bigint, umuzi_email string, email string, first_name string")
    for c in earn.DEMO_FIELDS:
        if c not in people.columns:
            people = people.withColumn(c, F.concat(F.lit(c), F.col("learner_id").cast("string")) if c != "date_of_birth" else F.lit(dt.datetime(2000, 1, 1)))
    return entries, people


def test_first_rows_of_the_demographics_are_found_in_one_exchange(spark):
    entries, people = _people_and_entries(spark)
    first = lambda demo: keep_first(demo.withColumn("umuzi_email", earn.person_key()), ["umuzi_email"], list(earn.ORDER_COLS))
    whole = first(earn.demographics(entries, people, people))
    once = earn.demographics(entries, people, people, then_first_per=earn.person_key())
    cols = ["umuzi_email", "_row", "first_name", "id_number", "age_service_accessed", "payment"]
    assert rows(first(once), *cols) == rows(whole, *cols) and once.count() == whole.count()
    assert len({r[0] for r in rows(once, earn.person_key())}) == once.count() < earn.demographics(entries, people, people).count()


def test_shipped_tables_exchange_no_entries_on_six_columns(spark, monkeypatch):
    entries, people = _people_and_entries(spark)
    monkeypatch.setattr(earnings_queries, "_people", lambda *a: people)
    monkeypatch.setattr(earnings_queries, "_all_people", lambda *a: people)
    plans = []
    session.on_stage.append(lambda name, df: plans.append(_plan(df)) if name == "breakdown" else None)
    try:
        summary, brk = earnings_queries._shipped(spark, None, entries)
    finally:
        session.on_stage.clear()
    demo = earn.demographics(entries, people, people)
    names = spark.createDataFrame(list(earnings_queries.PROGRAMMES), "slug string, name string")
    assert rows(brk) == rows(earn.breakdown(entries, demo, people.filter("learner_id % 4 = 0 AND umuzi_email IS NOT NULL").select("umuzi_email"), names))
    assert len(plans) == 1 and "WindowGroupLimit" in plans[0]
    assert not any("earning_opportunity_extra_info" in line for line in plans[0].splitlines() if "Exchange hashpartitioning" in line)
