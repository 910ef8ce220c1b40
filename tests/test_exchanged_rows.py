"""What the earnings chain exchanges: narrow rows, once a pass."""

import datetime as dt
import itertools

from pyspark.sql import functions as F

from impactspark.operators import drop_covered, keep_first
from impactspark.operators.windows import row_number_in_key

from .conftest import rows

ORDER = ["p", "f", "r"]
SCHEMA = "k1 string, k2 double, c string, p int, f string, r bigint"


def _frame(spark):
    """Keys that repeat and are null; the order is unique inside a key."""
    keys = itertools.product(("a", "b", None), (1.0, None), ("ex", "no", None))
    data = [(*k, p, f, r) for i, k in enumerate(keys) for n, (p, f, r) in enumerate(
        itertools.product((0, 1), ("x", None), (1, 5, 9))) if (i + n) % 3]
    return spark.createDataFrame(data, SCHEMA), data


def _sorted(data):
    return sorted(data, key=lambda t: tuple((x is not None, x) for x in t))


def _in_order(data):
    return sorted(data, key=lambda t: tuple((x is not None, x) for x in t[3:]))


def _plan(df):
    """The plan before it has run (a plan that has run is printed twice)."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def test_keep_first_with_an_exempt_key_exchanges_only_the_others(spark):
    df, data = _frame(spark)
    out = keep_first(df, ["k1", "k2", "c"], ORDER, exempt=F.col("c").eqNullSafe(F.lit("ex")), skew_safe=True)
    seen, want = set(), []
    for t in _in_order(data):
        if t[2] == "ex" or t[:3] not in seen:
            want.append(t)
        seen.add(t[:3])
    assert rows(out) == _sorted(want)
    assert _plan(out).count("Exchange hashpartitioning") == 1


def test_keep_first_with_an_exemption_beside_the_key(spark):
    df, data = _frame(spark)
    out = keep_first(df, ["k1", "k2"], [*ORDER[:2], "c", "r"], exempt=F.col("c") == "ex", skew_safe=True)
    seen, want = set(), []
    for t in sorted(data, key=lambda t: tuple((x is not None, x) for x in (t[3], t[4], t[2], t[5]))):
        if t[2] == "ex" or t[:2] not in seen:
            want.append(t)
        seen.add(t[:2])
    assert rows(out) == _sorted(want)


def test_ranking_carries_keys_once(spark):
    df, data = _frame(spark)
    out = row_number_in_key(df, ["k1", "k2", "c"], ORDER, "n", skew_safe=True, chunk=4)
    count, want = {}, []
    for t in _in_order(data):
        count[t[:3]] = count.get(t[:3], 0) + 1
        want.append((*t, count[t[:3]]))
    assert out.columns == [*df.columns, "n"]
    assert rows(out) == _sorted(want)
    made = next(line for line in _plan(out).splitlines() if "AS __key#" in line)
    assert "Project [k1#" not in made


def test_uncovered_rows_are_not_exchanged(spark):
    df, data = _frame(spark)
    state = df.filter("p = 0 AND r < 9")
    live = df.filter("p = 1").withColumn("late", F.col("r") > 5)
    kept, dropped = drop_covered(live, state, ["k1", "k2", "c"], ORDER, covered=~F.col("late"), skew_safe=True)
    left = {}
    for t in data:
        if t[3] == 0 and t[5] < 9:
            left[t[:3]] = left.get(t[:3], 0) + 1
    stay, gone = [], []
    for t in _in_order(t for t in data if t[3] == 1):
        if t[5] <= 5 and left.get(t[:3], 0):
            left[t[:3]] -= 1
            gone.append((*t, False))
        else:
            stay.append((*t, t[5] > 5))
    assert rows(kept) == _sorted(stay) and rows(dropped) == _sorted(gone)
    assert "__cand" not in _plan(kept)


def test_demographics_finds_first_rows_before_the_match(spark):
    from impactspark.plans import earnings as earn

    day = dt.datetime(2024, 5, 1)
    entries = spark.createDataFrame(
        [("a@x.org", 1.0, day, "C", "i", "t", "n", "live", 1, "f", n) for n in (2, 1)] + [("b@x.org", 1.0, day, "C", "i", "t", "n", "live", 1, "f", 3)],
        "umuzi_email string, payment double, date_service_accessed timestamp_ntz, cohort string, earning_opportunity_extra_info string, "
        "earning_opportunity_type string, earning_opportunity_name string, source string, _src_priority int, _file string, _row bigint")
    people = spark.createDataFrame(
        [(1, "a@x.org", "pa@x.org", "Ann", dt.datetime(2000, 1, 1))],
        "learner_id bigint, umuzi_email string, email string, first_name string, date_of_birth timestamp_ntz")
    out = earn.demographics(entries, people, people)
    assert rows(out, "umuzi_email", "_row", "first_name", "age_service_accessed") == [("a@x.org", 1, "Ann", 24), ("b@x.org", 3, None, None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("Window [row_number")
