"""Column functions on the trap rows listed in FIXTURES.md section D."""

import datetime as dt

from pyspark.sql import functions as F

from impactspark import functions as fx


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_normalize_email_strips_unicode_blanks_and_folds(spark):
    df = one_col(spark, ["  A@Example.org  ", "\tb@example.org\n",
                         "ａ@example.org", None])
    got = col_values(df, fx.normalize_email("v", nfkc_fold=True))
    assert got == ["a@example.org", "b@example.org", "a@example.org", None]


def test_strip_keeps_inner_blanks(spark):
    assert col_values(one_col(spark, [" a b "]), fx.strip("v")) == ["a b"]


def test_pad_id_never_truncates(spark):
    df = one_col(spark, ["123456789012", "1234567890123", "12345678901234", None])
    assert col_values(df, fx.pad_id("v")) == ["0123456789012", "1234567890123", "12345678901234", None]


def test_clean_money(spark):
    raw = ["R 1 200.50", "1,200", "Done", "0", "", "inf", "12d", "R 1 200,50", None, "-3.5", "1e3", "1e999"]
    got = col_values(one_col(spark, raw), fx.clean_money("v"))
    assert got == [1200.5, 1200.0, None, 0.0, None, None, None, 120050.0, None, -3.5, 1000.0, None]


def test_money_unparseable_flags_only_non_null_failures(spark):
    got = col_values(one_col(spark, ["Done", None, "5"]), fx.money_unparseable("v"))
    assert got == [True, False, False]


def test_parse_dates_six_layouts_and_traps(spark):
    raw = ["2026-01-05 10:30:00.123456", "2026-01-05 10:30:00", "2026-1-5", "05/01/2026 10:30:00.5",
           "5/1/2026 10:30:00", "05/01/2026", "02/13/2026", "1/6/2026 10:30", "30/02/2026", "", None,
           "46174"]
    df = one_col(spark, raw)
    got = col_values(df, fx.parse_dates("v"))
    assert got[:6] == [dt.datetime(2026, 1, 5, 10, 30, 0, 123456), dt.datetime(2026, 1, 5, 10, 30),
                       dt.datetime(2026, 1, 5), dt.datetime(2026, 1, 5, 10, 30, 0, 500000),
                       dt.datetime(2026, 1, 5, 10, 30), dt.datetime(2026, 1, 5)]
    assert got[6:] == [None] * 6
    suspect = col_values(df, fx.suspect_date("v"))
    assert suspect[6] is True and suspect[7] is True and suspect[8] is False
    serial = col_values(df, fx.parse_dates("v", serial_dates=True))
    assert serial[-1] == dt.datetime(1899, 12, 30) + dt.timedelta(days=46174)


def test_complete_seconds(spark):
    got = col_values(one_col(spark, ["2026-01-05 10:30", "2026-01-05 10:30:00"]), fx.complete_seconds("v"))
    assert got == ["2026-01-05 10:30:00", "2026-01-05 10:30:00"]


def _ages(spark, pairs):
    df = spark.createDataFrame([(dt.date(*a), dt.date(*b)) for a, b in pairs], "d date, dob date")
    return df.select(fx.age_calendar("d", "dob").alias("y"), fx.band_calendar("d", "dob").alias("b"),
                     fx.age_days365("d", "dob").alias("y365"),
                     fx.band_days365(fx.age_days365("d", "dob")).alias("b365")).collect()


def test_calendar_age_bands_borrow_from_birth_month(spark):
    r = _ages(spark, [((2018, 2, 28), (2000, 2, 29)),   # 17y 11m 28d -> still 17
                      ((2018, 3, 1), (2000, 2, 29)),    # 18y 0m 1d
                      ((2026, 3, 30), (2008, 3, 31)),   # 17y 11m 30d: 30-day months make it 18 years
                      ((2026, 3, 31), (2008, 3, 31)),   # 18th birthday
                      ((2026, 5, 8), (1975, 5, 10)),    # 50y 11m 29d
                      ((2026, 5, 9), (1975, 5, 10)),    # 50y 11m 30d: already 51 x 360 days
                      ((2026, 5, 10), (1975, 5, 10))])
    assert [(x.y, x.b) for x in r] == [(17, "17 and below"), (18, "18-25"), (17, "18-25"),
                                       (18, "18-25"), (50, "36-50"), (50, "Over 50"),
                                       (51, "Over 50")]


def test_days365_bands_right_closed(spark):
    r = _ages(spark, [((2018, 1, 1), (2000, 1, 1)), ((2026, 1, 1), (2000, 1, 1))])
    assert [(x.y365, x.b365) for x in r] == [(18, "18-25"), (26, "26-35")]


def test_calendar_band_unknown_on_null(spark):
    df = spark.createDataFrame([(None, dt.date(2000, 1, 1))], "d date, dob date")
    assert df.select(fx.band_calendar("d", "dob")).first()[0] == "Unknown"


def test_month_labels(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 5, 3, 10, 0),)], "d timestamp_ntz")
    r = df.select(fx.month_name("d"), fx.month_year("d"), fx.month_year_padded("d"),
                  fx.fy_rank("d"), fx.fy_start_year("d")).first()
    assert tuple(r) == ("May", "May 2026", "May       2026", 2, 2026)
    df2 = spark.createDataFrame([(dt.datetime(2027, 2, 1),)], "d timestamp_ntz")
    assert tuple(df2.select(fx.fy_rank("d"), fx.fy_start_year("d")).first()) == (11, 2026)


def test_period_end_keeps_last_day_rows(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 6, 30, 10, 0),)], "d timestamp_ntz")
    assert df.filter(fx.in_period("d", "2026-04-01", "2026-06-30")).count() == 1
    assert df.filter(fx.in_period("d", "2026-04-01", "2026-06-30", whole_last_day=False)).count() == 0


def test_national_id_rule(spark):
    cases = [("8001015009087", None, None, True),      # citizen digit 0
             ("8001015009187", True, None, False),     # valid id, digit 1: id decides
             ("800101500908", True, None, True),       # 12 digits -> self-report
             ("8001015009087\n", None, "South African", True),   # trailing newline is not valid
             ("8001015009087\n", None, None, None),
             (None, False, "Other", None),             # NULL id: NULL OR FALSE is NULL (dropped)
             (" 8001015009087 ", None, None, True)]
    df = spark.createDataFrame([c[:3] for c in cases], "idn string, cit boolean, nat string")
    got = col_values(df, fx.national_id_eligible("idn", "cit", "nat"))
    assert got == [c[3] for c in cases]


def test_three_valued_flags_drop_null(spark):
    df = spark.createDataFrame([(False, False), (None, False), (False, True)], "e boolean, t boolean")
    assert df.filter(fx.not_employed_not_test("e", "t")).count() == 1


def test_not_in_keeps_null_like_pandas(spark):
    df = one_col(spark, ["a", "b", None])
    assert col_values(df, fx.not_in("v", ["a"])) == [False, True, True]


def test_backfill_type(spark):
    df = spark.createDataFrame([(None, "Internship"), (None, "Other"), (None, None), ("Gig", "Internship")],
                               "t string, n string")
    assert col_values(df, fx.backfill_type("t", "n")) == ["Placement", "Experience gig",
                                                          "Experience gig", "Gig"]


def test_ordered_override_precedence(spark):
    df = spark.createDataFrame([("Vendor pathway",), ("Pathway x",), ("other",), (None,)], "p string")
    expr = fx.ordered_override(F.lit("mapped"), [(fx.contains_ci("p", "vendor"), "V"),
                                                  (fx.contains_ci("p", "pathway"), "P")])
    assert col_values(df, expr) == ["V", "P", "mapped", "mapped"]
