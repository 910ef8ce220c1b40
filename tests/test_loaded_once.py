"""What the earnings loaders do once for each record."""

import datetime as dt

from pyspark.sql import functions as F

from impactspark.sources.records import cells

from .conftest import rows


def test_a_record_is_parsed_once_whatever_filters_follow(spark):
    records = spark.createDataFrame([("f", 0, "a,1,"), ("f", 1, ",2,x"), ("f", 2, '"b,c",3')], "_file string, _row bigint, record string")
    df = cells(records, ["p", "q", "s"]).filter("p IS NOT NULL AND q > 1").filter(F.length("p") < 9)
    assert rows(df) == [("b,c", "3", None, "f", 2)]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_csv") == 1


def test_money_is_cleaned_once(spark):
    from impactspark.functions.numbers import clean_money

    df = spark.createDataFrame([("R 1 200.50",), ("1e999",), ("-1e999",), ("12d",), ("",), (None,), ("-.5",)], "s string")
    out = df.select("s", clean_money("s").alias("v"))
    assert dict(map(tuple, out.collect())) == {"R 1 200.50": 1200.5, "1e999": None, "-1e999": None, "12d": None, "": None, None: None, "-.5": -0.5}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_templates_of_many_orders_have_more_files(spark, monkeypatch):
    from impactspark.plans import template_queries as tq

    orders = spark.createDataFrame([(n, 1, "F", 10.0, dt.datetime(1996, 1, 2), "2-HIGH") for n in range(8)],
                                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
                                   "o_orderpriority string")
    customer = spark.createDataFrame([(1, "C1", 2, 5.0, "FURNITURE")],
                                     "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    tables = type("T", (), {"spark": spark, "orders": orders, "customer": customer})()
    used = []
    monkeypatch.setattr(tq, "write_template", lambda df, path, lead, files: used.append(files))
    monkeypatch.setattr(tq, "stored_bytes", lambda df: 40 * (16 << 20))
    tq._write_earnings(tables)
    assert set(used) == {tq.FILES + 40}
