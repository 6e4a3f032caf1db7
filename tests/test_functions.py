"""Column expressions."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from chanlytics.functions import date_attributes, surrogate_key, tokens
from chanlytics.functions.text import contains_ci, like_ci, message_length
from chanlytics.plans.marts import dim_dates_between


def test_surrogate_key_nulls_keep_separator(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (1, None), (None, None)], "x long, y string")
    got = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    want = [hashlib.md5(s.encode()).hexdigest() for s in ["1-a", "-a", "1-", "-"]]
    assert got == want


def test_date_attributes_edges(spark):
    days = [dt.date(2021, 1, 1), dt.date(2024, 2, 29), dt.date(2024, 9, 4), dt.date(2023, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select(*date_attributes("d"))
    rows = {r.full_date: r for r in df.collect()}
    r = rows[dt.date(2021, 1, 1)]
    assert (r.date_sk, r.year, r.week_of_year, r.day_of_week_num, r.quarter) == (20210101, 2021, 53, 5, 1)
    assert r.month_name == "January  " and r.day_of_week_name == "Friday   " and not r.is_weekend
    r = rows[dt.date(2024, 2, 29)]
    assert (r.day_of_year, r.day_of_month, r.month) == (60, 29, 2)
    r = rows[dt.date(2024, 9, 4)]
    assert r.month_name == "September" and r.day_of_week_name == "Wednesday"
    r = rows[dt.date(2023, 12, 31)]
    assert r.day_of_week_num == 0 and r.is_weekend and r.week_of_year == 52


def test_date_spine_guards(spark):
    def spine(lo, hi):
        b = spark.createDataFrame([(lo, hi)], "lo date, hi date")
        return dim_dates_between(b, F.col("lo"), F.col("hi")).collect()

    assert spine(dt.date(2024, 1, 3), dt.date(2024, 1, 1)) == []   # min > max: empty, no error
    assert spine(None, None) == []                                 # empty staging
    rows = spine(dt.date(2023, 12, 30), dt.date(2024, 1, 2))
    assert [r.incremental_num for r in rows] == [1, 2, 3, 4]


def test_text_rules(spark):
    df = spark.createDataFrame([("a😀é URGENT",), (None,)], "t string")
    r = df.select(message_length("t").alias("n"), contains_ci("t", "urgent").alias("u")).collect()
    assert [(x.n, x.u) for x in r] == [(10, True), (0, False)]
    df = spark.createDataFrame([("Cost 100% offax",)], "t string")
    assert df.filter(like_ci("t", "100%")).count() == 1
    assert df.filter(like_ci("t", "f_x")).count() == 1           # '_' is a wildcard
    assert df.filter(like_ci("t", "f_x", literal=True)).count() == 0


def test_tokens_are_unicode_words(spark):
    df = spark.createDataFrame([("ፓራሲታሞል tablet, tablet_2 café",)], "t string")
    got = df.select(tokens(F.lower("t"))).first()[0]
    assert got == ["ፓራሲታሞል", "tablet", "tablet_2", "café"]
