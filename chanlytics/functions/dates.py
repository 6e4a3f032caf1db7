"""Calendar attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chanlytics.functions._util import as_col
from chanlytics.functions.keys import date_key

# Month and weekday names are blank-padded to 9 characters, the width of
# the longest English name ("September", "Wednesday").
NAME_WIDTH = 9


def padded_name(d: Column, pattern: str) -> Column:
    return F.rpad(F.date_format(d, pattern), NAME_WIDTH, " ")


def date_attributes(d: "Column | str") -> list[Column]:
    """All columns of dim_dates except ``incremental_num``.

    ``day_of_week_num`` is 0 = Sunday; ``week_of_year`` is the ISO week
    while ``year`` is the calendar year (2021-01-01 -> 2021, week 53).
    """
    d = as_col(d)
    dow = F.dayofweek(d)  # 1 = Sunday in Spark
    return [
        date_key(d).alias("date_sk"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        padded_name(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        (dow - 1).alias("day_of_week_num"),
        padded_name(d, "EEEE").alias("day_of_week_name"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofyear(d).alias("day_of_year"),
        dow.isin(1, 7).alias("is_weekend"),
    ]
