"""Calendar features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark import config


def day_of_week(d: Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(d)


def is_holiday(d: Column) -> Column:
    return d.cast("date").isin(*[F.lit(h).cast("date") for h in config.HOLIDAYS]).cast("int")


def month_label(d: Column) -> Column:
    """``YYYY-MM`` period label."""
    return F.date_format(d, "yyyy-MM")


def add_time_features(txn: DataFrame, date_col: str = "date") -> DataFrame:
    """T5: month, quarter, year, day_of_week (Mon=0), is_weekend, is_holiday."""
    d = F.col(date_col)
    return (txn.withColumn("month", F.month(d))
            .withColumn("quarter", F.quarter(d))
            .withColumn("year", F.year(d))
            .withColumn("day_of_week", day_of_week(d))
            .withColumn("is_weekend", day_of_week(d).isin(5, 6).cast("int"))
            .withColumn("is_holiday", is_holiday(d)))
