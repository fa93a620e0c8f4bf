"""Calendar dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dim_date(spark: SparkSession, today: date, days: int) -> DataFrame:
    """One row per day, from today backwards. Days of the week count from Sunday = 0."""
    d = F.date_sub(F.lit(today), F.col("id").cast("int"))
    return spark.range(days).select(
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month_num"),
        F.monthname(d).alias("month_name"),
        F.weekofyear(d).alias("week_num"),
        F.dayofmonth(d).alias("day_num"),
        F.dayname(d).alias("day_name"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
    )
