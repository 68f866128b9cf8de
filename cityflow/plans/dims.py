"""Dimension tables. Their loading rules are this project's own choice: ids follow the
alphabet, Monday is day 1, and days 6 and 7 are the weekend."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cityflow.functions.columns import date_key

HOURS_PER_DAY = 24


def dim_borough(zones: DataFrame, name: str = "Borough") -> DataFrame:
    """Distinct borough names with dense ids. The ranking window is global but only
    sees the distinct names of the zone lookup."""
    names = zones.select(F.col(name).alias("BoroughName")).where("BoroughName IS NOT NULL")
    ranked = F.dense_rank().over(Window.orderBy("BoroughName"))
    return names.distinct().select(ranked.cast("int").alias("BoroughID"), "BoroughName")


def _calendar(days: DataFrame) -> DataFrame:
    day = F.col("DateValue")
    weekday = F.weekday(day) + 1
    return days.select(
        date_key(day).alias("DateKey"),
        day,
        F.year(day).alias("Year"),
        F.month(day).alias("MonthNumber"),
        F.date_format(day, "MMM").alias("MonthShort"),
        F.dayofmonth(day).alias("Day"),
        weekday.alias("DayOfWeek"),
        F.date_format(day, "EEE").alias("DayOfWeekShort"),
        F.when(weekday >= 6, 1).otherwise(0).alias("IsWeekend"),
    )


def dim_date(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Every day from `start` to `end`, both included."""
    first, last = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("DateValue"))
    return _calendar(days)


def dim_date_covering(fact: DataFrame, ts: Column | str) -> DataFrame:
    """Every day from the earliest to the latest date of a fact column."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    span = fact.agg(
        F.min(ts).cast("date").alias("first"), F.max(ts).cast("date").alias("last")
    )
    days = span.select(F.explode(F.sequence("first", "last")).alias("DateValue"))
    return _calendar(days)


def hour_dim(spark: SparkSession) -> DataFrame:
    return spark.range(HOURS_PER_DAY).select(F.col("id").cast("int").alias("Value"))
