"""The plan of what a feed has to cover: time windows, boxes and caps."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from cityflow.functions.columns import iso_utc
from cityflow.operators import positions


def backfill_windows(
    sensors: DataFrame, start: datetime | Column, end: datetime | Column, days: int = 31
) -> DataFrame:
    """Cut [start, end) into windows of `days` and give every sensor all of them.

    The windows are an array built in the row itself, so sensors are neither
    shuffled nor joined.
    """
    start, end = (
        b if isinstance(b, Column) else F.lit(b).cast("timestamp") for b in (start, end)
    )
    step = F.expr(f"INTERVAL {int(days)} DAYS")
    begins = F.when(start < end, F.sequence(start, end, step))
    return (
        sensors.select("sensor_id", end.alias("_end"), F.explode(begins).alias("window_start"))
        .where("window_start < _end")
        .select(
            "sensor_id",
            "window_start",
            F.least(F.col("window_start") + step, "_end").alias("window_end"),
        )
        .withColumns(
            {"date_from": iso_utc("window_start"), "date_to": iso_utc("window_end")}
        )
    )


def remaining_windows(
    planned: DataFrame, stored: DataFrame, key: str = "sensor_id"
) -> DataFrame:
    """What is left of planned windows when the spans already stored are taken away.

    `planned` has `window_start` and `window_end`, `stored` has `span_start` and `span_end`,
    both half-open and by `key`; spans may overlap, touch, repeat or reach over windows. A
    window keeps its gaps, in one row each, and none if it is covered.

    Spans meet the windows of their key in an equi-join, are clipped, and of those with one
    beginning only the longest stays before they are sorted within their window, so a task
    never holds more than the different beginnings of one window.
    """
    windows = planned.select(key, "window_start", "window_end").distinct()
    spans = stored.select(key, "span_start", "span_end").where("span_start < span_end")
    spans = spans.groupBy(key, "span_start").agg(F.max("span_end").alias("span_end"))
    clipped = windows.join(spans, key).where(
        "span_start < window_end AND span_end > window_start"
    ).select(
        key,
        "window_start",
        "window_end",
        F.greatest("span_start", "window_start").alias("begin"),
        F.least("span_end", "window_end").alias("end"),
    )
    # a mark at the end of each window closes its last gap
    marks = windows.select(
        "*", F.col("window_end").alias("begin"), F.col("window_end").alias("end")
    )
    points = clipped.unionByName(marks).groupBy(key, "window_start", "window_end", "begin").agg(
        F.max("end").alias("end")
    )
    before = Window.partitionBy(key, "window_start", "window_end").orderBy("begin")
    covered = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    gaps = points.select(
        key,
        F.coalesce(covered, "window_start").alias("window_start"),
        F.col("begin").alias("window_end"),
    )
    return gaps.where("window_start < window_end").withColumns(
        {"date_from": iso_utc("window_start"), "date_to": iso_utc("window_end")}
    )


def within_box(
    df: DataFrame, lon: str, lat: str, box: tuple[float, float, float, float]
) -> DataFrame:
    """Rows inside (west, south, east, north), edges included."""
    west, south, east, north = box
    return df.where(F.col(lon).between(west, east) & F.col(lat).between(south, north))


def capped(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first `n` rows in a stated order, the row cap of one request page."""
    return df.orderBy(*order).limit(n)


@dataclass(frozen=True)
class Pages:
    """Rows in a stated order, cut into pages of `size` rows numbered from 1."""

    ordered: positions.Ordered
    size: int

    def rows(self) -> DataFrame:
        """Every row with its `position` and `page`."""
        number = F.ceil(F.col(positions.POSITION) / self.size).alias("page")
        return self.ordered.rows().select("*", number)

    def page(self, number: int) -> DataFrame:
        """The rows of one page, none beyond the last; other pages' partitions are not read."""
        return self.ordered.slice((number - 1) * self.size + 1, number * self.size)


def paged(df: DataFrame, size: int, *order: Column | str) -> Pages:
    """The pages of a request in the order given, ties by the remaining columns. The rows are
    sorted once over all tasks, so that the last page costs as little as the first."""
    if size < 1:
        raise ValueError(f"a page needs at least one row, not {size}")
    return Pages(positions.ordered(df, *order), size)
