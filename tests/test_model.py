from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cityflow.plans import dims, gold, model

from .conftest import tuples

FACT = (
    "PUBoroughID int, PickupDateKey int, pickup_hour int, total string, tip string, "
    "trip_distance double"
)
ROWS = [
    (1, 20230115, 8, "10.00", "1.00", 1.0),
    (1, 20230115, 9, "20.00", None, 2.0),
    (1, 20230120, 8, "5.00", "1.00", None),
    (1, 20240110, 8, "65.00", "2.00", 4.0),
    (2, 20240210, 8, "40.00", "0.00", 3.0),
    (2, 20240211, 8, None, None, None),  # a day without amounts is no member
    (2, 19990101, 8, "7.00", "0.00", 1.0),  # not in the calendar
    (None, 20240210, 8, "3.00", "0.00", 1.0),
]


@pytest.fixture
def star(spark, frame):
    money = {"total_amount": F.col("total").cast("decimal(10,2)"), "tip_amount": F.col("tip").cast("decimal(10,2)")}
    fact = frame(ROWS, FACT).withColumns(money)
    boroughs = frame([(1, "Bronx"), (2, "Queens"), (3, "Empty")], "BoroughID int, BoroughName string")
    return model.Star(
        gold.FACT_TAXI,
        fact,
        {
            "DimBorough": boroughs,
            "DimDate": dims.dim_date(spark, "2023-01-01", "2024-12-31"),
            "HourKey": dims.hour_dim(spark),
        },
    )


def test_totals_have_a_blank_member_and_add_up(star):
    by_borough = model.evaluate(star, ["Total Revenue"], ["DimBorough.BoroughName"])
    assert tuples(by_borough) == [
        ("Bronx", Decimal("100.00")),
        ("Queens", Decimal("47.00")),
        (None, Decimal("3.00")),
    ]
    total = model.evaluate(star, ["Total Revenue"]).first()[0]
    assert total == Decimal("150.00")
    for ref in ("DimDate.Year", "DimDate.DateValue", "HourKey.Value", "pickup_hour"):
        sliced = model.evaluate(star, ["Total Revenue"], [ref])
        assert sum(r["Total Revenue"] or 0 for r in sliced.collect()) == total


def test_daily_average_skips_blank_days_and_counts_the_blank_date(star):
    rows = model.evaluate(star, ["Average Daily Revenue"], ["DimBorough.BoroughName"])
    # Bronx: days of 30, 5 and 65. Queens: 40 and the blank date's 7.
    assert tuples(rows) == [("Bronx", 100 / 3), ("Queens", 23.5), (None, 3.0)]


def test_monthly_average_folds_years_together(star):
    rows = model.evaluate(star, ["Average Monthly Revenue"], ["DimBorough.BoroughName"])
    # January of 2023 and of 2024 is one member
    assert tuples(rows)[0] == ("Bronx", 100.0)
    in_2023 = model.evaluate(star, ["Average Monthly Revenue"], (), {"DimDate.Year": [2023]})
    assert in_2023.first()[0] == 35.0


def test_slicing_by_the_averaged_column_itself(star):
    rows = model.evaluate(star, ["Total Revenue", "Average Daily Revenue"], ["DimDate.DateValue"])
    for row in rows.collect():
        assert (row["Total Revenue"] is None) == (row["Average Daily Revenue"] is None)
        assert row["Total Revenue"] is None or float(row["Total Revenue"]) == row["Average Daily Revenue"]


def test_averages_ignore_nulls(star):
    row = model.evaluate(star, ["Average Trip Distance", "Average Tip Amount"], (), {"DimBorough.BoroughName": ["Bronx"]})
    assert tuple(row.first()) == (7 / 3, 4 / 3)


def test_filters_on_dimensions_and_fact(star):
    total = ["Total Revenue"]
    assert model.evaluate(star, total, (), {"DimDate.Year": lambda y: y == 2024}).first()[0] == 108
    assert model.evaluate(star, total, (), {"pickup_hour": [9]}).first()[0] == 20
    none = model.evaluate(star, total, ["DimBorough.BoroughName"], {"DimBorough.BoroughName": ["Empty"]})
    assert none.count() == 0


def test_empty_context_is_blank(star):
    nothing = {"DimDate.Year": [1900]}
    row = model.evaluate(star, list(model.METRICS), (), nothing).first()
    assert tuple(row) == (None, None, None)


def test_members_include_the_blank_one(star):
    assert tuples(model.members(star, "DimDate.Year")) == [(2023,), (2024,), (None,)]
    matched = model.restrict(star, {"DimBorough.BoroughName": ["Bronx"]})
    assert tuples(model.members(matched, "DimDate.Year")) == [(2023,), (2024,)]


def test_metric_rows_and_selection(star, spark):
    tall = model.metric_value(star, model.METRICS, ["DimBorough.BoroughName"])
    assert tall.count() == 9
    metrics = model.metric_table(spark, model.METRICS)
    assert {r.Metric for r in tall.collect()} == {r.Metric for r in metrics.collect()}
    wide = model.evaluate(star, model.METRICS)
    for choice, value in (("Total Revenue", 150.0), ("Unknown", None), (None, None)):
        selector = F.lit(choice).cast("string")
        assert wide.select(model.selected_metric(wide, selector, model.METRICS)).first()[0] == value


def test_selected_value(frame):
    df = frame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", 1), ("c", None), ("d", None)], "k string, v int")
    rows = df.groupBy("k").agg(model.selected_value("v").alias("v"))
    assert tuples(rows) == [("a", 1), ("b", None), ("c", None), ("d", None)]


def test_titles(star):
    days = star.dims["DimDate"]
    both = model.titles(days).first()
    assert both["Financial Title"] == "Financial Data – Year "
    one = model.titles(days, where={"Year": [2024]}).first()
    assert tuple(one) == (
        "Financial Data – Year 2024",
        "Trip Data – Year 2024",
        "NYC Taxi Trips Summary – Year 2024",
    )


def test_implicit_measures(star):
    measures = model.implicit_measures(gold.FACT_TAXI, ["total_amount", "trip_distance"])
    rows = model.evaluate(star, measures, ["DimBorough.BoroughName"])
    assert tuples(rows)[0] == ("Bronx", Decimal("100.00"), 7.0)
    counted = model.evaluate(star, {"n": model.Measure("tip_amount", "count", "plain")})
    assert counted.first().n == 6
    days = model.summarize(star.dims["DimDate"], gold.DIM_DATE, ["IsWeekend", "Year"])
    assert tuple(days.first()) == (209, 365 * 2023 + 366 * 2024)


def test_formats_follow_the_measure(star):
    out = model.evaluate(star, ["Total Revenue", "Average Total Amount", "Average Trip Distance"])
    text = model.with_formats(out, out.columns).first()
    assert text["Total Revenue Text"] == "$150.00"
    assert text["Average Total Amount Text"].endswith(" zł")
    assert "zł" not in text["Average Trip Distance Text"]
