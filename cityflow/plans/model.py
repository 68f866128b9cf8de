"""The star schema's relationships and measures, and their evaluation over any slice.

A measure is an aggregate of one fact column, or the average of such an aggregate
over the members of a dimension column. Evaluation first reduces the fact on its
own narrow keys, then joins the dimensions to that small result, so the fact is
scanned and shuffled once whatever is asked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow.functions import columns as c
from cityflow.operators.joins import lookup, unmatched

# fact -> dimension -> (fact key, dimension key)
RELATIONSHIPS: dict[str, dict[str, tuple[str, str]]] = {
    "FactTaxiHourly": {
        "DimBorough": ("PUBoroughID", "BoroughID"),
        "DimDate": ("PickupDateKey", "DateKey"),
        "HourKey": ("pickup_hour", "Value"),
    },
    "FactAirQuality": {
        "DimBorough": ("BoroughID", "BoroughID"),
        "DimDate": ("DateKey", "DateKey"),
        "HourKey": ("HourKey", "Value"),
    },
}


@dataclass(frozen=True)
class Measure:
    """`how` is sum, avg or count of `column`; `over` names the dimension column whose
    non-blank member sums are averaged."""

    column: str
    how: str
    style: str
    over: str | None = None


# Measure names as reports use them.
MEASURES: dict[str, Measure] = {
    "Total Revenue": Measure("total_amount", "sum", c.DOLLARS),
    "Average Daily Revenue": Measure("total_amount", "sum", c.DOLLARS, "DimDate.DateValue"),
    "Average Monthly Revenue": Measure("total_amount", "sum", c.DOLLARS, "DimDate.MonthNumber"),
    "Average Trip Distance": Measure("trip_distance", "avg", c.PLAIN),
    "Average Total Amount": Measure("total_amount", "avg", c.ZLOTY),
    "Average Tip Amount": Measure("tip_amount", "avg", c.ZLOTY),
    "Average Trip Duration (Minutes)": Measure("trip_duration_minutes", "avg", c.PLAIN),
}
METRICS = ("Average Daily Revenue", "Average Monthly Revenue", "Total Revenue")
METRICS_2 = (
    "Average Trip Distance",
    "Average Total Amount",
    "Average Tip Amount",
    "Average Trip Duration (Minutes)",
)
TITLES = {
    "Financial Title": "Financial Data – Year ",
    "Trip Title": "Trip Data – Year ",
    "Dashboard Title": "NYC Taxi Trips Summary – Year ",
}

# What a report does with a bare column dropped into a value field.
DEFAULT_AGGREGATES: dict[str, dict[str, str]] = {
    "FactTaxiHourly": {
        "trip_duration_minutes": "sum",
        "trip_distance": "sum",
        "fare_amount": "sum",
        "tip_amount": "sum",
        "total_amount": "sum",
        "DOBoroughID": "count",
        "DropoffDateKey": "count",
    },
    "FactAirQuality": {"value": "sum"},
    "DimDate": {
        "Year": "sum",
        "MonthNumber": "sum",
        "Day": "sum",
        "DayOfWeek": "sum",
        "IsWeekend": "sum",
    },
}

Condition = Callable[[Column], Column] | Sequence


@dataclass(frozen=True)
class Star:
    """One fact and its dimensions. `stored`: the fact holds parts of measures (`partials`)
    that were summed before, in place of its rows."""

    fact_name: str
    fact: DataFrame
    dims: Mapping[str, DataFrame]
    stored: bool = False

    def keys(self, dim: str) -> tuple[str, str]:
        return RELATIONSHIPS[self.fact_name][dim]


def _split(ref: str) -> tuple[str | None, str]:
    """`DimDate.Year` -> (DimDate, Year); a bare name is a column of the fact."""
    dim, _, column = ref.rpartition(".")
    return (dim or None), column


def _slot(ref: str) -> str:
    return "_by_" + ref.replace(".", "_")


def _matches(column: Column, condition: Condition) -> Column:
    return condition(column) if callable(condition) else column.isin(list(condition))


def restrict(star: Star, where: Mapping[str, Condition]) -> Star:
    """Apply filters. A filter on a dimension becomes a semi-join of the fact with the
    dimension's remaining keys, so it removes fact rows before anything is aggregated
    (and prunes partitions where the fact is partitioned on that key)."""
    fact, dims = star.fact, dict(star.dims)
    for ref, condition in where.items():
        dim, column = _split(ref)
        if dim is None:
            fact = fact.where(_matches(F.col(column), condition))
        else:
            dims[dim] = dims[dim].where(_matches(F.col(column), condition))
    for dim in {_split(ref)[0] for ref in where} - {None}:
        key, dim_key = star.keys(dim)
        kept = dims[dim].select(F.col(dim_key).alias("_kept"))
        fact = fact.join(kept, F.col(key) == F.col("_kept"), "left_semi")
    return Star(star.fact_name, fact, dims, star.stored)


def _attach(star: Star, df: DataFrame, refs: Iterable[str]) -> DataFrame:
    """Add the dimension columns named by `refs` under their slot names."""
    wanted: dict[str, dict[str, str]] = {}
    for ref in dict.fromkeys(refs):
        dim, column = _split(ref)
        if dim is None:
            df = df.withColumn(_slot(ref), F.col(column))
        else:
            wanted.setdefault(dim, {})[_slot(ref)] = column
    for dim, take in wanted.items():
        key, dim_key = star.keys(dim)
        df = lookup(df, star.dims[dim], key, dim_key, take)
    return df


def members(star: Star, ref: str) -> DataFrame:
    """The distinct values of a dimension column, with a blank one if the fact holds keys
    the dimension lacks."""
    dim, column = _split(ref)
    key, dim_key = star.keys(dim)
    table = star.dims[dim]
    orphans = star.fact.select(F.col(key).alias(dim_key)).distinct()
    orphans = unmatched(orphans, table, [dim_key]).limit(1)
    blank = orphans.select(F.lit(None).cast(table.schema[column].dataType).alias(column))
    return table.select(column).unionByName(blank).distinct()


def evaluate(
    star: Star,
    measures: Sequence[str] | Mapping[str, Measure],
    by: Sequence[str] = (),
    where: Mapping[str, Condition] | None = None,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Measures per slice. `by` holds `Dimension.Column` references or fact columns;
    facts without a partner form the blank member of a dimension. `names` renames
    slice columns in the result."""
    star = restrict(star, where) if where else star
    specs = dict(measures) if isinstance(measures, Mapping) else {m: MEASURES[m] for m in measures}
    overs = list(dict.fromkeys(s.over for s in specs.values() if s.over))
    slots = {ref: F.col(_slot(ref)) for ref in by}

    # The fact is reduced on its own keys first; only that result meets the dimensions.
    refs = [*by, *overs]
    grain = dict.fromkeys(star.keys(d)[0] if d else col for d, col in map(_split, refs))
    parts = _combined if star.stored else partials
    reduced = star.fact.groupBy(*grain).agg(*parts(specs.values()))
    placed = _attach(star, reduced, refs)

    values = (
        _over_members(placed, specs, overs, list(slots.values()))
        if overs
        else placed.groupBy(*slots.values()).agg(*_combined(specs.values())).withColumns(
            {name: _value(spec) for name, spec in specs.items()}
        )
    )
    rename = names or {}
    return values.select(
        *[slot.alias(rename.get(ref, _split(ref)[1])) for ref, slot in slots.items()],
        *[F.col(f"`{name}`") for name in specs],
    )


def _states(specs: Iterable[Measure]) -> dict[str, tuple[str, str]]:
    """The additive parts the measures are made of: name -> (aggregate, column)."""
    parts = {"sum": ["sum"], "avg": ["sum", "count"], "count": ["count"]}
    return {f"_{how}_{s.column}": (how, s.column) for s in specs for how in parts[s.how]}


_AGGREGATES = {"sum": F.sum, "count": F.count}


def partials(specs: Iterable[Measure]) -> list[Column]:
    """The parts as aggregates of fact rows; they add up over any division of the rows."""
    return [_AGGREGATES[how](col).alias(name) for name, (how, col) in _states(specs).items()]


def _combined(specs: Iterable[Measure]) -> list[Column]:
    return [F.sum(name).alias(name) for name in _states(specs)]


def _ratio(total: Column, n: Column) -> Column:
    """Exact total over count, blank for an empty set."""
    return F.when(n > 0, total.cast("double") / n)


def _value(spec: Measure) -> Column:
    if spec.how == "avg":
        return _ratio(F.col(f"_sum_{spec.column}"), F.col(f"_count_{spec.column}"))
    return F.col(f"_{spec.how}_{spec.column}")


def _over_members(
    placed: DataFrame, specs: Mapping[str, Measure], overs: Sequence[str], slices: list[Column]
) -> DataFrame:
    """Totals per slice and per slice and member in one pass of grouping sets, then the
    averages of the member totals."""
    member = {over: f"_member_{i}" for i, over in enumerate(overs)}
    placed = placed.withColumns({m: F.col(_slot(over)) for over, m in member.items()})
    columns = [F.col(m) for m in member.values()]
    sets = [slices, *[[*slices, m] for m in columns]]
    totals = placed.groupingSets(sets, *slices, *columns).agg(
        *_combined(specs.values()), *[F.grouping(m).alias(f"_total{m}") for m in member.values()]
    )
    is_slice = reduce(and_, [F.col(f"_total{m}") == 1 for m in member.values()])

    def value(spec: Measure) -> Column:
        if spec.over is None:
            # a slice has one such row; max only picks it out
            return F.max(F.when(is_slice, _value(spec)))
        per_member = F.when(F.col(f"_total{member[spec.over]}") == 0, _value(spec))
        return _ratio(F.sum(per_member), F.count(per_member))

    return totals.groupBy(*slices).agg(*[value(s).alias(n) for n, s in specs.items()])


# --- metric selectors ---


def metric_table(spark: SparkSession, metrics: Sequence[str]) -> DataFrame:
    """The disconnected table a report's metric slicer is built on."""
    return spark.createDataFrame([(m,) for m in metrics], "Metric string")


def sliced_metrics(chosen: DataFrame, values: DataFrame, value: str = "Metric Value") -> DataFrame:
    """The rows of a metric table with the value of each metric, blank ones too: what a report
    shows for a selection of its slicer."""
    return chosen.join(values.select("Metric", value), "Metric", "left")


def metric_value(
    star: Star,
    metrics: Sequence[str] = METRICS,
    by: Sequence[str] = (),
    where: Mapping[str, Condition] | None = None,
    names: Mapping[str, str] | None = None,
    value: str = "Metric Value",
) -> DataFrame:
    """Every metric of a selector as one row per slice and metric; a slicer choice is a
    filter on `Metric`. A blank value gives no row, as in a report."""
    wide = evaluate(star, metrics, by, where, names)
    slices = [col for col in wide.columns if col not in metrics]
    same_type = wide.withColumns({m: F.col(f"`{m}`").cast("double") for m in metrics})
    tall = same_type.unpivot(
        [F.col(s) for s in slices], [F.col(f"`{m}`") for m in metrics], "Metric", value
    )
    return tall.where(F.col(value).isNotNull())


def selected_metric(wide: DataFrame, selector: Column, metrics: Sequence[str]) -> Column:
    """The chosen measure of a wide result, blank unless exactly one known metric is chosen."""
    return c.switch(selector, {m: wide[f"`{m}`"].cast("double") for m in metrics})


# --- selected values and titles ---


def selected_value(column: str) -> Column:
    """Aggregate: the column's value if all rows share one, else blank. A blank row is a
    value too. Needs no distinct, so it combines before the shuffle."""
    col = F.col(column)
    single = (F.count(col) == F.count(F.lit(1))) & (F.min(col) == F.max(col))
    return F.when(single, F.min(col))


def titles(
    dim_date: DataFrame,
    by: Sequence[str] = (),
    where: Mapping[str, Condition] | None = None,
) -> DataFrame:
    """The three report titles for a selection of dates, sliced by date columns."""
    for column, condition in (where or {}).items():
        dim_date = dim_date.where(_matches(F.col(column), condition))
    year = dim_date.groupBy(*by).agg(selected_value("Year").alias("_year"))
    return year.select(*by, *[c.label(text, "_year").alias(n) for n, text in TITLES.items()])


# --- implicit aggregates ---

def summarize(
    df: DataFrame, table: str, columns: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Columns of a single table under their default aggregate."""
    defaults = DEFAULT_AGGREGATES[table]
    chosen = columns or list(defaults)
    return df.groupBy(*by).agg(*[_AGGREGATES[defaults[col]](col).alias(col) for col in chosen])


def implicit_measures(table: str, columns: Sequence[str] | None = None) -> dict[str, Measure]:
    """The default aggregates of a fact's columns as measures, for `evaluate`."""
    defaults = DEFAULT_AGGREGATES[table]
    return {col: Measure(col, defaults[col], c.PLAIN) for col in columns or defaults}


def with_formats(df: DataFrame, measures: Sequence[str], suffix: str = " Text") -> DataFrame:
    """Add report text next to each measure."""
    return df.withColumns(
        {f"{m}{suffix}": c.formatted(df[f"`{m}`"], MEASURES[m].style) for m in measures}
    )
