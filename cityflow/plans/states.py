"""Measures from stored states: additive parts of the trip fact by date and borough.

The parts of one date and borough, sums and counts, merge by addition into those of any
slice, so reports read these few rows and never the fact. They are stored by month, since
a date has only a handful of them, and only months that new loads of trips have touched are
computed again, from the dates of the fact in them.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cityflow.plans import gold, model, silver
from cityflow.sources import loads, tables

STATES = "FactTaxiStates"
APPLIED = "gold_applied_state_loads"
GRAIN = ("PickupDateKey", "PUBoroughID")
MONTH = "month"


def month_of(date_key: Column) -> Column:
    """YYYYMM of a date key, 0 for none."""
    return F.coalesce(F.floor(date_key / 100).cast("int"), F.lit(loads.NO_PART))


def states_of(fact: DataFrame, measures: Mapping[str, model.Measure] = model.MEASURES) -> DataFrame:
    """One row per date and borough with every part that the measures are made of."""
    return fact.groupBy(*GRAIN).agg(*model.partials(measures.values()))


def columns(fact: DataFrame) -> dict[str, str]:
    """The columns of the table of states of a fact, the month as its partition."""
    kinds = {f.name: f.dataType.simpleString() for f in states_of(fact).schema.fields}
    return {**kinds, MONTH: "int"}


def load_states(
    spark: SparkSession,
    fact: str = gold.FACT_TAXI,
    states: str = STATES,
    ledger: str = silver.LOADS,
    source: str = silver.TRIPS,
    done: str = APPLIED,
) -> None:
    """Renew the states of the months that loads have touched since the last run; run it
    after `gold.load_fact_taxi`. Other months of the fact are not read. A failure before the
    loads are marked makes the next run write the same states again."""
    month = month_of(F.col(GRAIN[0]))
    rows = tables.scan(spark, fact)
    tables.create_if_missing(spark, states, columns(rows), [MONTH])
    records = loads.pending(spark, ledger, source, done)
    if records:
        months = sorted({part // 100 for part in loads.parts_of(records)})
        fresh = states_of(rows.where(month.isin(months))).withColumn(MONTH, month)
        tables.replace_partitions(fresh, states, [MONTH])
        loads.mark_done(spark, records, done)


def star(spark: SparkSession, dims: Mapping[str, DataFrame], states: str = STATES) -> model.Star:
    """A star whose fact are the stored states, for `model.evaluate`: slices and filters may
    name boroughs and dates."""
    return model.Star(gold.FACT_TAXI, tables.scan(spark, states), dims, stored=True)
