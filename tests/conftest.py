import uuid

import pytest
from pyspark.sql import functions as F

from cityflow import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.build(
        "cityflow-tests",
        master="local[4]",
        shuffle_partitions=4,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def database(spark):
    """An empty database, current for the length of one test."""
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    spark.sql(f"USE {name}")
    yield name
    spark.sql("USE default")


@pytest.fixture
def one(spark):
    """Evaluate a column expression once."""

    def run(column):
        return spark.range(1).select(column.alias("x")).first().x

    return run


@pytest.fixture
def frame(spark):
    """A frame from tuples; columns written as timestamps are given as text."""

    def make(rows, schema):
        kinds = [part.rsplit(" ", 1) for part in schema.split(", ")]
        text = ", ".join(f"{n} {'string' if k == 'timestamp' else k}" for n, k in kinds)
        df = spark.createDataFrame(rows, text)
        stamps = {n: F.col(n).cast("timestamp") for n, k in kinds if k == "timestamp"}
        return df.withColumns(stamps) if stamps else df

    return make


def tuples(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
