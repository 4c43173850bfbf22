import datetime as dt

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("seriema-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def months():
    return [dt.date(2023, m, 1) for m in range(1, 13)]


def rows(df, *order):
    """Collected tuples in a fixed order."""
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def near(got, want, digits=9):
    assert len(got) == len(want), (got, want)
    for g, w in zip(got, want):
        if g is None or w is None:
            assert g is w, (got, want)
        else:
            assert abs(g - w) < 10 ** -digits * max(1.0, abs(w)), (got, want)
