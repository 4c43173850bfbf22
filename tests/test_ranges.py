"""Measures of a range must equal those of the whole series."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seriema.catalogue import QUERIES
from seriema.model import Series
from seriema.operators import windows as w
from seriema.operators.aggregates import period_mean
from seriema.operators.calendar import resample
from seriema.operators.ranges import measure_between, period_of
from seriema.operators.spread import Measure, measure
from tests.conftest import near, rows

D = dt.date
RAW = Series(keys=("k",), tie=("t",))
MONTHLY = Series(keys=("k",), grain="M")
MEASURES = (w.percent_change(1, "p1"), w.percent_change(3, "p3", fill=None), w.moving_average(4), w.shift(2, "s2"))


def observations(spark):
    """A full series, one with long gaps, one without values for a year, one that ends early, one that begins late."""
    rng, out = random.Random(3), []
    months = [(y, m) for y in range(2015, 2024) for m in range(1, 13)]
    for i, (y, m) in enumerate(months):
        for k in ("full", "gappy", "blank", "ended", "new"):
            if k == "gappy" and i % 17 > 2 or k == "ended" and y > 2019 or k == "new" and y < 2023:
                continue
            for t in range(2):
                value = None if k == "blank" and y in (2020, 2021) else float(rng.randint(1, 50))
                out.append((k, D(y, m, rng.randint(1, 28)), t, value))
    return spark.createDataFrame(out, "k string, date date, t int, value double").repartition(3)


REDUCE = {
    "means": lambda df: period_mean(df, RAW, "M").drop("year_month"),
    "resampled": lambda df: resample(df, RAW, "M", "mean"),
}


@pytest.mark.parametrize("how", REDUCE)
@pytest.mark.parametrize("start,end", [(D(2022, 11, 1), None), (D(2021, 5, 10), D(2021, 8, 20)), (D(2016, 1, 1), D(2016, 1, 31)), (D(2010, 1, 1), None), (D(2030, 1, 1), None)])
def test_a_range_equals_the_whole_series(spark, how, start, end):
    df = observations(spark)
    whole = measure(REDUCE[how](df), MONTHLY, *MEASURES).where((F.col("date") >= F.lit(start)) & (F.col("date") <= F.lit(end or D(2099, 1, 1))))
    got = measure_between(df, MONTHLY, *MEASURES, start=start, end=end, reduce=REDUCE[how])
    want, have = rows(whole.select("k", "date", "value", "p1", "p3", "moving_avg_4", "s2"), "k", "date"), rows(
        got.select("k", "date", "value", "p1", "p3", "moving_avg_4", "s2"), "k", "date")
    assert [r[:2] for r in want] == [r[:2] for r in have]
    for a, b in zip(want, have):
        near(b[2:], a[2:])


def test_without_keys_and_by_other_grains(spark):
    df = observations(spark).where("k = 'full'")
    for grain in ("W", "Q", "Y"):
        reduce = lambda rows, g=grain: resample(rows, Series(tie=("t",)), g, "mean")
        series = Series(grain=grain)
        whole = measure(reduce(df), series, w.shift(2, "s")).where("date >= '2022-06-01'")
        got = measure_between(df, series, w.shift(2, "s"), start=D(2022, 6, 1), reduce=reduce)
        assert rows(whole.select("date", "value", "s"), "date") == rows(got.select("date", "value", "s"), "date")


def test_the_bound_reaches_the_scan(spark, tmp_path):
    observations(spark).where("k = 'full'").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    out = measure_between(df, MONTHLY, w.percent_change(12, "p", fill=None), start=D(2023, 6, 1), reduce=REDUCE["means"])
    scan = out._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1][:200]
    assert "GreaterThanOrEqual(date,2022-06-01)" in scan


def test_the_registered_query_reads_its_months_only(spark):
    text = QUERIES["g04_last_year_only"](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "1999-09-01" in text.split("PushedFilters")[1][:200]


def test_running_totals_are_refused(spark):
    with pytest.raises(ValueError):
        measure_between(observations(spark), MONTHLY, Measure("c", lambda f: f.running_sum(), carries=True), start=D(2023, 1, 1))
    with pytest.raises(ValueError):
        measure_between(observations(spark), RAW, w.shift(1), start=D(2023, 1, 1))


def test_periods():
    assert [period_of(D(2024, 2, 29), g, -1) for g in "DWMQY"] == [D(2024, 2, 28), D(2024, 2, 19), D(2024, 1, 1), D(2023, 10, 1), D(2023, 1, 1)]
