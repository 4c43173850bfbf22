import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from seriema.functions import date_to_period, period_end, period_to_date
from seriema.model import Series
from seriema.operators import calendar as cal
from tests.conftest import rows

D = dt.date
S = Series(keys=("k",))


def series(spark, *pairs, key="a"):
    return spark.createDataFrame([(key, d, v) for d, v in pairs], "k string, date date, value double")


def test_named_windows(spark):
    df = spark.createDataFrame([(D(2023, 1, 1),), (D(2023, 2, 1),), (D(2023, 3, 1),), (None,)], "date date")
    windows = [(D(2023, 1, 1), D(2023, 2, 1), "a"), (D(2023, 2, 1), D(2023, 2, 1), "b")]
    got = {r.date: r.time_window for r in cal.named_windows(df, windows).collect()}
    assert got == {D(2023, 1, 1): "a", D(2023, 2, 1): "b", D(2023, 3, 1): "other", None: "other"}
    assert cal.named_windows(df, []) is df


@pytest.mark.parametrize("freq,end", [
    ("D", D(2024, 2, 14)), ("W", D(2024, 2, 18)), ("M", D(2024, 2, 29)), ("Q", D(2024, 3, 31)),
    ("Y", D(2024, 12, 31)),
])
def test_period_ends(spark, freq, end):
    date = F.lit(D(2024, 2, 14))  # a Wednesday
    assert spark.range(1).select(period_end(date, freq)).first()[0] == end


def test_empty_periods(spark):
    df = series(spark, (D(2023, 1, 5), 1.0), (D(2023, 1, 9), 3.0), (D(2023, 4, 30), 5.0), (None, 9.0))
    mean = rows(cal.resample(df, S, "M", "mean"), "date")
    assert mean == [("a", D(2023, 1, 31), 2.0), ("a", D(2023, 2, 28), None),
                    ("a", D(2023, 3, 31), None), ("a", D(2023, 4, 30), 5.0)]
    total = rows(cal.resample(df, S, "M", "sum"), "date")
    assert [r[2] for r in total] == [4.0, 0.0, 0.0, 5.0]
    assert rows(cal.resample(df, S, "M", "whatever"), "date") == mean
    assert [r[1:] for r in rows(cal.resample(df, S, "Y", "last"), "date")] == [(D(2023, 12, 31), 5.0)]


def test_weeks_and_days(spark):
    df = series(spark, (D(2023, 1, 1), 1.0), (D(2023, 1, 2), 2.0), (D(2023, 1, 16), 4.0))
    weeks = rows(cal.resample(df, S, "W", "sum"), "date")
    assert [r[1:] for r in weeks] == [(D(2023, 1, 1), 1.0), (D(2023, 1, 8), 2.0),
                                      (D(2023, 1, 15), 0.0), (D(2023, 1, 22), 4.0)]
    assert cal.resample(df, S, "D", "max").count() == 16


def test_last_skips_missing_values_and_sum_of_nothing_is_zero(spark):
    df = series(spark, (D(2023, 1, 1), 1.0), (D(2023, 1, 2), None), (D(2023, 2, 1), None))
    assert [r[2] for r in rows(cal.resample(df, S, "M", "last"), "date")] == [1.0, None]
    assert [r[2] for r in rows(cal.resample(df, S, "M", "sum"), "date")] == [1.0, 0.0]


def test_each_series_has_its_own_spine(spark):
    df = series(spark, (D(2023, 1, 1), 1.0), (D(2023, 3, 1), 1.0)).union(
        series(spark, (D(2022, 7, 1), 1.0), (D(2022, 8, 1), 1.0), key="b"))
    assert cal.resample(df, S, "M").groupBy("k").count().orderBy("k").collect() == [("a", 3), ("b", 2)]
    assert cal.resample(df.drop("k"), Series(), "M").count() == 9


def test_period_texts(spark):
    cases = [("202301", "monthly", D(2023, 1, 1)), ("202313", "monthly", None),
             ("2023Q3", "quarterly", D(2023, 7, 1)), ("20233", "quarterly", D(2023, 7, 1)),
             ("202304", "quarterly", D(2023, 10, 1)), ("2023Q5", "quarterly", None),
             ("2023", "annual", D(2023, 1, 1)), ("20x3", "annual", None), (None, "annual", None)]
    df = spark.createDataFrame([(i, p, f) for i, (p, f, _) in enumerate(cases)], "i int, p string, f string")
    got = [r[1] for r in rows(df.select("i", period_to_date(F.col("p"), F.col("f"))), "i")]
    assert got == [c[2] for c in cases]
    day = F.lit(D(2023, 11, 5))
    texts = spark.range(1).select(*(date_to_period(day, f) for f in ("monthly", "quarterly", "annual")))
    assert tuple(texts.first()) == ("202311", "2023Q4", "2023")


def test_date_features(spark):
    df = spark.createDataFrame([(D(2023, 11, 5),), (None,)], "date date")
    got = {tuple(r) for r in cal.date_features(df).drop("date").collect()}
    assert got == {(2023, 11, 4, "2023-11", "2023Q4"), (None,) * 5}


def test_windows_from_a_table(spark):
    rng = random.Random(8)
    ranges = []
    for k in range(300):
        start = D(1950, 1, 1) + dt.timedelta(days=rng.randrange(0, 30_000))
        ranges.append((start, start + dt.timedelta(days=rng.choice([-1, 0, 1, 2, 7, 63, 64, 400, 9_000])), f"n{k}", rng.randrange(40)))
    ranges += [(None, D(2020, 1, 1), "open", 99), (D(2020, 1, 1), None, "open", 99), (D(1, 1, 1), D(1, 1, 3), "first", 1), (D(9999, 12, 30), D(9999, 12, 31), "last", 1)]
    days = [D(1950, 1, 1) + dt.timedelta(days=rng.randrange(0, 40_000)) for _ in range(2_000)] + [None, D(1, 1, 2), D(9999, 12, 31), D(1, 1, 4)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "i int, date date")
    out = cal.windows_from_table(df, spark.createDataFrame(ranges, "start date, end date, name string, priority int"))
    got = {r.i: r.time_window for r in out.collect()}

    def want(day):
        hits = [(p, n) for s, e, n, p in ranges if day and s and e and s <= day <= e]
        return max(hits)[1] if hits else "other"

    wrong = [(d, got[i], want(d)) for i, d in enumerate(days) if got[i] != want(d)]
    assert not wrong and len(got) == len(days) and len(set(got.values())) > 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
