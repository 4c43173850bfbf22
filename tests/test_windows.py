import datetime as dt
import math

import pytest

from seriema.model import Series
from seriema.operators import windows as w
from seriema.operators.spread import measure
from tests.conftest import near, rows

RATES = [4.0, 5.0, 2.5, 3.0, 6.0, -1.0, 0.5, 1.5, 2.0, 8.0, 7.0, 9.0]
M = Series(grain="M")


def frame(spark, values, start=dt.date(2022, 12, 1)):
    def month(i):
        return dt.date(start.year + (start.month - 1 + i) // 12, (start.month - 1 + i) % 12 + 1, 1)

    return spark.createDataFrame([(month(i), v) for i, v in enumerate(values)],
                                 "date date, value double")


def column(df, name, order="date"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_percent_change_over_gaps_and_zero(spark):
    df = frame(spark, [None, 2.0, None, 3.0, 0.0, 5.0, None])
    out = measure(df, M, w.percent_change(1, "pad"), w.percent_change(1, "raw", fill=None),
                  w.percent_change(2, "two", 100))
    near(column(out, "pad"), [None, None, 0.0, 0.5, -1.0, None, 0.0])
    near(column(out, "raw"), [None, None, None, None, -1.0, None, None])
    near(column(out, "two"), [None, None, None, 50.0, -100.0, 66.66666666667, None])


def test_variations_default_and_repeated_kinds(spark):
    df = frame(spark, RATES + [5.5])
    out = w.variations(df, M)
    assert column(out, "year_over_year_pct")[:12] == [None] * 12
    near(column(out, "year_over_year_pct")[12:], [(5.5 / 4.0 - 1) * 100])
    near(column(out, "monthly_change_pct")[:2], [None, (5.0 / 4.0 - 1) * 100])
    both = w.variations(df, M, [("diff", 1, None, 1), ("diff", 4, "a", 100)])
    near(column(both, "diff_1")[:3], [None, 1.0, -2.5])
    near(column(both, "a")[3:5], [None, (6.0 - 4.0) * 100])
    assert w.variations(df, M.but(value="nope")) is df
    with pytest.raises(ValueError):
        w.percent_change(fill="zero")


def test_moving_statistics_wait_for_full_windows(spark):
    df = frame(spark, [1.0, 2.0, None, 4.0, 5.0, 6.0])
    out = measure(df, M, w.moving_average(3), w.moving_average(3, "part", min_periods=1),
                  w.moving_sum(2, "s"), w.moving_std(2, "sd"))
    near(column(out, "moving_avg_3"), [None] * 5 + [5.0])
    near(column(out, "part"), [1.0, 1.5, 1.5, 3.0, 4.5, 5.0])
    near(column(out, "s"), [None, 3.0, None, None, 9.0, 11.0])
    near(column(out, "sd"), [None, math.sqrt(0.5), None, None, math.sqrt(0.5), math.sqrt(0.5)])


def test_cumulative_keeps_gaps(spark):
    df = frame(spark, [1.0, None, 3.0, 4.0], dt.date(2022, 11, 1))
    assert column(w.cumulative(df, M), "cumulative_value") == [1.0, None, 4.0, 8.0]
    df = df.selectExpr("*", "year(date) as year")
    assert column(w.cumulative(df, M, ("year",)), "cumulative_value") == [1.0, None, 3.0, 7.0]


@pytest.mark.parametrize("series", [M, Series()])
def test_year_to_date(spark, series):
    df = frame(spark, [5.0, 2.0, 3.0, None])
    out = w.year_to_date_percent(df, series)
    near(column(out, "year_to_date_pct"), [0.0, 0.0, 50.0, None])
    df = frame(spark, [5.0, None, 3.0, 0.0])
    assert column(w.year_to_date_percent(df, series), "year_to_date_pct") == [0.0, None, None, None]
    assert column(w.year_to_date_sum(df, series, chunks=3), "ytd_accumulated") == [5.0, None, 3.0, 3.0]


def test_volatility_dispatch(spark):
    data = [("a", "x", dt.date(2023, 1, d), float(d)) for d in (1, 2, 3)] + [
        ("a", None, dt.date(2023, 1, 4), 9.0), ("b", "x", dt.date(2023, 1, 1), 1.0)]
    df = spark.createDataFrame(data, "k string, g string, date date, value double")
    s = Series(keys=("k",), grain="D")
    by_group = {(r.k, r.date.day): r.volatility for r in w.volatility(df, s, group=("g",)).collect()}
    near([by_group["a", 1], by_group["a", 4], by_group["b", 1]], [1.0, None, None])
    rolling = column(w.volatility(df.filter("k = 'a'"), s, group=("absent",), window=2), "volatility")
    near(rolling, [None, math.sqrt(0.5), math.sqrt(0.5), math.sqrt(18)])
    overall = {r.k: r.volatility for r in w.volatility(df, s).collect()}
    near([overall["a"], overall["b"]], [3.593976442141304, None])
    assert w.volatility(df.drop("k", "g"), Series(grain="D")).count() == 5


def test_financial_metrics(spark):
    df = frame(spark, [float(i + 1) for i in range(60)]).selectExpr(
        "date", "value as close", "value + 1 as high", "value as low")
    out = w.financial_metrics(df, M.but(value="close"))
    assert column(out, "ma_cross_signal") == [-1] * 49 + [1] * 11
    near(column(out, "ma_20")[18:20], [None, 10.5])
    near(column(out, "amplitude_pct")[:2], [100.0, 50.0])
    near(column(out, "return_pct")[:2], [None, 100.0])
    bare = w.financial_metrics(df.select("date", "close"), M.but(value="close"))
    assert "amplitude_pct" not in bare.columns


@pytest.mark.parametrize("chunks", [None, 3])
def test_equal_averages_do_not_cross(spark, chunks):
    """Sums of 20 and of 50 rows round differently; that is no crossing, a last digit of one row is."""
    flat = {"a": 147.09, "b": 11.29, "c": -0.07, "d": 1e9 + 0.1, "e": 3e-7, "f": 42.59}
    data = [(k, dt.date(2023, 1, 1) + dt.timedelta(i), v) for k, v in flat.items() for i in range(90)]
    data += [(f"up {k}", date, v + (abs(v) * 1e-10 if date.month == 3 else 0)) for k, date, v in data]
    df = spark.createDataFrame(data, "k string, date date, close double")
    out = w.financial_metrics(df, Series(keys=("k",), value="close", grain=None if chunks else "D"), chunks=chunks)
    assert "_size" not in out.columns
    raised = {r.k for r in out.where("ma_cross_signal = 1").select("k").distinct().collect()}
    assert raised == {f"up {k}" for k in flat}
    first = out.where("ma_cross_signal = 1").agg({"date": "min"}).first()[0]
    assert first == dt.date(2023, 3, 1)


def test_latest_trend_and_change(spark):
    data = [("up", dt.date(2023, 1, d), float(d)) for d in range(1, 15)]
    data += [("short", dt.date(2023, 1, 1), 1.0), ("short", dt.date(2023, 1, 2), 2.0)]
    data += [("gap", dt.date(2023, 1, d), None if d == 3 else 1.0) for d in (1, 2, 3)]
    df = spark.createDataFrame(data, "k string, date date, value double")
    s = Series(keys=("k",))
    assert dict(rows(w.trend(df, s))) == {"up": "rising", "short": None, "gap": "stable"}
    near([dict(rows(w.change_since(df, s)))[k] for k in ("up", "short")], [600.0, None])
    assert {r.k: r.value for r in w.latest_row(df, s).collect()} == {"up": 14.0, "short": 2.0, "gap": None}


def test_min_max_scale(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 7.0), ("b", 7.0)],
                               "k string, v double")
    got = sorted(rows(w.min_max_scale(df, "v", ["k"], "s")), key=repr)
    assert got == [("a", 1.0, 0.0), ("a", 3.0, 100.0), ("a", None, None), ("b", 7.0, 7.0), ("b", 7.0, 7.0)]
    near([r[0] for r in rows(w.min_max_scale(df.select("v"), "v"), F_asc())],
         [None, 0.0, 100 / 3, 100.0, 100.0])


def F_asc():
    from pyspark.sql import functions as F
    return F.col("v").asc_nulls_first()
