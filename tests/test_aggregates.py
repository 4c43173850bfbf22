import datetime as dt
import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seriema.model import Series
from seriema.operators import aggregates
from seriema.operators import aggregates as a
from seriema.operators import joins as j
from tests.conftest import near, rows

D = dt.date


def test_ohlc(spark):
    data = [(D(2023, 1, 3), 1, 5.0), (D(2023, 1, 2), 2, 7.0), (D(2023, 1, 3), 0, 6.0),
            (D(2023, 2, 1), 3, 4.0), (None, 4, 100.0)]
    df = spark.createDataFrame(data, "date date, t int, value double")
    out = rows(a.period_ohlc(df, Series(tie=("t",))), "year_month")
    january, february = out
    assert january[:6] == ("2023-01", D(2023, 1, 3), 7.0, 5.0, 7.0, 5.0)
    near(january[6:], [6.0, 1.0])
    assert february == ("2023-02", D(2023, 2, 1), 4.0, 4.0, 4.0, 4.0, 4.0, 0.0)
    assert rows(a.period_ohlc(df, Series(tie=("t",)), lone_volatility=None), "year_month")[1][7] is None


def test_period_mean(spark):
    df = spark.createDataFrame(
        [("a", D(2023, 1, 1), 1.0), ("a", D(2023, 1, 9), 4.0), ("b", D(2023, 4, 1), None), ("b", None, 3.0)],
        "k string, date date, value double")
    s = Series(keys=("k",))
    assert rows(a.period_mean(df, s), "k") == [
        ("a", "2023-01", D(2023, 1, 9), 2.5), ("b", "2023-04", D(2023, 4, 1), None)]
    assert [r[1] for r in rows(a.period_mean(df, s, "Q"), "k")] == ["2023Q1", "2023Q2"]
    assert [r[1] for r in rows(a.period_mean(df, s, "Y"), "k")] == [2023, 2023]


def test_describe_and_stats(spark):
    df = spark.createDataFrame([(1.0, 1, "x"), (2.0, 2, "x"), (4.0, None, "y"), (float("nan"), 4, "y")],
                               "v double, n int, s string")
    out = {r["column"]: r for r in a.describe(df, chunks=2).collect()}
    assert set(out) == {"v", "n"}
    assert (out["v"]["count"], out["v"]["min"], out["v"]["max"], out["v"]["q50"]) == (3, 1.0, 4.0, 2.0)
    near([out["v"]["q25"], out["v"]["q75"], out["v"]["std"]], [1.5, 3.0, math.sqrt(7 / 3)])
    one = a.series_stats(df.filter("v = 1"), [], "v").first()
    assert one["std"] is None and one["mean"] == 1.0


def test_run_summary(spark):
    report = spark.createDataFrame([(True,), (True,), (False,)], "success boolean")
    near(a.run_summary(report).first(), [2, 1, 200 / 3])
    assert a.run_summary(report.filter("false")).first()["success_rate"] is None


def test_full_outer_meets_on_missing_keys(spark):
    left = spark.createDataFrame([("2023-01", 1, D(2023, 1, 1)), (None, 2, None)], "ym string, l int, date date")
    right = spark.createDataFrame([("2023-02", 3, D(2023, 2, 1)), (None, 4, None)], "ym string, r int, date date")
    found = lambda **how: sorted(
        rows(j.full_outer(left, right, "ym", **how).select("ym", "l", "r", "date")), key=repr)
    known = [("2023-01", 1, None, D(2023, 1, 1)), ("2023-02", None, 3, None)]
    assert found() == sorted([*known, (None, 2, None, None), (None, None, 4, None)], key=repr)
    assert found(pair_missing=True) == sorted([*known, (None, 2, 4, None)], key=repr)


def test_left_by_quarter(spark):
    left = spark.createDataFrame([("a", D(2023, 1, 1), 8.8), ("a", D(2023, 4, 1), 8.3), ("a", None, 1.0)],
                                 "k string, date date, rate double")
    right = spark.createDataFrame([("a", D(2023, 1, 1), 1.0), ("a", D(2023, 3, 1), 3.0), ("b", D(2023, 4, 1), 5.0)],
                                  "k string, date date, gdp double")
    last = rows(j.left_by_quarter(left, right, ["k"]).select("rate", "gdp"), "rate")
    assert last == [(1.0, None), (8.3, None), (8.8, 3.0)]
    every = rows(j.left_by_quarter(left, right, ["k"], "all").select("rate", "gdp"), "rate", "gdp")
    assert every == [(1.0, None), (8.3, None), (8.8, 1.0), (8.8, 3.0)]
    plain = j.left_by_quarter(left.drop("k"), right.drop("k")).select("rate", "gdp")
    assert rows(plain, "rate") == [(1.0, None), (8.3, 5.0), (8.8, 3.0)]


# ---- quantiles by brackets -------------------------------------------------------------------


@pytest.mark.parametrize("n,shape", [(1, "even"), (7, "even"), (5_000, "even"), (60_000, "even"), (60_000, "ties"), (60_000, "nan"), (3_000, "equal")])
def test_bracketed_quantiles_are_exact(spark, n, shape):
    rng = np.random.default_rng(n)
    values = {"even": rng.normal(size=n), "ties": rng.integers(0, 4, n).astype(float), "equal": np.full(n, 2.5),
              "nan": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n))}[shape]
    df = spark.createDataFrame(pa.table({"a": values, "b": pa.array([None] * n, pa.float64())})).repartition(5)
    probabilities = (0.0, 0.001, 0.25, 0.5, 0.75, 0.9999, 1.0)
    got = {(r[0], r[1]): r[2] for r in a.exact_quantiles(df, ["a", "b"], probabilities).collect()}
    good = values[~np.isnan(values)]
    assert got == {("a", p): pytest.approx(np.quantile(good, p), abs=1e-12) for p in probabilities}


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    values = np.random.default_rng(5).permutation(20_000).astype(float)
    df = spark.createDataFrame(pa.table({"a": values}))
    tried, brackets = [], aggregates._brackets
    inside = aggregates._inside
    # As if the sketch had been wrong about the narrow brackets of one quantile.
    monkeypatch.setattr(aggregates, "_brackets", lambda *args: [
        replace(b, width=0, edges=((-2.0, -1.0), (-2.0, 5.0), *b.edges[2:])) if b.probability == 0.1 else b for b in brackets(*args)])
    monkeypatch.setattr(aggregates, "_inside", lambda df, wanted: tried.append(len(wanted)) or inside(df, wanted))
    got = {r[1]: r[2] for r in a.exact_quantiles(df, ["a"], (0.1, 0.5)).collect()}
    assert got == {p: pytest.approx(np.quantile(values, p)) for p in (0.1, 0.5)} and tried[:3] == [2, 1, 1]


def test_few_cells_are_kept(spark):
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("_0"), F.rand(1).alias("_1"))
    found = df.agg(*aggregates._sketches(["a", "b"], (0.5,))).first()
    counts, kept = aggregates._inside(df, aggregates._brackets(found, ["a", "b"], (0.5,)))
    assert kept.count() == sum(n["inside"] for n in counts) < 0.003 * 2 * 200_000
    # Values that repeat are counted, not kept.
    df = df.select((F.col("_0") % 2).alias("_0"), F.lit(1.0).alias("_1"))
    found = df.agg(*aggregates._sketches(["a", "b"], (0.5,))).first()
    assert aggregates._inside(df, aggregates._brackets(found, ["a", "b"], (0.5,)))[1].isEmpty()
