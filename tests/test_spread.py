"""The chunked windows must equal one window over the whole series."""

import random

import pytest
from pyspark.sql import functions as F

from seriema.model import Series
from seriema.operators import windows as w
from seriema.operators.aggregates import describe, exact_quantiles
from seriema.operators.spread import CHUNK, cut, fitting_unit, measure, running_total
from seriema.session import workspace
from tests.conftest import near, rows


def observations(seed, n=160, keys=("hot", "warm", "tiny", None), gaps=0.3):
    """Two thirds of the rows belong to one series; long gaps and equal dates occur."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = keys[0] if rng.random() < 0.66 else rng.choice(keys)
        day = None if rng.random() < 0.03 else f"2023-{rng.randint(1, 6):02d}-{rng.randint(1, 9):02d}"
        value = None if rng.random() < gaps or 60 < i < 110 else float(rng.randint(0, 40))
        out.append((key, day, i, value, f"row {i}"))
    return out


def frame(spark, data):
    return spark.createDataFrame(
        data, "k string, d string, t long, value double, note string"
    ).select("k", F.col("d").cast("date").alias("date"), "t", "value", "note")


MEASURES = (
    w.percent_change(1, "p1"), w.percent_change(3, "p3", 100), w.percent_change(2, "raw", fill=None),
    w.difference(5, "d5"), w.shift(1, "s1"), w.moving_average(4, "ma4"),
    w.moving_average(7, "ma7", min_periods=1), w.moving_std(6, "sd6", min_periods=2),
    w.moving_sum(3, "sum3"),
)


@pytest.mark.parametrize("seed,chunks", [(1, 2), (2, 7), (4, 60)])
def test_chunked_measures_equal_whole_series(spark, seed, chunks):
    df = frame(spark, observations(seed))
    whole = Series(keys=("k",), tie=("t",), grain="D")
    # `grain` only selects the plain window here; it serves as the brute-force answer.
    expected = rows(measure(df, whole, *MEASURES), "t")
    got = rows(measure(df, whole.but(grain=None), *MEASURES, chunks=chunks), "t")
    assert len(expected) == len(got)
    for a, b in zip(expected, got):
        assert a[:5] == b[:5]
        near(b[5:], a[5:])


@pytest.mark.parametrize("chunks", [1, 30])
@pytest.mark.parametrize("keys", [("k",), ()])
@pytest.mark.parametrize("over_gaps", [False, True])
def test_running_total(spark, chunks, keys, over_gaps):
    df = frame(spark, observations(5))
    whole = Series(keys=keys, tie=("t",), grain="D")
    a = rows(running_total(df, whole, "c", over_gaps), "t")
    b = rows(running_total(df, whole.but(grain=None), "c", over_gaps, chunks), "t")
    assert [r[:5] for r in a] == [r[:5] for r in b]
    near([r[5] for r in b], [r[5] for r in a])


def test_all_null_series(spark):
    df = frame(spark, [("a", "2023-01-01", i, None, "") for i in range(30)])
    series = Series(keys=("k",), tie=("t",))
    out = measure(df, series, w.percent_change(1, "p"), w.moving_average(3, "m"), chunks=5)
    assert all(r.p is None and r.m is None for r in out.collect())
    total = running_total(df, series, "c", over_gaps=True, chunks=5)
    assert all(r.c is None for r in total.collect())


def test_year_to_date_without_grain(spark):
    df = frame(spark, observations(6))
    whole = Series(keys=("k",), tie=("t",), grain="D")
    a = rows(w.year_to_date_percent(df, whole), "t")
    b = rows(w.year_to_date_percent(df, whole.but(grain=None)).select(
        "k", "date", "t", "value", "note", "year", "year_to_date_pct"), "t")
    near([r[6] for r in b], [r[6] for r in a])
    a = rows(w.year_to_date_sum(df, whole), "t")
    b = rows(w.year_to_date_sum(df, whole.but(grain=None), chunks=9).select(
        "k", "date", "t", "value", "note", "year", "ytd_accumulated"), "t")
    near([r[6] for r in b], [r[6] for r in a])


def test_quantiles_match_brute_force(spark):
    rng = random.Random(7)
    values = [float(rng.choice([1, 1, 1, 1, 2, 3, 5, 8, 13])) for _ in range(101)]
    df = spark.createDataFrame([(v, None if i % 4 else v * 2) for i, v in enumerate(values)],
                               "a double, b double")
    got = {(r[0], r[1]): r[2] for r in
           exact_quantiles(df, ["a", "b"], (0.0, 0.25, 0.5, 0.9, 1.0), chunks=5).collect()}
    import numpy as np
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        assert abs(got["a", p] - np.quantile(values, p)) < 1e-12
        assert abs(got["b", p] - np.quantile([2 * v for v in values[::4]], p)) < 1e-12
    line = [r for r in describe(df, ["a"], chunks=3).collect()][0]
    assert line["count"] == 101 and line["q50"] == np.quantile(values, 0.5)


def test_chunks_have_similar_size_under_a_hot_key(spark):
    df = frame(spark, observations(9, n=4000))
    base = cut(df, Series(keys=("k",), tie=("t",)), 8)
    sizes = [r["count"] for r in base.groupBy(CHUNK).count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 2 * 4000 / 8
    hot = base.filter("k = 'hot'").select(CHUNK).distinct().count()
    assert hot >= 5  # two thirds of the rows


def test_hot_order_values_are_split_by_the_tie_breaker(spark):
    """A third of the rows without a date must not end up in one chunk."""
    data = [("a", None if i % 3 == 0 else f"2023-01-{i % 28 + 1:02d}", i, 1.0, "") for i in range(3000)]
    base = cut(frame(spark, data), Series(keys=("k",), tie=("t",)), 9)
    undated = base.filter("date is null").groupBy(CHUNK).count().collect()
    assert len(undated) >= 3


def test_value_keeps_its_type(spark):
    df = frame(spark, observations(10)).withColumn("value", F.col("value").cast("int"))
    series = Series(keys=("k",), tie=("t",))
    out = measure(df, series, w.percent_change(1, "p"), w.shift(1, "s"), chunks=3)
    assert dict(out.dtypes)["value"] == "int" and dict(out.dtypes)["s"] == "int"


def test_chunks_follow_the_rows(spark, monkeypatch):
    """Without a number of chunks there is one per so many rows, and the result is the same."""
    df = frame(spark, observations(11, n=600))
    whole = Series(keys=("k",), tie=("t",), grain="D")
    expected = rows(measure(df, whole, *MEASURES), "t")
    monkeypatch.setattr("seriema.operators.spread.ROWS_PER_CHUNK", 50)
    assert cut(df, whole).select(CHUNK).distinct().count() > 5
    got = rows(measure(df, whole.but(grain=None), *MEASURES), "t")
    for a, b in zip(expected, got, strict=True):
        assert a[:5] == b[:5]
        near(b[5:], a[5:])


def test_a_workspace_leaves_nothing(spark):
    df = frame(spark, observations(12, n=100))
    series = Series(keys=("k",), tie=("t",))
    with workspace(spark) as path:
        staged = cut(df, series, 3)
        assert path.split("/")[-1] in staged.inputFiles()[0]
        n = len(rows(measure(df, series, *MEASURES, chunks=3)))
    assert n == df.count()
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def test_rows_without_a_group_have_no_running_sum(spark):
    data = [("a", 1, 1.0), (None, 2, 2.0), ("a", 3, 3.0), (None, 4, 4.0)]
    df = spark.createDataFrame(data, "g string, t int, value double").withColumn("date", F.lit(None).cast("date"))
    for grain in (None, "D"):
        out = w.cumulative(df, Series(tie=("t",), grain=grain), ("g",))
        assert [r.cumulative_value for r in out.orderBy("t").collect()] == [1.0, None, 4.0, None]


# ---- calendar chunks -------------------------------------------------------------------------


@pytest.mark.parametrize("limit,unit", [(1000, "year"), (60, "month"), (16, "day"), (3, None)])
def test_calendar_chunks_equal_whole_series(spark, monkeypatch, limit, unit):
    df = frame(spark, observations(21, n=300))
    whole = Series(keys=("k",), tie=("t",), grain="D")
    monkeypatch.setattr("seriema.operators.spread.ROWS_PER_CHUNK", limit)
    assert fitting_unit(df, whole) == unit
    for measures in (MEASURES, (w.percent_change(1, "p1"), w.shift(1, "s")), (w.moving_average(50, "ma50", min_periods=1), w.percent_change(1, "p1"))):
        expected = rows(measure(df, whole, *measures), "t")
        got = rows(measure(df, whole.but(grain=None), *measures), "t")
        for a, b in zip(expected, got, strict=True):
            assert a[:5] == b[:5]
            near(b[5:], a[5:])
    for keys, over_gaps in (((), True), (("k",), False)):
        one = whole.but(keys=keys)
        a = rows(running_total(df, one, "c", over_gaps), "t")
        b = rows(running_total(df, one.but(grain=None), "c", over_gaps), "t")
        near([r[5] for r in b], [r[5] for r in a])


def test_wide_windows_in_constant_work(spark, monkeypatch):
    """Windows by blocks equal frames that are evaluated for each row, with gaps, halos and short series."""
    df = frame(spark, observations(31, n=400))
    measures = [f(n, f"{name}{n}_{m}", m) for n in (4, 7, 25) for m in (None, 1, 3)
                for name, f in (("avg", w.moving_average), ("sum", w.moving_sum), ("std", w.moving_std))]
    whole = Series(keys=("k",), tie=("t",), grain="D")
    expected = rows(measure(df, whole, *measures), "t")
    monkeypatch.setattr("seriema.operators.spread.WIDE", 2)
    monkeypatch.setattr("seriema.operators.spread.ROWS_PER_CHUNK", 60)
    for series in (whole, whole.but(grain=None)):
        got = measure(df, series, *measures)
        assert got.columns == df.columns + [m.column for m in measures]
        for a, b in zip(expected, rows(got, "t"), strict=True):
            assert a[:5] == b[:5]
            near(b[5:], a[5:], 7)


def test_instants_take_finer_units(spark, monkeypatch):
    df = spark.range(2000).select(
        F.lit("a").alias("k"), F.timestamp_seconds(F.col("id") * 7 + 1_700_000_000).alias("date"), F.col("id").cast("string").alias("t"),
        F.when(F.col("id") % 5 != 0, F.col("id") * 1.0).alias("value"))
    series = Series(keys=("k",), tie=("t",))
    monkeypatch.setattr("seriema.operators.spread.ROWS_PER_CHUNK", 600)
    assert fitting_unit(df, series) == "hour"
    a = rows(measure(df, series.but(grain="D"), *MEASURES[:5]), "date")
    b = rows(measure(df, series, *MEASURES[:5]), "date")
    for x, y in zip(a, b, strict=True):
        near(y[3:], x[3:])


def test_running_values_stage_nothing_and_move_rows_once(spark):
    df = frame(spark, observations(22, n=400)).withColumn("wide", F.repeat("note", 20))
    with workspace(spark) as path:
        out = running_total(df, Series(keys=("k",), tie=("t",)))
        text = out._jdf.queryExecution().executedPlan().toString()
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    assert "Join" not in text
    # Totals by chunk and by series, then the rows themselves.
    assert text.count("Exchange hashpartitioning") == 3
