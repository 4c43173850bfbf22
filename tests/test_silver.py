import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriema.plans import silver
from tests import fixtures as fx
from tests.conftest import near

RUN = dt.datetime(2024, 1, 2, 3, 4, 5)


def column(df, name):
    return [r[name] for r in df.orderBy("date").collect()]


def test_ipca(spark):
    out = silver.ipca(fx.bronze(spark, "ipca", fx.IPCA), run_ts=RUN)
    assert out.count() == 12 and "year" not in out.columns
    assert column(out, "value") == fx.IPCA
    near(column(out, "monthly_change_pct")[:2], [None, (0.5 / 1.25 - 1) * 100])
    assert column(out, "year_over_year_pct") == [None] * 12
    near(column(out, "moving_avg_3m")[:3], [None, None, (1.25 + 0.5 + 2.0) / 3])
    near(column(out, "year_to_date_pct")[:2], [0.0, (0.5 / 1.25 - 1) * 100])
    row = out.first()
    assert (row["unit"], row["frequency"], row["source"], row["processed_at"]) == ("%", "monthly", "bcb", RUN)


def test_ipca_rounded_keeps_what_is_there(spark):
    landed = fx.bronze(spark, "ipca15", fx.IPCA).withColumn("unit", F.lit("p.p."))
    out = silver.TRANSFORMS["ipca15"](landed, style=silver.ROUNDED)
    near(column(out, "monthly_change_pct")[:2], [None, -60.0])
    near(column(out, "moving_avg_3m")[:3], [1.25, 0.88, 1.25])
    near(column(out, "ytd_accumulated")[:3], [1.25, 1.75, 3.75])
    row = out.first()
    assert row["unit"] == "p.p." and row["year"] == 2023 and "IPCA-15" in row["indicator_name"]


def test_selic_daily_to_monthly(spark):
    days = [(dt.date(2023, 1, 1) + dt.timedelta(d), 20.0 if d < 30 else 18.5) for d in range(60)]
    df = spark.createDataFrame(days + [(None, 99.0)], "data date, selic double")
    out = silver.selic(df, run_ts=RUN)
    assert column(out, "date") == [dt.date(2023, 1, 31), dt.date(2023, 2, 28), dt.date(2023, 3, 1)]
    january = (30 * 20.0 + 18.5) / 31
    near(column(out, "value"), [january, 18.5, 18.5])
    near(column(out, "change_bps"), [None, (18.5 - january) * 100, 0.0])
    near(column(out, "moving_avg_3m"), [None, None, (january + 37.0) / 3])
    assert column(out, "real_interest_rate") == [0.0] * 3
    near(column(silver.selic(df, style=silver.ROUNDED), "change_bps"), [None, -145.0, 0.0])


def test_pib(spark):
    out = silver.pib(fx.bronze(spark, "pib", fx.PIB, 3), run_ts=RUN)
    near(column(out, "quarterly_change_pct"), [None, 25.0, -36.0, 37.5])
    near(column(out, "accumulated_value"), [None, None, None, 41.5])
    assert column(out, "annual_change_pct") == [None] * 4


def test_cambio(spark):
    days = [("2023-01-02", "5,20"), ("2023-01-31", "5,10"), ("2023-01-15", "5,40"), ("2023-02-01", "5,00")]
    df = spark.createDataFrame([(d, float(v.replace(",", "."))) for d, v in days], "data string, cambio double")
    out = silver.cambio(df, run_ts=RUN)
    january, february = out.orderBy("date").collect()
    assert (january.open, january.close, january.high, january.low, january.value) == (5.2, 5.1, 5.4, 5.1, 5.1)
    near([january.avg, january.volatility, january.monthly_amplitude_pct], [15.7 / 3, 0.1527525231651946, 100 / 17])
    assert february.volatility == 0.0 and february.ma_cross_signal == -1
    near([february.return_pct, february.ma_3m], [(5.0 / 5.1 - 1) * 100, 5.05])
    other = silver.cambio(df, style=silver.ROUNDED).orderBy("date").collect()[1]
    assert other.volatility is None and other.monthly_change_pct == -1.96


def test_desemprego_has_both_changes(spark):
    out = silver.desemprego(fx.bronze(spark, "desemprego", fx.UNEMPLOYMENT + [8.0], 2), run_ts=RUN)
    near(column(out, "quarterly_change_pp")[:2], [None, 1.5])
    near(column(out, "annual_change_pp"), [None] * 4 + [2.0])
    near(column(out, "moving_avg_3q")[2:3], [18.5 / 3])
    pnad = silver.TRANSFORMS["pnad"](fx.bronze(spark, "pnad", fx.UNEMPLOYMENT, 3), style=silver.ROUNDED)
    assert column(pnad, "year_quarter") == ["2023Q1", "2023Q2", "2023Q3", "2023Q4"]


def test_places_are_series_of_their_own(spark):
    one = fx.bronze(spark, "ipca", fx.IPCA)
    both = one.withColumn("localidade", F.lit("A")).unionByName(
        one.withColumn("localidade", F.lit("B")).withColumn("ipca", F.col("ipca") * 2))
    out = silver.ipca(both, keys=("localidade",))
    firsts = out.filter(F.month("date") == 1).collect()
    assert {r.localidade: r.monthly_change_pct for r in firsts} == {"A": None, "B": None}
    assert out.count() == 24


@pytest.mark.parametrize("style", [silver.STANDARD, silver.ROUNDED])
def test_long_series_take_the_chunked_way(spark, style):
    df = fx.bronze(spark, "ipca", fx.IPCA)
    a = silver.ipca(df, style=style)
    b = silver.ipca(df, style=style, grain=None)
    for name in ("monthly_change_pct", "moving_avg_3m"):
        near(column(b, name), column(a, name))
