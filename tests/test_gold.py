import datetime as dt

import pytest
from pyspark.sql import functions as F

from seriema.model import LABOR_SCHEMA, MACRO_SCHEMA, MONTHLY_SCHEMA
from seriema.plans import gold
from tests import fixtures as fx
from tests.conftest import near

RUN = dt.datetime(2024, 1, 2, 3, 4, 5)
TODAY = dt.date(2024, 1, 2)


@pytest.fixture
def frames(spark):
    return {
        "ipca": fx.silver(spark, "ipca", fx.IPCA, year_over_year_pct=fx.IPCA_YEAR),
        "selic": fx.silver(spark, "selic", fx.SELIC),
        "cambio": fx.silver(spark, "cambio", fx.CAMBIO, volatility=fx.CAMBIO_VOLATILITY),
        "desemprego": fx.silver(spark, "desemprego", fx.UNEMPLOYMENT, 3,
                                quarterly_change_pp=[-1.0, 1.5, -2.5, -1.0],
                                annual_change_pp=[0.5, 1.0, -2.0, -3.0]),
        "pib": fx.silver(spark, "pib", fx.PIB, 3, quarterly_change_pct=[2.0, 25.0, 0.0, 37.5]),
    }


def test_monthly_panel(spark, frames):
    out = gold.monthly_panel(frames, spark, RUN)
    assert out.schema.simpleString() == MONTHLY_SCHEMA.simpleString()
    got = out.collect()
    assert [r.year_month for r in got] == [f"2023-{m:02d}" for m in range(1, 13)]
    near([got[0].real_interest_rate], [20.0 - 1.25])
    raw = [0.4 * a + 0.3 * s + 0.3 * v
           for a, s, v in zip(fx.IPCA_YEAR, fx.SELIC, fx.CAMBIO_VOLATILITY)]
    want = [(x - min(raw)) / (max(raw) - min(raw)) * 100 for x in raw]
    near([r.economic_pressure_index for r in got], want)
    assert all(r.updated_at == RUN for r in got)


def test_monthly_panel_keeps_months_of_every_side(spark, frames):
    frames["selic"] = frames["selic"].filter("date >= '2023-06-01'")
    frames["ipca"] = frames["ipca"].filter("date <= '2023-02-01'")
    got = {r.year_month: r for r in gold.monthly_panel(frames, spark, RUN).collect()}
    assert len(got) == 12 and got["2023-07"].date is None and got["2023-07"].selic == 17.0
    assert got["2023-04"].selic is None and got["2023-04"].economic_pressure_index is None


def test_monthly_panel_needs_three_inputs(spark, frames):
    out = gold.monthly_panel({k: frames[k] for k in ("ipca", "selic")}, spark, RUN)
    assert out.schema.simpleString() == MONTHLY_SCHEMA.simpleString() and out.isEmpty()


def test_plain_index_without_input_columns(spark, frames):
    frames["cambio"] = frames["cambio"].drop("volatility")
    got = gold.monthly_panel(frames, spark, RUN).first()
    near([got.economic_pressure_index], [20.0 + 1.25])


def test_labor_market(spark, frames):
    out = gold.labor_market(frames, spark, RUN)
    assert out.schema.simpleString() == LABOR_SCHEMA.simpleString()
    got = out.orderBy("date").collect()
    second = -(1.5 / 6.0 * 100) / 25.0
    fourth = -(-1.0 / 5.0 * 100) / 37.5
    near([r.employment_gdp_elasticity for r in got], [None, second, None, fourth])
    near([r.employment_gdp_elasticity_ma for r in got], [None, second, second, (second + fourth) / 2])
    alone = gold.labor_market({"desemprego": frames["desemprego"]}, spark, RUN)
    assert [r.gdp for r in alone.collect()] == [None] * 4
    assert gold.labor_market({"pib": frames["pib"]}, spark, RUN).isEmpty()


def test_macro_dashboard(spark, frames):
    out = gold.macro_dashboard(frames, spark, TODAY, RUN)
    assert out.schema.simpleString() == MACRO_SCHEMA.simpleString()
    got = {r.indicator: r for r in out.collect()}
    assert set(got) == {*frames, "economic_health"}
    assert (got["ipca"].last_value, got["ipca"].last_date, got["ipca"].trend) == (
        3.0, dt.date(2023, 12, 1), "rising")
    assert got["selic"].trend == "falling" and got["selic"].annual_change is None
    assert got["ipca"].annual_change == 11.0 and got["desemprego"].annual_change == -3.0
    assert got["cambio"].annual_change is None  # twelve rows are one too few
    ratios = [fx.IPCA[-1] / (sum(fx.IPCA) / 12), 14.0 / (sum(fx.SELIC) / 12),
              4.0 / (sum(fx.UNEMPLOYMENT) / 4)]
    score = min(50 * (0.35 * ratios[0] + 0.30 * ratios[1] + 0.35 * ratios[2]), 100)
    health = got["economic_health"]
    assert health.last_value == round(score, 1) and health.last_date == TODAY
    assert health.situation == "crítica" and health.unit == "pontos" and health.trend is None
    assert got["ipca"].situation is None


def test_macro_dashboard_weights_are_renormalised(spark, frames):
    some = {k: frames[k] for k in ("selic", "desemprego", "pib")}
    got = {r.indicator: r for r in gold.macro_dashboard(some, spark, TODAY, RUN).collect()}
    score = 50 * (0.30 * 14.0 / (sum(fx.SELIC) / 12) + 0.35 * 4.0 / 5.625) / 0.65
    near([got["economic_health"].last_value], [round(score, 1)])
    assert got["economic_health"].situation == "boa"


def test_macro_dashboard_with_too_little(spark, frames):
    assert gold.macro_dashboard({"ipca": frames["ipca"]}, spark, TODAY, RUN).isEmpty()
    assert gold.macro_dashboard({}, spark, TODAY, RUN).isEmpty()
    pair = {k: frames[k] for k in ("pib", "ipca")}
    got = {r.indicator for r in gold.macro_dashboard(pair, spark, TODAY, RUN).collect()}
    assert got == {"pib", "ipca"}


def test_cambio_annual_change_over_thirteen_rows(spark, frames):
    values = [1.6] + fx.CAMBIO
    long = spark.createDataFrame(
        [(dt.date(2022 + (11 + i) // 12, (11 + i) % 12 + 1, 1), v) for i, v in enumerate(values)],
        "date date, value double")
    got = {r.indicator: r for r in gold.macro_dashboard(
        {"cambio": long, "ipca": frames["ipca"]}, spark, TODAY, RUN).collect()}
    near([got["cambio"].annual_change], [(4.0 / 1.6 - 1) * 100])
    assert got["cambio"].indicator_name == "CAMBIO" and got["cambio"].unit == "%"


def test_places_do_not_mix(spark, frames):
    from functools import reduce

    from pyspark.sql import functions as F

    places = ("Brasil", "Norte", "Sul")
    def spread(df):
        parts = [df.withColumns({"localidade": F.lit(p), "value": F.col("value") + 10 * k}) for k, p in enumerate(places)]
        return reduce(lambda a, b: a.unionByName(b), parts)

    many = {name: spread(df) for name, df in frames.items()}
    for make in (gold.monthly_panel, gold.labor_market):
        assert sorted(map(str, make(many, spark, RUN).collect())) == sorted(map(str, make(frames, spark, RUN).collect()))
        keyed = make(many, spark, RUN, keys=("localidade",))
        alone = make(frames, spark, RUN).count()
        assert keyed.groupBy("localidade").count().collect() and keyed.count() == 3 * alone
        norte = keyed.where("localidade = 'Norte'").drop("localidade")
        assert sorted(map(str, norte.collect())) == sorted(map(str, make(many, spark, RUN, place="Norte").collect()))
    lines = {r.indicator: r.last_value for r in gold.macro_dashboard(many, spark, TODAY, RUN).collect()}
    assert lines["ipca"] == fx.IPCA[-1]


def test_several_rows_of_a_month_are_one(spark, frames):
    doubled = {k: v.unionByName(v) for k, v in frames.items()}
    assert gold.monthly_panel(doubled, spark, RUN).count() == 12
    assert gold.labor_market(doubled, spark, RUN).count() == 4


def two_sources(spark, frames):
    """Each indicator also from another source, with ten times the values and three months more."""
    def both(name, df):
        moved = df.withColumns({c: F.col(c) * 10 for c in df.columns if dict(df.dtypes)[c] == "double"})
        later = moved.withColumn("date", F.add_months("date", 3))
        other = moved.unionByName(later.filter("date > '2023-12-31'"))
        return df.withColumn("source", F.lit("bcb")).unionByName(other.withColumn("source", F.lit("ibge")))

    return {name: both(name, df) for name, df in frames.items()}


def test_one_source_per_period(spark, frames):
    alone, both = frames, two_sources(spark, frames)
    columns = ["year_month", "ipca", "ipca_annual_change", "selic", "cambio", "cambio_volatility"]
    want = {r.year_month: tuple(r) for r in gold.monthly_panel(alone, spark, RUN).select(*columns).collect()}
    got = {r.year_month: tuple(r) for r in gold.monthly_panel(both, spark, RUN).select(*columns).collect()}
    assert len(got) == 15 and all(got[m] == want[m] for m in want)
    # An order of sources turns it round, and by key each has its own rows.
    other = {r.year_month: r.selic for r in gold.monthly_panel(both, spark, RUN, sources=("ibge",)).collect()}
    assert len(other) == 15 and all(other[m] == 10 * want[m][3] for m in want)
    keyed = gold.monthly_panel(both, spark, RUN, keys=("source",)).groupBy("source").count().collect()
    assert dict(map(tuple, keyed)) == {"bcb": 12, "ibge": 15}
    labor = gold.labor_market(both, spark, RUN).collect()
    assert [r.unemployment_rate for r in labor][:4] == [r.unemployment_rate for r in gold.labor_market(alone, spark, RUN).collect()]
    assert len(labor) == 5 and [r.gdp for r in labor][:4] == [r.gdp for r in gold.labor_market(alone, spark, RUN).collect()]


def test_macro_lines_of_one_source(spark, frames):
    both = two_sources(spark, frames)
    # Without the months that only the other source has, all lines are those of the registered one.
    same = {n: df.filter("date <= '2023-12-31'") for n, df in both.items()}
    want = sorted(map(tuple, gold.macro_dashboard(frames, spark, TODAY, RUN).collect()))
    assert sorted(map(tuple, gold.macro_dashboard(same, spark, TODAY, RUN).collect())) == want


def test_a_panel_computes_its_inputs_once(spark, frames):
    text = gold.monthly_panel(frames, spark, RUN)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 3
