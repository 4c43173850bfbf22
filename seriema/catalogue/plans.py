"""Silver and gold transforms and the two runs.

The orders play the indicators: monthly means (ipca), daily means (selic, cambio), quarterly sums
(pib) and quarterly means (desemprego) of one priority each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import period_mean
from ..operators.calendar import resample
from ..operators.joins import append
from ..operators.quality import CONTRACTS, EXPECTED_INDICATORS, check_contract
from ..operators.spread import measure
from ..operators.windows import difference, percent_change, year_to_date_percent
from ..plans import gold, pipeline, silver
from ..session import scratch_path
from ..sources import files, sinks
from .inputs import (
    AS_OF,
    MONTHLY,
    MONTHLY_SQL,
    OBSERVATIONS_SQL,
    RAW,
    RUN_TS,
    monthly,
    observations,
)
from .registry import query

# ---- silver transforms, one series per priority ----------------------------------------------


def _rounded(df, digits, *keep):
    return df.select(*keep, *(F.round(c, n).alias(c) for c, n in digits.items()))


_NAMES = ("indicator", "unit", "frequency")
_METADATA = "'{}' AS indicator, '{}' AS unit, '{}' AS frequency"

_BY_K = "PARTITION BY k ORDER BY date"
_IPCA = f"""
WITH {MONTHLY_SQL}
SELECT k, date, {_METADATA.format('ipca', '%', 'monthly')}, strftime(date, '%Y-%m') AS year_month,
       round((value / lag(value, 1) OVER w - 1) * 100, {{0}}) AS monthly_change_pct,
       round((value / lag(value, 12) OVER w - 1) * 100, {{0}}) AS year_over_year_pct,
       {{1}}
FROM monthly
WINDOW w AS ({_BY_K}), w3 AS ({_BY_K} ROWS 2 PRECEDING), y AS (PARTITION BY k, year(date) ORDER BY date)"""


@query("i01_ipca", _IPCA.format(6, """
       round(CASE WHEN count(value) OVER w3 = 3 THEN avg(value) OVER w3 END, 6) AS moving_avg_3m,
       round((value / first_value(value) OVER y - 1) * 100, 6) AS year_to_date_pct"""))
def ipca(spark, path):
    out = silver.ipca(monthly(spark, path), keys=("k",), run_ts=RUN_TS)
    digits = {"monthly_change_pct": 6, "year_over_year_pct": 6, "moving_avg_3m": 6,
              "year_to_date_pct": 6}
    return _rounded(out, digits, "k", "date", *_NAMES, "year_month")


@query("i01_ipca_rounded", _IPCA.format(2, """
       round(avg(value) OVER w3, 2) AS moving_avg_3m,
       round(sum(value) OVER y, 5) AS ytd_accumulated"""))
def ipca_rounded(spark, path):
    out = silver.ipca(monthly(spark, path), keys=("k",), style=silver.ROUNDED, run_ts=RUN_TS)
    return out.select(
        "k", "date", *_NAMES, "year_month", "monthly_change_pct", "year_over_year_pct",
        "moving_avg_3m", F.round("ytd_accumulated", 5).alias("ytd_accumulated"),
    )


@query("i01_ipca15_rounded", _IPCA.format(2, """
       round(avg(value) OVER w3, 2) AS moving_avg_3m""").replace("'ipca'", "'ipca15'"))
def ipca15_rounded(spark, path):
    landed = monthly(spark, path).select("k", F.col("date").alias("data"),
                                         F.col("value").alias("ipca15"))
    out = silver.TRANSFORMS["ipca15"](landed, keys=("k",), style=silver.ROUNDED, run_ts=RUN_TS)
    return out.select("k", "date", *_NAMES, "year_month", "monthly_change_pct",
                      "year_over_year_pct", "moving_avg_3m")


_SELIC = f"""
WITH {MONTHLY_SQL}
SELECT k, date, {_METADATA.format('selic', '%', 'monthly')}, round(value, 7) AS value,
       {{}}
FROM monthly WINDOW w AS ({_BY_K}), w3 AS ({_BY_K} ROWS 2 PRECEDING)"""


@query("i02_selic", _SELIC.format("""
       round((value - lag(value, 1) OVER w) * 100, 4) AS change_bps,
       round(CASE WHEN count(value) OVER w3 = 3 THEN avg(value) OVER w3 END, 6) AS moving_avg_3m,
       0.0::DOUBLE AS real_interest_rate"""))
def selic(spark, path):
    out = silver.selic(observations(spark, path).drop("t"), keys=("k",), run_ts=RUN_TS)
    digits = {"value": 7, "change_bps": 4, "moving_avg_3m": 6, "real_interest_rate": 1}
    return _rounded(out, digits, "k", "date", *_NAMES)


@query("i02_selic_rounded", _SELIC.format("""
       round((value - lag(value, 1) OVER w) * 100, 0) AS change_bps,
       round(avg(value) OVER w3, 2) AS moving_avg_3m"""))
def selic_rounded(spark, path):
    out = silver.selic(observations(spark, path).drop("t"), keys=("k",), style=silver.ROUNDED,
                       run_ts=RUN_TS)
    return out.select("k", "date", *_NAMES, F.round("value", 7).alias("value"), "change_bps",
                      "moving_avg_3m")


_QUARTERS_SQL = f"""{OBSERVATIONS_SQL},
quarters AS (SELECT k, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
             AS date, sum(value) AS total, avg(value) AS mean FROM obs GROUP BY 1, 2)"""


@query("i03_pib", f"""
WITH {_QUARTERS_SQL}
SELECT k, date, {_METADATA.format('pib', 'R$ milhões', 'quarterly')}, round(total, 2) AS value,
       round((total / lag(total, 1) OVER w - 1) * 100, 6) AS quarterly_change_pct,
       round((total / lag(total, 4) OVER w - 1) * 100, 6) AS annual_change_pct,
       round(CASE WHEN count(total) OVER w4 = 4 THEN sum(total) OVER w4 END, 2) AS accumulated_value
FROM quarters WINDOW w AS ({_BY_K}), w4 AS ({_BY_K} ROWS 3 PRECEDING)""")
def pib(spark, path):
    quarters = resample(observations(spark, path), RAW, "Q", "sum")
    out = silver.pib(quarters, keys=("k",), run_ts=RUN_TS)
    digits = {"value": 2, "quarterly_change_pct": 6, "annual_change_pct": 6,
              "accumulated_value": 2}
    return _rounded(out, digits, "k", "date", *_NAMES)


_BARS_SQL = f"""{OBSERVATIONS_SQL},
bars AS (SELECT k, strftime(date, '%Y-%m') AS year_month, max(date) AS date,
                arg_min(value, (date, t)) AS open, arg_max(value, (date, t)) AS close,
                max(value) AS high, min(value) AS low, avg(value) AS avg,
                CASE WHEN count(*) > 1 THEN stddev_samp(value) END AS sd FROM obs GROUP BY 1, 2)"""
_CAMBIO = f"""
WITH {_BARS_SQL}
SELECT k, date, {_METADATA.format('cambio', 'BRL', 'monthly')}, year_month, open, close, high, low,
       close AS value, round(avg, 7) AS avg, {{}}
FROM bars
WINDOW w AS ({_BY_K}), w3 AS ({_BY_K} ROWS 2 PRECEDING), w6 AS ({_BY_K} ROWS 5 PRECEDING),
       w20 AS ({_BY_K} ROWS 19 PRECEDING), w50 AS ({_BY_K} ROWS 49 PRECEDING)"""


@query("i04_cambio", _CAMBIO.format("""
       round(coalesce(sd, 0), 5) AS volatility,
       round((close / lag(close, 1) OVER w - 1) * 100, 6) AS return_pct,
       round((close / lag(close, 1) OVER w - 1) * 100, 6) AS monthly_change_pct,
       round(CASE WHEN count(close) OVER w20 = 20 THEN stddev_samp(close) OVER w20 END, 5)
         AS volatility_20,
       round((high - low) / low * 100, 6) AS amplitude_pct,
       round((high - low) / low * 100, 6) AS monthly_amplitude_pct,
       round(CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END, 5) AS ma_20,
       round(CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END, 5) AS ma_50,
       CAST(CASE WHEN count(close) OVER w50 = 50 AND avg(close) OVER w20 > avg(close) OVER w50
            THEN 1 ELSE -1 END AS INTEGER) AS ma_cross_signal,
       round(avg(close) OVER w3, 6) AS ma_3m, round(avg(close) OVER w6, 6) AS ma_6m"""))
def cambio(spark, path):
    out = silver.cambio(observations(spark, path), keys=("k",), tie=("t",), run_ts=RUN_TS)
    digits = {
        "avg": 7, "volatility": 5, "return_pct": 6, "monthly_change_pct": 6, "volatility_20": 5,
        "amplitude_pct": 6, "monthly_amplitude_pct": 6, "ma_20": 5, "ma_50": 5, "ma_3m": 6,
        "ma_6m": 6,
    }
    prices = ("open", "close", "high", "low", "value")
    return _rounded(out, digits, "k", "date", *_NAMES, "year_month", *prices, "ma_cross_signal")


@query("i04_cambio_rounded", _CAMBIO.format("""
       round(sd, 5) AS volatility,
       round((close / lag(close, 1) OVER w - 1) * 100, 2) AS monthly_change_pct,
       round((high - low) / low * 100, 2) AS monthly_amplitude_pct,
       round(avg(close) OVER w3, 4) AS ma_3m, round(avg(close) OVER w6, 4) AS ma_6m"""))
def cambio_rounded(spark, path):
    out = silver.cambio(observations(spark, path), keys=("k",), tie=("t",), style=silver.ROUNDED,
                        run_ts=RUN_TS)
    return _rounded(
        out, {"avg": 7, "volatility": 5}, "k", "date", *_NAMES, "year_month", "open", "close",
        "high", "low", "value", "monthly_change_pct", "monthly_amplitude_pct", "ma_3m", "ma_6m",
    )


_DESEMPREGO = f"""
WITH {_QUARTERS_SQL}
SELECT k, date, {_METADATA}, {{}}
FROM quarters WINDOW w AS ({_BY_K}), w3 AS ({_BY_K} ROWS 2 PRECEDING)"""


@query("i05_desemprego", _DESEMPREGO.format("desemprego", "%", "quarterly", """
       round(mean - lag(mean, 1) OVER w, 6) AS quarterly_change_pp,
       round(mean - lag(mean, 4) OVER w, 6) AS annual_change_pp,
       round(CASE WHEN count(mean) OVER w3 = 3 THEN avg(mean) OVER w3 END, 6) AS moving_avg_3q"""))
def desemprego(spark, path):
    quarters = resample(observations(spark, path), RAW, "Q", "mean")
    out = silver.desemprego(quarters, keys=("k",), run_ts=RUN_TS)
    digits = {"quarterly_change_pp": 6, "annual_change_pp": 6, "moving_avg_3q": 6}
    return _rounded(out, digits, "k", "date", *_NAMES)


@query("i05_pnad_rounded", _DESEMPREGO.format("pnad", "%", "quarterly", """
       CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
       year(date)::VARCHAR || 'Q' || quarter(date)::VARCHAR AS year_quarter,
       round(mean - lag(mean, 1) OVER w, 2) AS quarterly_change_pp,
       round(mean - lag(mean, 4) OVER w, 2) AS annual_change_pp,
       round(avg(mean) OVER w3, 2) AS moving_avg_3q"""))
def pnad_rounded(spark, path):
    quarters = resample(observations(spark, path), RAW, "Q", "mean")
    out = silver.TRANSFORMS["pnad"](quarters, keys=("k",), style=silver.ROUNDED, run_ts=RUN_TS)
    return out.select("k", "date", *_NAMES, "year", "quarter", "year_quarter",
                      "quarterly_change_pp", "annual_change_pp", "moving_avg_3q")


# ---- dashboards ------------------------------------------------------------------------------

def bronze_series(spark, path) -> dict:
    """Each indicator's bronze rows (date, value) at its own frequency."""
    rows = observations(spark, path)

    def of(df, k):
        return df.filter(F.col("k") == k).select("date", "value")

    days = period_mean(rows, RAW, "D").drop("period")
    return {
        "ipca": of(monthly(spark, path), "1-URGENT"),
        "selic": of(days, "2-HIGH"),
        "pib": of(resample(rows, RAW, "Q", "sum"), "3-MEDIUM"),
        "cambio": of(days, "4-NOT SPECIFIED"),
        "desemprego": of(resample(rows, RAW, "Q", "mean"), "5-LOW"),
    }


def silver_series(spark, path) -> dict:
    return {
        name: silver.TRANSFORMS[name](df, run_ts=RUN_TS)
        for name, df in bronze_series(spark, path).items()
    }


_SILVER_SQL = f"""{MONTHLY_SQL},
day_means AS (SELECT k, date, avg(value) AS value FROM obs GROUP BY k, date),
quarters AS (SELECT k, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)
             AS date, sum(value) AS total, avg(value) AS mean FROM obs GROUP BY 1, 2),
s_ipca AS (SELECT date, value, (value / lag(value, 1) OVER w - 1) * 100 AS monthly,
                  (value / lag(value, 12) OVER w - 1) * 100 AS annual
           FROM monthly WHERE k = '1-URGENT' WINDOW w AS (ORDER BY date)),
selic_months AS (SELECT max(date) AS date, avg(value) AS value FROM day_means WHERE k = '2-HIGH'
                 GROUP BY strftime(date, '%Y-%m')),
s_selic AS (SELECT *, CASE WHEN count(*) OVER w3 = 3 THEN avg(value) OVER w3 END AS ma
            FROM selic_months WINDOW w3 AS (ORDER BY date ROWS 2 PRECEDING)),
cambio_months AS (SELECT max(date) AS date, arg_max(value, date) AS value,
                         CASE WHEN count(*) > 1 THEN stddev_samp(value) ELSE 0 END AS sd
                  FROM day_means WHERE k = '4-NOT SPECIFIED' GROUP BY strftime(date, '%Y-%m')),
s_cambio AS (SELECT *, (value / lag(value, 1) OVER w - 1) * 100 AS monthly,
                    (value / lag(value, 12) OVER w - 1) * 100 AS annual
             FROM cambio_months WINDOW w AS (ORDER BY date)),
s_pib AS (SELECT date, total AS value, (total / lag(total, 1) OVER w - 1) * 100 AS growth,
                 (total / lag(total, 4) OVER w - 1) * 100 AS annual
          FROM quarters WHERE k = '3-MEDIUM' WINDOW w AS (ORDER BY date)),
s_des AS (SELECT date, mean AS value, mean - lag(mean, 1) OVER w AS change,
                 mean - lag(mean, 4) OVER w AS annual
          FROM quarters WHERE k = '5-LOW' WINDOW w AS (ORDER BY date))"""

_PANEL_SQL = f"""
WITH {_SILVER_SQL},
p AS (SELECT i.date, coalesce(strftime(i.date, '%Y-%m'), strftime(s.date, '%Y-%m'),
                              strftime(c.date, '%Y-%m')) AS year_month,
             i.value AS ipca, i.monthly AS im, i.annual AS ia, s.value AS selic, s.ma,
             c.value AS cambio, c.monthly AS cm, c.sd,
             0.4 * i.annual + 0.3 * s.value + 0.3 * c.sd AS pressure
      FROM s_ipca i
      FULL JOIN s_selic s ON strftime(i.date, '%Y-%m') = strftime(s.date, '%Y-%m')
      FULL JOIN s_cambio c ON coalesce(strftime(i.date, '%Y-%m'), strftime(s.date, '%Y-%m'))
                              = strftime(c.date, '%Y-%m'))
SELECT date, year_month, round(ipca, 6) AS ipca, round(im, 6) AS ipca_monthly_change,
       round(ia, 6) AS ipca_annual_change, round(selic, 6) AS selic,
       round(ma, 6) AS selic_moving_avg, round(cambio, 6) AS cambio,
       round(cm, 6) AS cambio_monthly_change, round(sd, 5) AS cambio_volatility,
       round(selic - ipca, 6) AS real_interest_rate,
       round((pressure - min(pressure) OVER ()) / (max(pressure) OVER () - min(pressure) OVER ())
             * 100, 6) AS economic_pressure_index
FROM p"""


def _panel_columns(df):
    digits = {c: 6 for c in df.columns if c not in ("date", "year_month", "updated_at")}
    digits["cambio_volatility"] = 5
    return _rounded(df, digits, "date", "year_month")


@query("i06_monthly_panel", _PANEL_SQL)
def monthly_panel(spark, path):
    return _panel_columns(gold.monthly_panel(silver_series(spark, path), spark, RUN_TS))


@query("i06_monthly_panel_plain_index", f"""
WITH {MONTHLY_SQL}, m AS (SELECT strftime(date, '%Y-%m') AS year_month, k, date, value FROM monthly),
a AS (SELECT * FROM m WHERE k = '1-URGENT'), b AS (SELECT * FROM m WHERE k = '2-HIGH'),
c AS (SELECT * FROM m WHERE k = '4-NOT SPECIFIED')
SELECT coalesce(a.year_month, b.year_month, c.year_month) AS year_month, a.date,
       round(a.value, 7) AS ipca, round(b.value, 7) AS selic, round(c.value, 7) AS cambio,
       round(a.value + b.value, 3) AS economic_pressure_index
FROM a FULL JOIN b ON a.year_month = b.year_month
FULL JOIN c ON coalesce(a.year_month, b.year_month) = c.year_month""")
def monthly_panel_plain(spark, path):
    """Inputs without the change columns: the index is rate plus prices."""
    df = monthly(spark, path)
    frames = {
        name: df.filter(F.col("k") == k).select("date", "value")
        for name, k in (("ipca", "1-URGENT"), ("selic", "2-HIGH"), ("cambio", "4-NOT SPECIFIED"))
    }
    panel = gold.monthly_panel(frames, spark, RUN_TS)
    digits = {"ipca": 7, "selic": 7, "cambio": 7, "economic_pressure_index": 3}
    return _rounded(panel, digits, "date", "year_month")


# Orders by the remainder of their number as two places of each indicator.
_PLACES_SQL = f"""{OBSERVATIONS_SQL},
placed AS (SELECT k, CASE WHEN t % 2 = 0 THEN 'Norte' ELSE 'Sul' END AS localidade, date, value FROM obs),
pm AS (SELECT k, localidade, date_trunc('month', date)::DATE AS date, avg(value) AS value FROM placed GROUP BY ALL),
pq AS (SELECT k, localidade, CAST(date_trunc('quarter', date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS date,
              sum(value) AS total, avg(value) AS mean FROM placed GROUP BY ALL)"""


def _placed_series(spark, path) -> dict:
    """Silver frames of two places in each indicator."""
    place = F.when(F.col("t") % 2 == 0, "Norte").otherwise("Sul").alias("localidade")
    rows = observations(spark, path).select("k", place, "date", "t", "value")
    raw, keys = RAW.but(keys=("k", "localidade")), ("localidade",)
    months = period_mean(rows, raw, "M").drop("year_month")

    def of(df, k):
        return df.filter(F.col("k") == k).drop("k")

    return {
        "ipca": silver.ipca(of(months, "1-URGENT"), keys, run_ts=RUN_TS),
        "selic": silver.selic(of(rows, "2-HIGH").drop("t"), keys, run_ts=RUN_TS),
        "cambio": silver.cambio(of(rows, "4-NOT SPECIFIED"), keys, tie=("t",), run_ts=RUN_TS),
        "pib": silver.pib(of(resample(rows, raw, "Q", "sum"), "3-MEDIUM"), keys, run_ts=RUN_TS),
        "desemprego": silver.desemprego(of(resample(rows, raw, "Q", "mean"), "5-LOW"), keys, run_ts=RUN_TS),
    }


@query("i06_panel_by_place", f"""
WITH {_PLACES_SQL},
a AS (SELECT *, strftime(date, '%Y-%m') AS ym, (value / lag(value, 1) OVER w - 1) * 100 AS change
      FROM pm WHERE k = '1-URGENT' WINDOW w AS (PARTITION BY localidade ORDER BY date)),
b AS (SELECT *, strftime(date, '%Y-%m') AS ym FROM pm WHERE k = '2-HIGH'),
c AS (SELECT localidade, strftime(date, '%Y-%m') AS ym, max(high) AS cambio FROM (
        SELECT localidade, date, value AS high FROM placed WHERE k = '4-NOT SPECIFIED') GROUP BY ALL)
SELECT coalesce(a.localidade, b.localidade, c.localidade) AS localidade, coalesce(a.ym, b.ym, c.ym) AS year_month,
       round(a.value, 6) AS ipca, round(a.change, 6) AS ipca_monthly_change, round(b.value, 6) AS selic,
       c.cambio IS NOT NULL AS has_cambio
FROM a FULL JOIN b ON a.localidade = b.localidade AND a.ym = b.ym
FULL JOIN c ON coalesce(a.localidade, b.localidade) = c.localidade AND coalesce(a.ym, b.ym) = c.ym""")
def panel_by_place(spark, path):
    panel = gold.monthly_panel(_placed_series(spark, path), spark, RUN_TS, keys=("localidade",))
    digits = {c: 6 for c in ("ipca", "ipca_monthly_change", "selic")}
    return _rounded(panel.withColumn("has_cambio", F.col("cambio").isNotNull()), digits, "localidade", "year_month", "has_cambio")


@query("i07_labor_by_place", f"""
WITH {_PLACES_SQL},
d AS (SELECT localidade, date, mean AS rate, mean - lag(mean, 1) OVER w AS change FROM pq WHERE k = '5-LOW'
      WINDOW w AS (PARTITION BY localidade ORDER BY date)),
g AS (SELECT localidade, date, total AS gdp, (total / lag(total, 1) OVER w - 1) * 100 AS growth FROM pq WHERE k = '3-MEDIUM'
      WINDOW w AS (PARTITION BY localidade ORDER BY date)),
e AS (SELECT d.*, gdp, growth,
             -(change / nullif(lag(rate, 1) OVER (PARTITION BY d.localidade ORDER BY d.date), 0) * 100) / nullif(growth, 0) AS el
      FROM d LEFT JOIN g ON d.localidade = g.localidade AND d.date = g.date)
SELECT localidade, date, round(rate, 6) AS unemployment_rate, round(gdp, 2) AS gdp,
       round(el, 6) AS employment_gdp_elasticity,
       round(avg(el) OVER (PARTITION BY localidade ORDER BY date ROWS 3 PRECEDING), 6) AS employment_gdp_elasticity_ma
FROM e""")
def labor_by_place(spark, path):
    out = gold.labor_market(_placed_series(spark, path), spark, RUN_TS, keys=("localidade",))
    digits = {"unemployment_rate": 6, "gdp": 2, "employment_gdp_elasticity": 6, "employment_gdp_elasticity_ma": 6}
    return _rounded(out, digits, "localidade", "date")


_LABOR_SQL = f"""
WITH {_SILVER_SQL},
l AS (SELECT d.date, d.value AS rate, d.change, d.annual, g.value AS gdp, g.growth
      FROM s_des d LEFT JOIN s_pib g ON date_trunc('quarter', g.date) = date_trunc('quarter', d.date)),
e AS (SELECT *, -(change / nullif(lag(rate, 1) OVER w, 0) * 100) / nullif(growth, 0) AS el
      FROM l WINDOW w AS (ORDER BY date))
SELECT date, round(rate, 6) AS unemployment_rate, round(change, 6) AS unemployment_qtr_change,
       round(annual, 6) AS unemployment_annual_change, round(gdp, 2) AS gdp,
       round(growth, 6) AS gdp_growth, round(el, 6) AS employment_gdp_elasticity,
       round(avg(el) OVER (ORDER BY date ROWS 3 PRECEDING), 6) AS employment_gdp_elasticity_ma
FROM e"""


def _labor_columns(df):
    digits = {c: 6 for c in df.columns if c not in ("date", "updated_at")}
    digits["gdp"] = 2
    return _rounded(df, digits, "date")


@query("i07_labor_market", _LABOR_SQL)
def labor_market(spark, path):
    return _labor_columns(gold.labor_market(silver_series(spark, path), spark, RUN_TS))


@query("i07_labor_market_without_product", f"""
WITH {_SILVER_SQL}
SELECT date, round(value, 6) AS unemployment_rate, CAST(NULL AS DOUBLE) AS gdp,
       CAST(NULL AS DOUBLE) AS employment_gdp_elasticity FROM s_des""")
def labor_market_alone(spark, path):
    frames = {"desemprego": silver_series(spark, path)["desemprego"]}
    out = gold.labor_market(frames, spark, RUN_TS)
    return out.select("date", F.round("unemployment_rate", 6).alias("unemployment_rate"), "gdp",
                      "employment_gdp_elasticity")


_ENDS = """
SELECT arg_max(value, date) AS v, max(date) AS d, arg_max({annual}, date) AS a, avg(value) AS m,
       (SELECT value FROM {t} ORDER BY date DESC LIMIT 1 OFFSET 2) AS v3 FROM {t}"""


def _line_sql(table: str, indicator: str, unit: str, annual: str = "annual") -> str:
    return f"""SELECT '{indicator}' AS indicator, '{unit}' AS unit, * FROM
    ({_ENDS.format(t=table, annual=annual)})"""


_MACRO_SQL = f"""
WITH {_SILVER_SQL},
lines AS ({_line_sql("s_ipca", "ipca", "%")} UNION ALL
          {_line_sql("s_selic", "selic", "%", "CAST(NULL AS DOUBLE)")} UNION ALL
          {_line_sql("s_pib", "pib", "R$ milhões")} UNION ALL
          {_line_sql("s_cambio", "cambio", "BRL")} UNION ALL
          {_line_sql("s_des", "desemprego", "%")})"""

_LINES_SQL = _MACRO_SQL + """
SELECT indicator, unit, round(v, 6) AS last_value, d AS last_date, round(a, 6) AS annual_change,
       CASE WHEN v > v3 THEN 'rising' WHEN v < v3 THEN 'falling' ELSE 'stable' END AS trend
FROM lines"""


@query("i08_macro_dashboard", _LINES_SQL)
def macro_dashboard(spark, path):
    out = gold.macro_dashboard(silver_series(spark, path), spark, AS_OF, RUN_TS)
    lines = out.filter(F.col("indicator") != "economic_health")
    return lines.select("indicator", "unit", F.round("last_value", 6).alias("last_value"),
                        "last_date", F.round("annual_change", 6).alias("annual_change"), "trend")


# Two sources deliver each indicator: a third of the orders, and the others up to 1996.
_SOURCES_SQL = f"""{OBSERVATIONS_SQL},
so AS (SELECT k, CASE WHEN t % 3 = 0 THEN 'ibge' ELSE 'bcb' END AS source, date, value FROM obs
       WHERE t % 3 = 0 OR year(date) <= 1996),
sm AS (SELECT k, source, max(date) AS date, strftime(date, '%Y-%m') AS ym, avg(value) AS value FROM so GROUP BY ALL),
sd AS (SELECT k, source, date, avg(value) AS value FROM so GROUP BY ALL),
own AS (SELECT source, date, ym, value, (value / lag(value, 1) OVER w - 1) * 100 AS monthly,
               (value / lag(value, 12) OVER w - 1) * 100 AS annual
        FROM sm WHERE k = '1-URGENT' WINDOW w AS (PARTITION BY source ORDER BY date)),
one_ipca AS (SELECT * FROM own QUALIFY row_number() OVER (PARTITION BY ym ORDER BY source) = 1),
one_selic AS (SELECT date, ym, value FROM sm WHERE k = '2-HIGH'
              QUALIFY row_number() OVER (PARTITION BY ym ORDER BY source) = 1),
one_cambio AS (SELECT * FROM (
                 SELECT source, max(date) AS date, strftime(date, '%Y-%m') AS ym, arg_max(value, date) AS value
                 FROM sd WHERE k = '4-NOT SPECIFIED' GROUP BY ALL)
               QUALIFY row_number() OVER (PARTITION BY ym ORDER BY source) = 1)"""


def _sourced_series(spark, path) -> dict:
    """Silver frames of two sources in each indicator, computed source by source."""
    source = F.when(F.col("t") % 3 == 0, "ibge").otherwise("bcb").alias("source")
    rows = observations(spark, path).select("k", source, "date", "t", "value")
    rows = rows.filter((F.col("source") == "ibge") | (F.year("date") <= 1996))
    raw, keys = RAW.but(keys=("k", "source")), ("source",)
    months, days = (period_mean(rows, raw, freq) for freq in ("M", "D"))

    def of(df, k):
        return df.filter(F.col("k") == k).select("source", "date", "value")

    return {
        "ipca": silver.ipca(of(months, "1-URGENT"), keys, run_ts=RUN_TS),
        "selic": silver.selic(of(days, "2-HIGH"), keys, run_ts=RUN_TS),
        "cambio": silver.cambio(of(days, "4-NOT SPECIFIED"), keys, run_ts=RUN_TS),
    }


@query("i06_panel_two_sources", f"""
WITH {_SOURCES_SQL},
selic_days AS (SELECT source, max(date) AS date, strftime(date, '%Y-%m') AS ym, avg(value) AS value FROM sd WHERE k = '2-HIGH' GROUP BY ALL),
s AS (SELECT * FROM selic_days QUALIFY row_number() OVER (PARTITION BY ym ORDER BY source) = 1)
SELECT ym AS year_month, round(i.value, 6) AS ipca, round(i.monthly, 6) AS ipca_monthly_change,
       round(s.value, 6) AS selic, round(c.value, 6) AS cambio, round(s.value - i.value, 4) AS real_interest_rate
FROM one_ipca i FULL JOIN s USING (ym) FULL JOIN one_cambio c USING (ym)""")
def panel_two_sources(spark, path):
    """A month has the row of its preferred source, with the changes of that source."""
    panel = gold.monthly_panel(_sourced_series(spark, path), spark, RUN_TS)
    digits = {c: 6 for c in ("ipca", "ipca_monthly_change", "selic", "cambio")}
    return _rounded(panel, {**digits, "real_interest_rate": 4}, "year_month")


@query("i08_macro_two_sources", f"""
WITH {_SOURCES_SQL},
selic_days AS (SELECT source, max(date) AS date, strftime(date, '%Y-%m') AS ym, avg(value) AS value FROM sd WHERE k = '2-HIGH' GROUP BY ALL),
s AS (SELECT * FROM selic_days QUALIFY row_number() OVER (PARTITION BY ym ORDER BY source) = 1),
every AS (SELECT 'ipca' AS indicator, date, value, annual FROM one_ipca
          UNION ALL SELECT 'selic', date, value, NULL FROM s UNION ALL SELECT 'cambio', date, value, NULL FROM one_cambio),
r AS (SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY date DESC) AS nth FROM every),
l AS (SELECT indicator, max(value) FILTER (nth = 1) AS v, max(date) AS d, max(annual) FILTER (nth = 1) AS a,
             max(value) FILTER (nth = 3) AS v3, max(value) FILTER (nth = 13) AS v13 FROM r GROUP BY indicator)
SELECT indicator, round(v, 6) AS last_value, d AS last_date,
       round(CASE WHEN indicator = 'cambio' THEN (v / v13 - 1) * 100 ELSE a END, 6) AS annual_change,
       CASE WHEN v > v3 THEN 'rising' WHEN v < v3 THEN 'falling' ELSE 'stable' END AS trend FROM l""")
def macro_two_sources(spark, path):
    out = gold.macro_dashboard(_sourced_series(spark, path), spark, AS_OF, RUN_TS)
    return out.filter(F.col("indicator") != "economic_health").select(
        "indicator", F.round("last_value", 6).alias("last_value"), "last_date",
        F.round("annual_change", 6).alias("annual_change"), "trend")


@query("i09_economic_health", _MACRO_SQL + """,
w AS (SELECT CASE indicator WHEN 'selic' THEN 0.3 ELSE 0.35 END AS w,
             CASE WHEN m > 0 THEN v / m ELSE 1 END AS r
      FROM lines WHERE indicator IN ('ipca', 'selic', 'desemprego')),
s AS (SELECT least(greatest(50 * sum(w * r) / sum(w), 0), 100) AS score FROM w)
SELECT 'economic_health' AS indicator, 'Índice de Saúde Econômica' AS indicator_name,
       round(score, 1) AS last_value, DATE '2001-08-31' AS last_date, 'pontos' AS unit,
       CASE WHEN score < 35 THEN 'excelente' WHEN score < 45 THEN 'boa' WHEN score < 55 THEN 'estável'
            WHEN score < 70 THEN 'desafiadora' ELSE 'crítica' END AS situation FROM s""")
def economic_health(spark, path):
    out = gold.macro_dashboard(silver_series(spark, path), spark, AS_OF, RUN_TS)
    return out.filter(F.col("indicator") == "economic_health").select(
        "indicator", "indicator_name", "last_value", "last_date", "unit", "situation"
    )


def _contract_sql(table: str, required: Sequence[str], expected: Sequence[str] = ()) -> str:
    """Lines of a contract over the rows of a SQL table."""
    lines = [f"SELECT 'presence' AS \"check\", '{c}' AS \"column\", CAST(1 AS DOUBLE) AS metric, true AS passed, 'error' AS severity"
             for c in required]
    lines += [f"SELECT 'null_share', '{c}', round(100.0 * (count(*) - count({c})) / count(*), 6), count(*) = count({c}), 'warn' FROM {table}"
              for c in required]
    lines += [f"SELECT 'rows', NULL, count(*), count(*) >= 3, 'warn' FROM {table}"]
    lines += [f"SELECT 'expected_indicator', '{i}', count(*), count(*) > 0, 'warn' FROM {table} WHERE indicator = '{i}'" for i in expected]
    return " UNION ALL ".join(lines)


def _contract(df: DataFrame, table: str) -> DataFrame:
    return check_contract(df, table).withColumn("metric", F.round("metric", 6))


@query("j07_silver_contract", f"""
WITH {_SILVER_SQL},
silver AS (SELECT date, value, 'ipca' AS indicator, '%' AS unit, 'monthly' AS frequency FROM s_ipca)
{_contract_sql("silver", CONTRACTS["silver"])}""")
def silver_contract(spark, path):
    return _contract(silver_series(spark, path)["ipca"], "silver")


@query("j07_monthly_contract", f"""
WITH panel AS ({_PANEL_SQL})
{_contract_sql("panel", CONTRACTS["monthly_indicators"])}""")
def monthly_contract(spark, path):
    return _contract(gold.monthly_panel(silver_series(spark, path), spark, RUN_TS), "monthly_indicators")


@query("j07_labor_contract", f"""
WITH labor AS ({_LABOR_SQL})
{_contract_sql("labor", CONTRACTS["labor_market"])}""")
def labor_contract(spark, path):
    return _contract(gold.labor_market(silver_series(spark, path), spark, RUN_TS), "labor_market")


@query("j07_macro_contract", f"""
WITH macro AS ({_LINES_SQL} UNION ALL SELECT 'economic_health', NULL, 1.0, DATE '2001-08-31', NULL, NULL)
{_contract_sql("macro", CONTRACTS["macro_dashboard"], EXPECTED_INDICATORS)}""")
def macro_contract(spark, path):
    return _contract(gold.macro_dashboard(silver_series(spark, path), spark, AS_OF, RUN_TS), "macro_dashboard")


# ---- runs ------------------------------------------------------------------------------------

def _landed(spark, path) -> str:
    """A bronze layer of all indicators plus one that has no transform."""
    series = bronze_series(spark, path)
    series["inpc"] = series["ipca"]
    rows = append(*(
        df.select(
            F.lit("bcb").alias("source"), F.date_format("date", "yyyy-MM-dd").alias("data"),
            F.col("value").cast("string").alias("valor"), F.lit(name).alias("indicator"),
        )
        for name, df in series.items()
    ))
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(rows, root, RUN_TS)
    return root


def _run_silver(spark, path):
    target = scratch_path(spark, "silver")
    return target, pipeline.bronze_to_silver(spark, _landed(spark, path), target, RUN_TS)


_COUNTS_SQL = f"""WITH {_SILVER_SQL},
n AS (SELECT 'ipca' AS indicator, count(*) AS rows FROM s_ipca
      UNION ALL SELECT 'selic', count(*) FROM s_selic UNION ALL SELECT 'pib', count(*) FROM s_pib
      UNION ALL SELECT 'cambio', count(*) FROM s_cambio
      UNION ALL SELECT 'desemprego', count(*) FROM s_des)"""


@query("i10_bronze_to_silver_report", _COUNTS_SQL + """
SELECT 'bcb' AS source, indicator, rows, true AS success, 'ok' AS message FROM n
UNION ALL SELECT 'bcb', 'inpc', 0, false, 'no transform'""")
def bronze_to_silver_report(spark, path):
    return _run_silver(spark, path)[1]


@query("i10_report_per_source", _COUNTS_SQL + """,
b AS (SELECT count(*) AS rows FROM s_ipca WHERE year(date) > 1994)
SELECT 'bcb' AS source, indicator, rows, true AS success, 'ok' AS message FROM n
UNION ALL SELECT 'bcb', 'inpc', 0, false, 'no transform' UNION ALL SELECT 'ibge', 'ipca', rows, true, 'ok' FROM b""")
def report_per_source(spark, path):
    """A second source delivers one of the indicators, later and with fewer years."""
    root, target = _landed(spark, path), scratch_path(spark, "silver")
    other = files.read_layer(spark, root).where("indicator = 'ipca' AND year(CAST(data AS DATE)) > 1994")
    other = other.withColumn("source", F.lit("ibge")).drop("snapshot_ts")
    sinks.write_snapshot(other, root, RUN_TS + dt.timedelta(hours=1))
    return pipeline.bronze_to_silver(spark, root, target, RUN_TS)


@query("i10_failing_transform", _COUNTS_SQL + """
SELECT indicator, CASE WHEN indicator IN ('ipca', 'pib') THEN 0 ELSE rows END AS rows,
       indicator NOT IN ('ipca', 'pib') AS success FROM n UNION ALL SELECT 'inpc', 0, false""")
def failing_transform(spark, path):
    """One transform fails when it is called, one when its rows are computed; the others run."""
    def at_once(df, **_):
        raise ValueError("no such thing")

    def on_rows(df, **options):
        out = silver.TRANSFORMS["pib"](df, **options)
        return out.withColumn("value", F.when(F.col("value") > 0, F.raise_error(F.lit("a bad row")).cast("double")))

    transforms = {**silver.TRANSFORMS, "ipca": at_once, "pib": on_rows}
    report = pipeline.bronze_to_silver(spark, _landed(spark, path), scratch_path(spark, "silver"), RUN_TS, transforms=transforms)
    return report.select("indicator", "rows", "success")


@query("i10_validation_lines", f"""
WITH {MONTHLY_SQL}, m AS (SELECT * FROM monthly WHERE k = '1-URGENT')
SELECT 'ipca' AS indicator, count(*) AS rows, true AS success,
       printf('%d rows in a month that has a later one; %.1f%% of value missing', count(*),
              100.0 * count(*) FILTER (month(date) % 4 = 0) / count(*)) AS message FROM m""")
def validation_lines(spark, path):
    """Every month comes twice, and every fourth has no value."""
    months = monthly(spark, path).filter(F.col("k") == "1-URGENT")
    value = F.when(F.month("date") % 4 != 0, F.col("value").cast("string")).otherwise("n/d").alias("valor")
    rows = months.select(
        F.lit("bcb").alias("source"), F.lit("ipca").alias("indicator"), value,
        F.explode(F.array("date", F.date_add(F.trunc("date", "month"), 5))).alias("data"),
    ).withColumn("data", F.col("data").cast("string"))
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(rows, root, RUN_TS)
    report = pipeline.bronze_to_silver(spark, root, scratch_path(spark, "silver"), RUN_TS)
    return report.select("indicator", "rows", "success", "message")


@query("i10_gold_monthly_panel", _PANEL_SQL)
def gold_monthly_panel(spark, path):
    """Bronze to silver to gold through the layers, then the panel read back."""
    layer, _ = _run_silver(spark, path)
    root = scratch_path(spark, "gold")
    pipeline.silver_to_gold(spark, layer, root, RUN_TS)
    return _panel_columns(spark.read.parquet(f"{root}/monthly_indicators").drop("snapshot_ts"))


@query("i10_gold_labor_market", _LABOR_SQL)
def gold_labor_market(spark, path):
    layer, _ = _run_silver(spark, path)
    root = scratch_path(spark, "gold")
    pipeline.silver_to_gold(spark, layer, root, RUN_TS)
    return _labor_columns(spark.read.parquet(f"{root}/labor_market").drop("snapshot_ts"))


@query("i11_load_latest_silver", _COUNTS_SQL + " SELECT indicator, rows FROM n")
def load_latest_silver(spark, path):
    layer, _ = _run_silver(spark, path)
    frames = pipeline.load_latest_silver(spark, layer)
    return append(*(
        df.groupBy("indicator").agg(F.count(F.lit(1)).alias("rows")) for df in frames.values()
    ))


@query("l01_group_wise_expression", f"""
WITH {MONTHLY_SQL}
SELECT k, date, round((value / first_value(value) OVER w - 1) * 100, 6) AS year_to_date_pct
FROM monthly WINDOW w AS (PARTITION BY k, year(date) ORDER BY date)""")
def group_wise_expression(spark, path):
    """What a function per group would do is a window expression."""
    out = year_to_date_percent(monthly(spark, path), MONTHLY)
    return _rounded(out, {"year_to_date_pct": 6}, "k", "date")


@query("l02_row_expression", f"""
WITH {MONTHLY_SQL},
c AS (SELECT k, date, (value / lag(value, 1) OVER w - 1) * 100 AS change,
             value - lag(value, 2) OVER w AS growth FROM monthly
      WINDOW w AS (PARTITION BY k ORDER BY date))
SELECT k, date, round(-change / nullif(growth, 0), 8) AS elasticity FROM c""")
def row_expression(spark, path):
    """What a function per row would do is a column expression."""
    out = measure(monthly(spark, path), MONTHLY, percent_change(1, "change", 100),
                  difference(2, "growth"))
    elasticity = F.round(F.try_divide(-F.col("change"), F.col("growth")), 8)
    return out.select("k", "date", elasticity.alias("elasticity"))


@query("l03_aggregate_by_name", f"""
WITH {OBSERVATIONS_SQL}
SELECT k, CAST(date_trunc('year', date) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS date,
       round(avg(value), 5) AS value FROM obs GROUP BY 1, 2""")
def aggregate_by_name(spark, path):
    """An unknown name means the mean."""
    out = resample(observations(spark, path), RAW, "Y", "median-ish")
    return out.withColumn("value", F.round("value", 5))


@query("l04_own_transform", f"""
WITH {MONTHLY_SQL}
SELECT 'ipca' AS indicator, date, round(value, 7) AS value, round(value * 2, 6) AS twice
FROM monthly WHERE k = '1-URGENT'""")
def own_transform(spark, path):
    """A user's transform in the run instead of the built-in ones."""
    def double(df, keys, style, run_ts, value):
        out = silver.standardize(df, value)
        return out.withColumn("twice", F.col("value") * 2)

    target = scratch_path(spark, "silver")
    pipeline.bronze_to_silver(
        spark, _landed(spark, path), target, RUN_TS, ["ipca", "selic"], transforms={"ipca": double}
    )
    return files.read_latest(spark, target).select(
        "indicator", "date", F.round("value", 7).alias("value"), F.round("twice", 6).alias("twice")
    )
