"""Grouped statistics and joins of period series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..model import Series
from ..operators import aggregates as a
from ..operators import joins as j
from ..operators.cleaning import attach_registry
from ..operators.windows import group_std
from .inputs import (
    DAILY_SQL,
    INDICATOR_SQL,
    MONTHLY_SQL,
    OBSERVATIONS_SQL,
    RAW,
    bronze,
    daily,
    monthly,
    observations,
    table,
)
from .cleaning import REGISTRY_SQL
from .registry import query

SHIPPED = Series(keys=("l_returnflag",), date="l_shipdate", value="l_extendedprice")


# ---- joins -----------------------------------------------------------------------------------

_SIDES_SQL = f"""{MONTHLY_SQL},
m AS (SELECT k, strftime(date, '%Y-%m') AS year_month, month(date) AS month, date, value FROM monthly),
a AS (SELECT CASE WHEN month <> 3 THEN year_month END AS year_month, date, value AS ipca
      FROM m WHERE k = '1-URGENT'),
b AS (SELECT CASE WHEN month <> 5 THEN year_month END AS year_month, value AS selic
      FROM m WHERE k = '2-HIGH'),
c AS (SELECT year_month, value AS cambio FROM m WHERE k = '4-NOT SPECIFIED' AND month <> 7)"""


def _side(spark, path, k, name):
    df = monthly(spark, path).filter(F.col("k") == k)
    return df.select(
        F.date_format("date", "yyyy-MM").alias("year_month"), "date", F.col("value").alias(name)
    )


def _month_sides(spark, path):
    """Keys are missing in March, in May, and rows in July."""
    left, middle = _side(spark, path, "1-URGENT", "ipca"), _side(spark, path, "2-HIGH", "selic")
    right = _side(spark, path, "4-NOT SPECIFIED", "cambio").where(F.month("date") != 7)
    without = lambda df, month: df.withColumn(
        "year_month", F.when(F.month("date") != month, F.col("year_month")))
    return without(left, 3), without(middle, 5), right


def _panel(spark, path, pair_missing):
    left, middle, right = _month_sides(spark, path)
    panel = j.full_outer(left, middle, "year_month", pair_missing)
    panel = j.full_outer(panel, right, "year_month", pair_missing)
    return panel.select(
        "year_month", "date", *(F.round(c, 7).alias(c) for c in ("ipca", "selic", "cambio"))
    )


_E01_SQL = f"""
WITH {_SIDES_SQL},
ab AS (SELECT coalesce(a.year_month, b.year_month) AS year_month, date, ipca, selic
       FROM a FULL JOIN b ON a.year_month {{0}} b.year_month)
SELECT coalesce(ab.year_month, c.year_month) AS year_month, date, round(ipca, 7) AS ipca,
       round(selic, 7) AS selic, round(cambio, 7) AS cambio
FROM ab FULL JOIN c ON ab.year_month {{0}} c.year_month"""


@query("e01_full_outer_by_month", _E01_SQL.format("="))
def full_outer(spark, path):
    """Rows with a missing key stay rows of their own."""
    return _panel(spark, path, False)


@query("e01_full_outer_missing_paired", _E01_SQL.format("IS NOT DISTINCT FROM"))
def full_outer_paired(spark, path):
    """Missing keys meet each other on demand."""
    return _panel(spark, path, True)


_QUARTER_SQL = f"""{MONTHLY_SQL},
u AS (SELECT date, value AS rate, date_trunc('quarter', date) AS q FROM monthly
      WHERE k = '5-LOW'),
g AS (SELECT date AS d, value AS gdp, date_trunc('quarter', date) AS q FROM monthly
      WHERE k = '3-MEDIUM')"""


def _quarter_sides(spark, path):
    df = monthly(spark, path)
    left, right = df.filter(F.col("k") == "5-LOW"), df.filter(F.col("k") == "3-MEDIUM")
    return (
        left.select("date", F.col("value").alias("rate")),
        right.select("date", F.col("value").alias("gdp")),
    )


@query("e02_left_by_quarter_last", f"""
WITH {_QUARTER_SQL}, last AS (SELECT q, arg_max(gdp, d) AS gdp FROM g GROUP BY q)
SELECT date, round(rate, 7) AS rate, round(gdp, 7) AS gdp FROM u LEFT JOIN last USING (q)""")
def left_by_quarter(spark, path):
    out = j.left_by_quarter(*_quarter_sides(spark, path))
    return out.select("date", F.round("rate", 7).alias("rate"), F.round("gdp", 7).alias("gdp"))


@query("e02_left_by_quarter_all", f"""
WITH {_QUARTER_SQL}
SELECT date, round(rate, 7) AS rate, round(gdp, 7) AS gdp FROM u LEFT JOIN g USING (q)""")
def left_by_quarter_all(spark, path):
    out = j.left_by_quarter(*_quarter_sides(spark, path), per_quarter="all")
    return out.select("date", F.round("rate", 7).alias("rate"), F.round("gdp", 7).alias("gdp"))


@query("e03_scalar_join", """
SELECT event_id, round(value - (SELECT avg(value) FROM events), 6) AS centred FROM events""")
def scalar_join(spark, path):
    df = table(spark, path, "events").select("event_id", "value")
    mean = a.series_stats(df, []).select("mean")
    return j.attach_scalars(df, mean).select(
        "event_id", F.round(F.col("value") - F.col("mean"), 6).alias("centred")
    )


@query("e04_registry_lookup", f"""
WITH {OBSERVATIONS_SQL}, {REGISTRY_SQL},
b AS (SELECT 'bcb' AS source, {INDICATOR_SQL} AS indicator, value FROM obs)
SELECT b.indicator, any_value(frequency) AS frequency, any_value(unit) AS unit, count(*) AS n
FROM b LEFT JOIN registry r ON r.source = b.source AND r.indicator = b.indicator GROUP BY 1""")
def registry_lookup(spark, path):
    rows = attach_registry(bronze(spark, path))
    return rows.groupBy("indicator").agg(
        F.max("frequency").alias("frequency"), F.max("unit").alias("unit"),
        F.count(F.lit(1)).alias("n"),
    )


# ---- aggregates ------------------------------------------------------------------------------

@query("f01_monthly_mean", f"""
WITH {OBSERVATIONS_SQL}
SELECT k, strftime(date, '%Y-%m') AS year_month, max(date) AS date, round(avg(value), 7) AS value
FROM obs GROUP BY 1, 2""")
def monthly_mean(spark, path):
    out = a.period_mean(observations(spark, path), RAW, "M")
    return out.withColumn("value", F.round("value", 7))


@query("f01_monthly_mean_lineitem", """
SELECT l_returnflag, strftime(l_shipdate, '%Y-%m') AS year_month,
       CAST(max(l_shipdate) AS DATE) AS last_date, round(avg(l_extendedprice), 7) AS value
FROM lineitem GROUP BY 1, 2""")
def monthly_mean_lineitem(spark, path):
    out = a.period_mean(table(spark, path, "lineitem"), SHIPPED, "M")
    return out.select(
        "l_returnflag", "year_month", F.to_date("l_shipdate").alias("last_date"),
        F.round("l_extendedprice", 7).alias("value"),
    )


@query("f02_monthly_ohlc", f"""
WITH {OBSERVATIONS_SQL}
SELECT k, strftime(date, '%Y-%m') AS year_month, max(date) AS date,
       arg_min(value, (date, t)) AS open, arg_max(value, (date, t)) AS close,
       max(value) AS high, min(value) AS low, round(avg(value), 7) AS avg,
       round(CASE WHEN count(*) > 1 THEN stddev_samp(value) ELSE 0 END, 5) AS volatility
FROM obs GROUP BY 1, 2""")
def monthly_ohlc(spark, path):
    out = a.period_ohlc(observations(spark, path), RAW, "M")
    return out.withColumns({
        "avg": F.round("avg", 7), "volatility": F.round("volatility", 5),
    })


@query("f02_daily_ohlc_single_rows", f"""
WITH {OBSERVATIONS_SQL}
SELECT k, date AS period, date, arg_min(value, t) AS open, arg_max(value, t) AS close,
       max(value) AS high, min(value) AS low, round(avg(value), 6) AS avg,
       round(CASE WHEN count(*) > 1 THEN stddev_samp(value) END, 5) AS volatility
FROM obs GROUP BY 1, 2""")
def daily_ohlc(spark, path):
    """Many days have one order, whose deviation is NULL here."""
    out = a.period_ohlc(observations(spark, path), RAW, "D", lone_volatility=None)
    return out.withColumns({
        "avg": F.round("avg", 6), "volatility": F.round("volatility", 5),
    })


@query("f03_series_mean_min_max", """
SELECT event_type, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max
FROM events GROUP BY event_type""")
def series_mean(spark, path):
    out = a.series_stats(table(spark, path, "events"), ["event_type"])
    return out.select("event_type", F.round("mean", 6).alias("mean"), "min", "max")


@query("f04_sample_std", """
SELECT l_returnflag, round(stddev_samp(l_discount), 8) AS std, count(l_discount) AS count
FROM lineitem GROUP BY l_returnflag""")
def sample_std(spark, path):
    out = a.series_stats(table(spark, path, "lineitem"), ["l_returnflag"], "l_discount")
    return out.select("l_returnflag", F.round("std", 8).alias("std"), "count")


@query("f05_group_std_per_row", f"""
WITH {DAILY_SQL},
g AS (SELECT k, date, value, CASE WHEN month(date) <> 5 THEN strftime(date, '%Y-%m') END AS ym
      FROM daily)
SELECT k, date, CASE WHEN ym IS NOT NULL THEN
       round(stddev_samp(value) OVER (PARTITION BY k, ym), 5) END AS volatility FROM g""")
def group_std_per_row(spark, path):
    """Rows of one month of the year have no group."""
    ym = F.when(F.month("date") != 5, F.date_format("date", "yyyy-MM"))
    out = group_std(daily(spark, path).withColumn("ym", ym), "value", ["k", "ym"])
    return out.select("k", "date", F.round("volatility", 5).alias("volatility"))


@query("f06_describe", """
WITH long AS (
  SELECT 'l_quantity' AS "column", l_quantity AS v FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT 'l_linenumber', l_linenumber FROM lineitem)
SELECT "column", count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 5) AS std,
       min(v) AS min, round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
       round(quantile_cont(v, 0.75), 6) AS q75, max(v) AS max
FROM long GROUP BY 1""")
def describe(spark, path):
    """Exact quartiles by ranks over counted values."""
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"]
    out = a.describe(table(spark, path, "lineitem").select(*columns))
    digits = {"mean": 6, "std": 5, "q25": 6, "q50": 6, "q75": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("f07_counts", """
SELECT count(*) AS rows, count(CASE WHEN o_totalprice < 10000 OR o_totalprice > 400000 THEN 1 END)
       AS out_of_range, count(DISTINCT o_custkey) AS customers FROM orders""")
def counts(spark, path):
    price = F.col("o_totalprice")
    out = a.counts(table(spark, path, "orders"), "o_custkey", (price < 10000) | (price > 400000))
    return out.withColumnsRenamed({"wanted": "out_of_range", "keys": "customers"})


@query("f08_run_summary", """
SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS successes,
       count(*) FILTER (WHERE o_orderstatus <> 'F') AS failures,
       round(100.0 * count(*) FILTER (WHERE o_orderstatus = 'F') / count(*), 6) AS success_rate
FROM orders""")
def run_summary(spark, path):
    report = table(spark, path, "orders").select((F.col("o_orderstatus") == "F").alias("success"))
    out = a.run_summary(report)
    return out.withColumn("success_rate", F.round("success_rate", 6))
