"""Date features, named windows and resampling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import date_to_period, period_to_date
from ..operators import calendar as cal
from .inputs import EVENTS, OBSERVATIONS_SQL, RAW, events, observations, table
from .registry import query


@query("d01_date_features", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%Y-%m') AS year_month,
       year(date)::VARCHAR || 'Q' || quarter(date)::VARCHAR AS year_quarter
FROM obs""")
def date_features(spark, path):
    return cal.date_features(observations(spark, path)).drop("k", "date", "value")


@query("d02_named_windows", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, CASE WHEN date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' THEN 'crisis'
               WHEN date BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' THEN 'plan'
               ELSE 'other' END AS time_window
FROM obs""")
def named_windows(spark, path):
    """The ranges overlap; the later entry wins."""
    windows = [
        (dt.date(1996, 1, 1), dt.date(1998, 6, 30), "plan"),
        (dt.date(1998, 1, 1), dt.date(1998, 12, 31), "crisis"),
    ]
    return cal.named_windows(observations(spark, path), windows).select("t", "time_window")


@query("d02_windows_from_table", f"""
WITH {OBSERVATIONS_SQL},
r AS (SELECT DATE '1992-01-01' + CAST(c_custkey * 37 % 3300 AS INTEGER) AS s, c_custkey * 13 % 90 AS n, c_name, c_custkey FROM customer),
days AS (SELECT DISTINCT date FROM obs),
best AS (SELECT date, arg_max(c_name, c_custkey) AS name FROM days JOIN r ON date BETWEEN s AND s + CAST(n AS INTEGER) GROUP BY date)
SELECT t, coalesce(name, 'other') AS time_window FROM obs LEFT JOIN best USING (date)""")
def windows_from_table(spark, path):
    """Every customer has a range of up to three months; the later customer wins."""
    start = F.date_add(F.lit(dt.date(1992, 1, 1)), (F.col("c_custkey") * 37 % 3300).cast("int"))
    ranges = table(spark, path, "customer").select(
        start.alias("start"), F.date_add(start, (F.col("c_custkey") * 13 % 90).cast("int")).alias("end"),
        F.col("c_name").alias("name"), F.col("c_custkey").alias("priority"))
    return cal.windows_from_table(observations(spark, path), ranges).select("t", "time_window")


_ENDS = {
    "D": "s", "W": "s + 6", "M": "CAST(s + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE)",
    "Q": "CAST(s + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)",
    "Y": "CAST(s + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE)",
}
_UNITS = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
_STEPS = {"D": "1 DAY", "W": "7 DAY", "M": "1 MONTH", "Q": "3 MONTH", "Y": "1 YEAR"}


def _resample_sql(freq: str, aggregate: str, empty: str = "NULL") -> str:
    """Orders of two years, so that daily and weekly gaps occur."""
    start = f"CAST(date_trunc('{_UNITS[freq]}', date) AS DATE)"
    return f"""
WITH {OBSERVATIONS_SQL},
p AS (SELECT k, {start} AS s, {aggregate} AS v FROM obs GROUP BY 1, 2),
ends AS (SELECT k, min(s) AS a, max(s) AS b FROM p GROUP BY k),
spine AS (SELECT k, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP),
          INTERVAL {_STEPS[freq]})) AS DATE) AS s FROM ends)
SELECT spine.k, {_ENDS[freq].replace('s', 'spine.s', 1)} AS date,
       round(CASE WHEN p.k IS NULL THEN {empty} ELSE v END, 7) AS value
FROM spine LEFT JOIN p ON p.k = spine.k AND p.s = spine.s"""


def _resample(freq: str, how: str):
    def run(spark, path):
        out = cal.resample(observations(spark, path), RAW, freq, how)
        return out.withColumn("value", F.round("value", 7))

    return run


for _freq, _how, _sql, _empty in (
    ("D", "sum", "sum(value)", "0"), ("D", "last", "arg_max(value, t)", "NULL"),
    ("W", "sum", "sum(value)", "0"), ("W", "max", "max(value)", "NULL"),
    ("M", "mean", "avg(value)", "NULL"), ("M", "last", "arg_max(value, (date, t))", "NULL"),
    ("Q", "min", "min(value)", "NULL"), ("Y", "max", "max(value)", "NULL"),
):
    query(f"d03_resample_{_freq.lower()}_{_how}", _resample_sql(_freq, _sql, _empty))(
        _resample(_freq, _how)
    )


@query("d03_resample_events_daily", """
WITH p AS (SELECT event_type, CAST(ts AS DATE) AS date, avg(value) AS v FROM events GROUP BY 1, 2)
SELECT event_type, date, round(v, 6) AS value FROM p""")
def resample_events(spark, path):
    """Instants to days; every type has an event on every day."""
    out = cal.resample(events(spark, path), EVENTS, "D", "mean")
    return out.select("event_type", F.col("ts").alias("date"), F.round("value", 6).alias("value"))


@query("d04_quarter_key", f"""
WITH {OBSERVATIONS_SQL}
SELECT CAST(date_trunc('quarter', date) AS DATE) AS quarter, count(*) AS n FROM obs GROUP BY 1""")
def quarter_key(spark, path):
    quarter = cal.quarter_key(F.col("date")).alias("quarter")
    return observations(spark, path).groupBy(quarter).agg(F.count(F.lit(1)).alias("n"))


@query("d05_period_to_date", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, CAST(CASE t % 4 WHEN 0 THEN date_trunc('month', date) WHEN 1 THEN
       date_trunc('quarter', date) WHEN 2 THEN date_trunc('year', date) END AS DATE) AS date
FROM obs""")
def period_date(spark, path):
    form, d = F.col("t") % 4, F.col("date")
    period = (
        F.when(form == 0, F.date_format(d, "yyyyMM"))
        .when(form == 1, F.concat(F.year(d), F.lit("Q"), F.quarter(d)))
        .when(form == 2, F.date_format(d, "yyyy")).otherwise("199913")
    )
    frequency = F.when((form == 0) | (form == 3), "monthly").when(form == 1, "quarterly").otherwise("annual")
    return observations(spark, path).select("t", period_to_date(period, frequency).alias("date"))


@query("d06_date_to_period", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, strftime(date, '%Y%m') AS monthly,
       year(date)::VARCHAR || 'Q' || quarter(date)::VARCHAR AS quarterly,
       strftime(date, '%Y') AS annual
FROM obs""")
def date_period(spark, path):
    forms = ("monthly", "quarterly", "annual")
    return observations(spark, path).select(
        "t", *(date_to_period(F.col("date"), f).alias(f) for f in forms)
    )
