"""Changes, moving statistics, running values: on daily and monthly series and on raw rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..model import Series
from ..operators import windows as w
from ..operators.aggregates import period_mean, period_ohlc
from ..operators.ranges import measure_between
from ..operators.spread import measure
from .inputs import (
    DAILY,
    DAILY_SQL,
    EVENTS,
    MONTHLY,
    MONTHLY_SQL,
    OBSERVATIONS_SQL,
    RAW,
    daily,
    events,
    monthly,
    observations,
)
from .registry import query


def show(df, *columns, digits=6, keep=("k", "date")):
    """Keys and rounded measures; six digits absorb the order of floating-point sums."""
    return df.select(*keep, *(F.round(c, digits).alias(c) for c in columns))


# The padded value of SQL's windows: the last non-null at or before the row.
_PADDED = "last_value(value IGNORE NULLS) OVER (PARTITION BY k ORDER BY date)"


@query("g01_pct_change", f"""
WITH {DAILY_SQL}, p AS (SELECT *, {_PADDED} AS f FROM daily)
SELECT k, date,
       round((f / nullif(lag(f, 1) OVER w, 0) - 1) * 100, 6) AS change_pct,
       round(f / nullif(lag(f, 5) OVER w, 0) - 1, 6) AS pct_change_5
FROM p WINDOW w AS (PARTITION BY k ORDER BY date)""")
def pct_change(spark, path):
    out = measure(daily(spark, path), DAILY,
                  w.percent_change(1, "change_pct", 100), w.percent_change(5))
    return show(out, "change_pct", "pct_change_5")


@query("g01_pct_change_unfilled", f"""
WITH {DAILY_SQL}
SELECT k, date, round((value / nullif(lag(value, 1) OVER w, 0) - 1) * 100, 6) AS change_pct
FROM daily WINDOW w AS (PARTITION BY k ORDER BY date)""")
def pct_change_unfilled(spark, path):
    out = measure(daily(spark, path), DAILY, w.percent_change(1, "change_pct", 100, fill=None))
    return show(out, "change_pct")


@query("g01_pct_change_raw_rows", f"""
WITH {OBSERVATIONS_SQL},
g AS (SELECT k, date, t, CASE WHEN t % 5 <> 0 THEN value END AS value FROM obs),
p AS (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY k ORDER BY date, t) AS f FROM g)
SELECT k, date, t, round((f / nullif(lag(f, 3) OVER w, 0) - 1) * 100, 6) AS change_pct
FROM p WINDOW w AS (PARTITION BY k ORDER BY date, t)""")
def pct_change_raw_rows(spark, path):
    df = observations(spark, path).withColumn("value", F.when(F.col("t") % 5 != 0, F.col("value")))
    out = measure(df, RAW, w.percent_change(3, "change_pct", 100))
    return show(out, "change_pct", keep=("k", "date", "t"))


@query("g02_difference", f"""
WITH {DAILY_SQL}
SELECT k, date, round((value - lag(value, 1) OVER w) * 100, 6) AS change_bps,
       round(value - lag(value, 4) OVER w, 6) AS diff_4
FROM daily WINDOW w AS (PARTITION BY k ORDER BY date)""")
def difference(spark, path):
    out = measure(daily(spark, path), DAILY, w.difference(1, "change_bps", 100), w.difference(4))
    return show(out, "change_bps", "diff_4")


@query("g02_difference_raw_rows", """
SELECT event_type, ts, event_id, round(value - lag(value, 7) OVER w, 6) AS diff_7
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def difference_raw_rows(spark, path):
    out = measure(events(spark, path), EVENTS, w.difference(7))
    return show(out, "diff_7", keep=("event_type", "ts", "event_id"))


@query("g03_year_over_year", f"""
WITH {MONTHLY_SQL}
SELECT k, date,
       round((value / nullif(lag(value, 12) OVER w, 0) - 1) * 100, 6) AS year_over_year_pct
FROM monthly WINDOW w AS (PARTITION BY k ORDER BY date)""")
def year_over_year(spark, path):
    out = measure(monthly(spark, path), MONTHLY, w.year_over_year(12, "year_over_year_pct", 100))
    return show(out, "year_over_year_pct")


@query("g04_variations", f"""
WITH {MONTHLY_SQL}
SELECT k, date,
       round((value / nullif(lag(value, 1) OVER w, 0) - 1) * 100, 6) AS monthly_change_pct,
       round((value / nullif(lag(value, 12) OVER w, 0) - 1) * 100, 6) AS year_over_year_pct,
       round(value - lag(value, 1) OVER w, 5) AS diff_1,
       round(value - lag(value, 4) OVER w, 5) AS diff_4
FROM monthly WINDOW w AS (PARTITION BY k ORDER BY date)""")
def variations(spark, path):
    specs = (*w.DEFAULT_VARIATIONS, ("diff", 1, None, 1.0), ("diff", 4, None, 1.0))
    out = w.variations(monthly(spark, path), MONTHLY, specs)
    return out.select(
        "k", "date", F.round("monthly_change_pct", 6).alias("monthly_change_pct"),
        F.round("year_over_year_pct", 6).alias("year_over_year_pct"),
        F.round("diff_1", 5).alias("diff_1"), F.round("diff_4", 5).alias("diff_4"),
    )


@query("g04_last_year_only", f"""
WITH {MONTHLY_SQL}, v AS (
  SELECT k, date, value, (value / nullif(lag(value, 1) OVER w, 0) - 1) * 100 AS change,
         (value / nullif(lag(value, 12) OVER w, 0) - 1) * 100 AS year, avg(value) OVER w6 AS average
  FROM monthly WINDOW w AS (PARTITION BY k ORDER BY date), w6 AS (PARTITION BY k ORDER BY date ROWS 5 PRECEDING))
SELECT k, date, round(value, 6) AS value, round(change, 6) AS monthly_change_pct, round(year, 6) AS year_over_year_pct,
       round(average, 4) AS moving_avg_6
FROM v WHERE date >= DATE '2000-09-01'""")
def last_year_only(spark, path):
    """The last months of the orders, which read one year more than they show."""
    measures = (w.percent_change(1, "monthly_change_pct", 100), w.year_over_year(12, "year_over_year_pct", 100), w.moving_average(6))
    out = measure_between(
        observations(spark, path), MONTHLY, *measures, start=dt.date(2000, 9, 1),
        reduce=lambda rows: period_mean(rows, RAW, "M").drop("year_month"))
    out = show(out, "value", "monthly_change_pct", "year_over_year_pct", keep=("k", "date", "moving_avg_6"))
    return out.withColumn("moving_avg_6", F.round("moving_avg_6", 4))


@query("g05_moving_average", f"""
WITH {DAILY_SQL}
SELECT k, date,
       round(CASE WHEN count(value) OVER w3 = 3 THEN avg(value) OVER w3 END, 6) AS moving_avg_3,
       round(CASE WHEN count(value) OVER w20 = 20 THEN avg(value) OVER w20 END, 6) AS ma_20
FROM daily
WINDOW w3 AS (PARTITION BY k ORDER BY date ROWS 2 PRECEDING),
       w20 AS (PARTITION BY k ORDER BY date ROWS 19 PRECEDING)""")
def moving_average(spark, path):
    out = measure(daily(spark, path), DAILY, w.moving_average(3), w.moving_average(20, "ma_20"))
    return show(out, "moving_avg_3", "ma_20")


@query("g05_moving_average_raw_rows", """
SELECT event_type, ts, event_id,
       round(CASE WHEN count(value) OVER w = 10 THEN avg(value) OVER w END, 6) AS moving_avg_10
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 9 PRECEDING)""")
def moving_average_raw_rows(spark, path):
    out = measure(events(spark, path), EVENTS, w.moving_average(10))
    return show(out, "moving_avg_10", keep=("event_type", "ts", "event_id"))


@query("g05_window_of_500_rows", """
SELECT event_type, ts, event_id,
       round(CASE WHEN count(value) OVER w = 500 THEN avg(value) OVER w END, 6) AS mean_500,
       round(sum(value) OVER w, 3) AS sum_500,
       round(CASE WHEN count(value) OVER w = 500 THEN stddev_samp(value) OVER w END, 5) AS std_500
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 499 PRECEDING)""")
def window_of_500_rows(spark, path):
    """Wide windows cost as much per row as narrow ones."""
    out = measure(events(spark, path), EVENTS, w.moving_average(500, "mean_500"),
                  w.moving_sum(500, "sum_500", min_periods=1), w.moving_std(500, "std_500"))
    digits = {"mean_500": 6, "sum_500": 3, "std_500": 5}
    return out.select("event_type", "ts", "event_id", *(F.round(c, n).alias(c) for c, n in digits.items()))


@query("g06_moving_average_partial", f"""
WITH {DAILY_SQL}
SELECT k, date, round(avg(value) OVER (PARTITION BY k ORDER BY date ROWS 5 PRECEDING), 6) AS ma_6
FROM daily""")
def moving_average_partial(spark, path):
    out = measure(daily(spark, path), DAILY, w.moving_average(6, "ma_6", min_periods=1))
    return show(out, "ma_6")


@query("g07_moving_sum", f"""
WITH {MONTHLY_SQL}
SELECT k, date, round(CASE WHEN count(value) OVER w = 4 THEN sum(value) OVER w END, 5)
       AS accumulated_value
FROM monthly WINDOW w AS (PARTITION BY k ORDER BY date ROWS 3 PRECEDING)""")
def moving_sum(spark, path):
    out = measure(monthly(spark, path), MONTHLY, w.moving_sum(4, "accumulated_value"))
    return show(out, "accumulated_value", digits=5)


@query("g08_moving_std", f"""
WITH {DAILY_SQL}
SELECT k, date, round(CASE WHEN count(value) OVER w = 20 THEN stddev_samp(value) OVER w END, 5)
       AS volatility_20
FROM daily WINDOW w AS (PARTITION BY k ORDER BY date ROWS 19 PRECEDING)""")
def moving_std(spark, path):
    out = measure(daily(spark, path), DAILY, w.moving_std(20))
    return show(out, "volatility_20", digits=5)


@query("g08_moving_std_raw_rows", """
SELECT event_type, ts, event_id,
       round(CASE WHEN count(value) OVER w = 20 THEN stddev_samp(value) OVER w END, 6)
       AS volatility_20
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 19 PRECEDING)""")
def moving_std_raw_rows(spark, path):
    out = measure(events(spark, path), EVENTS, w.moving_std(20))
    return show(out, "volatility_20", keep=("event_type", "ts", "event_id"))


@query("g09_volatility_by_group", """
SELECT event_id, event_type,
       round(stddev_samp(value) OVER (PARTITION BY event_type, CAST(ts AS DATE)), 6) AS volatility
FROM events""")
def volatility_by_group(spark, path):
    df = events(spark, path).withColumn("day", F.to_date("ts"))
    out = w.volatility(df, EVENTS, group=("day",))
    return show(out, "volatility", keep=("event_id", "event_type"))


@query("g09_volatility_overall", """
SELECT event_id, event_type,
       round(stddev_samp(value) OVER (PARTITION BY event_type), 6) AS volatility
FROM events""")
def volatility_overall(spark, path):
    out = w.volatility(events(spark, path), EVENTS)
    return show(out, "volatility", keep=("event_id", "event_type"))


@query("g09_volatility_rolling", f"""
WITH {MONTHLY_SQL}
SELECT k, date, round(CASE WHEN count(value) OVER w = 6 THEN stddev_samp(value) OVER w END, 5)
       AS volatility
FROM monthly WINDOW w AS (PARTITION BY k ORDER BY date ROWS 5 PRECEDING)""")
def volatility_rolling(spark, path):
    out = w.volatility(monthly(spark, path), MONTHLY, window=6)
    return show(out, "volatility", digits=5)


@query("g10_cumulative_by_group", f"""
WITH {OBSERVATIONS_SQL},
g AS (SELECT k, date, t, CASE WHEN t % 5 <> 0 THEN value END AS value FROM obs)
SELECT k, date, t, round(CASE WHEN value IS NOT NULL AND year(date) <> 1996 THEN
       sum(value) OVER (PARTITION BY k, year(date) ORDER BY date, t) END, 2) AS cumulative_value
FROM g""")
def cumulative_by_group(spark, path):
    """One year has no name and so makes no group."""
    df = observations(spark, path).withColumns({
        "year": F.when(F.year("date") != 1996, F.year("date")),
        "value": F.when(F.col("t") % 5 != 0, F.col("value")),
    })
    out = w.cumulative(df, RAW, group=("year",))
    return show(out, "cumulative_value", digits=2, keep=("k", "date", "t"))


@query("g10_cumulative_global", f"""
WITH {OBSERVATIONS_SQL}
SELECT k, date, t, round(sum(value) OVER (ORDER BY date, t ROWS UNBOUNDED PRECEDING), 2)
       AS cumulative_value
FROM obs""")
def cumulative_global(spark, path):
    """One series over the whole table."""
    out = w.cumulative(observations(spark, path), Series(tie=("t",)))
    return show(out, "cumulative_value", digits=2, keep=("k", "date", "t"))


@query("g11_year_to_date_percent", f"""
WITH {DAILY_SQL}
SELECT k, date, round((value / nullif(first_value(value) OVER w, 0) - 1) * 100, 6)
       AS year_to_date_pct
FROM daily WINDOW w AS (PARTITION BY k, year(date) ORDER BY date)""")
def year_to_date_percent(spark, path):
    out = w.year_to_date_percent(daily(spark, path), DAILY)
    return show(out, "year_to_date_pct")


@query("g11_year_to_date_percent_raw_rows", f"""
WITH {OBSERVATIONS_SQL}
SELECT k, date, t, round((value / nullif(first_value(value) OVER w, 0) - 1) * 100, 5)
       AS year_to_date_pct
FROM obs WINDOW w AS (PARTITION BY k, year(date) ORDER BY date, t)""")
def year_to_date_percent_raw_rows(spark, path):
    out = w.year_to_date_percent(observations(spark, path), RAW)
    return show(out, "year_to_date_pct", digits=5, keep=("k", "date", "t"))


@query("g12_year_to_date_sum", f"""
WITH {OBSERVATIONS_SQL}
SELECT k, date, t, round(sum(value) OVER (PARTITION BY k, year(date) ORDER BY date), 2)
       AS ytd_accumulated
FROM obs""")
def year_to_date_sum(spark, path):
    """Rows of one day share the day's total, hence the raw rows."""
    out = w.year_to_date_sum(observations(spark, path), RAW)
    return show(out, "ytd_accumulated", digits=2, keep=("k", "date", "t"))


_FINANCIAL = """
       round((close / nullif(lag(close, 1) OVER w, 0) - 1) * 100, 6) AS return_pct,
       round(CASE WHEN count(close) OVER w20 = 20 THEN stddev_samp(close) OVER w20 END, 5)
         AS volatility_20,
       round((high - low) / nullif(low, 0) * 100, 6) AS amplitude_pct,
       round(CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END, 5) AS ma_20,
       round(CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END, 5) AS ma_50,
       CAST(CASE WHEN count(close) OVER w50 = 50
                  AND avg(close) OVER w20 > avg(close) OVER w50 THEN 1 ELSE -1 END AS INTEGER)
         AS ma_cross_signal"""


@query("g13_financial_metrics", f"""
WITH {OBSERVATIONS_SQL},
bars AS (SELECT k, date, arg_max(value, t) AS close, max(value) AS high, min(value) AS low
         FROM obs GROUP BY k, date)
SELECT k, date, {_FINANCIAL}
FROM bars
WINDOW w AS (PARTITION BY k ORDER BY date),
       w20 AS (PARTITION BY k ORDER BY date ROWS 19 PRECEDING),
       w50 AS (PARTITION BY k ORDER BY date ROWS 49 PRECEDING)""")
def financial_metrics(spark, path):
    bars = period_ohlc(observations(spark, path), RAW, "D")
    out = w.financial_metrics(bars, DAILY.but(value="close"))
    return out.select(
        "k", "date", F.round("return_pct", 6).alias("return_pct"),
        F.round("volatility_20", 5).alias("volatility_20"),
        F.round("amplitude_pct", 6).alias("amplitude_pct"), F.round("ma_20", 5).alias("ma_20"),
        F.round("ma_50", 5).alias("ma_50"), "ma_cross_signal",
    )


@query("g13_financial_metrics_raw_rows", """
WITH bars AS (SELECT event_type, ts, event_id, value AS close, value * 1.25 AS high,
                     value * 0.75 AS low FROM events)
SELECT event_type, ts, event_id,""" + _FINANCIAL + """
FROM bars
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
       w20 AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 19 PRECEDING),
       w50 AS (PARTITION BY event_type ORDER BY ts, event_id ROWS 49 PRECEDING)""")
def financial_metrics_raw_rows(spark, path):
    value = F.col("value")
    bars = events(spark, path).select(
        "event_type", "ts", "event_id", value.alias("close"), (value * 1.25).alias("high"),
        (value * 0.75).alias("low"),
    )
    out = w.financial_metrics(bars, EVENTS.but(value="close"))
    return out.select(
        "event_type", "ts", "event_id", F.round("return_pct", 6).alias("return_pct"),
        F.round("volatility_20", 5).alias("volatility_20"),
        F.round("amplitude_pct", 6).alias("amplitude_pct"), F.round("ma_20", 5).alias("ma_20"),
        F.round("ma_50", 5).alias("ma_50"), "ma_cross_signal",
    )


@query("g14_crossover_signal", f"""
WITH {MONTHLY_SQL}
SELECT k, date, CAST(CASE WHEN count(value) OVER w9 = 9
       AND avg(value) OVER w3 > avg(value) OVER w9 THEN 1 ELSE -1 END AS INTEGER) AS signal
FROM monthly
WINDOW w3 AS (PARTITION BY k ORDER BY date ROWS 2 PRECEDING),
       w9 AS (PARTITION BY k ORDER BY date ROWS 8 PRECEDING)""")
def crossover(spark, path):
    out = measure(monthly(spark, path), MONTHLY, w.moving_average(3, "f"), w.moving_average(9, "s"))
    return out.select("k", "date", w.crossover_signal(F.col("f"), F.col("s")).alias("signal"))


@query("g15_shift", f"""
WITH {MONTHLY_SQL}
SELECT k, date, round(lag(value, 1) OVER (PARTITION BY k ORDER BY date), 7) AS previous
FROM monthly""")
def shift(spark, path):
    return show(measure(monthly(spark, path), MONTHLY, w.shift(1, "previous")), "previous",
                digits=7)


@query("g16_change_since_nth", """
WITH r AS (SELECT event_type, value,
                  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n
           FROM events)
SELECT event_type, round((max(CASE WHEN n = 1 THEN value END)
       / CASE WHEN max(CASE WHEN n = 13 THEN value END) > 0
              THEN max(CASE WHEN n = 13 THEN value END) END - 1) * 100, 6) AS annual_change
FROM r GROUP BY event_type""")
def change_since(spark, path):
    out = w.change_since(events(spark, path), EVENTS, 12)
    return show(out, "annual_change", keep=("event_type",))


@query("g17_trend", f"""
WITH {OBSERVATIONS_SQL},
r AS (SELECT k, value, row_number() OVER (PARTITION BY k ORDER BY date DESC, t DESC) AS n FROM obs),
e AS (SELECT k, max(CASE WHEN n = 1 THEN value END) AS a, max(CASE WHEN n = 3 THEN value END) AS b,
             count(*) AS c FROM r WHERE n <= 3 GROUP BY k)
SELECT k, CASE WHEN c >= 3 THEN CASE WHEN a > b THEN 'rising' WHEN a < b THEN 'falling'
       ELSE 'stable' END END AS trend
FROM e""")
def trend(spark, path):
    return w.trend(observations(spark, path), RAW)


@query("g18_min_max_scale", """
WITH r AS (SELECT min(value) AS low, max(value) AS high FROM events)
SELECT event_id, round(CASE WHEN high > low THEN (value - low) / (high - low) * 100 ELSE value END,
       6) AS scaled
FROM events, r""")
def min_max(spark, path):
    out = w.min_max_scale(events(spark, path), "value", column="scaled")
    return show(out, "scaled", keep=("event_id",))


@query("g18_min_max_scale_per_series", """
WITH r AS (SELECT event_type, min(value) AS low, max(value) AS high FROM events GROUP BY 1)
SELECT event_id, e.event_type,
       round(CASE WHEN high > low THEN (value - low) / (high - low) * 100 ELSE value END, 6)
       AS scaled
FROM events e JOIN r ON e.event_type = r.event_type""")
def min_max_per_series(spark, path):
    out = w.min_max_scale(events(spark, path), "value", ["event_type"], column="scaled")
    return show(out, "scaled", keep=("event_id", "event_type"))
