"""Sorts, limits, appends and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import clamp, rounded, year_quarter
from ..operators import compose, joins
from ..operators import windows as w
from ..operators.cleaning import head
from .inputs import DAILY_SQL, EVENTS, OBSERVATIONS_SQL, daily, events, observations, table
from .registry import query


@query("h01_sort_nulls_last", f"""
WITH {DAILY_SQL}
SELECT k, date, round(value, 6) AS value FROM daily ORDER BY value ASC NULLS LAST, k, date""")
def sort_nulls_last(spark, path):
    df = daily(spark, path).withColumn("value", F.round("value", 6))
    return df.orderBy(F.col("value").asc_nulls_last(), "k", "date")


@query("h02_latest_row", """
SELECT event_type, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n
  FROM events) WHERE n = 1""")
def latest_row(spark, path):
    return w.latest_row(events(spark, path), EVENTS)


@query("h03_amplitude", """
SELECT event_type, CAST(ts AS DATE) AS date,
       round((max(value) - min(value)) / nullif(min(value), 0) * 100, 5) AS amplitude_pct
FROM events GROUP BY 1, 2""")
def amplitude(spark, path):
    days = events(spark, path).groupBy("event_type", F.to_date("ts").alias("date")).agg(
        F.max("value").alias("high"), F.min("value").alias("low")
    )
    pct = F.round(w.amplitude(F.col("high"), F.col("low")), 5).alias("amplitude_pct")
    return days.select("event_type", "date", pct)


@query("h04_head", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5""")
def first_rows(spark, path):
    df = table(spark, path, "orders").select("o_orderkey", "o_totalprice")
    return head(df, 5, "o_totalprice", "o_orderkey")


@query("h05_append", """
SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def append(spark, path):
    customers = table(spark, path, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, path, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id")
    )
    return joins.append(customers, suppliers)


@query("h06_rounding", """
SELECT event_id, round(value / 7, 2) AS two, round(value / 7, 0) AS zero, round(value / 7, 4) AS four
FROM events""")
def rounding(spark, path):
    seventh = F.col("value") / 7
    digits = {"two": 2, "zero": 0, "four": 4}
    return table(spark, path, "events").select(
        "event_id", *(rounded(seventh, d).alias(c) for c, d in digits.items())
    )


@query("h07_clamp", f"""
WITH {DAILY_SQL}
SELECT k, date, CASE WHEN value IS NOT NULL THEN
       round(least(greatest(value / 7 - 30000, 0), 100), 8) END AS score FROM daily""")
def clamped(spark, path):
    score = clamp(F.col("value") / 7 - 30000, 0, 100)
    return daily(spark, path).select("k", "date", F.round(score, 8).alias("score"))


@query("h08_situation_label", """
SELECT event_id, CASE WHEN value < 35 THEN 'excelente' WHEN value < 45 THEN 'boa'
       WHEN value < 55 THEN 'estável' WHEN value < 70 THEN 'desafiadora' ELSE 'crítica' END
       AS situation FROM events""")
def situation_label(spark, path):
    label = compose.label_below(F.col("value")).alias("situation")
    return table(spark, path, "events").select("event_id", label)


@query("h09_weighted_mean", """
SELECT user_id, round(sum(value * w) FILTER (w IS NOT NULL) / sum(w), 6) AS score
FROM (SELECT user_id, value, CASE event_type WHEN 'click' THEN 0.35 WHEN 'view' THEN 0.3
      WHEN 'purchase' THEN 0.35 END AS w FROM events) GROUP BY user_id""")
def weighted_mean(spark, path):
    kind = F.col("event_type")
    weight = F.when(kind == "click", 0.35).when(kind == "view", 0.3).when(kind == "purchase", 0.35)
    rows = table(spark, path, "events").withColumn("w", weight)
    score = compose.weighted_mean(F.col("value"), F.col("w"), F.col("w").isNotNull())
    return rows.groupBy("user_id").agg(F.round(score, 6).alias("score"))


@query("h10_ratio_to_mean", """
SELECT user_id, round(CASE WHEN avg(value - 60) > 0 THEN max(value) / avg(value - 60) ELSE 1.0 END,
       5) AS ratio FROM events GROUP BY user_id""")
def ratio_to_mean(spark, path):
    ratio = compose.ratio_to_mean(F.max("value"), F.avg(F.col("value") - 60))
    return table(spark, path, "events").groupBy("user_id").agg(F.round(ratio, 5).alias("ratio"))


@query("h11_linear_combination", """
SELECT event_id, round(0.4 * value + 0.3 * user_id - 0.3 * event_id, 6) AS mix FROM events""")
def linear_combination(spark, path):
    mix = compose.linear_combination(
        (0.4, F.col("value")), (0.3, F.col("user_id")), (-0.3, F.col("event_id"))
    )
    return table(spark, path, "events").select("event_id", F.round(mix, 6).alias("mix"))


@query("h12_conditional_division", """
SELECT event_id, round(-(value / nullif(user_id % 7, 0) * 100) / nullif(user_id % 5, 0), 6) AS elasticity
FROM events""")
def conditional_division(spark, path):
    rest = lambda n: (F.col("user_id") % n).cast("double")
    ratio = compose.elasticity(F.col("value"), rest(7), rest(5))
    return table(spark, path, "events").select("event_id", F.round(ratio, 6).alias("elasticity"))


@query("h13_string_helpers", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, year(date)::VARCHAR || 'Q' || quarter(date)::VARCHAR AS label,
       split_part(k, '-', 2) AS tail, contains(lower(k), 'urg') AS urgent, upper(k) AS upper,
       replace(k, '-', '.') AS dotted FROM obs""")
def string_helpers(spark, path):
    k = F.col("k")
    return observations(spark, path).select(
        "t", year_quarter(F.col("date")).alias("label"),
        F.split_part(k, F.lit("-"), F.lit(2)).alias("tail"),
        F.lower(k).contains("urg").alias("urgent"), F.upper(k).alias("upper"),
        F.replace(k, F.lit("-"), F.lit(".")).alias("dotted"),
    )


@query("h14_default_text", """
SELECT event_id, coalesce(CASE WHEN event_id % 3 <> 0 THEN 'BRL' END, '%') AS unit,
       coalesce(CASE WHEN event_id % 4 <> 0 THEN event_type END, upper(event_type)) AS name
FROM events""")
def default_text(spark, path):
    n, kind = F.col("event_id"), F.col("event_type")
    return table(spark, path, "events").select(
        "event_id", compose.default_text(F.when(n % 3 != 0, "BRL"), "%").alias("unit"),
        compose.default_text(F.when(n % 4 != 0, kind), F.upper(kind)).alias("name"),
    )
