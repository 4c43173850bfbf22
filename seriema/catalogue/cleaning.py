"""Row pruning, names and types, duplicates and metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..model import REGISTRY
from ..operators import cleaning as c
from .inputs import AS_OF, INDICATOR_SQL, OBSERVATIONS_SQL, RUN_TS, bronze, observations, table
from .registry import query


@query("b01_select_present", f"""
WITH {OBSERVATIONS_SQL} SELECT date, value AS cambio, t AS cambio_volatility FROM obs""")
def select_present(spark, path):
    return c.select_present(
        observations(spark, path), "date", ("cambio", ["value"]),
        ("cambio_monthly_change", ["monthly_change_pct", "return_pct"]),
        ("cambio_volatility", ["volatility", "t"]),
    )


@query("b02_drop_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def drop_columns(spark, path):
    return c.drop_columns(
        table(spark, path, "orders"), "o_custkey", "o_orderstatus", "o_orderdate",
        "o_orderpriority", "not_there",
    )


def _gaps(spark, path):
    """Every third date and every fourth value missing."""
    return observations(spark, path).select(
        "k", "t", F.when(F.col("t") % 3 != 0, F.col("date")).alias("date"),
        F.when(F.col("t") % 4 != 0, F.col("value")).alias("value"),
    )


_GAPS_SQL = f"""{OBSERVATIONS_SQL},
gaps AS (SELECT k, t, CASE WHEN t % 3 <> 0 THEN date END AS date,
                CASE WHEN t % 4 <> 0 THEN value END AS value FROM obs)"""


@query("b03_drop_incomplete", f"""
WITH {_GAPS_SQL} SELECT * FROM gaps WHERE date IS NOT NULL AND value IS NOT NULL""")
def drop_incomplete(spark, path):
    return c.drop_incomplete(_gaps(spark, path), "date", "value", "not_there")


@query("b04_between_dates", f"""
WITH {OBSERVATIONS_SQL}
SELECT * FROM obs WHERE date BETWEEN DATE '1997-02-01' AND DATE '1998-06-30'""")
def between_dates(spark, path):
    return c.between_dates(
        observations(spark, path), start=dt.date(1997, 2, 1), end=dt.date(1998, 6, 30)
    )


@query("b05_lookback", f"""
WITH {OBSERVATIONS_SQL}
SELECT * FROM obs WHERE date BETWEEN DATE '2001-08-31' - 1098 AND DATE '2001-08-31'""")
def lookback(spark, path):
    return c.lookback(observations(spark, path), AS_OF, months=36)


@query("b06_drop_null_groups", f"""
WITH {_GAPS_SQL}
SELECT date, count(*) AS n FROM gaps WHERE date IS NOT NULL GROUP BY date""")
def drop_null_groups(spark, path):
    kept = c.drop_null_groups(_gaps(spark, path), "date")
    return kept.groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query("c01_rename_present", "SELECT c_custkey AS id, c_acctbal AS value FROM customer")
def rename_present(spark, path):
    df = table(spark, path, "customer").select("c_custkey", "c_acctbal")
    return c.rename_present(df, {"c_custkey": "id", "c_acctbal": "value", "not_there": "x"})


@query("c02_value_column", f"""
WITH {OBSERVATIONS_SQL} SELECT date, value FROM obs""")
def value_column(spark, path):
    df = observations(spark, path).select("date", "value")
    name = c.value_column(df.withColumnRenamed("value", "ipca"))
    return df.withColumnRenamed("value", "ipca").select("date", F.col(name).alias("value"))


@query("c03_ensure_numeric", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE value END
       AS value FROM events""")
def ensure_numeric(spark, path):
    form, value = F.col("event_id") % 6, F.col("value").cast("string")
    text = (
        F.when(form == 0, "n/d").when(form == 1, "NaN").when(form == 2, F.lit("12d"))
        .when(form == 3, F.concat(F.lit(" "), value, F.lit(" "))).otherwise(value)
    )
    df = table(spark, path, "events").select("event_id", text.alias("value"))
    return c.ensure_numeric(df, "value", "not_there")


_TEXT_DATES = """
SELECT t, CASE WHEN t % 6 <> 5 THEN
          CASE WHEN t % 6 = 4 THEN CAST(date_trunc('month', date) AS DATE) ELSE date END END AS date
FROM obs"""


def _text_dates(spark, path, name):
    form, d = F.col("t") % 6, F.col("date")
    text = (
        F.when(form == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(form == 1, F.date_format(d, "yyyy-MM-dd HH:mm:ss"))
        .when(form == 2, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(form == 3, F.date_format(d, "dd/MM/yyyy"))
        .when(form == 4, F.date_format(d, "MM/yyyy"))
        .otherwise(F.lit("32/01/2020"))
    )
    return observations(spark, path).select("t", text.alias(name))


@query("c04_standardize_date", f"WITH {OBSERVATIONS_SQL} {_TEXT_DATES}")
def standardize_date(spark, path):
    return c.standardize_date(_text_dates(spark, path, "data"))


@query("c05_normalize_date", f"""
WITH {OBSERVATIONS_SQL} SELECT t, date AS last_date FROM ({_TEXT_DATES})""")
def normalize_date(spark, path):
    return c.normalize_date(_text_dates(spark, path, "last_date"), "last_date")


@query("c06_parse_date_format", f"""
WITH {OBSERVATIONS_SQL} SELECT t, CASE WHEN t % 6 = 3 THEN date END AS date FROM obs""")
def parse_date_format(spark, path):
    return c.normalize_date(_text_dates(spark, path, "date"), "date", ["dd/MM/yyyy"])


@query("c07_comma_to_number", """
SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events""")
def comma_to_number(spark, path):
    text = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    df = table(spark, path, "events").select(
        "event_id", F.when(F.col("event_id") % 5 != 0, text).otherwise("...").alias("value")
    )
    return c.comma_to_number(df, "value")


def _dedup_sql(direction: str) -> str:
    return f"""
WITH r AS (SELECT user_id, event_type, event_id, value, row_number() OVER (
             PARTITION BY user_id, event_type ORDER BY ts {direction}, event_id {direction}) AS n
           FROM events)
SELECT user_id, event_type, event_id, value FROM r WHERE n = 1"""


def _dedup(spark, path, keep):
    df = table(spark, path, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return c.remove_duplicates(df, ["ts", "event_id"], ["user_id", "event_type"], keep).drop("ts")


@query("c08_duplicates_keep_first", _dedup_sql("ASC"))
def duplicates_first(spark, path):
    return _dedup(spark, path, "first")


@query("c08_duplicates_keep_last", _dedup_sql("DESC"))
def duplicates_last(spark, path):
    return _dedup(spark, path, "last")


@query("c08_duplicates_keep_none", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, min(o_orderkey) AS o_orderkey FROM orders
GROUP BY 1, 2 HAVING count(*) = 1""")
def duplicates_none(spark, path):
    df = table(spark, path, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderkey"
    )
    return c.remove_duplicates(df, ["o_orderkey"], ["o_custkey", "date"], False)


@query("c09_fill_missing", f"""
WITH {_GAPS_SQL}
SELECT k, t, coalesce(date, DATE '1990-01-01') AS date, coalesce(value, -1.0) AS value FROM gaps""")
def fill_missing(spark, path):
    return c.fill_missing(
        _gaps(spark, path), {"value": -1, "date": "1990-01-01", "not_there": 0}
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


REGISTRY_SQL = "registry(source, indicator, indicator_name, unit, frequency) AS (VALUES " + ", ".join(
    "(" + ", ".join(map(_quoted, (s, i, n, u, f))) + ")" for s, i, _, n, u, f in REGISTRY
) + ")"


@query("c10_attach_registry", f"""
WITH {OBSERVATIONS_SQL}, {REGISTRY_SQL},
b AS (SELECT CASE WHEN t % 3 = 0 THEN 'ibge' ELSE 'bcb' END AS source,
             {INDICATOR_SQL} AS indicator, t FROM obs)
SELECT b.source, b.indicator, t, indicator_name, unit, frequency, '2024-03-01 12:30:45' AS collected_at FROM b
LEFT JOIN registry r ON r.source = b.source AND r.indicator = b.indicator""")
def attach_registry(spark, path):
    """A third of the rows carries a source that does not know the indicator."""
    source = F.when(F.col("t") % 3 == 0, "ibge").otherwise("bcb")
    df = bronze(spark, path).select(source.alias("source"), "indicator", "t")
    out = c.attach_registry(df, collected_at=RUN_TS)
    return out.withColumn("collected_at", F.date_format("collected_at", "yyyy-MM-dd HH:mm:ss"))


@query("c11_literal_metadata", f"""
WITH {OBSERVATIONS_SQL} SELECT t, 'x' AS k, 'BRL' AS unit, k AS kept, 'daily' AS frequency FROM obs""")
def literal_metadata(spark, path):
    df = observations(spark, path).select("t", "k", F.col("k").alias("kept"))
    df = c.with_metadata(df, k="x", unit="BRL")
    return c.with_metadata(df, "if_missing", kept="y", frequency="daily")


@query("c12_inspect_sample", """
SELECT event_id, event_type, value FROM events ORDER BY ts, event_id LIMIT 2""")
def inspect_sample(spark, path):
    df = table(spark, path, "events").select("event_id", "event_type", "value", "ts")
    return c.head(df, 2, "ts", "event_id").drop("ts")
