"""The test tables seen as series, in Spark and in SQL.

``orders`` has one series per priority: many rows per day, a mean per day or month. ``events`` has
one series per event type with unique instants.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import period_end
from ..model import Series
from ..operators.aggregates import period_mean

RUN_TS = dt.datetime(2024, 3, 1, 12, 30, 45)
AS_OF = dt.date(2001, 8, 31)

RAW = Series(keys=("k",), tie=("t",))
DAILY = Series(keys=("k",), grain="D")
MONTHLY = Series(keys=("k",), grain="M")
EVENTS = Series(keys=("event_type",), date="ts", tie=("event_id",))


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def observations(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "orders").select(
        F.col("o_orderpriority").alias("k"), F.col("o_orderdate").cast("date").alias("date"),
        F.col("o_orderkey").alias("t"), F.col("o_totalprice").alias("value"),
    )


def daily(spark: SparkSession, path: str) -> DataFrame:
    """Daily means, where the 7th of a month is a gap (a row without a value)."""
    means = period_mean(observations(spark, path), RAW, "D").drop("period")
    return means.withColumn("value", F.when(F.dayofmonth("date") != 7, F.col("value")))


def monthly(spark: SparkSession, path: str) -> DataFrame:
    return period_mean(observations(spark, path), RAW, "M").drop("year_month")


def month_ends(spark: SparkSession, path: str) -> DataFrame:
    """Monthly means dated by the last day of the month."""
    return monthly(spark, path).withColumn("date", period_end(F.col("date"), "M"))


def events(spark: SparkSession, path: str) -> DataFrame:
    return table(spark, path, "events").select("event_type", "ts", "event_id", "value")


def chunk_count(spark: SparkSession) -> int:
    """As many chunks as the session has shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


OBSERVATIONS_SQL = """
obs AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS date, o_orderkey AS t,
               o_totalprice AS value FROM orders)"""

DAILY_SQL = f"""{OBSERVATIONS_SQL},
day_means AS (SELECT k, date, avg(value) AS v FROM obs GROUP BY k, date),
daily AS (SELECT k, date, CASE WHEN day(date) <> 7 THEN v END AS value FROM day_means)"""

MONTHLY_SQL = f"""{OBSERVATIONS_SQL},
monthly AS (SELECT k, max(date) AS date, avg(value) AS value FROM obs
            GROUP BY k, strftime(date, '%Y-%m'))"""

# Priorities played as indicators.
INDICATOR_OF = {
    "1-URGENT": "ipca", "2-HIGH": "selic", "3-MEDIUM": "pib", "4-NOT SPECIFIED": "cambio",
    "5-LOW": "desemprego",
}

_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in INDICATOR_OF.items())
INDICATOR_SQL = f"CASE k {_CASES} END"


def indicator_name(k):
    name = F.lit(None).cast("string")
    for priority, indicator in INDICATOR_OF.items():
        name = F.when(k == priority, indicator).otherwise(name)
    return name


def bronze(spark: SparkSession, path: str) -> DataFrame:
    """Orders as landed bronze rows: text dates and text values, one place per customer order."""
    return observations(spark, path).select(
        F.lit("bcb").alias("source"), F.date_format("date", "dd/MM/yyyy").alias("data"),
        F.col("value").cast("string").alias("valor"), "t",
        indicator_name(F.col("k")).alias("indicator"),
    )
