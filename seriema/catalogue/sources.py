"""Readers, payload parsers, sinks and incremental ingest, by round trip in the shared folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import parse_date
from ..session import scratch_path
from ..sources import files, payloads, sinks
from ..streaming.ingest import ingest_new_files
from .inputs import (
    INDICATOR_OF,
    INDICATOR_SQL,
    OBSERVATIONS_SQL,
    RUN_TS,
    bronze,
    observations,
    table,
)
from .registry import query

EARLIER = RUN_TS - dt.timedelta(seconds=1)


def _typed(df):
    return df.select(
        "indicator", parse_date(F.col("data"), ["dd/MM/yyyy"]).alias("date"),
        F.col("valor").try_cast("double").alias("value"), "t",
    )


@query("a01_latest_snapshot", f"""
WITH {OBSERVATIONS_SQL}, b AS (SELECT {INDICATOR_SQL} AS indicator, date, value, t FROM obs)
SELECT * FROM b WHERE indicator NOT IN ('ipca', 'selic') OR year(date) < 2000""")
def latest_snapshot(spark, path):
    """The second snapshot holds two indicators; the others stay at the first."""
    root, rows = scratch_path(spark, "bronze"), bronze(spark, path)
    sinks.write_snapshot(rows, root, EARLIER)
    newer = rows.filter(F.col("indicator").isin("ipca", "selic") & (F.right("data", F.lit(4)) < "2000"))
    sinks.write_snapshot(newer, root, RUN_TS)
    return _typed(files.read_latest(spark, root))


@query("a02_read_parquet", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
GROUP BY o_orderstatus""")
def read_parquet(spark, path):
    df = files.read_parquet(spark, f"{path}/orders.parquet")
    return df.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("a03_read_csv", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, date_trunc('month', date)::DATE AS data, value AS ipca15 FROM obs
WHERE k <> '5-LOW' AND date_trunc('month', date) BETWEEN DATE '1996-02-01' AND DATE '1999-03-01'""")
def read_csv(spark, path):
    """A delivered table: semicolons, Latin-1, MM/yyyy and missing values."""
    file = scratch_path(spark, "table") + ".csv"
    month = F.date_format("date", "MM/yyyy")
    observations(spark, path).select(
        F.when(F.col("k") != "5-LOW", month).otherwise("sem data").alias("Mês/Ano"),
        F.col("value").alias("Variação Mensal (%)"), "t",
    ).write.options(header=True, sep=";", encoding="ISO-8859-1").csv(file)
    landed = files.read_csv(spark, file, sep=";", encoding="ISO-8859-1")
    out = files.indicator_table(
        landed, "ipca15", "Mês/Ano", "Variação Mensal (%)", "MM/yyyy",
        start=dt.date(1996, 2, 1), end=dt.date(1999, 3, 1),
    )
    return out.withColumn("t", F.col("t").cast("long"))


@query("a04_read_by_extension", """
SELECT s_suppkey, s_name, s_acctbal, 'csv' AS fmt FROM supplier
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'parquet' FROM supplier""")
def read_by_extension(spark, path):
    file = scratch_path(spark, "supplier") + ".csv"
    sinks.write_csv(table(spark, path, "supplier"), file)
    columns = ("s_suppkey", "s_name", "s_acctbal")
    text = files.read_any(spark, file).select(
        F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name",
        F.col("s_acctbal").cast("double").alias("s_acctbal"), F.lit("csv").alias("fmt"),
    )
    binary = files.read_any(spark, f"{path}/supplier.parquet").select(
        *columns, F.lit("parquet").alias("fmt")
    )
    return text.unionByName(binary)


@query("a05_flat_payload", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, date AS data, value AS valor FROM obs
UNION ALL SELECT t, NULL, NULL FROM obs""")
def flat_payload(spark, path):
    landed = observations(spark, path).select("t", F.to_json(F.array(
        F.struct(F.date_format("date", "dd/MM/yyyy").alias("data"),
                 F.col("value").cast("string").alias("valor")),
        F.struct(F.lit("31/02/2020").alias("data"), F.lit("n/d").alias("valor")),
    )).alias("payload"))
    return payloads.parse_flat(landed, keep=("t",))


@query("a06_sidra_payload", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, CAST(date_trunc(CASE WHEN t % 4 < 2 THEN 'month' ELSE 'quarter' END, date) AS DATE)
       AS data, value AS valor, CASE WHEN t % 3 = 2 THEN 'Brasil' ELSE k END AS localidade
FROM obs""")
def sidra_payload(spark, path):
    """List form, object form, and a series without a place; comma decimals."""
    monthly = F.col("t") % 4 < 2
    period = F.when(monthly, F.date_format("date", "yyyyMM")).otherwise(
        F.concat(F.year("date"), F.lit("Q"), F.quarter("date"))
    )
    value = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    place = F.struct(F.lit("1").alias("id"), F.col("k").alias("nome"))
    listed = F.array(F.struct(period.alias("periodo"), value.alias("valor"))).alias("serie")
    keyed = F.create_map(period, F.struct(period.alias("data"), value.alias("valor")))

    def document(*fields):
        series = F.array(F.struct(*fields)).alias("series")
        results = F.array(F.struct(series)).alias("resultados")
        return F.to_json(F.array(F.struct(F.lit("63").alias("id"), results)))

    payload = (
        F.when(F.col("t") % 3 == 0, document(place.alias("localidade"), listed))
        .when(F.col("t") % 3 == 1, document(place.alias("localidade"), keyed.alias("serie")))
        .otherwise(document(listed))
    )
    landed = observations(spark, path).select(
        "t", payload.alias("payload"),
        F.when(monthly, "monthly").otherwise("quarterly").alias("frequency"),
    )
    return payloads.parse_sidra(landed, keep=("t",))


def _pnad_landing(spark, path):
    year, quarter, form = F.year("date"), F.quarter("date"), F.col("t") % 3
    period = (
        F.when(form == 0, F.concat(year, quarter))
        .when(form == 1, F.concat(year, F.lit("0"), quarter))
        .otherwise(F.concat(year, F.lit("Q"), quarter))
    )

    def entry(name, value):
        values = F.array(F.struct(value.cast("string").alias("valor")))
        return F.struct(name.alias("nome"), values.alias("valoresDeReferencia"))

    rate_name = F.when(F.col("t") % 5 != 0, "Taxa de DESOCUPAÇÃO").otherwise("Rendimento")
    payload = F.to_json(F.array(
        entry(F.lit("População"), F.lit(1)), entry(rate_name, F.col("value")),
        entry(rate_name, F.lit(2)),
    ))
    return observations(spark, path).select(
        "t", period.alias("period_id"), payload.alias("payload")
    )


_PNAD_SQL = f"""
WITH {OBSERVATIONS_SQL}
SELECT t, CAST(date_trunc('quarter', date) AS DATE) AS data, value AS pnad,
       year(date)::VARCHAR || CASE t % 3 WHEN 0 THEN '' WHEN 1 THEN '0' ELSE 'Q' END
       || quarter(date)::VARCHAR AS period_id
FROM obs WHERE t % 5 <> 0"""


@query("a07_pnad_payload", _PNAD_SQL)
def pnad_payload(spark, path):
    return payloads.parse_pnad(_pnad_landing(spark, path), keep=("t",))


@query("a08_periods_between", f"""
SELECT * FROM ({_PNAD_SQL}) WHERE data BETWEEN DATE '1996-04-01' AND DATE '1998-07-01'""")
def periods_between(spark, path):
    landed = payloads.periods_between(
        _pnad_landing(spark, path), dt.date(1996, 5, 20), dt.date(1998, 8, 1)
    )
    return payloads.parse_pnad(landed, keep=("t",))


@query("a09_write_snapshot", f"""
WITH {OBSERVATIONS_SQL}
SELECT {INDICATOR_SQL} AS indicator, '20240301_123045' AS snapshot_ts, t, value FROM obs""")
def write_snapshot(spark, path):
    """Written twice, as by a run that is repeated."""
    root = scratch_path(spark, "bronze")
    for _ in range(2):
        sinks.write_snapshot(bronze(spark, path), root, RUN_TS, refuse_empty=True)
    return files.read_layer(spark, root).select(
        "indicator", "snapshot_ts", "t", F.col("valor").cast("double").alias("value")
    )


@query("a10_write_csv", "SELECT event_id, event_type, value FROM events")
def write_csv(spark, path):
    file = scratch_path(spark, "events")
    sinks.write_csv(table(spark, path, "events").select("event_id", "event_type", "value"), file)
    return files.read_csv(spark, file, schema="event_id LONG, event_type STRING, value DOUBLE")


@query("a11_write_partitioned", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, k, value, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month
FROM obs""")
def write_partitioned(spark, path):
    root = scratch_path(spark, "silver")
    df = observations(spark, path).select(
        "t", "k", "value", F.year("date").alias("year"), F.month("date").alias("month")
    )
    sinks.write_partitioned(df, root, sinks.folder_columns("ipca"))
    return files.read_parquet(spark, root)


@query("a12_discover_indicators", f"""
WITH {OBSERVATIONS_SQL} SELECT DISTINCT {INDICATOR_SQL} AS indicator FROM obs""")
def discover_indicators(spark, path):
    root = scratch_path(spark, "bronze")
    sinks.write_snapshot(bronze(spark, path), root, RUN_TS)
    return files.discover_indicators(spark, root)


@query("a12_discover_in_file_names", f"""
WITH {OBSERVATIONS_SQL} SELECT DISTINCT {INDICATOR_SQL} AS indicator FROM obs""")
def discover_in_file_names(spark, path):
    root, rows = scratch_path(spark, "foreign"), bronze(spark, path)
    stamp = sinks.snapshot_id(RUN_TS)
    folders = [f"{root}/economic_indicators/{name}_{stamp}" for name in INDICATOR_OF.values()]
    for name, folder in zip(INDICATOR_OF.values(), folders):
        rows.filter(F.col("indicator") == name).drop("indicator").write.parquet(folder)
    return files.discover_in_file_names(spark, f"{root}/economic_indicators")


@query("a13_conform", f"""
WITH {OBSERVATIONS_SQL}
SELECT t, CASE WHEN t % 7 <> 0 THEN date END AS last_date,
       CASE WHEN t % 4 <> 0 THEN value END AS last_value, CAST(NULL AS VARCHAR) AS situation
FROM obs""")
def conform(spark, path):
    schema = T.StructType([
        T.StructField("t", T.LongType()), T.StructField("last_date", T.DateType()),
        T.StructField("last_value", T.DoubleType()), T.StructField("situation", T.StringType()),
    ])
    day = F.when(F.col("t") % 7 != 0, F.date_format("date", "dd/MM/yyyy")).otherwise("?")
    value = F.when(F.col("t") % 4 != 0, F.col("value").cast("string")).otherwise("n/d")
    df = observations(spark, path).select(
        "t", day.alias("last_date"), value.alias("last_value"), F.lit(1).alias("extra")
    )
    return sinks.conform(df, schema)


@query("k01_incremental_ingest", f"""
WITH {OBSERVATIONS_SQL}
SELECT {INDICATOR_SQL} AS indicator, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total
FROM obs GROUP BY 1""")
def incremental_ingest(spark, path):
    """Two deliveries and three runs; every row arrives once."""
    landing, root, marks = (scratch_path(spark, p) for p in ("landing", "bronze", "marks"))
    rows = bronze(spark, path).withColumns({
        "source": F.lit("bcb"), "snapshot_ts": F.lit(sinks.snapshot_id(RUN_TS))})
    for part in (0, 1):
        rows.filter(F.col("t") % 2 == part).write.mode("append").parquet(landing)
        for _ in range(part + 1):
            ingest_new_files(spark, landing, root, marks, rows.schema)
    return files.read_layer(spark, root).groupBy("indicator").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("valor").cast("double")), 2).alias("total")
    )
