"""Landed JSON payloads to bronze rows.

Every function takes a frame with one payload per row, keeps the columns named in ``keep`` and
returns one row per observation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decimal_comma, parse_date, period_to_date, to_number

_FLAT = "array<struct<data:string,valor:string>>"
# `serie` stays text: it is a list of records or an object keyed by period.
_SIDRA = (
    "array<struct<resultados:array<struct<series:array<struct<"
    "localidade:struct<nome:string>,serie:string>>>>>>"
)
_SIDRA_LIST = "array<struct<periodo:string,valor:string>>"
_SIDRA_MAP = "map<string,string>"
_PNAD = "array<struct<nome:string,valoresDeReferencia:array<struct<valor:string>>>>"


def parse_flat(df: DataFrame, payload: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """``[{"data": "01/01/2023", "valor": "0.53"}]`` to (data, valor)."""
    rows = df.select(*keep, F.explode(F.from_json(payload, _FLAT)).alias("r"))
    return rows.select(
        *keep, parse_date(F.col("r.data"), ["dd/MM/yyyy"]).alias("data"),
        to_number(F.col("r.valor")).alias("valor"),
    )


def parse_sidra(df: DataFrame, payload: str = "payload", frequency: str = "frequency",
                keep: Sequence[str] = ()) -> DataFrame:
    """The first result of the first variable to (data, valor, localidade)."""
    first = F.get(F.from_json(payload, _SIDRA), F.lit(0))
    series = F.get(first["resultados"], F.lit(0))["series"]
    each = df.select(*keep, F.col(frequency).alias("_frequency"), F.explode(series).alias("s"))
    text = F.col("s.serie")
    listed = F.from_json(text, _SIDRA_LIST)
    keyed = F.transform(
        F.map_entries(F.from_json(text, _SIDRA_MAP)),
        lambda e: F.struct(
            e["key"].alias("periodo"),
            F.coalesce(F.get_json_object(e["value"], "$.valor"), e["value"]).alias("valor"),
        ),
    )
    records = F.when(F.ltrim(text).startswith("["), listed).otherwise(keyed)
    rows = each.select(
        *keep, "_frequency", F.coalesce(F.col("s.localidade.nome"), F.lit("Brasil"))
        .alias("localidade"), F.explode(records).alias("r"),
    )
    return rows.select(
        *keep, period_to_date(F.col("r.periodo"), F.col("_frequency")).alias("data"),
        decimal_comma(F.col("r.valor")).alias("valor"), "localidade",
    )


def parse_pnad(df: DataFrame, payload: str = "payload", period: str = "period_id",
               keep: Sequence[str] = ()) -> DataFrame:
    """Per period the first indicator named like ``desocupa``, to (data, pnad, period_id)."""
    matching = F.filter(
        F.from_json(payload, _PNAD), lambda i: F.lower(i["nome"]).contains("desocupa")
    )
    # Exploding at most one element drops periods without the indicator and parses each text once.
    found = df.select(*keep, F.col(period).alias("period_id"),
                      F.explode(F.slice(matching, 1, 1)).alias("found"))
    rate = F.get(F.col("found.valoresDeReferencia"), F.lit(0))["valor"]
    return found.select(
        *keep, period_to_date(F.col("period_id"), "quarterly").alias("data"),
        to_number(rate).alias("pnad"), "period_id",
    )


def periods_between(df: DataFrame, start, end, period: str = "period_id") -> DataFrame:
    """Periods whose quarter lies between the quarters of two dates."""
    quarter = period_to_date(F.col(period), "quarterly")
    low, high = (F.trunc(F.lit(d).cast("date"), "quarter") for d in (start, end))
    return df.filter(quarter.between(low, high))


def name_value_column(df: DataFrame, indicator: str, value: str = "valor") -> DataFrame:
    """Bronze names the value column after its indicator."""
    return df.withColumnRenamed(value, indicator)
