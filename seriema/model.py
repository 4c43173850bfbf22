"""The data model: series description, layer schemas and the indicator registry."""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .session import constant_frame

GRAINS = ("D", "W", "M", "Q", "Y")


@dataclass(frozen=True)
class Series:
    """Names the columns that make up the series of a frame.

    ``keys`` identify a series, ``date`` orders it and ``tie`` breaks equal dates. ``grain`` declares
    that there is one row per series and calendar period, as after a resample: a series is then
    bounded by the calendar (a century of days is 36,525 rows) and fits one task. Without a grain
    the rows per series are unknown, and ordered operators cut every series into ordered chunks.
    """

    keys: tuple[str, ...] = ()
    date: str = "date"
    value: str = "value"
    tie: tuple[str, ...] = ()
    grain: str | None = None

    def __post_init__(self):
        object.__setattr__(self, "keys", tuple(self.keys))
        object.__setattr__(self, "tie", tuple(self.tie))
        if self.grain is not None and self.grain not in GRAINS:
            raise ValueError(f"grain must be one of {GRAINS}, not {self.grain!r}")

    def order(self) -> list[Column]:
        return [F.col(c).asc_nulls_last() for c in (self.date, *self.tie)]

    def reverse_order(self) -> list[Column]:
        """Exactly the opposite of :meth:`order`: the latest row first, undated rows before it."""
        return [F.col(c).desc_nulls_first() for c in (self.date, *self.tie)]

    def rank_key(self, df: DataFrame) -> Column:
        """One comparable column for ``min_by``/``max_by`` over the rows of ``df``.

        A date and a whole number become one decimal, which an aggregate by hash can hold; of other
        ties a struct is made, for which Spark sorts the rows first.
        """
        if not self.tie:
            return F.col(self.date)
        date, tie = df.schema[self.date].dataType, df.schema[self.tie[0]].dataType
        number = {T.DateType: F.unix_date, T.TimestampType: F.unix_micros}.get(type(date))
        if len(self.tie) > 1 or number is None or not isinstance(tie, T.IntegralType):
            return F.struct(self.date, *self.tie)
        # A missing tie comes first, as in a struct; all others are moved above zero.
        place = F.coalesce(F.col(self.tie[0]).cast("decimal(20,0)") + F.lit(Decimal(2**63 + 1)), F.lit(Decimal(0)))
        when = number(F.col(self.date)).cast("decimal(18,0)") * F.lit(Decimal(2**65))
        return (when + place).cast("decimal(38,0)")

    def order_key(self, df: DataFrame) -> Column:
        """One comparable column in the order of :meth:`order`, missing dates and ties last.

        A date and a whole number become one decimal, as in :meth:`rank_key`.
        """
        number = {T.DateType: F.unix_date, T.TimestampType: F.unix_micros}.get(type(df.schema[self.date].dataType))
        whole = len(self.tie) < 2 and all(isinstance(df.schema[c].dataType, T.IntegralType) for c in self.tie)
        if number is None or not whole:
            return F.struct(*(x for c in (self.date, *self.tie) for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))))
        when = F.coalesce(number(F.col(self.date)).cast("decimal(18,0)"), F.lit(Decimal(10**18 - 1)).cast("decimal(18,0)"))
        if not self.tie:
            return when
        place = F.coalesce(F.col(self.tie[0]).cast("decimal(20,0)") + F.lit(Decimal(2**63)), F.lit(Decimal(2**64)))
        return (when * F.lit(Decimal(2**65)) + place).cast("decimal(38,0)")

    def but(self, **changes) -> "Series":
        return replace(self, **changes)


_TYPES = {
    "STRING": T.StringType(), "DOUBLE": T.DoubleType(), "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(), "INT": T.IntegerType(),
}


def _struct(columns: str) -> T.StructType:
    """``name TYPE, ...``; ``StructType.fromDDL`` would need a running session at import."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[dtype]) for name, dtype in pairs])


BRONZE_SCHEMA = _struct(
    "source STRING, data STRING, valor STRING, localidade STRING, period_id STRING, "
    "indicator_name STRING, unit STRING, frequency STRING, collected_at TIMESTAMP, "
    "indicator STRING, snapshot_ts STRING"
)

# Fixed value: the place of national figures.
NATIONAL = "Brasil"

# Every column a silver transform may write. Reading with it needs no look at the files, and
# columns that a snapshot lacks are NULL.
SILVER_SCHEMA = _struct(
    "source STRING, localidade STRING, indicator_name STRING, unit STRING, frequency STRING, date DATE, "
    "value DOUBLE, year INT, month INT, quarter INT, year_month STRING, year_quarter STRING, "
    "monthly_change_pct DOUBLE, year_over_year_pct DOUBLE, year_to_date_pct DOUBLE, "
    "ytd_accumulated DOUBLE, moving_avg_3m DOUBLE, change_bps DOUBLE, real_interest_rate DOUBLE, "
    "quarterly_change_pct DOUBLE, annual_change_pct DOUBLE, accumulated_value DOUBLE, "
    "open DOUBLE, close DOUBLE, high DOUBLE, low DOUBLE, avg DOUBLE, volatility DOUBLE, "
    "monthly_amplitude_pct DOUBLE, ma_3m DOUBLE, ma_6m DOUBLE, return_pct DOUBLE, "
    "volatility_20 DOUBLE, amplitude_pct DOUBLE, ma_20 DOUBLE, ma_50 DOUBLE, "
    "ma_cross_signal INT, quarterly_change_pp DOUBLE, annual_change_pp DOUBLE, "
    "moving_avg_3q DOUBLE, processed_at TIMESTAMP, indicator STRING, snapshot_ts STRING"
)

MONTHLY_SCHEMA = _struct(
    "date DATE, year_month STRING, ipca DOUBLE, ipca_monthly_change DOUBLE, "
    "ipca_annual_change DOUBLE, selic DOUBLE, selic_moving_avg DOUBLE, cambio DOUBLE, "
    "cambio_monthly_change DOUBLE, cambio_volatility DOUBLE, real_interest_rate DOUBLE, "
    "economic_pressure_index DOUBLE, updated_at TIMESTAMP"
)

LABOR_SCHEMA = _struct(
    "date DATE, unemployment_rate DOUBLE, unemployment_qtr_change DOUBLE, "
    "unemployment_annual_change DOUBLE, gdp DOUBLE, gdp_growth DOUBLE, "
    "employment_gdp_elasticity DOUBLE, employment_gdp_elasticity_ma DOUBLE, updated_at TIMESTAMP"
)

MACRO_SCHEMA = _struct(
    "indicator STRING, indicator_name STRING, last_value DOUBLE, last_date DATE, unit STRING, "
    "annual_change DOUBLE, trend STRING, situation STRING, updated_at TIMESTAMP"
)

# Fixed values: (source, indicator, series or table code, name, unit, frequency).
REGISTRY = (
    ("bcb", "ipca", "433", "IPCA - Índice Nacional de Preços ao Consumidor Amplo", "%", "monthly"),
    ("bcb", "selic", "11", "Taxa SELIC", "%", "daily"),
    ("bcb", "pib", "4380", "PIB Mensal", "R$ milhões", "monthly"),
    ("bcb", "cambio", "1",
     "Taxa de Câmbio - Livre - Dólar americano (compra) - Média de período", "BRL", "daily"),
    ("bcb", "desemprego", "24369", "Taxa de Desemprego", "%", "quarterly"),
    ("ibge", "ipca15", "7062",
     "IPCA-15 - Índice Nacional de Preços ao Consumidor Amplo-15", "%", "monthly"),
    ("ibge", "inpc", "7063", "INPC - Índice Nacional de Preços ao Consumidor", "%", "monthly"),
    ("ibge", "pnad", "pnad_taxa_desocupacao",
     "Taxa de Desocupação - PNAD Contínua", "%", "quarterly"),
    ("ibge", "pib_ibge", "1621", "PIB Trimestral - IBGE", "R$ milhões", "quarterly"),
)

# Silver metadata per indicator (name, unit, frequency, source).
SILVER_METADATA = {
    "ipca": ("IPCA - Índice Nacional de Preços ao Consumidor Amplo", "%", "monthly", "bcb"),
    "ipca15": ("IPCA-15 - Índice Nacional de Preços ao Consumidor Amplo-15", "%", "monthly",
               "ibge"),
    "selic": ("Taxa SELIC", "%", "monthly", "bcb"),
    "pib": ("Produto Interno Bruto", "R$ milhões", "quarterly", "bcb"),
    "cambio": ("Taxa de Câmbio (USD/BRL)", "BRL", "monthly", "bcb"),
    "desemprego": ("Taxa de Desemprego", "%", "quarterly", "bcb"),
    "pnad": ("Taxa de Desemprego - PNAD", "%", "quarterly", "ibge"),
}


def registry_frame(spark: SparkSession) -> DataFrame:
    """The registry as a lookup table; its size is the length of ``REGISTRY``."""
    names = ("source", "indicator", "code", "indicator_name", "unit", "frequency")
    return constant_frame(spark, names, REGISTRY)
