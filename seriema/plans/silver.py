"""Bronze observations to standardised indicator series.

Each transform handles all series of a frame at once: ``keys`` names the columns that tell them
apart (several places of one indicator, for example).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rounded, year_quarter
from ..model import SILVER_METADATA, Series
from ..operators import windows as w
from ..operators.aggregates import period_mean, period_ohlc
from ..operators.calendar import date_features
from ..operators.cleaning import (
    ensure_numeric,
    rename_present,
    standardize_date,
    value_column,
    with_metadata,
)
from ..operators.spread import measure

# Columns that are never the value of a bronze frame.
_NOT_VALUES = (
    "date", "data", "source", "indicator", "indicator_name", "unit", "frequency", "localidade",
    "period_id", "collected_at", "snapshot_ts",
)


@dataclass(frozen=True)
class Style:
    """The two ways to compute the same measures.

    ``STANDARD`` leaves values unrounded, averages full windows only, carries values over gaps
    and measures the year to date in percent. ``ROUNDED`` rounds, averages whatever there is,
    leaves gaps and sums up the year.
    """

    rounded: bool = False

    @property
    def fill(self) -> str | None:
        return None if self.rounded else "pad"

    @property
    def min_periods(self) -> int | None:
        return 1 if self.rounded else None

    def digits(self, n: int) -> int | None:
        return n if self.rounded else None


STANDARD = Style()
ROUNDED = Style(rounded=True)


def standardize(df: DataFrame, value: str | None = None,
                keys: Sequence[str] = ()) -> DataFrame:
    """DATE column ``date`` and DOUBLE column ``value``, whatever they were called."""
    if value is None:
        value = "value" if "value" in df.columns else value_column(df, (*_NOT_VALUES, *keys))
    named = df if "date" in df.columns else rename_present(df, {"data": "date"})
    named = named.withColumnRenamed(value, "value")
    return ensure_numeric(standardize_date(named), "value")


def _describe(df: DataFrame, indicator: str, style: Style, run_ts) -> DataFrame:
    name, unit, frequency, source = SILVER_METADATA[indicator]
    mode = "if_missing" if style.rounded else "overwrite"
    out = with_metadata(df, mode, indicator=indicator, indicator_name=name, unit=unit,
                        frequency=frequency)
    out = with_metadata(out, "if_missing", source=source)
    return with_metadata(out, processed_at=F.lit(run_ts).cast("timestamp"))


def ipca(df: DataFrame, keys: Sequence[str] = (), style: Style = STANDARD, run_ts=None,
         indicator: str = "ipca", value: str | None = None, grain: str | None = "M",
         tie: Sequence[str] = ()) -> DataFrame:
    """Monthly price index: changes, year to date and a 3-month average."""
    series = Series(keys=keys, tie=tie, grain=grain)
    out = date_features(standardize(df, value, keys))
    digits = style.digits(2)
    out = measure(
        out, series,
        w.percent_change(1, "monthly_change_pct", 100, style.fill, digits),
        w.year_over_year(12, "year_over_year_pct", 100, style.fill, digits),
        w.moving_average(3, "moving_avg_3m", style.min_periods, digits),
    )
    if style.rounded:
        out = w.year_to_date_sum(out, series).drop("quarter", "year_quarter")
    else:
        out = w.year_to_date_percent(out, series).drop("year")
    return _describe(out, indicator, style, run_ts)


def selic(df: DataFrame, keys: Sequence[str] = (), style: Style = STANDARD, run_ts=None,
          indicator: str = "selic", value: str | None = None) -> DataFrame:
    """Daily policy rate to monthly means with the change in basis points."""
    monthly = period_mean(standardize(df, value, keys), Series(keys=keys), "M")
    out = measure(
        monthly, Series(keys=keys, grain="M"),
        w.difference(1, "change_bps", 100, style.digits(0)),
        w.moving_average(3, "moving_avg_3m", style.min_periods, style.digits(2)),
    )
    if style.rounded:
        out = out.withColumns({"year": F.year("date"), "month": F.month("date")})
    else:
        out = out.withColumn("real_interest_rate", F.lit(0.0))
    return _describe(out, indicator, style, run_ts)


def pib(df: DataFrame, keys: Sequence[str] = (), style: Style = STANDARD, run_ts=None,
        indicator: str = "pib", value: str | None = None, grain: str | None = "Q",
        tie: Sequence[str] = ()) -> DataFrame:
    """Quarterly product: changes and the sum of four quarters."""
    out = measure(
        standardize(df, value, keys), Series(keys=keys, tie=tie, grain=grain),
        w.percent_change(1, "quarterly_change_pct", 100, style.fill, style.digits(2)),
        w.year_over_year(4, "annual_change_pct", 100, style.fill, style.digits(2)),
        w.moving_sum(4, "accumulated_value"),
    )
    return _describe(out, indicator, style, run_ts)


def cambio(df: DataFrame, keys: Sequence[str] = (), style: Style = STANDARD, run_ts=None,
           indicator: str = "cambio", value: str | None = None,
           tie: Sequence[str] = ()) -> DataFrame:
    """Daily exchange rate to monthly open, close, high, low, and financial measures."""
    monthly = period_ohlc(
        standardize(df, value, keys), Series(keys=keys, tie=tie), "M",
        lone_volatility=None if style.rounded else 0.0,
    ).withColumn("value", F.col("close"))
    series = Series(keys=keys, value="close", grain="M")
    spread = w.amplitude(F.col("high"), F.col("low"))
    out = measure(
        monthly, series,
        w.percent_change(1, "monthly_change_pct", 100, style.fill, style.digits(2)),
        w.moving_average(3, "ma_3m", 1, style.digits(4)),
        w.moving_average(6, "ma_6m", 1, style.digits(4)),
    ).withColumn("monthly_amplitude_pct", rounded(spread, style.digits(2)))
    if style.rounded:
        out = out.withColumns({"year": F.year("date"), "month": F.month("date")})
    else:
        out = w.financial_metrics(out, series)
    return _describe(out, indicator, style, run_ts)


def desemprego(df: DataFrame, keys: Sequence[str] = (), style: Style = STANDARD, run_ts=None,
               indicator: str = "desemprego", value: str | None = None,
               grain: str | None = "Q", tie: Sequence[str] = ()) -> DataFrame:
    """Quarterly unemployment rate: changes in percentage points and a 3-quarter average."""
    out = standardize(df, value, keys)
    if style.rounded:
        date = F.col("date")
        out = out.withColumns({
            "year": F.year(date), "quarter": F.quarter(date), "year_quarter": year_quarter(date),
        })
    out = measure(
        out, Series(keys=keys, tie=tie, grain=grain),
        w.difference(1, "quarterly_change_pp", 1, style.digits(2)),
        w.difference(4, "annual_change_pp", 1, style.digits(2)),
        w.moving_average(3, "moving_avg_3q", style.min_periods, style.digits(2)),
    )
    return _describe(out, indicator, style, run_ts)


def _named(transform: Callable, indicator: str) -> Callable[..., DataFrame]:
    def run(df: DataFrame, **options) -> DataFrame:
        return transform(df, indicator=indicator, **options)

    return run


# indicator -> transform(df, keys=..., style=..., run_ts=...). Callers may pass their own map.
TRANSFORMS: dict[str, Callable[..., DataFrame]] = {
    "ipca": _named(ipca, "ipca"),
    "ipca15": _named(ipca, "ipca15"),
    "selic": _named(selic, "selic"),
    "pib": _named(pib, "pib"),
    "cambio": _named(cambio, "cambio"),
    "desemprego": _named(desemprego, "desemprego"),
    "pnad": _named(desemprego, "pnad"),
}
