"""Changes, moving statistics, year-to-date and financial measures of a series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import percent_of, rounded
from ..model import Series
from .joins import attach_scalars
from .spread import Measure, Rolling, join_back, measure, running_total

# ---- measures --------------------------------------------------------------------------------


def percent_change(periods: int = 1, column: str | None = None, scale: float = 1.0,
                   fill: str | None = "pad", round_to: int | None = None) -> Measure:
    """``(v / v[periods rows ago] - 1) * scale``.

    ``fill='pad'`` carries the last value over gaps on both sides; ``None`` leaves gaps. A zero
    base gives NULL.
    """
    if fill not in ("pad", None):
        raise ValueError("fill is 'pad' or None")

    def build(frame) -> Column:
        now, then = (
            (frame.filled(), frame.filled(periods)) if fill == "pad"
            else (frame.value, frame.lag(periods))
        )
        return rounded((F.try_divide(now, then) - 1) * F.lit(float(scale)), round_to)

    return Measure(column or f"pct_change_{periods}", build, periods, carries=fill == "pad")


def difference(periods: int = 1, column: str | None = None, scale: float = 1.0,
               round_to: int | None = None) -> Measure:
    """``(v - v[periods rows ago]) * scale``."""
    return Measure(
        column or f"diff_{periods}",
        lambda frame: rounded((frame.value - frame.lag(periods)) * F.lit(float(scale)), round_to),
        periods,
    )


def year_over_year(periods: int = 12, column: str | None = None, scale: float = 1.0,
                   fill: str | None = "pad", round_to: int | None = None) -> Measure:
    """Percent change over a year of rows: 12 months or 4 quarters."""
    return percent_change(periods, column or f"year_over_year_{periods}", scale, fill, round_to)


def shift(periods: int = 1, column: str | None = None) -> Measure:
    return Measure(column or f"shift_{periods}", lambda frame: frame.lag(periods), periods)


def _rolling(kind: str, n: int, column: str, min_periods: int | None = None, round_to: int | None = None) -> Measure:
    rolling = Rolling(kind, n, min_periods, round_to)
    return Measure(column, rolling.over_frame, n - 1, rolling=rolling)


def moving_average(n: int = 3, column: str | None = None, min_periods: int | None = None,
                   round_to: int | None = None) -> Measure:
    """Mean of the last ``n`` rows; NULL until there are ``min_periods`` (default all) values."""
    return _rolling("mean", n, column or f"moving_avg_{n}", min_periods, round_to)


def moving_sum(n: int, column: str | None = None, min_periods: int | None = None) -> Measure:
    return _rolling("sum", n, column or f"moving_sum_{n}", min_periods)


def moving_std(n: int, column: str | None = None, min_periods: int | None = None) -> Measure:
    return _rolling("std", n, column or f"volatility_{n}", min_periods)


_KINDS = {"pct_change": percent_change, "diff": difference, "year_over_year": year_over_year}

# The changes taken when none are asked for (kind, periods, column, scale).
DEFAULT_VARIATIONS = (
    ("pct_change", 1, "monthly_change_pct", 100.0),
    ("year_over_year", 12, "year_over_year_pct", 100.0),
)


def variations(df: DataFrame, series: Series,
               specs: Sequence[tuple] = DEFAULT_VARIATIONS,
               chunks: int | None = None) -> DataFrame:
    """Several changes over one window.

    ``specs`` is a list of ``(kind, periods, column, scale)``, so a kind may occur more than once;
    ``column`` None means ``<kind>_<periods>``. Without the value or date column nothing happens.
    """
    if not {series.value, series.date} <= set(df.columns):
        return df
    built = [
        _KINDS[kind](periods, column or f"{kind}_{periods}", scale)
        for kind, periods, column, scale in specs
    ]
    return measure(df, series, *built, chunks=chunks)


# ---- running values --------------------------------------------------------------------------

def cumulative(df: DataFrame, series: Series, group: Sequence[str] = (),
               column: str = "cumulative_value", chunks: int | None = None) -> DataFrame:
    """Running sum per series, restarted for every value of ``group``; rows without one get NULL."""
    present = [g for g in group if g in df.columns]
    inner = series.but(keys=(*series.keys, *present))
    out = running_total(df, inner, column, chunks=chunks)
    if not present:
        return out
    known = F.lit(True)
    for g in present:
        known = known & F.col(g).isNotNull()
    return out.withColumn(column, F.when(known, F.col(column)))


def _with_year(df: DataFrame, series: Series, year: str) -> DataFrame:
    return df if year in df.columns else df.withColumn(year, F.year(series.date))


def year_to_date_percent(df: DataFrame, series: Series, column: str = "year_to_date_pct",
                         year: str = "year") -> DataFrame:
    """Percent above the year's first row; a missing first value leaves the year NULL.

    Without a grain the first rows are found by an aggregate and joined back, which splits and
    spreads like any join; a keyed window would hold a whole series-year in one task.
    """
    df = _with_year(df, series, year)
    value = F.col(series.value)
    dated = F.col(year).isNotNull()
    if series.grain is not None:
        window = Window.partitionBy(*series.keys, year).orderBy(*series.order())
        first = F.first(value).over(window)
        return df.withColumn(column, F.when(dated, (F.try_divide(value, first) - 1) * 100))
    firsts = df.filter(dated).groupBy(*series.keys, year).agg(
        F.min_by(value, series.rank_key(df)).alias("_first")
    )
    joined = join_back(df, firsts, [*series.keys, year])
    return joined.withColumn(
        column, F.when(dated, (F.try_divide(value, F.col("_first")) - 1) * 100)
    ).drop("_first")


def year_to_date_sum(df: DataFrame, series: Series, column: str = "ytd_accumulated",
                     year: str = "year", chunks: int | None = None) -> DataFrame:
    """Running sum within the year; rows of one date share the total of that date."""
    df = _with_year(df, series, year)
    if series.grain is not None:
        window = Window.partitionBy(*series.keys, year).orderBy(F.col(series.date).asc_nulls_last())
        frame = window.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(column, F.sum(series.value).over(frame))
    at = [*series.keys, year, series.date]
    # Ties share a total, so dates are summed first and the running sum goes over dates, of which a year
    # has 366; instants may be many more.
    dates = df.groupBy(*at).agg(F.sum(series.value).alias("_sum"))
    days = isinstance(df.schema[series.date].dataType, T.DateType)
    yearly = series.but(keys=(*series.keys, year), tie=(), value="_sum", grain="D" if days else None)
    totals = running_total(dates, yearly, column, over_gaps=True, chunks=chunks).drop("_sum")
    return join_back(df, totals, at)


# ---- dispersion ------------------------------------------------------------------------------

def group_std(df: DataFrame, value: str, group: Sequence[str], column: str = "volatility",
              staged: bool = True) -> DataFrame:
    """Every row gets the sample deviation of its group; rows without a group get NULL.

    The deviations are aggregated (partially, in every task) and joined back, so a hot group is
    never gathered in one window task.
    """
    stats = df.groupBy(*group).agg(F.stddev_samp(value).alias(column)).dropna(subset=list(group))
    return join_back(df.drop(column), stats, group, staged)


def overall_std(df: DataFrame, series: Series, column: str = "volatility") -> DataFrame:
    """Every row gets the sample deviation of its series."""
    stats = df.groupBy(*series.keys).agg(F.stddev_samp(series.value).alias(column))
    if not series.keys:
        return attach_scalars(df, stats)
    return join_back(df, stats, series.keys, series.grain is None)


def volatility(df: DataFrame, series: Series, group: Sequence[str] = (), window: int | None = None,
               column: str = "volatility", chunks: int | None = None) -> DataFrame:
    """Group deviation if the group exists, else rolling if there is a window, else overall."""
    present = [g for g in group if g in df.columns]
    if present:
        return group_std(
            df, series.value, [*series.keys, *present], column, series.grain is None
        )
    if window:
        return measure(df, series, moving_std(window, column), chunks=chunks)
    return overall_std(df, series, column)


# ---- financial bundle ------------------------------------------------------------------------

def amplitude(high: Column, low: Column) -> Column:
    return percent_of(high - low, low)


# Fixed value: how far two averages of up to 50 rows that are equal can lie apart by rounding, in mean magnitudes of those rows.
ROUNDING = 1.5e-14


def crossover_signal(fast: Column, slow: Column, slack: Column | float = 0.0) -> Column:
    """1 if the fast average is above the slow one by more than ``slack``, otherwise (or when unknown) -1."""
    return F.when(fast > slow + slack, 1).otherwise(-1)


def financial_metrics(df: DataFrame, series: Series, high: str = "high", low: str = "low",
                      chunks: int | None = None) -> DataFrame:
    """Return, 20-row deviation, amplitude, 20- and 50-row averages and their crossover.

    Averages that are equal but for the rounding of their sums do not cross.
    """
    size = Measure("_size", lambda frame: frame.rolling(lambda v: F.avg(F.abs(v)), 50), 49)
    out = measure(
        df, series,
        percent_change(1, "return_pct", 100), moving_std(20, "volatility_20"),
        moving_average(20, "ma_20"), moving_average(50, "ma_50"), size, chunks=chunks,
    )
    if high in df.columns and low in df.columns:
        out = out.withColumn("amplitude_pct", amplitude(F.col(high), F.col(low)))
    slack = F.col("_size") * ROUNDING
    slack = F.when(slack < float("inf"), slack).otherwise(0.0)
    return out.withColumn("ma_cross_signal", crossover_signal(F.col("ma_20"), F.col("ma_50"), slack)).drop("_size")


# ---- latest rows -----------------------------------------------------------------------------

def latest_rows(df: DataFrame, series: Series, n: int = 1, position: str = "_nth") -> DataFrame:
    """The last ``n`` rows of every series with their position from the end.

    The rank filter becomes a group limit, so every task passes on at most ``n`` rows per series.
    """
    rank = F.row_number().over(
        Window.partitionBy(*(series.keys or [F.lit(0)])).orderBy(*series.reverse_order())
    )
    return df.withColumn(position, rank).filter(F.col(position) <= n)


def latest_row(df: DataFrame, series: Series) -> DataFrame:
    return latest_rows(df, series, 1).drop("_nth")


def change_since(df: DataFrame, series: Series, back: int = 12,
                 column: str = "annual_change") -> DataFrame:
    """Percent change of the latest value over the one ``back`` rows earlier, per series.

    NULL without that row or when it is not positive.
    """
    nth, value = F.col("_nth"), F.col(series.value)
    ends = latest_rows(df, series, back + 1).groupBy(*series.keys).agg(
        F.max(F.when(nth == 1, value)).alias("_now"),
        F.max(F.when(nth == back + 1, value)).alias("_then"),
    )
    base = F.when(F.col("_then") > 0, F.col("_then"))
    return ends.select(
        *series.keys, ((F.try_divide(F.col("_now"), base) - 1) * 100).alias(column)
    )


def trend_label(rows: Column, now: Column, then: Column) -> Column:
    """rising, falling or stable over three rows; NULL with fewer, stable when incomparable."""
    return F.when(
        rows >= 3, F.when(now > then, "rising").when(now < then, "falling").otherwise("stable")
    )


def trend(df: DataFrame, series: Series, column: str = "trend") -> DataFrame:
    nth, value = F.col("_nth"), F.col(series.value)
    return latest_rows(df, series, 3).groupBy(*series.keys).agg(
        trend_label(
            F.count(F.lit(1)), F.max(F.when(nth == 1, value)), F.max(F.when(nth == 3, value))
        ).alias(column)
    )


# ---- scaling ---------------------------------------------------------------------------------

def min_max_scale(df: DataFrame, value: str, keys: Sequence[str] = (),
                  column: str | None = None, scale: float = 100.0, grain: str | None = None) -> DataFrame:
    """Scale to 0..``scale`` over all rows (or per key); unchanged where all values are equal.

    With a ``grain`` the rows of a key are bounded by the calendar: the ends are then taken over a window and ``df`` is
    computed once. Otherwise they are aggregated and put back.
    """
    v, low, high = F.col(value), F.col("_low"), F.col("_high")
    if grain is not None:
        own = Window.partitionBy(*(keys or [F.lit(0)]))
        joined = df.withColumns({"_low": F.min(value).over(own), "_high": F.max(value).over(own)})
    else:
        ends = df.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        joined = join_back(df, ends, keys) if keys else attach_scalars(df, ends)
    return joined.withColumn(
        column or value,
        F.when(high > low, (v - low) / F.nullif(high - low, F.lit(0.0)) * scale).otherwise(v),
    ).drop("_low", "_high")
