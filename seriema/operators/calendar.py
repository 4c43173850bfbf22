"""Date features, named windows and resampling."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import period_end, period_start, period_step, year_quarter
from ..model import Series
from .spread import join_back


def date_features(df: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year_month": F.date_format(d, "yyyy-MM"),
        "year_quarter": year_quarter(d),
    })


def named_windows(df: DataFrame, windows: Sequence[tuple[object, object, str]],
                  date: str = "date", column: str = "time_window") -> DataFrame:
    """Label rows by inclusive date ranges; a later range wins over an earlier one."""
    if not windows:
        return df
    d = F.col(date)
    label = F.when(F.lit(False), F.lit(None).cast("string"))
    for start, end, name in reversed(windows):
        label = label.when((d >= F.lit(start)) & (d <= F.lit(end)), F.lit(name))
    return df.withColumn(column, label.otherwise("other"))


#: Powers of two that cover all days from the year 1 to 9999.
_LEVELS = 22


def _day(date: Column) -> Column:
    """The number of a day, from 0."""
    return F.date_diff(date, F.lit("0001-01-01").cast("date")).cast("long")


def _blocks(first: Column, last: Column) -> Column:
    """The aligned blocks of 1, 2, 4, ... days that make up a range, as (level, block): at most two of each size."""
    block = lambda level, n: F.array(F.struct(level.alias("level"), n.alias("block")))
    none = F.array().cast("array<struct<level:int,block:bigint>>")
    odd = lambda n: n.bitwiseAND(F.lit(1).cast("long")) == 1

    def step(held: Column, level: Column) -> Column:
        low, high, open_ = held["low"], held["high"], held["low"] < held["high"]
        # Blocks of this size at the ends that are not half of a larger one inside the range.
        taken = F.concat(held["taken"], F.when(open_ & odd(low), block(level, low)).otherwise(none),
                         F.when(open_ & odd(high), block(level, high - 1)).otherwise(none))
        return F.struct(F.shiftright(low + 1, 1).alias("low"), F.shiftright(high, 1).alias("high"), taken.alias("taken"))

    start = F.struct(first.alias("low"), (last + 1).alias("high"), none.alias("taken"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(_LEVELS)), start, step, lambda held: held["taken"])


def windows_from_table(df: DataFrame, ranges: DataFrame, date: str = "date", column: str = "time_window",
                       other: str | None = "other") -> DataFrame:
    """Label rows by any number of inclusive date ranges: ``ranges`` has (start, end, name, priority).

    Of ranges that overlap the one with the highest priority wins, of equal ones the larger name. Ranges without
    a bound or with the end first hold no day; rows without a date or outside all ranges are ``other``.

    A range is made of aligned blocks of days, two of each size at most, and a day lies in one block of each size. So
    winners are found by equal blocks, for the distinct days of ``df``, of which there are as many as the calendar has;
    no row is compared with a range.
    """
    inside = ranges.where((F.col("start") <= F.col("end")) & F.col("name").isNotNull())
    held = inside.select(
        F.struct("priority", "name").alias("best"),
        F.inline(_blocks(_day(F.col("start").cast("date")), _day(F.col("end").cast("date")))),
    ).groupBy("level", "block").agg(F.max("best").alias("best"))
    days = df.select(F.col(date).cast("date").alias("_day")).where("_day IS NOT NULL").distinct()
    level = F.explode(F.sequence(F.lit(0), F.lit(_LEVELS))).alias("level")
    looked = days.select("_day", level).withColumn("block", F.expr("shiftright(datediff(_day, DATE'0001-01-01') + 0L, level)"))
    found = looked.join(held, ["level", "block"]).groupBy("_day").agg(F.max("best")["name"].alias(column))
    labelled = join_back(df.drop(column).withColumn("_day", F.col(date).cast("date")), found, ["_day"])
    return labelled.withColumn(column, F.coalesce(column, F.lit(other))).drop("_day")


def quarter_key(date: Column) -> Column:
    """A joinable quarter: its first day."""
    return F.trunc(date, "quarter")


def _last_value(value: Column, rank_key: Column) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), rank_key))


# Aggregations by name.
AGGREGATES: dict[str, Callable[[Column, Column], Column]] = {
    "mean": lambda value, _: F.avg(value),
    "sum": lambda value, _: F.coalesce(F.sum(value), F.lit(0.0)),
    "min": lambda value, _: F.min(value),
    "max": lambda value, _: F.max(value),
    "last": _last_value,
}


def resample(df: DataFrame, series: Series, freq: str = "M", how: str = "mean") -> DataFrame:
    """One row per series and period, labelled by the period's last day, empty periods included.

    An unknown ``how`` means the mean. Empty periods hold NULL, or 0 for a sum. The rows are
    reduced by a partial aggregate first; the gaps are then opened on the period rows, of which
    a series has as many as the calendar has periods.
    """
    value, start = F.col(series.value), "_start"
    aggregate = AGGREGATES.get(how, AGGREGATES["mean"])
    periods = (
        df.filter(F.col(series.date).isNotNull())
        .groupBy(*series.keys, period_start(F.col(series.date), freq).alias(start))
        .agg(aggregate(value, series.rank_key(df)).alias("_value"))
    )
    until = F.coalesce(_previous(F.col("_next"), freq), F.col(start))
    filled = F.sequence(F.col(start), until, period_step(freq))
    spread = periods.withColumn("_next", F.lead(start).over(_by_start(series, start))).withColumn(
        "_period", F.explode(filled)
    )
    empty = F.lit(0.0) if how == "sum" else F.lit(None).cast("double")
    return spread.select(
        *series.keys,
        period_end(F.col("_period"), freq).alias(series.date),
        F.when(F.col("_period") == F.col(start), F.col("_value")).otherwise(empty)
        .alias(series.value),
    )


def _by_start(series: Series, start: str):
    # Without keys there is one series, and its period rows are bounded by the calendar.
    return Window.partitionBy(*(series.keys or [F.lit(0)])).orderBy(start)


def _previous(start: Column, freq: str) -> Column:
    """Start of the period before."""
    if freq == "D":
        return F.date_sub(start, 1)
    if freq == "W":
        return F.date_sub(start, 7)
    return F.add_months(start, {"M": -1, "Q": -3, "Y": -12}[freq])
