"""Measures of a date range that read only as much of the past as they look back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import period_start
from ..model import Series
from .cleaning import between_dates
from .spread import Measure, measure, null_safe_join

#: By how much a range that was too narrow is widened at a time.
GROWTH = 4
_MONTHS = {"M": 1, "Q": 3, "Y": 12}


def period_of(day: dt.date, grain: str, moved: int = 0) -> dt.date:
    """First day of the period of a day, or of one so many periods later. Weeks begin on Monday."""
    if grain == "D":
        return day + dt.timedelta(days=moved)
    if grain == "W":
        return day - dt.timedelta(days=day.weekday()) + dt.timedelta(weeks=moved)
    months = day.year * 12 + (day.month - 1) // _MONTHS[grain] * _MONTHS[grain] + moved * _MONTHS[grain]
    return dt.date(months // 12, months % 12 + 1, 1)


def measure_between(df: DataFrame, series: Series, *measures: Measure, start: dt.date, end: dt.date | None = None,
                    reduce: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The rows dated from ``start`` to ``end``, measured as in the whole series.

    ``reduce`` makes the rows of a period from those of ``df`` (a resample or a period mean); ``series`` has their grain.
    The range is widened by as many periods as the measures look back and put to ``df`` as a filter on its dates, so
    that it reaches the scan. Where series have gaps that is not enough: if one has fewer rows (or, for measures that
    carry values over gaps, no value so far back) and older rows exist, the range grows until that no longer
    holds, so gaps cost more but change nothing. The same goes for the end, where a resample opens gaps up to the next row.

    The checks run when this is called: one row reaches the driver for each. Running totals look back
    to the beginning and are refused.
    """
    if series.grain is None:
        raise ValueError("a range needs a series with a grain")
    if any(m.carries and not m.lookback for m in measures):
        raise ValueError("a running total looks back to the beginning")
    back = max(1, *(m.lookback for m in measures))
    carries = max((m.lookback for m in measures if m.carries), default=0)
    before, behind = back, 0
    while True:
        low = period_of(start, series.grain, -before)
        high = period_of(end, series.grain, behind + 1) - dt.timedelta(days=1) if end is not None else None
        part = reduce(between_dates(df, series.date, low, high))
        short, open_ = _unfinished(df, part, series, start, end, low, high, back, carries)
        if not short and not open_:
            out = measure(part, series, *measures)
            return between_dates(out, series.date, start, end)
        before = before * GROWTH if short else before
        behind = max(1, behind * GROWTH) if open_ else behind


def _unfinished(df: DataFrame, part: DataFrame, series: Series, start: dt.date, end: dt.date | None, low: dt.date,
                high: dt.date | None, back: int, carries: int) -> tuple[bool, bool]:
    """Whether older rows, and whether later ones, exist that a series may need."""
    keys, date, value = list(series.keys), F.col(series.date), F.col(series.value)
    earlier = date < F.lit(start)
    past = F.sort_array(F.collect_list(F.when(earlier, F.struct(date.alias("date"), value.isNotNull().alias("known")))))
    found = part.where(date.isNotNull()).groupBy(*keys).agg(
        F.count_if(earlier).alias("rows"), F.max(date).alias("last"),
        # As many as the part has periods.
        *([past.alias("past")] if carries else []),
    )
    enough = F.col("rows") >= back
    if carries:
        far = F.slice("past", 1, F.greatest(F.size("past") - carries + 1, F.lit(0)))
        enough = enough & F.exists(far, lambda r: r["known"])
    short = _any(df.where(date < F.lit(low)), found.where(~enough), keys, "leftsemi")
    if end is None:
        return short, False
    closed = found.where(period_start(F.col("last"), series.grain) >= F.lit(period_of(end, series.grain)))
    return short, _any(df.where(date > F.lit(high)), closed, keys, "leftanti")


def _any(rows: DataFrame, of: DataFrame, keys: list[str], how: str) -> bool:
    """Whether there are rows of (or, by ``leftanti``, of others than) some series."""
    if keys:
        return not null_safe_join(rows.select(*keys), of.select(*keys), keys, how).isEmpty()
    return of.isEmpty() == (how == "leftanti") and not rows.isEmpty()
