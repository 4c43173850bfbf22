"""Date parsing, period arithmetic and period identifiers."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tried in this order, value by value.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "dd/MM/yyyy",
    "MM/yyyy",
)

_STEPS = {
    "D": "INTERVAL 1 DAY",
    "W": "INTERVAL 7 DAY",
    "M": "INTERVAL 1 MONTH",
    "Q": "INTERVAL 3 MONTH",
    "Y": "INTERVAL 1 YEAR",
}


# What each field of a format may look like.
_FIELDS = {
    "yyyy": r"\d{4}", "MM": r"(?:0[1-9]|1[0-2])", "dd": r"\d{2}", "HH": r"(?:[01]\d|2[0-3])",
    "mm": r"[0-5]\d", "ss": r"[0-5]\d",
}
_TOKEN = re.compile(r"'([^']*)'|(" + "|".join(_FIELDS) + r")|(.)")


def _parse_one(text: Column, form: str) -> Column:
    """Cut the fields out of their fixed places and cast the ISO text.

    The cast returns NULL for an impossible day at no cost, where a formatter would raise and
    catch an exception for every value that does not fit, most of them in a mixed column.
    """
    shape, at, places = "", 1, {}
    for quoted, field, other in _TOKEN.findall(form):
        if other.isalpha():  # a letter with a meaning of its own
            return F.try_to_timestamp(text, F.lit(form)).cast("date")
        shape += _FIELDS[field] if field else re.escape(quoted or other)
        if field:
            places[field] = at
        at += len(field or quoted or other)
    if not {"yyyy", "MM"} <= places.keys():
        return F.try_to_timestamp(text, F.lit(form)).cast("date")
    day = F.substring(text, places["dd"], 2) if "dd" in places else F.lit("01")
    iso = F.concat_ws("-", F.substring(text, places["yyyy"], 4),
                      F.substring(text, places["MM"], 2), day)
    return F.when(text.rlike(f"^{shape}$"), iso.try_cast("date"))


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits gives the date, otherwise NULL."""
    return F.coalesce(*(_parse_one(text, f) for f in formats))


def year_quarter(date: Column) -> Column:
    return F.concat(F.year(date), F.lit("Q"), F.quarter(date))


def period_start(date: Column, freq: str) -> Column:
    day = date.cast("date")
    if freq == "D":
        return day
    return F.trunc(day, {"W": "week", "M": "month", "Q": "quarter", "Y": "year"}[freq])


def period_end(date: Column, freq: str) -> Column:
    """Last day of the period; weeks end on Sunday."""
    start = period_start(date, freq)
    if freq == "D":
        return start
    if freq == "W":
        return F.date_add(start, 6)
    return F.last_day(F.add_months(start, {"M": 0, "Q": 2, "Y": 11}[freq]))


def period_step(freq: str) -> Column:
    return F.expr(_STEPS[freq])


def period_to_date(period: Column, frequency: Column | str) -> Column:
    """First day of a period written YYYYMM, YYYYQn, YYYY0n, YYYYn or YYYY."""
    frequency = F.lit(frequency) if isinstance(frequency, str) else frequency
    quarter = F.right(period, F.lit(1)).try_cast("int")
    month = (
        F.when((frequency == "monthly") & period.rlike(r"^\d{4}(0[1-9]|1[0-2])$"),
               F.right(period, F.lit(2)))
        .when((frequency == "quarterly") & period.rlike(r"^\d{4}[Q0]?[1-4]$"),
              F.lpad(((quarter - 1) * 3 + 1).cast("string"), 2, "0"))
        .when(~frequency.isin("monthly", "quarterly") & period.rlike(r"^\d{4}$"), "01")
    )
    # concat is NULL without a month
    return F.concat(F.left(period, F.lit(4)), F.lit("-"), month, F.lit("-01")).try_cast("date")


def date_to_period(date: Column, frequency: str) -> Column:
    """The inverse: YYYYMM, YYYYQn or YYYY."""
    if frequency == "monthly":
        return F.date_format(date, "yyyyMM")
    if frequency == "quarterly":
        return year_quarter(date)
    return F.date_format(date, "yyyy")
