"""Row pruning, renaming, typing, de-duplication and metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import DATE_FORMATS, decimal_comma, null_if_nan, parse_date, to_number
from ..model import registry_frame

_DATE_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


# ---- projections and row filters -------------------------------------------------------------

def select_present(df: DataFrame, *choices: str | tuple[str, Sequence[str]]) -> DataFrame:
    """Keep the columns that exist.

    A choice is a column name, or ``(new_name, candidates)`` which takes the first candidate that
    exists. Decided on the schema, so it costs no job.
    """
    picked = []
    for choice in choices:
        name, candidates = (choice, [choice]) if isinstance(choice, str) else choice
        found = next((c for c in candidates if c in df.columns), None)
        if found is not None:
            picked.append(F.col(found).alias(name))
    return df.select(*picked)


def drop_columns(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def drop_incomplete(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows where one of the columns that exist is missing."""
    present = [c for c in columns if c in df.columns]
    return df.dropna(subset=present) if present else df


def between_dates(df: DataFrame, date: str = "date", start=None, end=None) -> DataFrame:
    """Inclusive on both sides; either bound may be missing."""
    if start is not None:
        df = df.filter(F.col(date) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(date) <= F.lit(end))
    return df


def lookback(df: DataFrame, as_of, months: float | None = None, days: int | None = None,
             date: str = "date") -> DataFrame:
    """Rows of the last ``30.5 * months`` (or ``days``) days up to ``as_of``."""
    if (months is None) == (days is None):
        raise ValueError("give months or days")
    span = int(30.5 * months) if days is None else days
    end = F.lit(as_of).cast("date")
    return df.filter((F.col(date) >= F.date_sub(end, span)) & (F.col(date) <= end))


def drop_null_groups(df: DataFrame, *columns: str) -> DataFrame:
    """A missing group key forms no group."""
    return df.dropna(subset=list(columns))


# ---- names and types -------------------------------------------------------------------------

def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def value_column(df: DataFrame, exclude: Sequence[str] = ("date", "data")) -> str:
    """The first column that is not excluded."""
    for name in df.columns:
        if name not in exclude:
            return name
    raise ValueError("no value column")


def ensure_numeric(df: DataFrame, *columns: str) -> DataFrame:
    """Cast to double; what does not parse, and NaN, becomes NULL. Absent columns are ignored."""
    casts = {}
    for name in columns:
        if name in df.columns:
            dtype = df.schema[name].dataType
            casts[name] = (
                to_number(F.col(name)) if isinstance(dtype, T.StringType)
                else null_if_nan(F.col(name).cast("double"))
            )
    return df.withColumns(casts) if casts else df


def standardize_date(df: DataFrame, date: str = "date",
                     formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Give the frame a DATE column; ``data`` is taken when ``date`` is missing."""
    if date not in df.columns:
        if "data" not in df.columns:
            return df
        df, date = df.withColumnRenamed("data", "date"), "date"
    return normalize_date(df, date, formats)


def normalize_date(df: DataFrame, column: str = "last_date",
                   formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Parse a text column value by value; date and timestamp columns lose their time of day."""
    if column not in df.columns:
        return df
    if isinstance(df.schema[column].dataType, _DATE_LIKE):
        return df.withColumn(column, F.col(column).cast("date"))
    return df.withColumn(column, parse_date(F.col(column).cast("string"), formats))


def comma_to_number(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: decimal_comma(F.col(c)) for c in columns})


# ---- duplicates and gaps ---------------------------------------------------------------------

def remove_duplicates(df: DataFrame, order: Sequence[str], subset: Sequence[str] | None = None,
                      keep: str | bool = "first") -> DataFrame:
    """Keep the first, the last or (``False``) none of the rows that agree on ``subset``.

    ``order`` says what first and last mean. The rank filter reaches Spark as a group limit, and
    the count is a partial aggregate, so a group of any size shrinks to one row per task before
    the shuffle.
    """
    subset = list(subset or df.columns)
    if keep is False:
        single = df.groupBy(*subset).agg(
            F.count(F.lit(1)).alias("_rows"), F.first(F.struct(*df.columns)).alias("_row")
        )
        return single.filter(F.col("_rows") == 1).select("_row.*")
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first', 'last' or False")
    direction = [
        F.col(c).asc_nulls_last() if keep == "first" else F.col(c).desc_nulls_first()
        for c in order
    ]
    rank = F.row_number().over(Window.partitionBy(*subset).orderBy(*direction))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def fill_missing(df: DataFrame, values: Mapping[str, object] | None = None) -> DataFrame:
    """Replace NULL (and NaN) by a constant per column; absent columns are ignored."""
    fills = {}
    for name, value in (values or {}).items():
        if name in df.columns:
            dtype = df.schema[name].dataType
            current = F.col(name)
            if isinstance(dtype, (T.DoubleType, T.FloatType)):
                current = null_if_nan(current)
            fills[name] = F.coalesce(current, F.lit(value).cast(dtype))
    return df.withColumns(fills) if fills else df


# ---- metadata --------------------------------------------------------------------------------

def attach_registry(df: DataFrame, collected_at=None, registry: DataFrame | None = None,
                    on: Sequence[str] = ("source", "indicator")) -> DataFrame:
    """Look the indicator up; rows of unknown indicators keep their columns and get no metadata.

    The built-in registry is a constant table, hence the broadcast. A caller's own registry is
    joined without a hint, so Spark decides by its size.
    """
    lookup = F.broadcast(registry_frame(df.sparkSession)) if registry is None else registry
    metadata = [c for c in lookup.columns if c not in on and c != "code"]
    clash = [c for c in metadata if c in df.columns]
    found = lookup.select(*on, *(F.col(c).alias(f"_{c}") for c in metadata))
    out = df.join(found, list(on), "left")
    for name in metadata:
        new = F.col(f"_{name}")
        out = out.withColumn(name, F.coalesce(new, F.col(name)) if name in clash else new)
    out = out.drop(*(f"_{c}" for c in metadata))
    if collected_at is not None:
        out = out.withColumn("collected_at", _instant(collected_at))
    return out


def with_metadata(df: DataFrame, mode: str = "overwrite", **values) -> DataFrame:
    """Literal columns; ``mode='if_missing'`` leaves existing columns alone."""
    if mode not in ("overwrite", "if_missing"):
        raise ValueError("mode is 'overwrite' or 'if_missing'")
    new = {
        k: v if isinstance(v, Column) else F.lit(v)
        for k, v in values.items()
        if mode == "overwrite" or k not in df.columns
    }
    return df.withColumns(new) if new else df


def _instant(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("timestamp")


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the given order (a top-n in every task, then one merge of n rows)."""
    return df.orderBy(*(F.col(c).asc_nulls_last() for c in order)).limit(n)
