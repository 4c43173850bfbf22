"""Joins of period series and appends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .calendar import quarter_key
from .spread import null_safe_join


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str] | str,
               pair_missing: bool = False) -> DataFrame:
    """Full outer join on equal keys.

    A row with a missing key stays a row of its own, unless ``pair_missing`` asks for missing keys
    to meet each other, all with all. Sides should have one row per key (``one_per``); rows that
    repeat a key are paired. A column that both sides have besides the keys is kept from the left.
    """
    on = [on] if isinstance(on, str) else list(on)
    right = right.drop(*(c for c in right.columns if c in left.columns and c not in on))
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        own, other = F.col(c), F.col(f"_r_{c}")
        condition = condition & (own.eqNullSafe(other) if pair_missing else own == other)
    merged = {c: F.coalesce(F.col(c), F.col(f"_r_{c}")) for c in on}
    joined = left.join(renamed, condition, "full_outer")
    return joined.withColumns(merged).drop(*(f"_r_{c}" for c in on))


def one_per(df: DataFrame, keys: Sequence[str], *order: str | Column) -> DataFrame:
    """The row of each key that comes first by ``order``, names meaning the largest; rows without a key stay.

    The rank filter becomes a group limit: every task passes on one row per key. A row without a key gets a
    key of its own, so that what lies below is computed once and no task gets all of them.
    """
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in keys), F.lit(True))
    largest = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    alone = df.withColumn("_alone", F.when(~known, F.monotonically_increasing_id()))
    rank = F.row_number().over(Window.partitionBy(*keys, "_alone").orderBy(*largest))
    return alone.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_alone")


def left_by_quarter(left: DataFrame, right: DataFrame, keys: Sequence[str] = (),
                    per_quarter: str = "last", date: str = "date") -> DataFrame:
    """Left join on the quarter of the date.

    ``per_quarter='last'`` takes the latest right row of a quarter (of equal dates the one with the
    larger values), so that a monthly right side does not repeat left rows; ``'all'`` pairs every
    row.
    """
    values = [c for c in right.columns if c not in (*keys, date)]
    dated = right.filter(F.col(date).isNotNull()).withColumn("_quarter", quarter_key(F.col(date)))
    if per_quarter == "last":
        order = [F.col(c).desc_nulls_last() for c in (date, *values)]
        rank = F.row_number().over(Window.partitionBy(*keys, "_quarter").orderBy(*order))
        dated = dated.withColumn("_rank", rank).where("_rank = 1").drop(date, "_rank")
    elif per_quarter == "all":
        dated = dated.drop(date)
    else:
        raise ValueError("per_quarter is 'last' or 'all'")
    quartered = left.withColumn("_quarter", quarter_key(F.col(date)))
    if keys:
        # The quarter of an undated left row is NULL and has no partner on the right.
        joined = null_safe_join(quartered, dated, [*keys, "_quarter"], "left")
    else:
        joined = quartered.join(dated, "_quarter", "left")
    return joined.drop("_quarter")


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Put the one row of a keyless aggregate on every row.

    As a scalar subquery it is a constant to the scan of ``df``: nothing is joined or moved.
    """
    row = scalars.select(F.struct(*scalars.columns)).scalar()
    held = df.withColumn("_row", row)
    return held.select(*df.columns, *(F.col("_row")[c].alias(c) for c in scalars.columns))


def append(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; columns that a frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
