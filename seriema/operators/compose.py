"""Composite scores: weighted sums, ratios to the mean, clamps and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (exclusive) of the economic situation labels.
SITUATIONS = ((35.0, "excelente"), (45.0, "boa"), (55.0, "estável"), (70.0, "desafiadora"))
WORST_SITUATION = "crítica"


def ratio_to_mean(value: Column, mean: Column) -> Column:
    """``value / mean``, or 1 when the mean is not positive (or unknown)."""
    return F.when(mean > 0, F.try_divide(value, mean)).otherwise(F.lit(1.0))


def weighted_mean(value: Column, weight: Column, counted: Column | None = None) -> Column:
    """Aggregate with the weights of the counted rows (default all) scaled to one.

    A counted row without a value makes the score unknown; a row that is not there has no weight.
    """
    if counted is not None:
        value, weight = F.when(counted, value), F.when(counted, weight)
    total = F.try_divide(F.sum(value * weight), F.sum(weight))
    rows = F.count(F.lit(1)) if counted is None else F.count_if(counted)
    return F.when(F.count(value) == rows, total)


def elasticity(change: Column, base: Column, growth: Column) -> Column:
    """Percent change of a rate per percent of growth, with the sign turned; NULL on a zero."""
    return F.try_divide(-(F.try_divide(change, base) * 100), growth)


def linear_combination(*terms: tuple[float, Column]) -> Column:
    """NULL as soon as one input is NULL."""
    total = F.lit(terms[0][0]) * terms[0][1]
    for factor, column in terms[1:]:
        total = total + F.lit(factor) * column
    return total


def label_below(value: Column, bounds: Sequence[tuple[float, str]] = SITUATIONS,
                otherwise: str = WORST_SITUATION) -> Column:
    """The label of the first bound above the value; NULL stays NULL."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in bounds:
        label = label.when(value < bound, name)
    return label.otherwise(otherwise)


def default_text(value: Column, default: Column | str) -> Column:
    return F.coalesce(value, F.lit(default) if isinstance(default, str) else default)
