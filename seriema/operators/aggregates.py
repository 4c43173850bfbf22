"""Grouped statistics. Everything here is a partial and a final aggregate."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import null_if_nan, period_start, year_quarter
from ..model import Series
from ..session import constant_frame, stage
from .spread import CHUNK, ROWS_PER_CHUNK, cut


def _labelled(periods: DataFrame, freq: str, keys: Sequence[str]) -> DataFrame:
    """Name the period. Rows are grouped by its first day, which is cheaper than by a text."""
    start = F.col("_start")
    name, label = {
        "M": ("year_month", F.date_format(start, "yyyy-MM")),
        "Q": ("year_quarter", year_quarter(start)),
        "Y": ("year", F.year(start)),
    }.get(freq, ("period", start))
    measures = [c for c in periods.columns if c not in (*keys, "_start")]
    return periods.select(*keys, label.alias(name), *measures)


def _periods(df: DataFrame, series: Series, freq: str):
    start = period_start(F.col(series.date), freq).alias("_start")
    return df.filter(F.col(series.date).isNotNull()).groupBy(*series.keys, start)


def period_mean(df: DataFrame, series: Series, freq: str = "M") -> DataFrame:
    """Mean per period; the row is dated by the latest observation of the period."""
    means = _periods(df, series, freq).agg(
        F.max(series.date).alias(series.date), F.avg(series.value).alias(series.value)
    )
    return _labelled(means, freq, series.keys)


def period_ohlc(df: DataFrame, series: Series, freq: str = "M",
                lone_volatility: float | None = 0.0) -> DataFrame:
    """Open, close, high, low, mean and sample deviation per period.

    ``lone_volatility`` is the deviation of a period with one row.
    """
    value, when = F.col(series.value), series.rank_key(df)
    deviation = F.when(F.count(F.lit(1)) > 1, F.stddev_samp(value)).otherwise(
        F.lit(lone_volatility).cast("double")
    )
    bars = _periods(df, series, freq).agg(
        F.max(series.date).alias(series.date),
        F.min_by(value, when).alias("open"),
        F.max_by(value, when).alias("close"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.avg(value).alias("avg"),
        deviation.alias("volatility"),
    )
    return _labelled(bars, freq, series.keys)


def series_stats(df: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Mean, extremes and sample deviation per series (one row in all when there are no keys)."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.stddev_samp(v).alias("std"), F.count(v).alias("count"),
    )


def counts(df: DataFrame, key: str, wanted: Column) -> DataFrame:
    """One row (rows, wanted, keys): all rows, those that meet a condition, distinct keys.

    Counted per key first, so that no task holds the distinct keys of another kind of row.
    """
    by_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(wanted).alias("met"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return by_key.agg(total("n").alias("rows"), total("met").alias("wanted"), F.count(key).alias("keys"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


#: Rank error of the sketches is one in so many rows.
ACCURACY = 10_000
#: How far from a wanted probability a bracket may reach, from narrow to everything.
_WIDTHS = (*(3 / ACCURACY * 4**k for k in range(5)), 1.0)


def _cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles ``_0``, ``_1``, ..., NaN being missing."""
    return df.select(*(null_if_nan(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)))


def _literal(value: float) -> str:
    return f"double('{value!r}')"


@dataclass(frozen=True)
class _Bracket:
    """Values between which the ranks ``low`` and ``high`` of a column lie, unless counting tells otherwise.

    Its conditions are SQL text: a wide frame would spend its time in building columns one call at a time.
    """

    cell: int
    column: str
    probability: float
    rows: int
    edges: tuple[tuple[float, float], ...]
    width: int

    @property
    def position(self) -> float:
        return (self.rows - 1) * self.probability

    @property
    def ranks(self) -> tuple[int, int]:
        return math.floor(self.position), math.ceil(self.position)

    @property
    def ends(self) -> tuple[float, float]:
        return self.edges[self.width]

    def inside(self) -> str:
        low, high = map(_literal, self.ends)
        return f"_{self.cell} > {low} AND _{self.cell} < {high}"

    def counts(self) -> dict[str, str]:
        low, high = map(_literal, self.ends)
        cell = f"_{self.cell}"
        return {
            "below": f"count_if({cell} < {low})", "at_low": f"count_if({cell} = {low})",
            "inside": f"count_if({self.inside()})", "at_high": f"count_if({cell} = {high} AND {low} <> {high})",
        }

    def holds(self, n: Mapping[str, int]) -> bool:
        """Whether both ranks lie between the ends, these included."""
        first, last = self.ranks
        return n["below"] <= first and last < sum(n.values())


def _sketches(columns: Sequence[str], probabilities: Sequence[float]) -> list[Column]:
    """Per cell one aggregate: rows with a value, and the edges of all brackets from one mergeable sketch."""
    asked = [x for p in probabilities for d in _WIDTHS for x in (max(0.0, p - d), min(1.0, p + d))]
    listed = ", ".join(map(_literal, asked))
    return [
        F.expr(f"struct(count(_{i}) AS n, percentile_approx(_{i}, array({listed}), {ACCURACY}) AS edges)").alias(f"_sketch_{i}")
        for i in range(len(columns))
    ]


def _brackets(found: Row, columns: Sequence[str], probabilities: Sequence[float]) -> list[_Bracket]:
    out, step = [], 2 * len(_WIDTHS)
    for i, column in enumerate(columns):
        n, edges = found[f"_sketch_{i}"]
        for k, p in enumerate(probabilities if n else ()):
            own = edges[k * step:(k + 1) * step]
            # Both wanted ranks and the error of the sketch have to fit between the edges.
            width = next(w for w, d in enumerate(_WIDTHS) if d * n >= 3 * n / ACCURACY + 2 or d == 1.0)
            out.append(_Bracket(i, column, p, n, tuple(zip(own[::2], own[1::2])), width))
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
                    chunks: int | None = None) -> DataFrame:
    """Interpolated quantiles, exact at any size: (column, probability, quantile).

    A sketch of each column brackets the wanted ranks; one more pass counts the values below each bracket and
    at its ends, and keeps those strictly between, a few in ten thousand however often values repeat, of which the
    ranks are looked up. No other value is moved. ``percentile`` would instead collect all distinct values of
    a column in one task.
    """
    cells = _cells(df, columns)
    found = cells.agg(*_sketches(columns, probabilities)).first()
    return _selected(cells, _brackets(found, columns, probabilities), chunks)


def _selected(df: DataFrame, brackets: list[_Bracket], chunks: int | None) -> DataFrame:
    """The quantiles of brackets of a frame of cells. One that does not hold its ranks, which counting shows, is widened."""
    spark, parts = df.sparkSession, []
    while brackets:
        counts, kept = _inside(df, brackets)
        ready = [(i, b, n) for i, (b, n) in enumerate(zip(brackets, counts)) if b.holds(n)]
        if ready:
            parts.append(_ranked(spark, kept, ready, chunks))
        brackets = [replace(b, width=b.width + 1) for b, n in zip(brackets, counts) if not b.holds(n)]
    if not parts:
        return spark.createDataFrame([], "column string, probability double, quantile double")
    return reduce(DataFrame.unionByName, parts)


def _inside(df: DataFrame, brackets: Sequence[_Bracket]) -> tuple[list[dict[str, int]], DataFrame]:
    """Per bracket how many values lie below, at its ends and inside, and the staged values inside: (bracket, value).

    The counts are observed while the values are written, by tasks whose results count once.
    """
    counted = Observation()
    every = [b.counts() for b in brackets]
    listed = F.expr("array(" + ", ".join(c for one in every for c in one.values()) + ")")
    values = ", ".join(f"CASE WHEN {b.inside()} THEN struct({i} AS bracket, _{b.cell} AS value) END" for i, b in enumerate(brackets))
    kept = df.observe(counted, listed.alias("counts")).where(" OR ".join(f"({b.inside()})" for b in brackets))
    kept = stage(kept.selectExpr(f"inline(array_compact(array({values})))"), "bracket-values")
    found = iter(counted.get["counts"])
    return [{name: next(found) for name in one} for one in every], kept


def _ranked(spark: SparkSession, kept: DataFrame, brackets: Sequence[tuple[int, _Bracket, dict[str, int]]],
            chunks: int | None) -> DataFrame:
    """(column, probability, quantile) from the values of each bracket.

    Equal values are counted before they are sorted, so no value is hot. The counts are cut into ordered chunks;
    the chunk totals tell which hold the wanted ranks, and only those are ranked.
    """
    wanted = constant_frame(
        spark, ("bracket", "column", "probability", "position", "low", "high"),
        [(i, b.column, b.probability, b.position - n["below"], *(r - n["below"] for r in b.ranks)) for i, b, n in brackets],
        (pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()),
    )
    ends = constant_frame(
        spark, ("bracket", "value", "n"),
        [(i, v, n[name]) for i, b, n in brackets for v, name in zip(b.ends, ("at_low", "at_high")) if n[name]],
        (pa.int32(), pa.float64(), pa.int64()),
    )
    between = kept.where(F.col("bracket").isin([i for i, *_ in brackets]))
    counts = between.groupBy("bracket", "value").agg(F.count(F.lit(1)).alias("n")).unionByName(ends)
    chunks = chunks or max(1, -(-sum(n["inside"] for *_, n in brackets) // ROWS_PER_CHUNK))
    base = cut(counts, Series(keys=("bracket",), date="value", value="n"), chunks)
    before = Window.partitionBy("bracket").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    # One row per bracket and chunk.
    totals = base.groupBy("bracket", CHUNK).agg(F.sum("n").alias("rows")).withColumn(
        "before", F.coalesce(F.sum("rows").over(before), F.lit(0)))

    def within(rank: str, start: Column, end: Column) -> Column:
        return (F.col(rank) >= start) & (F.col(rank) < end)

    chunk = (F.col("before"), F.col("before") + F.col("rows"))
    places = totals.join(F.broadcast(wanted), "bracket").filter(within("low", *chunk) | within("high", *chunk)).drop("rows")
    # At most two chunks per bracket are wanted, and the brackets are fixed by the call.
    held = base.join(F.broadcast(places), ["bracket", CHUNK])
    so_far = Window.partitionBy("bracket", CHUNK).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = held.withColumn("upto", F.col("before") + F.sum("n").over(so_far))

    def at(rank: str) -> Column:
        return F.max(F.when(within(rank, F.col("upto") - F.col("n"), F.col("upto")), F.col("value")))

    return ranked.groupBy("column", "probability", "position").agg(at("low").alias("a"), at("high").alias("b")).select(
        "column", "probability",
        (F.col("a") + (F.col("b") - F.col("a")) * (F.col("position") - F.floor("position"))).alias("quantile"),
    )


# Name of a moment -> SQL aggregate.
_MOMENTS = {"count": "count", "mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str] | None = None,
             chunks: int | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, one row per numeric column.

    Moments and sketches share a pass; one row of them reaches the driver.
    """
    columns = list(columns or numeric_columns(df))
    cells = _cells(df, columns)
    moments = [
        F.expr("struct(" + ", ".join(f"{f}(_{i}) AS `{name}`" for name, f in _MOMENTS.items()) + ")").alias(f"_moments_{i}")
        for i in range(len(columns))
    ]
    found = cells.agg(*moments, *_sketches(columns, QUARTILES)).first()
    lines = constant_frame(
        df.sparkSession, ("column", *_MOMENTS), [(c, *found[f"_moments_{i}"]) for i, c in enumerate(columns)],
        (pa.string(), pa.int64(), *[pa.float64()] * (len(_MOMENTS) - 1)),
    )
    p = F.col("probability")
    quartiles = _selected(cells, _brackets(found, columns, QUARTILES), chunks).groupBy("column").agg(
        F.max(F.when(p == 0.25, F.col("quantile"))).alias("q25"),
        F.max(F.when(p == 0.5, F.col("quantile"))).alias("q50"),
        F.max(F.when(p == 0.75, F.col("quantile"))).alias("q75"),
    )
    return lines.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def run_summary(report: DataFrame) -> DataFrame:
    """Successes, failures and success rate of a run report."""
    ok = F.col("success")
    return report.agg(
        F.count_if(ok).alias("successes"), F.count_if(~ok).alias("failures"),
        F.try_divide(F.count_if(ok) * F.lit(100.0), F.count(F.lit(1))).alias("success_rate"),
    )
