"""Ordered operators over series of any length.

A window partitioned by the series key sorts a whole series in one task. That is fine for a series
with one row per calendar period, but not for raw observations, where one series may hold a third
of all rows. Such series are evaluated in two levels:

1. Every row belongs to a chunk of its series: the calendar unit (year, month, day, and below that for
   instants) of its date. The coarsest unit of which no series has more than ``ROWS_PER_CHUNK`` rows is
   taken; one aggregate over keys and dates tells. Rows are not moved or written for it.
2. What a chunk needs from those before it comes from partial aggregates: totals and last values per chunk,
   summed up over the chunks of a series, and for measures that look back further the last rows of
   each chunk (the halo), which a group limit takes before the shuffle.
3. Measures are evaluated by (keys, chunk) over the chunk's own rows behind its halo, whose rows are then
   dropped. This is the only shuffle of whole rows.

A series whose days (or seconds) hold more rows than that is cut by its rows instead: the frame is
range-partitioned by (keys, date, tie) and staged with the partition number as its chunk.

The results equal those of one window over the whole series. The order (date, tie) has to be unique
within a series, as for any deterministic window. The frame is read more than once, so it must give the
same rows each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rounded
from ..model import Series
from ..session import stage

#: Rows that a chunk has at most, where no number of chunks is given.
ROWS_PER_CHUNK = 250_000
#: Calendar units of chunks by type of date, each ladder from fine to coarse; the next one is only tried if
#: no unit of the first fits.
UNITS = {
    T.DateType: (("day", "month", "year"),),
    T.TimestampType: (("day", "month", "year"), ("second", "minute", "hour")),
}
#: The chunk of rows without a date, which come last.
UNDATED = (1 << 62)
CHUNK, HALO, FILLED, TOTAL = "_chunk", "_halo", "_filled", "_total"
#: Rows of a rolling window from which it is computed by blocks.
WIDE = 64
_TEMPORARY = "_rolling_"


class Frame:
    """What a measure may use: the ordered window of a series and its value column."""

    def __init__(self, series: Series, chunked: bool):
        keys = [*series.keys, CHUNK] if chunked else list(series.keys or [F.lit(0)])
        # Halo rows precede a chunk's own rows by construction.
        first = [F.col(HALO).desc()] if chunked else []
        self.keys = keys
        self.window: WindowSpec = Window.partitionBy(*keys).orderBy(*first, *series.order())
        self.value = F.col(series.value)
        self._chunked = chunked

    def lag(self, periods: int) -> Column:
        return F.lag(self.value, periods).over(self.window)

    def filled(self, back: int = 0) -> Column:
        """The last non-null value at or before the row ``back`` rows ago."""
        known = F.coalesce(F.col(FILLED), self.value) if self._chunked else self.value
        return F.last(known, ignorenulls=True).over(
            self.window.rowsBetween(Window.unboundedPreceding, -back)
        )

    def rolling(self, aggregate: Callable[[Column], Column], n: int,
                min_periods: int | None = None) -> Column:
        """``aggregate`` over the last ``n`` rows, NULL below ``min_periods`` non-null values."""
        window = self.window.rowsBetween(1 - n, 0)
        enough = F.count(self.value).over(window) >= (n if min_periods is None else min_periods)
        return F.when(enough, aggregate(self.value).over(window))

    def running_sum(self, over_gaps: bool = False) -> Column:
        """Sum of the values so far. A row without a value gets NULL, or with ``over_gaps`` the
        sum that holds there."""
        window = self.window.rowsBetween(Window.unboundedPreceding, 0)
        if self._chunked:
            own = F.sum(F.when(~F.col(HALO), self.value)).over(window)
            before = F.last(F.col(TOTAL), ignorenulls=True).over(window)
            total = F.when(
                before.isNotNull() | own.isNotNull(),
                F.coalesce(before, F.lit(0.0)) + F.coalesce(own, F.lit(0.0)),
            )
        else:
            total = F.sum(self.value).over(window)
        return total if over_gaps else F.when(self.value.isNotNull(), total)


@dataclass(frozen=True)
class Rolling:
    """``mean``, ``sum`` or ``std`` of the last ``n`` rows; NULL below ``min_periods`` (default all) values."""

    kind: str
    n: int
    min_periods: int | None = None
    round_to: int | None = None

    _PLAIN = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp}

    def over_frame(self, frame: Frame) -> Column:
        return rounded(frame.rolling(self._PLAIN[self.kind], self.n, self.min_periods), self.round_to)


@dataclass(frozen=True)
class Measure:
    """A new column of a series.

    ``lookback`` is the number of earlier rows it reads; ``carries`` says that it also depends on
    running values from any distance back. A ``rolling`` one may be computed in another way than by ``build``.
    """

    column: str
    build: Callable[[Frame], Column]
    lookback: int = 0
    carries: bool = False
    rolling: Rolling | None = None


def measure(df: DataFrame, series: Series, *measures: Measure,
            chunks: int | None = None) -> DataFrame:
    """Add all measures with one shared window.

    A series with a declared grain takes a plain keyed window; without one it is evaluated by chunks:
    calendar units that fit, or ``chunks`` cuts of the rows if that is given. Cuts are written when this is
    called; use ``session.workspace`` to have them deleted when the result is done.
    """
    if not measures:
        return df
    if series.grain is not None:
        return _built(df, Frame(series, chunked=False), measures)
    base = chunked(df, series, chunks)
    halo = _halos(base, series, measures)
    own = base.withColumns({
        FILLED: F.lit(None).cast("double"), TOTAL: F.lit(None).cast("double"), HALO: F.lit(False),
    })
    built = _built(own.unionByName(halo, allowMissingColumns=True), Frame(series, chunked=True), measures)
    return built.filter(~F.col(HALO)).drop(CHUNK, HALO, FILLED, TOTAL)


def _built(df: DataFrame, frame: Frame, measures: Sequence[Measure]) -> DataFrame:
    """The measures as columns; they must not hide an input column that another measure reads."""
    wide = {m.column: m.rolling for m in measures if m.rolling and m.rolling.n >= WIDE}
    df, late = _wide(df, frame, wide)
    built = {m.column: late[m.column] if m.column in wide else m.build(frame) for m in measures}
    return df.withColumns(built).drop(*(c for c in df.columns if c.startswith(_TEMPORARY)))


def _wide(df: DataFrame, frame: Frame, measures: dict[str, Rolling]) -> tuple[DataFrame, dict[str, Column]]:
    """Rolling statistics in constant work per row, however wide: temporary columns, and the measures over them.

    Rows are put in blocks of n. A window is the end of one block and the beginning of the next, so running
    statistics from both sides of the blocks are all that is needed; they are merged, not subtracted, so nothing
    cancels. A frame of n rows would be evaluated anew for every row.
    """
    out: dict[str, Column] = {}
    for n in sorted({r.n for r in measures.values()}):
        name = lambda part, n=n: f"{_TEMPORARY}{n}_{part}"
        place = F.row_number().over(frame.window) - 1
        df = df.withColumn(name("place"), place % n).withColumn(name("block"), F.floor((place - F.col(name("place"))) / n))
        blocks = Window.partitionBy(*frame.keys, name("block")).orderBy(name("place"))
        back = Window.partitionBy(*frame.keys, name("block")).orderBy(F.col(name("place")).desc())
        parts = {"count": F.count, "sum": F.sum, "mean": F.avg, "var": F.var_pop}
        df = df.withColumns({name(f"own_{p}"): f(frame.value).over(blocks) for p, f in parts.items()})
        df = df.withColumns({name(f"end_{p}"): f(frame.value).over(back) for p, f in parts.items()})
        before = F.col(name("place")) < n - 1
        df = df.withColumns({name(f"past_{p}"): F.when(before, F.lag(name(f"end_{p}"), n - 1).over(frame.window)) for p in parts})
        own, past = ({p: F.col(name(f"{side}_{p}")) for p in parts} for side in ("own", "past"))
        zero = lambda c: F.coalesce(c, F.lit(0.0))
        a, b = zero(own["count"]), zero(past["count"])
        count = a + b
        total = F.when(count > 0, zero(own["sum"]) + zero(past["sum"]))
        apart = F.when((a > 0) & (b > 0), own["mean"] - past["mean"]).otherwise(0.0)
        spread = zero(own["var"]) * a + zero(past["var"]) * b + apart * apart * F.try_divide(a * b, count)
        kinds = {"mean": F.try_divide(total, count), "sum": total, "std": F.when(count > 1, F.sqrt(F.try_divide(spread, count - 1)))}
        for column, r in measures.items():
            if r.n == n:
                enough = count >= (n if r.min_periods is None else r.min_periods)
                out[column] = rounded(F.when(enough, kinds[r.kind]), r.round_to)
    return df, out


def chunked(df: DataFrame, series: Series, chunks: int | None = None) -> DataFrame:
    """The frame with the number of its chunk, in the order of the series, in ``CHUNK``."""
    unit = None if chunks else fitting_unit(df, series)
    return df.withColumn(CHUNK, chunk_of(series, unit)) if unit else cut(df, series, chunks)


def chunk_of(series: Series, unit: str) -> Column:
    start = F.date_trunc(unit, series.date)
    return F.coalesce(F.unix_seconds(start), F.lit(UNDATED)).cast("long")


def fitting_unit(df: DataFrame, series: Series, rows: int | None = None) -> str | None:
    """The coarsest calendar unit of which no series has more rows than that; None if there is none.

    Counts per series and fine unit are added up to the coarser ones, so the frame is read once. One row
    reaches the driver.
    """
    rows = rows or ROWS_PER_CHUNK
    for units in UNITS.get(type(df.schema[series.date].dataType), ()):
        start = lambda unit, of: F.date_trunc(unit, of).alias("_start")
        counts = df.groupBy(*series.keys, start(units[0], series.date)).agg(F.count(F.lit(1)).alias("n"))
        kept: list[str] = []
        for finer, unit in zip(units, units[1:]):
            most = [F.max(c).alias(c) for c in kept]
            counts = counts.groupBy(*series.keys, start(unit, "_start")).agg(
                F.sum("n").alias("_n"), F.max("n").alias(f"_{finer}"), *most
            ).withColumnRenamed("_n", "n")
            kept.append(f"_{finer}")
        found = counts.agg(F.max("n").alias(f"_{units[-1]}"), *(F.max(c).alias(c) for c in kept)).first()
        for unit in reversed(units):
            if (found[f"_{unit}"] or 0) <= rows:
                return unit
    return None


def cut(df: DataFrame, series: Series, chunks: int | None = None) -> DataFrame:
    """The frame staged in ordered chunks of similar size, numbered in ``CHUNK``."""
    order = [*(F.col(k).asc() for k in series.keys), *series.order()]
    if not chunks:
        # Adaptive execution would merge small chunks but never split large ones.
        chunks = max(1, -(-df.count() // ROWS_PER_CHUNK))
    ranged = df.repartitionByRange(chunks, *order)
    # Sorted rows compress well and give each file narrow min/max statistics.
    numbered = ranged.sortWithinPartitions(*order).withColumn(CHUNK, F.spark_partition_id())
    return stage(numbered, "chunks")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Join on columns of the same name where NULL equals NULL; the left side's copies stay."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(renamed, condition, how).drop(*(f"_r_{c}" for c in on))


def join_back(df: DataFrame, stats: DataFrame, on: Sequence[str],
              staged: bool = True) -> DataFrame:
    """Put the statistics of each group on its rows.

    Staged statistics have a size that Spark reads off the files: small ones are broadcast and the
    rows stay where they are, larger ones get a sort-merge join whose hot keys adaptive execution
    splits. From an unfinished aggregate Spark would guess its input's size and shuffle all rows.
    """
    return null_safe_join(df, stage(stats, "stats") if staged else stats, on, "left")


def _halos(base: DataFrame, series: Series, measures: Sequence[Measure]) -> DataFrame:
    """The rows that a chunk needs from the chunks of its series before it.

    Each is addressed to that chunk. The last one carries the running sum and the last non-null value there;
    if a measure takes the last value of an earlier row, all carry theirs.
    """
    keys, value = list(series.keys), series.value
    at, order = [*keys, CHUNK], [series.date, *series.tie]
    reach = max(1, *(m.lookback for m in measures))
    carried = [m.lookback for m in measures if m.carries]
    number = F.col(value).cast("double")
    rank = series.order_key(base)

    # One row per series and chunk, reduced in every task. What no measure asks for is not computed.
    statistics = {"rows": F.count(F.lit(1))}
    if carried:
        statistics["sum"] = F.sum(number)
        statistics["last"] = F.max_by(number, F.when(number.isNotNull(), rank))
    if reach == 1:
        statistics["end"] = F.max_by(value, rank)
    chunks = base.groupBy(*at).agg(*(c.alias(name) for name, c in statistics.items()))
    by_series = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CHUNK)
    before = by_series.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(None).cast("double")
    chunks = chunks.withColumns({
        "before": F.coalesce(F.sum("rows").over(before), F.lit(0)),
        FILLED: F.last("last", ignorenulls=True).over(before) if carried else none,
        TOTAL: F.sum("sum").over(before) if carried else none,
        **({"end": F.lag("end").over(by_series)} if reach == 1 else {}),
    })
    if reach == 1:
        unknown = [F.lit(None).cast(base.schema[c].dataType).alias(c) for c in order]
        return chunks.filter(F.col("before") > 0).select(
            *at, *unknown, F.col("end").alias(value), FILLED, TOTAL, F.lit(True).alias(HALO)
        )

    narrow = base.select(*at, *order, value)
    back = F.row_number().over(Window.partitionBy(*at).orderBy(*series.reverse_order()))
    # The rank filters become group limits: every task passes on so many rows per series and chunk.
    tails = narrow.withColumn("back", back).filter(F.col("back") <= reach)
    each = max(carried, default=0) > 1
    if each:
        # Of the rows with a value one more: the last one at or before the first row of the tail is among them.
        known = narrow.filter(number.isNotNull()).withColumn("back", back).filter(F.col("back") <= reach + 1)
        so_far = Window.partitionBy(*at).orderBy(*series.order(), "own").rowsBetween(Window.unboundedPreceding, 0)
        both = tails.withColumn("own", F.lit(True)).unionByName(known.withColumn("own", F.lit(False)))
        tails = both.withColumn("_known", F.last(number, ignorenulls=True).over(so_far)).filter("own").drop("own")
    spans = chunks.select(*at, "rows", "before", F.col(FILLED).alias("_start"))
    placed = null_safe_join(tails, spans, at)

    # A border behind row B needs the rows B-reach+1 .. B, which lie in at most two blocks.
    def block(position: Column) -> Column:
        return F.floor(position / reach)

    upto = F.col("before") + F.col("rows") - F.col("back") + 1
    rows = placed.select(
        *keys, *order, value, upto.alias("upto"), block(upto - 1).alias("block"),
        (F.coalesce("_known", "_start") if each else none).alias("_at_row"),
    )
    borders = chunks.filter(F.col("before") > 0).select(
        *at, "before", FILLED, TOTAL,
        F.explode(F.sequence(
            block(F.greatest(F.col("before") - reach, F.lit(0))), block(F.col("before") - 1)
        )).alias("block"),
    )
    found = null_safe_join(borders, rows, [*keys, "block"])
    wanted = (F.col("upto") <= F.col("before")) & (F.col("upto") > F.col("before") - reach)
    end = F.col("upto") == F.col("before")
    return found.filter(wanted).select(
        *at, *order, value,
        (F.col("_at_row") if each else F.when(end, F.col(FILLED))).alias(FILLED),
        F.when(end, F.col(TOTAL)).alias(TOTAL), F.lit(True).alias(HALO),
    )


def running_total(df: DataFrame, series: Series, column: str = "cumulative_value",
                  over_gaps: bool = False, chunks: int | None = None) -> DataFrame:
    """Running sum of a series; see :meth:`Frame.running_sum`."""
    total = Measure(column, lambda frame: frame.running_sum(over_gaps), carries=True)
    return measure(df, series, total, chunks=chunks)
