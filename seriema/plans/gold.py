"""Silver series to dashboards with composite indices.

Inputs are mappings from indicator to its silver frame; a missing indicator is a missing key. A frame
may hold several places: a dashboard takes the national rows (and those without a place), or, by
``place``, those of another one; with ``keys=("localidade",)`` panel and labor market have the rows of
every place. Of several sources of an indicator one counts in a period: the first of the ``sources`` asked for, then the
registered one of the indicator, then by name; with ``keys=("source",)`` each has rows of its own. Of several rows
of a source, place and period the latest counts (of equal dates the larger value). Results have the fixed gold schemas, with the keys behind them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import clamp
from ..model import LABOR_SCHEMA, MACRO_SCHEMA, MONTHLY_SCHEMA, NATIONAL, SILVER_METADATA, Series
from ..operators.cleaning import normalize_date, select_present
from ..operators.compose import (
    default_text,
    elasticity,
    label_below,
    linear_combination,
    ratio_to_mean,
    weighted_mean,
)
from ..operators.joins import append, full_outer, left_by_quarter, one_per
from ..operators.spread import measure
from ..operators.windows import (
    latest_rows,
    min_max_scale,
    moving_average,
    shift,
    trend_label,
)
from ..sources.sinks import conform

INDICATORS = ("ipca", "selic", "pib", "cambio", "desemprego")

# Weights of the pressure index and of the health index.
PRESSURE_WEIGHTS = {"ipca_annual_change": 0.4, "selic": 0.3, "cambio_volatility": 0.3}
HEALTH_WEIGHTS = {"ipca": 0.35, "selic": 0.30, "desemprego": 0.35}

# The column that holds the annual change of an indicator.
ANNUAL_CHANGE = {
    "ipca": "year_over_year_pct", "pib": "annual_change_pct", "desemprego": "annual_change_pp",
}


def split_indicators(silver: DataFrame,
                     indicators: Sequence[str] = INDICATORS) -> dict[str, DataFrame]:
    """One filtered frame per indicator; on a partitioned layer each reads only its folders."""
    return {i: silver.filter(F.col("indicator") == i) for i in indicators}


def _empty(like: DataFrame | SparkSession, schema: StructType) -> DataFrame:
    spark = like if isinstance(like, SparkSession) else like.sparkSession
    return spark.createDataFrame([], schema)


def _with_keys(schema: StructType, keys: Sequence[str]) -> StructType:
    return StructType([*schema.fields, *(StructField(k, StringType()) for k in keys)])


def _placed(frame: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """The rows a dashboard takes, dated, with all ``keys`` and their source."""
    frame = normalize_date(frame, "date")
    if "localidade" in frame.columns and "localidade" not in keys:
        frame = frame.where(F.col("localidade").isNull() | (F.col("localidade") == place))
    absent = {k: F.lit(None).cast("string") for k in (*keys, "source") if k not in frame.columns}
    # A place that is not told is the national one.
    told = {k: F.coalesce(F.col(k), F.lit(place)) for k in keys if k == "localidade"}
    return frame.withColumns(absent).withColumns(told)


def _preference(indicator: str, sources: Sequence[str]) -> Column:
    """The place of a row's source in the order of those of an indicator; others are equal."""
    registered = SILVER_METADATA[indicator][3:] if indicator in SILVER_METADATA else ()
    place = F.lit(len(sources) + 1)
    for k, name in reversed(list(enumerate((*sources, *registered)))):
        place = F.when(F.col("source") == name, k).otherwise(place)
    return place


def _by_source(place: Column) -> list[Column]:
    return [place.asc(), F.col("source").asc_nulls_last()]


def _one_source(frame: DataFrame, keys: Sequence[str], period: str, value: str, indicator: str,
                sources: Sequence[str]) -> DataFrame:
    """One row per key and period, of the preferred source."""
    order = [*([] if "source" in keys else _by_source(_preference(indicator, sources))), "date", value]
    kept = one_per(frame, [*keys, period], *order)
    return kept if "source" in keys else kept.drop("source")


def _monthly(frame: DataFrame, keys: Sequence[str], indicator: str, sources: Sequence[str], *columns) -> DataFrame:
    """One row per place and month."""
    picked = select_present(frame, "date", *columns, *dict.fromkeys((*keys, "source")))
    picked = picked.withColumn("year_month", F.date_format("date", "yyyy-MM"))
    return _one_source(picked, keys, "year_month", columns[0][0], indicator, sources)


def _finish(df: DataFrame, schema: StructType, run_ts) -> DataFrame:
    return conform(df.withColumn("updated_at", F.lit(run_ts).cast("timestamp")), schema)


def monthly_panel(indicators: Mapping[str, DataFrame], spark: SparkSession, run_ts=None,
                  keys: Sequence[str] = (), place: str = NATIONAL,
                  sources: Sequence[str] = ()) -> DataFrame:
    """Prices, policy rate and exchange rate side by side per month.

    All three are required. The pressure index is scaled to 0..100 over the panel of a place; if one
    of its input columns does not exist it is the plain sum of rate and price index.
    """
    schema = _with_keys(MONTHLY_SCHEMA, keys)
    if any(indicators.get(i) is None for i in ("ipca", "selic", "cambio")):
        return _empty(spark, schema)
    prices = _monthly(
        _placed(indicators["ipca"], keys, place), keys, "ipca", sources, ("ipca", ["value"]),
        ("ipca_monthly_change", ["monthly_change_pct"]),
        ("ipca_annual_change", ["year_over_year_pct"]),
    )
    rates = _monthly(
        _placed(indicators["selic"], keys, place), keys, "selic", sources, ("selic", ["value"]),
        ("selic_moving_avg", ["moving_avg_3m"]),
    ).drop("date")
    exchange = _monthly(
        _placed(indicators["cambio"], keys, place), keys, "cambio", sources, ("cambio", ["value"]),
        ("cambio_monthly_change", ["monthly_change_pct", "return_pct"]),
        ("cambio_volatility", ["volatility", "volatility_20"]),
    ).drop("date")

    on = [*keys, "year_month"]
    panel = full_outer(full_outer(prices, rates, on), exchange, on)
    panel = panel.withColumn("real_interest_rate", F.col("selic") - F.col("ipca"))
    index = "economic_pressure_index"
    if set(PRESSURE_WEIGHTS) <= set(panel.columns):
        terms = [(weight, F.col(c)) for c, weight in PRESSURE_WEIGHTS.items()]
        panel = min_max_scale(panel.withColumn(index, linear_combination(*terms)), index, keys, grain="M")
    else:
        panel = panel.withColumn(index, F.col("selic") + F.col("ipca"))
    return _finish(panel, schema, run_ts).orderBy(F.col("year_month").asc_nulls_last(), *keys)


def labor_market(indicators: Mapping[str, DataFrame], spark: SparkSession, run_ts=None,
                 per_quarter: str = "last", keys: Sequence[str] = (),
                 place: str = NATIONAL, sources: Sequence[str] = ()) -> DataFrame:
    """Unemployment with the product of the same quarter and their elasticity."""
    schema = _with_keys(LABOR_SCHEMA, keys)
    if indicators.get("desemprego") is None:
        return _empty(spark, schema)
    labor = select_present(
        _placed(indicators["desemprego"], keys, place), "date",
        ("unemployment_rate", ["value"]), ("unemployment_qtr_change", ["quarterly_change_pp"]),
        ("unemployment_annual_change", ["annual_change_pp"]), *dict.fromkeys((*keys, "source")),
    )
    # One row per place and quarter, so that the windows below are bounded by the calendar.
    labor = labor.withColumn("_quarter", F.date_trunc("quarter", "date"))
    labor = _one_source(labor, keys, "_quarter", "unemployment_rate", "desemprego", sources).drop("_quarter")
    product = indicators.get("pib")
    if product is not None:
        columns = select_present(
            _placed(product, keys, place), "date", ("gdp", ["value"]),
            ("gdp_growth", ["quarterly_change_pct"]), *dict.fromkeys((*keys, "source")),
        )
        measured = [c for c in columns.columns if c not in ("date", "source", *keys)]
        if measured:
            # The product comes by quarter or by month.
            months = columns.withColumn("_month", F.date_trunc("month", "date"))
            columns = _one_source(months, keys, "_month", measured[0], "pib", sources).drop("_month")
            labor = left_by_quarter(labor, columns, keys, per_quarter)
    needed = {"unemployment_qtr_change", "gdp_growth", "unemployment_rate"}
    if needed <= set(labor.columns):
        rates = Series(keys=tuple(keys), value="unemployment_rate", grain="Q")
        labor = measure(labor, rates, shift(1, "_previous_rate"))
        change, before = F.col("unemployment_qtr_change"), F.col("_previous_rate")
        labor = labor.withColumn(
            "employment_gdp_elasticity", elasticity(change, before, F.col("gdp_growth"))
        ).drop("_previous_rate")
        labor = measure(
            labor, rates.but(value="employment_gdp_elasticity"),
            moving_average(4, "employment_gdp_elasticity_ma", min_periods=1),
        )
    return _finish(labor, schema, run_ts)


def _long(indicators: Mapping[str, DataFrame], place: str, sources: Sequence[str]) -> DataFrame | None:
    """The columns that the macro dashboard reads, all indicators below one another, with one row per indicator
    and month (of a quarterly one, per quarter)."""
    parts = []
    for name in INDICATORS:
        frame = indicators.get(name)
        if frame is not None:
            picked = select_present(
                _placed(frame, (), place), "date", "value", "indicator_name", "unit",
                ("measured_change", [c for c in [ANNUAL_CHANGE.get(name)] if c]), "source",
            )
            parts.append(picked.withColumns({"indicator": F.lit(name), "_place": _preference(name, sources)}))
    if not parts:
        return None
    out = append(*parts).withColumn("_month", F.date_trunc("month", "date"))
    out = one_per(out, ["indicator", "_month"], *_by_source(F.col("_place")), "date", "value")
    out = out.drop("_month", "_place", "source")
    texts = {c: F.lit(None).cast("string") for c in ("indicator_name", "unit")
             if c not in out.columns}
    if "measured_change" not in out.columns:
        texts["measured_change"] = F.lit(None).cast("double")
    return out.withColumns(texts) if texts else out


def _latest(long: DataFrame) -> DataFrame:
    """One line per indicator: latest value, mean, annual change and trend.

    The exchange rate has no annual change of its own; it is taken over 12 rows.
    """
    nth, value = F.col("_nth"), F.col("value")
    series = Series(keys=("indicator",), tie=("value",), grain="M")
    means = long.groupBy("indicator").agg(F.avg(value).alias("mean"))

    def at(column, n: int = 1):
        return F.max(F.when(nth == n, column))

    base = F.when(at(value, 13) > 0, at(value, 13))
    lines = latest_rows(long, series, 13).groupBy("indicator").agg(
        default_text(at(F.col("indicator_name")), F.upper("indicator")).alias("indicator_name"),
        at(value).alias("last_value"),
        at(F.col("date")).alias("last_date"),
        default_text(at(F.col("unit")), "%").alias("unit"),
        F.when(F.col("indicator") == "cambio", (F.try_divide(at(value), base) - 1) * 100)
        .otherwise(at(F.col("measured_change"))).alias("annual_change"),
        trend_label(F.count(F.lit(1)), at(value), at(value, 3)).alias("trend"),
    )
    return lines.join(means, "indicator")


_LINE = ("indicator", "indicator_name", "last_value", "last_date", "unit", "annual_change",
         "trend", "situation")


def health_index(latest: DataFrame) -> DataFrame:
    """One row (score, inputs, lines): the index, how many inputs it has, all lines gathered.

    The score is the weighted ratio of latest values to their means, 50 being average. There are
    as many lines as known indicators.
    """
    weights = F.lit(None).cast("double")
    for name, weight in HEALTH_WEIGHTS.items():
        weights = F.when(F.col("indicator") == name, F.lit(weight)).otherwise(weights)
    lines = latest.withColumns({"situation": F.lit(None).cast("string"), "_weight": weights})
    counted = F.col("_weight").isNotNull()
    ratio = ratio_to_mean(F.col("last_value"), F.col("mean"))
    return lines.agg(
        clamp(
            50 * weighted_mean(F.when(counted, ratio), F.col("_weight"), counted), 0, 100
        ).alias("score"),
        F.count_if(counted).alias("inputs"),
        F.collect_list(F.struct(*_LINE)).alias("lines"),
    )


def macro_dashboard(indicators: Mapping[str, DataFrame], spark: SparkSession, as_of=None,
                    run_ts=None, place: str = NATIONAL, sources: Sequence[str] = ()) -> DataFrame:
    """Latest state of every indicator and the health index.

    Empty below two indicators; without a health line below two of its inputs.
    """
    long = _long(indicators, place, sources)
    if long is None:
        return _empty(spark, MACRO_SCHEMA)
    summary = F.struct(
        F.lit("economic_health").alias("indicator"),
        F.lit("Índice de Saúde Econômica").alias("indicator_name"),
        F.round("score", 1).alias("last_value"), F.lit(as_of).cast("date").alias("last_date"),
        F.lit("pontos").alias("unit"), F.lit(None).cast("double").alias("annual_change"),
        F.lit(None).cast("string").alias("trend"), label_below(F.col("score")).alias("situation"),
    )
    lines = F.col("lines")
    gathered = health_index(_latest(long)).filter(F.size(lines) >= 2)
    every = F.when(F.col("inputs") >= 2, F.concat(lines, F.array(summary))).otherwise(lines)
    return _finish(gathered.select(F.inline(every)), MACRO_SCHEMA, run_ts)
