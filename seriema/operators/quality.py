"""Data-quality checks that return a plain frame (check, column, metric, passed).

Column checks fold into one aggregation over the data; nothing is counted on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import constant_frame

_TYPE_FAMILIES = {
    "numeric": (T.NumericType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "string": (T.StringType,),
    "boolean": (T.BooleanType,),
}


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _missing(df: DataFrame, column: str) -> str:
    """SQL condition; NaN is missing."""
    missing = f"{_name(column)} IS NULL"
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        missing += f" OR isnan({_name(column)})"
    return missing


def _array(expressions: Sequence[str], dtype: str) -> Column:
    """One SQL text for any number of aggregates: a wide frame would otherwise spend its time in
    building columns one call at a time."""
    return F.expr("array(" + ", ".join(f"CAST({e} AS {dtype})" for e in expressions) + ")")


def _type_matches(df: DataFrame, column: str, expected: str) -> bool:
    dtype = df.schema[column].dataType
    if expected in _TYPE_FAMILIES:
        return isinstance(dtype, _TYPE_FAMILIES[expected])
    return dtype.simpleString() == expected


def _check_lines(df: DataFrame, required: Sequence[str], types: Mapping[str, str],
                 ranges: Mapping[str, tuple[float, float]],
                 null_threshold: float | None) -> list[tuple[str, str | None, str]]:
    """(check, column, metric in SQL) of presence, types, ranges and null shares."""
    lines: list[tuple[str, str | None, str]] = []
    for name in required:
        found = name in df.columns
        lines.append(("presence", name, f"count_if({str(found).lower()}) > 0"))
    for name, expected in types.items():
        if name in df.columns:
            lines.append(("type", name, str(_type_matches(df, name, expected)).lower()))
    for name, (low, high) in ranges.items():
        dtype = df.schema[name].dataType if name in df.columns else None
        if isinstance(dtype, T.NumericType):
            c = _name(name)
            outside = f"({c} < {float(low)!r}D OR {c} > {float(high)!r}D)"
            if isinstance(dtype, (T.DoubleType, T.FloatType)):
                outside += f" AND NOT isnan({c})"
            lines.append(("range", name, f"count_if({outside})"))
    for name in df.columns if null_threshold is not None else ():
        share = f"try_divide(count_if({_missing(df, name)}) * 100.0D, count(1))"
        lines.append(("null_share", name, share))
    lines.append(("rows", None, "count(1)"))
    return lines


def _passes(check: Column, metric: Column, rows: Column, null_threshold: float | None) -> Column:
    """An empty frame fails every check."""
    fine = (
        F.when(check.isin("presence", "type"), metric == 1)
        .when(check == "range", metric == 0)
        .when(check == "null_share", F.coalesce(metric, F.lit(0.0)) <= (null_threshold or 0.0))
        .otherwise(True)
    )
    return (rows > 0) & fine


def _column_checks(df: DataFrame, required: Sequence[str], types: Mapping[str, str],
                   ranges: Mapping[str, tuple[float, float]],
                   null_threshold: float | None) -> DataFrame:
    """Presence, types, ranges and null shares from one aggregation.

    An empty frame fails every check except duplicates.
    """
    lines = _check_lines(df, required, types, ranges, null_threshold)
    one_row = df.agg(
        F.count(F.lit(1)).alias("rows"), _array([m for *_, m in lines], "DOUBLE").alias("metrics")
    )
    names = constant_frame(
        df.sparkSession, ("position", "check", "column"),
        [(i, check, column) for i, (check, column, _) in enumerate(lines)],
        (pa.int32(), pa.string(), pa.string()),
    )
    passed = _passes(F.col("check"), F.col("metric"), F.col("rows"), null_threshold)
    return (
        one_row.select("rows", F.posexplode("metrics").alias("position", "metric"))
        .join(names, "position")
        .select("check", "column", "metric", passed.alias("passed"))
    )


def observe_checks(df: DataFrame, required: Sequence[str] = (), types: Mapping[str, str] | None = None,
                   ranges: Mapping[str, tuple[float, float]] | None = None,
                   null_threshold: float = 5.0) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The frame, and what gives its column checks after an action on it, such as a write.

    The metrics are counted by the tasks of that action, so the rows are not read again. If they are
    written right behind this frame, each counts once however often tasks are repeated; behind a shuffle those
    of a lost executor may count twice.
    """
    lines = _check_lines(df, required, types or {}, ranges or {}, null_threshold)
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), _array([m for *_, m in lines], "DOUBLE").alias("metrics"))

    def checks() -> DataFrame:
        found = seen.get
        counted = constant_frame(
            df.sparkSession, ("check", "column", "metric", "rows"),
            [(check, column, metric, found["rows"]) for (check, column, _), metric in zip(lines, found["metrics"])],
            (pa.string(), pa.string(), pa.float64(), pa.int64()),
        )
        passed = _passes(F.col("check"), F.col("metric"), F.col("rows"), null_threshold)
        return counted.select("check", "column", "metric", passed.alias("passed"))

    return out, checks


def check_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    return _column_checks(df, required, {}, {}, None).filter(F.col("check") == "presence")


def check_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``numeric``, ``datetime``, ``string``, ``boolean`` or an exact Spark type name."""
    return _column_checks(df, (), types, {}, None).filter(F.col("check") == "type")


def check_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Number of values outside ``[low, high]``; text columns are skipped, NULL is not outside."""
    return _column_checks(df, (), {}, ranges, None).filter(F.col("check") == "range")


def check_nulls(df: DataFrame, threshold: float = 5.0) -> DataFrame:
    """Percent of missing values per column; fails strictly above the threshold."""
    return _column_checks(df, (), {}, {}, threshold).filter(F.col("check") == "null_share")


def check_not_empty(df: DataFrame) -> DataFrame:
    return _column_checks(df, (), {}, {}, None).filter(F.col("check") == "rows")


def fingerprint(columns: Sequence[str]) -> Column:
    """128 bits of a row: two hashes of all columns and of which of them are missing."""
    cells = ", ".join(map(_name, columns))
    missing = "concat(" + ", ".join(f"if({_name(c)} IS NULL, '1', '0')" for c in columns) + ")"
    return F.expr(f"struct(xxhash64({missing}, {cells}) AS a, xxhash64({cells}, {missing}, 1) AS b)")


def check_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows after the first of each group of equal rows; NULL equals NULL, empty is valid.

    Fingerprints are grouped, 16 bytes a row however wide it is; only rows whose fingerprint occurs again are
    compared in full. Group sizes are partial aggregates: a group of any size is one row per task.
    """
    subset = list(subset or df.columns)
    marked = df.select(*map(_name, subset), fingerprint(subset).alias("_mark"))
    again = marked.groupBy("_mark").count().where("count > 1").select(F.col("_mark").alias("_again"))
    alike = marked.join(again, F.col("_mark") == F.col("_again"), "leftsemi")
    groups = alike.groupBy(*map(_name, subset)).agg(F.count(F.lit(1)).alias("n"))
    extra = groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"))
    return extra.select(
        F.lit("duplicates").alias("check"), F.lit(None).cast("string").alias("column"),
        F.col("extra").cast("double").alias("metric"), (F.col("extra") == 0).alias("passed"),
    )


def validate(df: DataFrame, required: Sequence[str] = (), types: Mapping[str, str] | None = None,
             ranges: Mapping[str, tuple[float, float]] | None = None, null_threshold: float = 5.0,
             duplicates: bool = True, subset: Sequence[str] | None = None) -> DataFrame:
    """All checks plus a row ``dataset`` that tells whether all of them passed."""
    checks = _column_checks(df, required, types or {}, ranges or {}, null_threshold)
    if duplicates:
        checks = checks.unionByName(check_duplicates(df, subset))
    # The verdict is taken over the check rows, of which there are a few per column.
    failed = F.count_if(~F.col("passed"))
    gathered = checks.agg(
        F.collect_list(F.struct("check", "column", "metric", "passed")).alias("all"),
        F.struct(
            F.lit("dataset").alias("check"), F.lit(None).cast("string").alias("column"),
            failed.cast("double").alias("metric"), (failed == 0).alias("passed"),
        ).alias("verdict"),
    )
    return gathered.select(F.inline(F.concat("all", F.array("verdict"))))


# ---- layer contracts -------------------------------------------------------------------------

# Required columns per layer table, and the indicators a macro dashboard must list.
CONTRACTS = {
    "silver": ("date", "value", "indicator", "unit", "frequency"),
    "monthly_indicators": ("year_month", "ipca", "selic", "cambio"),
    "labor_market": ("date", "unemployment_rate"),
    "macro_dashboard": ("indicator", "last_value", "last_date"),
}
EXPECTED_INDICATORS = ("ipca", "selic", "cambio", "desemprego", "economic_health")


def check_contract(df: DataFrame, table: str) -> DataFrame:
    """Result rows with a severity: missing columns are errors, the rest are warnings.

    Warnings are NULLs in required columns, fewer than three rows and indicators that the macro
    dashboard lacks.
    """
    required = CONTRACTS[table]
    present = [c for c in required if c in df.columns]
    checks = _column_checks(df.select(*present), required, {}, {}, 0.0)
    severity = F.when(F.col("check").isin("presence"), "error").otherwise("warn")
    enough = F.when(F.col("check") == "rows", F.col("metric") >= 3).otherwise(F.col("passed"))
    out = checks.withColumn("passed", enough).withColumn("severity", severity)
    if table == "macro_dashboard" and "indicator" in df.columns:
        names = [(i,) for i in EXPECTED_INDICATORS]
        wanted = constant_frame(df.sparkSession, ["column"], names)
        seen = df.select(F.col("indicator").alias("column"), F.lit(1.0).alias("metric")).distinct()
        found = wanted.join(seen, "column", "left").select(
            F.lit("expected_indicator").alias("check"), "column",
            F.coalesce("metric", F.lit(0.0)).alias("metric"),
            F.col("metric").isNotNull().alias("passed"), F.lit("warn").alias("severity"),
        )
        out = out.unionByName(found)
    return out


# ---- profile ---------------------------------------------------------------------------------

def profile(df: DataFrame) -> DataFrame:
    """(column, dtype, rows, nulls, null_pct) per column and a total line, from one pass."""
    nulls = _array([f"count_if({_missing(df, c)})" for c in df.columns], "BIGINT")
    one = df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"))
    total = F.aggregate("nulls", F.lit(0).cast("long"), lambda a, n: a + n)
    fields = [*((f.name, f.dataType.simpleString()) for f in df.schema.fields), ("*", None)]
    names = constant_frame(
        df.sparkSession, ("position", "column", "dtype"),
        [(i, *field) for i, field in enumerate(fields)], (pa.int32(), pa.string(), pa.string()),
    )
    lines = one.select(
        "rows", F.posexplode(F.concat("nulls", F.array(total))).alias("position", "nulls")
    )
    share = F.try_divide(F.col("nulls") * 100.0, F.col("rows"))
    return lines.join(names, "position").select(
        "column", "dtype", "rows", "nulls",
        F.when(F.col("column") != "*", share).alias("null_pct"),
    )
