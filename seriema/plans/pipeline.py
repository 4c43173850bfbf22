"""The two runs: bronze to silver and silver to gold."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_date, to_number
from ..model import BRONZE_SCHEMA, NATIONAL, SILVER_SCHEMA
from ..operators.calendar import date_features
from ..operators.joins import one_per
from ..operators.quality import check_duplicates, observe_checks, validate
from ..session import constant_frame
from ..sources.files import newest_snapshots, read_snapshots
from ..sources.sinks import folder_columns, snapshot_id, write_partitioned, write_snapshot
from . import gold
from .silver import STANDARD, TRANSFORMS, Style

REPORT_SCHEMA = "source STRING, indicator STRING, rows BIGINT, success BOOLEAN, message STRING"
# Share of missing values in percent above which the report warns, and the columns that silver has to have.
NULL_WARNING = 10.0
PRESENT = ("date", "value", "indicator")
#: Sources and indicators that a run works on at a time.
WORKERS = 4
# Bronze of these has one row per series and period; of the others many, which their
# transforms reduce.
PERIODS = {"ipca": "month", "ipca15": "month", "pib": "quarter", "desemprego": "quarter",
           "pnad": "quarter"}


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str, run_ts: datetime,
                     indicators: Sequence[str] | None = None,
                     keys: Sequence[str] = ("source", "localidade"),
                     style: Style = STANDARD,
                     transforms: Mapping[str, Callable[..., DataFrame]] = TRANSFORMS,
                     value: str = "valor", sources: Sequence[str] | None = None,
                     schema=BRONZE_SCHEMA, partitioned: str | None = None,
                     workers: int = WORKERS) -> DataFrame:
    """Transform the newest snapshot of every source and indicator and write a silver snapshot.

    Each source and indicator is a plan and a write of its own, ``workers`` of them at a time, under the
    caller's job group: whatever goes wrong with one, when its plan is built or when its rows are computed, is a line
    of the report and stops no other. ``keys`` tell the series of an indicator apart. Every transform gets the
    same arguments at any size. For the indicators in ``PERIODS`` of several rows of a series in one period the
    latest counts (of equal dates the larger value), and the report tells that there were any.

    The checks are counted while rows are written; only duplicates are looked for in what was written.

    With ``partitioned`` the result is also written below that path in folders by year and month or
    quarter. Returns the report (source, indicator, rows, success, message).
    """
    found = newest_snapshots(spark, bronze, indicators, sources)

    def line(snapshot: Row) -> tuple:
        source, name = snapshot["source"], snapshot["indicator"]
        if name not in transforms:
            return source, name, 0, False, "no transform"
        try:
            rows, extra = read_snapshots(spark, bronze, [snapshot], schema), dict  # no period, nothing to tell
            if name in PERIODS:
                rows, extra = one_per_period(rows, keys, value, PERIODS[name])
            out = transforms[name](rows, keys=[*keys], style=style, run_ts=run_ts, value=value)
            n, warnings = written(spark, out.drop("snapshot_ts", "valor", "data"), silver, snapshot, run_ts, partitioned)
            notes = [f"{k} rows in a {PERIODS[name]} that has a later one" for k in [extra().get("extra")] if k]
            return source, name, n, n > 0, "; ".join([*notes, *warnings]) or ("ok" if n else "no data")
        except Exception as error:  # noqa: BLE001 - a line of the report, whatever it is
            return source, name, 0, False, first_line(error)

    lines = together(spark, line, found, workers)
    for name in sorted(set(indicators or ()) - {r["indicator"] for r in found}):
        message = "no data" if name in transforms else "no transform"
        lines.append((None, name, 0, False, message))
    names = ("source", "indicator", "rows", "success", "message")
    return constant_frame(spark, names, lines, (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.string()))


def together(spark: SparkSession, job: Callable, items: Sequence, workers: int) -> list:
    """``job`` of every item, some at a time, in threads that inherit the caller's job group; results in order."""
    if not items:
        return []
    # One set of inherited properties per item: a thread may change its own.
    jobs = [inheritable_thread_target(spark)(lambda item=item: job(item)) for item in items]
    with ThreadPoolExecutor(max(1, min(workers, len(jobs)))) as pool:
        return [done.result() for done in [pool.submit(j) for j in jobs]]


def written(spark: SparkSession, out: DataFrame, silver: str, snapshot: Row, run_ts: datetime,
            partitioned: str | None) -> tuple[int, list[str]]:
    """Write a silver snapshot; its rows and what its generic checks find wrong."""
    folder = folder_of(silver, snapshot, run_ts)
    observed = []

    def through(rows: DataFrame) -> DataFrame:
        rows, checks = observe_checks(rows, PRESENT, null_threshold=NULL_WARNING)
        observed.append(checks)
        return rows

    write_snapshot(out, silver, run_ts, folders=[folder], through=through)
    checks = {(r["check"], r["column"]): r for r in observed[0]().collect()}
    n = int(checks["rows", None]["metric"])
    if not n:
        return 0, []
    new = Row(source=snapshot["source"], indicator=snapshot["indicator"], snapshot_ts=snapshot_id(run_ts), folder=folder)
    rows = read_snapshots(spark, silver, [new], SILVER_SCHEMA)
    if partitioned is not None:
        columns = folder_columns(snapshot["indicator"])
        dated = rows if set(columns) <= set(rows.columns) else date_features(rows)
        parts = {c: getattr(F, c)("date") for c in columns}
        write_partitioned(dated.withColumns(parts), f"{partitioned}/{snapshot['source']}/{snapshot['indicator']}", columns)
    found = []
    for (check, column), r in checks.items():
        if not r["passed"] and check == "null_share" and column in PRESENT:
            found.append(f"{r['metric']:.1f}% of {column} missing")
        elif not r["passed"] and check == "presence":
            found.append(f"{check} of {column}")
    # Columns of the layer that this snapshot lacks are equal in all rows.
    extra = check_duplicates(rows, [c for c in rows.columns if c in out.columns]).first()["metric"]
    return n, [*found, *([f"{extra:.0f} duplicate rows"] if extra else [])]


def folder_of(root: str, snapshot: Row, run_ts: datetime) -> str:
    """The folder of a new snapshot of the same source and indicator."""
    kept = re.search(r"/(source=[^/]*/indicator=[^/]*)/[^/]*$", snapshot["folder"])
    return f"{root}/{kept[1]}/snapshot_ts={snapshot_id(run_ts)}"


def first_line(error: Exception) -> str:
    text = str(error).strip().splitlines()
    # A failed task tells its own error after Spark's account of the task.
    own = [line for line in text if re.match(r"\w*(Error|Exception)\b", line.strip())]
    return (own or text or [type(error).__name__])[0].strip()


def one_per_period(rows: DataFrame, keys: Sequence[str], value: str,
                   period: str) -> tuple[DataFrame, Callable[[], dict]]:
    """One row per series and period, and what tells after an action how many there were more (``extra``).

    Undated rows stay apart. The rows before are counted by the tasks that read them, so rows of a lost
    executor may count again; the number is for a message.
    """
    date = parse_date(F.col("data"))
    before, after = Observation(), Observation()
    marked = rows.withColumns({
        "_date": date, "_period": F.date_trunc(period, date), "_value": to_number(F.col(value)),
    }).observe(before, F.count(F.lit(1)).alias("rows"))
    # A key that is missing is a value like others here, only a missing date makes a row of its own.
    series = {f"_key_{k}": F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys if k in rows.columns}
    missing = {f"_no_{k}": F.col(k).isNull() for k in keys if k in rows.columns}
    kept = one_per(marked.withColumns({**series, **missing}), [*series, *missing, "_period"], "_date", "_value")
    kept = kept.select(*rows.columns).observe(after, F.count(F.lit(1)).alias("rows"))
    return kept, lambda: {"extra": before.get["rows"] - after.get["rows"]}


def load_latest_silver(spark: SparkSession, silver: str,
                       indicators: Sequence[str] = gold.INDICATORS,
                       sources: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The newest silver snapshots per indicator, of all (asked) sources; indicators without one
    are left out."""
    found = newest_snapshots(spark, silver, indicators, sources)
    by_name: dict[str, list[Row]] = {}
    for r in found:
        by_name.setdefault(r["indicator"], []).append(r)
    return {i: read_snapshots(spark, silver, by_name[i], SILVER_SCHEMA) for i in indicators if i in by_name}


def silver_to_gold(spark: SparkSession, silver: str, root: str, run_ts: datetime,
                   per_quarter: str = "last", place: str = NATIONAL,
                   sources: Sequence[str] | None = None, workers: int = WORKERS) -> DataFrame:
    """Write the three dashboards of a place below ``root``; empty ones are refused.

    With ``sources`` only these count, in that order of preference.

    Returns (dashboard, success). The run succeeded if one dashboard was written.
    """
    frames, order = load_latest_silver(spark, silver, sources=sources), tuple(sources or ())
    dashboards = {
        "monthly_indicators": gold.monthly_panel(frames, spark, run_ts, place=place, sources=order),
        "labor_market": gold.labor_market(frames, spark, run_ts, per_quarter, place=place, sources=order),
        "macro_dashboard": gold.macro_dashboard(frames, spark, run_ts.date(), run_ts, place, sources=order),
    }
    done = together(spark, lambda d: (d[0], save_dashboard(d[1], root, d[0], run_ts)), list(dashboards.items()), workers)
    return constant_frame(spark, ("dashboard", "success"), done, (pa.string(), pa.bool_()))


def save_dashboard(df: DataFrame, root: str, name: str, run_ts: datetime) -> bool:
    """One snapshot folder per dashboard and run.

    A dashboard has a row per month, quarter or indicator; it is kept between the emptiness check
    and the write so that it is computed once.
    """
    df = df.persist()
    try:
        if df.isEmpty():
            return False
        df.write.mode("overwrite").parquet(f"{root}/{name}/snapshot_ts={snapshot_id(run_ts)}")
        return True
    finally:
        df.unpersist()


def process_validation(silver: DataFrame) -> DataFrame:
    """The generic checks of a silver frame, as warnings."""
    return validate(silver, required=PRESENT, null_threshold=NULL_WARNING)
