"""Snapshot, CSV and partitioned writers."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime
from hashlib import sha256

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions import parse_date
from ..operators.spread import null_safe_join
from ..session import exists, put_text
from .files import COMMITS, PARTITIONS, manifests, snapshot_folders


def snapshot_id(run_ts: datetime) -> str:
    return run_ts.strftime("%Y%m%d_%H%M%S")


def _balanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a folder together, but split a large folder over several tasks.

    A repartition by the same columns would write a hot folder from one task; the rebalance hint
    lets adaptive execution merge small folders and cut large ones.
    """
    return df.hint("rebalance", *(F.col(c) for c in columns))


def write_snapshot(df: DataFrame, root: str, run_ts: datetime, refuse_empty: bool = False,
                   folders: Sequence[str] | None = None,
                   through: Callable[[DataFrame], DataFrame] = lambda df: df) -> bool:
    """Write one snapshot per source and indicator. Returns False for a refused empty frame.

    A snapshot that exists, as after a run that is repeated, is replaced; others are not touched.
    Rows without a source column have no source. Readers see a snapshot when all of it is written: the
    manifests come last (see ``files``). Jobs that write at the same time with one ``run_ts`` have to name the
    ``folders`` they write, so that none commits what another has only begun. ``through`` is applied to what is
    written, in the tasks that write it.
    """
    if refuse_empty and df.isEmpty():
        return False
    if "source" not in df.columns:
        df = df.withColumn("source", F.lit(None).cast("string"))
    stamp = snapshot_id(run_ts)
    stamped = df.withColumn("snapshot_ts", F.lit(stamp))
    writer = through(_balanced(stamped, PARTITIONS)).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS).parquet(root)
    commit_snapshots(df.sparkSession, root, folders, stamp)
    return True


def commit_snapshots(spark: SparkSession, root: str, folders: Sequence[str] | None = None,
                     stamp: str | None = None) -> int:
    """Write the manifests of some folders, or of all (with that stamp) that have none; how many there were.

    Also adopts a layer that was written without manifests.
    """
    paths = [f for f in folders if exists(spark, f)] if folders is not None else [root]
    found = snapshot_folders(spark, *paths) if paths and exists(spark, root) else None
    if found is None:
        return 0
    found = found.drop("folder") if stamp is None else found.where(F.col("snapshot_ts") == stamp).drop("folder")
    if folders is None:
        found = null_safe_join(found, manifests(spark, root), found.columns, "leftanti")
    # One row per source and indicator of a run.
    rows = found.collect()
    for row in rows:
        name = sha256(repr(tuple(row[c] for c in PARTITIONS)).encode()).hexdigest()
        put_text(spark, f"{root}/{COMMITS}/{name}.json", json.dumps(row.asDict()))
    return len(rows)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    df.write.mode(mode).options(header=True, sep=sep).csv(path)


# Folder columns of the indicators that are not split by year alone.
FOLDERS = {
    "ipca": ("year", "month"),
    "ipca15": ("year", "month"),
    "selic": ("year", "month"),
    "cambio": ("year", "month"),
    "pnad": ("year", "quarter"),
}


def folder_columns(indicator: str) -> tuple[str, ...]:
    return FOLDERS.get(indicator, ("year",))


def write_partitioned(df: DataFrame, path: str, columns: Sequence[str],
                      mode: str = "overwrite") -> None:
    _balanced(df, columns).write.mode(mode).partitionBy(*columns).parquet(path)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns and types of ``schema``.

    Text becomes a date by parsing, everything else by a cast that gives NULL on failure; columns
    that are not there are NULL.
    """
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            value = F.lit(None)
        else:
            value = F.col(field.name)
            is_text = isinstance(df.schema[field.name].dataType, StringType)
            if is_text and field.dataType.typeName() == "date":
                value = parse_date(value)
            elif df.schema[field.name].dataType != field.dataType:
                value = value.try_cast(field.dataType)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)
