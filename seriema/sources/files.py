"""Files and snapshot layers.

A layer is a Parquet folder partitioned by ``source``, ``indicator`` and ``snapshot_ts``
(YYYYmmdd_HHMMSS), so that a name never has to be guessed from a file name: the prefix ``pib`` cannot
match ``pib_ibge``. What a layer holds is read off its folder names; no data file is opened for it.

A snapshot has several files, which appear one after the other. It counts from the moment when its manifest is
written, last and as one object below ``_commits``: the manifest tells how many files there are, their bytes and a
sum over their names, and a folder that does not agree with it (being written, or written anew) is not a
snapshot yet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import parse_date, to_number
from ..operators.cleaning import between_dates, drop_incomplete, rename_present
from ..operators.spread import null_safe_join
from ..session import exists

PARTITIONS = ("source", "indicator", "snapshot_ts")
# Fixed value: how Spark names the folder of a missing partition value.
_MISSING = "__HIVE_DEFAULT_PARTITION__"
#: The folder of the manifests; Spark's readers pass over names with an underscore.
COMMITS = "_commits"
MANIFEST = "source STRING, indicator STRING, snapshot_ts STRING, files BIGINT, bytes BIGINT, names BIGINT"


def read_layer(spark: SparkSession, root: str, schema: StructType | str | None = None,
               merge_schema: bool = False) -> DataFrame:
    """All snapshots of a layer. ``merge_schema`` is for layers whose columns grew over time."""
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader.schema(schema) if schema is not None else reader).parquet(root)


def file_names(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path) of the files below ``root``: a listing, whose files are not opened."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    return reader.option("pathGlobFilter", pattern).load(root).select("path")


def _folder_value(column: str) -> Column:
    text = F.regexp_extract(F.col("path"), f"/{column}=([^/]*)/", 1)
    # Spark escapes some characters as in a URL, but leaves a plus alone.
    plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return F.when((text != "") & (text != _MISSING), plain).alias(column)


def snapshot_folders(spark: SparkSession, *paths: str) -> DataFrame:
    """(source, indicator, snapshot_ts, folder, files, bytes, names) of the folders with files below some paths."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    found = reader.option("pathGlobFilter", "*.parquet").load(list(paths)).select("path", "length")
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    placed = found.select(*(_folder_value(c) for c in PARTITIONS), folder.alias("folder"), "length", F.crc32(name).alias("name"))
    placed = placed.where(F.col("indicator").isNotNull() & F.col("snapshot_ts").isNotNull())
    return placed.groupBy(*PARTITIONS, "folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum("name").alias("names"))


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """(source, indicator, snapshot_ts, files, bytes, names) of all manifests of a layer."""
    if not exists(spark, f"{root}/{COMMITS}"):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).json(f"{root}/{COMMITS}/*.json")


def snapshots(spark: SparkSession, root: str, committed: bool = True) -> DataFrame:
    """(source, indicator, snapshot_ts, folder) of every snapshot of a layer.

    Without ``committed``, as for a layer that others write without manifests, every folder is one.
    """
    found = snapshot_folders(spark, root)
    if committed:
        # One row per snapshot on both sides.
        found = null_safe_join(found, manifests(spark, root), [*PARTITIONS, "files", "bytes", "names"], "leftsemi")
    return found.select(*PARTITIONS, "folder")


def newest_snapshots(spark: SparkSession, root: str, indicators: Sequence[str] | None = None,
                     sources: Sequence[str] | None = None, committed: bool = True) -> list[Row]:
    """The newest snapshot of each source and indicator (of the asked ones), in order.

    One row per pair reaches the driver, which lists the same folders to plan any read.
    """
    found = snapshots(spark, root, committed)
    if indicators is not None:
        found = found.where(F.col("indicator").isin(*indicators))
    if sources is not None:
        found = found.where(F.col("source").isin(*sources))
    newest = found.groupBy("source", "indicator").agg(
        F.max("snapshot_ts").alias("snapshot_ts"), F.max_by("folder", "snapshot_ts").alias("folder")
    )
    return sorted(newest.collect(), key=lambda r: (r["indicator"], r["source"] or ""))


def read_snapshots(spark: SparkSession, root: str, found: Sequence[Row],
                   schema: StructType | str | None = None,
                   merge_schema: bool = False) -> DataFrame:
    """The rows of some snapshots: only their folders are planned, whatever else the layer holds."""
    if not found:
        return read_layer(spark, root, schema, merge_schema).where("false")
    reader = spark.read.option("mergeSchema", merge_schema).option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader
    return reader.parquet(*(r["folder"] for r in found))


def read_latest(spark: SparkSession, root: str, indicators: Sequence[str] | None = None,
                schema: StructType | str | None = None, merge_schema: bool = False,
                sources: Sequence[str] | None = None, committed: bool = True) -> DataFrame:
    """The newest snapshot of every source and indicator (of the asked ones); absent ones are
    just absent, however many there are."""
    found = newest_snapshots(spark, root, indicators, sources, committed)
    return read_snapshots(spark, root, found, schema, merge_schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, sep: str = ",", encoding: str = "utf-8",
             schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header. Without a schema every column is text, which saves an inference pass."""
    reader = spark.read.options(header=True, sep=sep, encoding=encoding, **options)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_any(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """By explicit format, else by extension; Parquet when the extension says nothing."""
    fmt = fmt or ("csv" if path.lower().rstrip("/").endswith(".csv") else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, **options)
    return spark.read.format(fmt).options(**options).load(path)


def indicator_table(df: DataFrame, indicator: str, date_column: str, value_column: str,
                    date_format: str, start=None, end=None) -> DataFrame:
    """A delivered table (CSV or spreadsheet export) as a bronze series ``data, <indicator>``."""
    named = rename_present(df, {date_column: "data", value_column: indicator})
    if "data" in named.columns:
        named = named.withColumn("data", parse_date(F.col("data").cast("string"), [date_format]))
    if indicator in named.columns:
        named = named.withColumn(indicator, to_number(F.col(indicator).cast("string")))
    return between_dates(drop_incomplete(named, "data", indicator), "data", start, end)


def discover_indicators(spark: SparkSession, root: str) -> DataFrame:
    """Indicators that a layer holds, from its folder names."""
    return snapshots(spark, root, committed=False).select("indicator").distinct()


def discover_in_file_names(spark: SparkSession, root: str) -> DataFrame:
    """Indicators of a foreign layout with files or folders ``<indicator>_<YYYYmmdd>_<HHMMSS>``."""
    name = F.regexp_extract(F.col("path"), r"([^/]+)_\d{8}_\d{6}[^/]*(?:/|$)", 1)
    found = file_names(spark, root).select(name.alias("indicator"))
    return found.filter(F.col("indicator") != "").distinct()
