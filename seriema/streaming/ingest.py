"""Incremental bronze ingest: every landed file is processed once, over any number of runs."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from ..sources.files import PARTITIONS
from ..sources.sinks import commit_snapshots


def ingest_new_files(spark: SparkSession, landing: str, bronze: str, checkpoint: str,
                     schema: StructType, max_files: int | None = None) -> None:
    """Append the files that arrived since the last run to the bronze layer, then stop.

    The file source remembers in ``checkpoint`` what it has read. ``max_files`` bounds one
    micro-batch, not the run: a backlog is worked off in several batches. At the end the snapshots that
    grew or are new are committed.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", False)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(landing).writeStream.format("parquet").partitionBy(*PARTITIONS)
        .option("path", bronze).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    commit_snapshots(spark, bronze)
