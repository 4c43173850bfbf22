"""Where a job may put staged tables: the shared folder of the session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Folders of the workspaces that are open, the innermost last.
_open: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    ``spark.checkpoint.dir`` decides. Only a local master, where driver and executors share one
    disk, gets a temporary folder when the setting is missing.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="seriema-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, or below the open workspace."""
    return f"{_open[-1] if _open else shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A folder for everything that is staged inside; it is deleted at the end.

    Operators that stage return frames that read what they staged, so a result has to be written or
    collected inside::

        with workspace(spark):
            measure(df, series, ...).write.parquet(target)

    What is staged without a workspace stays until the shared folder is cleaned.
    """
    path = scratch_path(spark, "workspace")
    _open.append(path)
    try:
        yield path
    finally:
        _open.remove(path)
        folder, store = _place(spark, path)
        store.delete(folder, True)


def _place(spark: SparkSession, path: str):
    """A path and its file system, whichever store it is in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text as one object that appears whole, in the place of one of that name."""
    place, store = _place(spark, path)
    draft, _ = _place(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = store.create(draft, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    store.delete(place, False)
    if not store.rename(draft, place):
        raise OSError(f"cannot write {path}")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and unlike a checkpoint stays
    columnar: later passes read only the columns they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def constant_frame(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple],
                   types: Sequence[pa.DataType] | None = None) -> DataFrame:
    """A small frame of values known to the program; text columns unless typed.

    From Arrow it becomes a local relation: no job to build it, and Spark knows its size.
    """
    types = types or [pa.string()] * len(columns)
    data = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
    return spark.createDataFrame(pa.table(data, names=list(columns)))
