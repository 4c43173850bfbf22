"""Questions from blocks of documents to buckets of names, and the answers.

Documents are packed into blocks of some megabytes, as they lie in the input. A block asks about names
(digests, hashes, pieces of text): it sends each bucket of the name space one message with its distinct
names, and gets one reply with an answer per name, in the same order. So a name that a third of all
documents share costs one entry per block, texts never move, and what moves is packed arrays.

Blocks are a table bucketed by their number, so that joining the replies does not shuffle the texts.
Blocks and buckets grow with the input up to ``MOST_BYTES``, which keeps the number of messages, one per
pair of them, in hand.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, stage

LEAST_BYTES, MOST_BYTES, MOST_BLOCKS = 2 << 20, 32 << 20, 1 << 15
#: A task numbers its blocks from its own number times this.
PER_TASK = 1 << 32

Replies = dict[tuple[str, int], bytes]
#: From the documents of a block and the replies so far to one message per bucket (None: no message).
Ask = Callable[[pa.Table, Replies, int], list[bytes | None]]
#: From the messages of a bucket to one reply each.
Answer = Callable[[list[bytes]], list[bytes]]


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


@dataclass(frozen=True)
class Blocks:
    table: DataFrame
    buckets: int
    #: (block, phase, bucket, reply) of all exchanges so far.
    replies: DataFrame | None = None

    def _joined(self) -> DataFrame:
        if self.replies is None:
            return self.table.select("block", "body", F.array().cast("array<struct<phase:string,bucket:int,reply:binary>>").alias("replies"))
        mine = self.replies.groupBy("block").agg(F.collect_list(F.struct("phase", "bucket", "reply")).alias("replies"))
        return self.table.join(mine, "block", "left").select("block", "body", "replies")

    def exchange(self, phase: str, ask: Ask, answer: Answer) -> Blocks:
        """These blocks with the replies to one more question."""
        buckets = self.buckets

        def questions(batches):
            for block, docs, replies in opened(batches):
                sent = [(k, m) for k, m in enumerate(ask(docs, replies, buckets)) if m is not None]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _ in sent], pa.int32()), pa.array([block] * len(sent), pa.int64()),
                    pa.array([m for _, m in sent], pa.binary()),
                ], names=["bucket", "block", "message"])

        def answers(group: pa.Table) -> pa.Table:
            replies = answer(group.column("message").to_pylist())
            return pa.table({
                "block": group.column("block"), "phase": pa.array([phase] * len(replies)),
                "bucket": group.column("bucket"), "reply": pa.array(replies, pa.binary()),
            })

        messages = self._joined().mapInArrow(questions, "bucket int, block long, message binary")
        found = messages.groupBy("bucket").applyInArrow(answers, "block long, phase string, bucket int, reply binary")
        found = stage(found, f"replies-{phase}")
        return replace(self, replies=found if self.replies is None else self.replies.unionAll(found))

    def finish(self, result: Callable[[pa.Table, Replies, int], pa.Table], schema: str) -> DataFrame:
        """Rows made from each block and its replies."""
        buckets = self.buckets

        def rows(batches):
            for _, docs, replies in opened(batches):
                yield from result(docs, replies, buckets).combine_chunks().to_batches()

        return self._joined().mapInArrow(rows, schema)


def opened(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            replies = batch.column("replies")[row].as_py() or []
            yield (batch.column("block")[row].as_py(), unpacked(batch.column("body")[row].as_py()),
                   {(r["phase"], r["bucket"]): r["reply"] for r in replies})


def blocks(docs: DataFrame, text: str = "text") -> Blocks:
    """Packs the rows of ``docs``, with all their columns."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    size = min(MOST_BYTES, max(LEAST_BYTES, total // MOST_BLOCKS))

    def pack(batches):
        part, held, nth = [], 0, 0

        def block(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(rows)
            number = table.column("_blocks_task")[0].as_py() * PER_TASK + nth
            body = packed(table.drop_columns("_blocks_task").combine_chunks())
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([body], pa.binary())], names=["block", "body"])

        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
            start = 0
            for k, n in enumerate(lengths):
                held += n + 64
                if held >= size:
                    part.append(batch.slice(start, k + 1 - start))
                    yield block(part)
                    part, held, nth, start = [], 0, nth + 1, k + 1
            if start < batch.num_rows:
                part.append(batch.slice(start))
        if part:
            yield block(part)

    table = docs.withColumn("_blocks_task", F.spark_partition_id()).mapInArrow(pack, "block long, body binary")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"blocks_{uuid.uuid4().hex}"
    table.write.bucketBy(parts, "block").option("path", scratch_path(spark, "blocks")).option("compression", "none").saveAsTable(name)
    return Blocks(spark.table(name), max(parts, total // (4 * size)))
