"""Packing documents into training sequences by minimum bin slack.

A document becomes token ids and an end mark, and is cut into pieces of at most ``capacity`` tokens, of
which only the first may be shorter. For each sequence, the longest piece left is taken, and a bitset
dynamic program over the lengths still available finds the pieces that fill the rest best; they are
removed, and so on. Pieces of one length are alike to it, so the plan only needs their counts (at most
``capacity`` numbers, whatever the size of the corpus), and a combination is used as often as its lengths
last. Each use exhausts a length, so there are at most ``capacity`` combinations. Pieces then find
their place by their rank among those of their length, which Spark counts by task and length.

Defined cases: a NULL or empty text is only the end mark; a NULL doc_id is kept; repeated rows are
packed each; an empty table gives an empty result. Columns of the pieces: ``doc_id, piece, start,
length, ids_crc32, sequence_id, offset`` and, if asked for, ``ids``; extra columns of the documents do
not take part.
"""

from __future__ import annotations

import re
import zlib
from base64 import b64decode
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

CAPACITY = 1_024
END = 2

#: Characters on whose kind all Unicode versions agree. Texts made of them get the same ids from the
#: rank table as from the tokenizer's file, several times faster; all others take the file.
PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\u00a1-\\u024f]*")


@dataclass(frozen=True)
class Vocabulary:
    """Files of one byte-level vocabulary; the second may be absent."""

    json_path: str
    ranks_path: str | None = None

    def encoder(self):
        """A function from a text to its ids as numpy array."""
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(self.json_path)
        special = [t.content for t in whole.get_added_tokens_decoder().values()]

        def by_file(text: str) -> np.ndarray:
            return np.array(whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

        if not self.ranks_path:
            return by_file
        import public_tokenizers
        import tiktoken

        with open(self.ranks_path, "rb") as lines:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

        def by_ranks(text: str) -> np.ndarray:
            if PLAIN.fullmatch(text) and not any(s in text for s in special):
                return fast.encode_to_numpy(text)
            return by_file(text)

        return by_ranks


def default_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def cuts(n: int, capacity: int) -> list[int]:
    """Borders of the pieces of n tokens."""
    first = n % capacity or capacity
    return [0, *range(first, n + 1, capacity)]


def pieces(docs: DataFrame, vocabulary: Vocabulary, capacity: int, end: int, keep_ids: bool) -> DataFrame:
    """One row per piece, with ``cell`` (the task) and ``nth`` (before it in the task with its length)."""
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, cell int, nth long"
    schema += ", ids array<int>" if keep_ids else ""

    def tokenize(batches):
        encode = vocabulary.encoder()
        seen: Counter = Counter()
        mark = np.array([end], dtype=np.uint32)
        for batch in batches:
            at, rows, ids = [], [], []
            cells = batch.column("cell").to_pylist()
            for k, text in enumerate(batch.column("text")):
                tokens = np.concatenate([encode(text.as_py() or ""), mark]).astype("<u4", copy=False)
                borders = cuts(len(tokens), capacity)
                for j, (a, b) in enumerate(zip(borders, borders[1:])):
                    at.append(k)
                    rows.append((j, a, b - a, zlib.crc32(tokens[a:b].tobytes()), cells[k], seen[b - a]))
                    seen[b - a] += 1
                    if keep_ids:
                        ids.append(tokens[a:b].astype(np.int32))
            j, a, n, crc, cell, nth = zip(*rows) if rows else ([],) * 6
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(at, pa.int32())), "piece": pa.array(j, pa.int32()),
                "start": pa.array(a, pa.int64()), "length": pa.array(n, pa.int64()), "ids_crc32": pa.array(crc, pa.int64()),
                "cell": pa.array(cell, pa.int32()), "nth": pa.array(nth, pa.int64()),
            }
            if keep_ids:
                columns["ids"] = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select("doc_id", "text", F.spark_partition_id().alias("cell")).mapInArrow(tokenize, schema)


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """Lengths with the largest sum of at most ``room``, none more often than ``counts`` has it.

    Bit s of ``reach`` says that some choice among the lengths so far sums to s.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        if length > room or reach >> room & 1:
            continue
        n, power = min(counts[length], room // length), 1
        while n > 0:
            take = min(power, n)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & mask
            n, power = n - take, power * 2
    total, chosen = reach.bit_length() - 1, []
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * take
            total -= length * take
    return chosen


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths (long ones first) and how many sequences use each."""
    left = {n: c for n, c in counts.items() if c > 0}
    plan = []
    while left:
        lengths = sorted(left, reverse=True)
        anchor = lengths[0]
        left[anchor] -= 1
        chosen = [anchor, *fullest(left, lengths, capacity - anchor)]
        left[anchor] += 1
        used = Counter(chosen)
        times = min(left[n] // k for n, k in used.items())
        plan.append((tuple(sorted(chosen, reverse=True)), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return plan


def places(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length the rows (first rank, first sequence, pieces per sequence, first offset), by rank."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for chosen, times in plan:
        offset = 0
        for n, k in Counter(chosen).items():
            rows.setdefault(n, []).append((ranks[n], sequence, k, offset))
            ranks[n] += k * times
            offset += n * k
        sequence += times
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def pack(docs: DataFrame, *, vocabulary: Vocabulary | None = None, capacity: int = CAPACITY, end: int = END,
         keep_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) with their sequence and offset. Texts are read once."""
    cut = stage(pieces(docs, vocabulary or default_vocabulary(), capacity, end, keep_ids), "pack-pieces")
    cells = stage(cut.groupBy("length", "cell").agg(F.count("*").alias("n")), "pack-cells")
    # At most ``capacity`` rows.
    plan = minimum_bin_slack({r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    table = places(plan)
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(cells, ["length", "cell"]).withColumn("rank", F.col("before") + F.col("nth"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    fields = [f for f in ranked.select(*kept).schema.fields]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", sequence_id long, offset long"

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros_like(rank), np.zeros_like(rank)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                rows = table[int(n)]
                row = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                inside = rank[at] - row[:, 0]
                sequence[at] = row[:, 1] + inside // row[:, 2]
                offset[at] = row[:, 3] + inside % row[:, 2] * n
            columns = {c: batch.column(c) for c in kept} | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_pydict(columns)

    return ranked.select(*kept, "rank").mapInArrow(place, schema)
