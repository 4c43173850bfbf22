"""Vectors as short codes: product codebooks learned by dual-tree Lloyd in integers.

Each component x becomes floor(4096 * x), a vector is cut in ``PARTS`` equal parts, and each part position has a
codebook of ``ENTRIES`` entries. A code names the nearest entry of every part.

Vectors are dealt to blocks, which are written once with a tree over the parts of each position: cells are halved
along their widest side, and each has its box, its count and its sum of points. A round makes a tree over the entries too
and goes down both together. Of a pair of a cell and a group of entries, the boxes bound the squared distances from
below and above; groups whose nearest point is farther than the farthest of another group are cut off. A cell that is
left with one entry is assigned whole, by its kept sum; points of last cells with several entries are
compared one by one. All bounds and distances are integers, so no rounding decides a tie: of entries equally near, the
one with the lower index is taken.

A round is a pass over the blocks, the sums of which (one per entry and component) are added by Spark; only the
codebooks, ``PARTS * ENTRIES`` entries, are on the driver. Sums travel in pieces of 40 bits and are exact at any size.

Defined cases: vectors that are NULL or hold a NULL, NaN, infinite or (times 4096) infinite component are
dropped; an empty vector is one of zeros; vectors are filled with zeros to the longest length, raised to a multiple of
``PARTS``; components too large for 64-bit squares are computed with Python's integers, and an error beyond a
long is the largest long. Repeated rows and equal ids are coded each by itself. The first entries are those of
the smallest ids, a NULL id last, of equal ids the smaller vector; with fewer vectors there are fewer entries. NULL
labels are equal. An empty table gives an empty result. Other columns do not take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.spread import join_back
from ..session import stage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors of a block, at most, and components of it, so that long vectors make smaller blocks.
BLOCK, COMPONENTS = 4096, 1 << 19
#: Points of a last cell, at most.
LEAF = 16
PIECE = 40
LARGEST = (1 << 63) - 1


def bounds(n: int, level: int) -> np.ndarray:
    """Where the cells of a level begin in n points, and the end; those of the next level halve them."""
    return np.arange((1 << level) + 1) * n >> level


def depth_of(n: int, leaf: int) -> int:
    """The level at which no cell has more than ``leaf`` points."""
    level = 0
    while -(-n >> level) > leaf:
        level += 1
    return level


def planted(x: np.ndarray, leaf: int) -> np.ndarray:
    """The order of the points of each part in its tree; ``x`` is (parts, points, components)."""
    parts, n, _ = x.shape
    order = np.tile(np.arange(n), (parts, 1))
    which = np.repeat(np.arange(parts), n)
    for level in range(depth_of(n, leaf)):
        at = bounds(n, level)
        sorted_ = np.take_along_axis(x, order[:, :, None], axis=1)
        low, high = np.minimum.reduceat(sorted_, at[:-1], axis=1), np.maximum.reduceat(sorted_, at[:-1], axis=1)
        cell = np.repeat(np.arange(1 << level), np.diff(at))
        side = (high - low).argmax(axis=2)[:, cell]
        value = np.take_along_axis(sorted_, side[:, :, None], axis=2)[:, :, 0]
        way = np.lexsort((value.ravel(), np.tile(cell, parts), which)).reshape(parts, n) % n
        order = np.take_along_axis(order, way, axis=1)
    return order


def whole_numbers(x: np.ndarray, kind) -> np.ndarray:
    """Whole doubles as 64-bit or as Python's integers."""
    if kind is not object:
        return x.astype(np.int64)
    out = np.empty(x.size, dtype=object)
    out[:] = [int(v) for v in x.ravel()]
    return out.reshape(x.shape)


@dataclass
class Tree:
    """Per level (low, high, sum) of the cells, each (parts, cells, components); ``x`` in the order of the tree."""

    x: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def over(cls, x: np.ndarray, leaf: int) -> "Tree":
        n = x.shape[1]
        levels = []
        for level in range(depth_of(n, leaf) + 1):
            at = bounds(n, level)
            begin = np.minimum(at[:-1], n - 1)  # an empty cell, which is never visited, repeats a point
            levels.append(tuple(f.reduceat(x, begin, axis=1) for f in (np.minimum, np.maximum, np.add)))
        return cls(x, levels)


def entry_tree(book: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The tree over the entries of each part, and which entry stands at each of its places."""
    order = planted(book.astype(np.float64), 1)
    return Tree.over(np.take_along_axis(book, order[:, :, None], axis=1), 1), order


@dataclass
class Assigned:
    """What a descent decides: whole cells (level, part, cell, entry), and points (part, place, entry) one by one."""

    cells: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]
    points: tuple[np.ndarray, np.ndarray, np.ndarray]


def squares(a: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=-1)


def descend(tree: Tree, entries: Tree, names: np.ndarray) -> Assigned:
    """Go down both trees together, a level of each at a time."""
    parts, n, _ = tree.x.shape
    m = names.shape[1]
    last, last_entry = len(tree.levels) - 1, len(entries.levels) - 1
    level = level_e = 0
    part, cell, group = np.arange(parts), np.zeros(parts, np.int64), np.zeros(parts, np.int64)
    cells = []
    while True:
        low, high, _ = (a[part, cell] for a in tree.levels[level])
        low_e, high_e, _ = (a[part, group] for a in entries.levels[level_e])
        apart = np.maximum(np.maximum(low - high_e, low_e - high), 0)
        across = np.maximum(np.abs(high - low_e), np.abs(high_e - low))
        nearest, farthest = squares(apart), squares(across)
        # Pairs of a cell stand together; its best bound cuts off the others. Equal ones stay.
        first = np.ones(len(part), dtype=bool)
        first[1:] = (part[1:] != part[:-1]) | (cell[1:] != cell[:-1])
        begin = np.flatnonzero(first)
        owner = np.cumsum(first) - 1
        stay = nearest <= np.minimum.reduceat(farthest, begin)[owner]
        part, cell, group, owner = part[stay], cell[stay], group[stay], owner[stay]
        if level_e == last_entry:
            alone = np.bincount(owner)[owner] == 1
            place = bounds(m, level_e)[group[alone]]
            cells.append((level, part[alone], cell[alone], names[part[alone], place]))
            part, cell, group = part[~alone], cell[~alone], group[~alone]
            if not len(part) or level == last:
                break
        if level_e < last_entry:
            part, cell, group = (np.repeat(a, 2) for a in (part, cell, group))
            group = 2 * group + np.arange(len(group)) % 2
            at = bounds(m, level_e + 1)
            some = at[group] < at[group + 1]
            part, cell, group = part[some], cell[some], group[some]
            level_e += 1
        if level < last:
            part, cell, group = np.tile(part, 2), np.concatenate([2 * cell, 2 * cell + 1]), np.tile(group, 2)
            way = np.lexsort((group, cell, part))
            part, cell, group = part[way], cell[way], group[way]
            level += 1
    # What is left: points of last cells with several entries.
    at = bounds(n, level)
    size = np.diff(at)[cell]
    pair = np.repeat(np.arange(len(part)), size)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + at[cell][pair]
    where = bounds(m, level_e)[group][pair]
    far = squares(tree.x[part[pair], place] - entries.x[part[pair], where]) if len(pair) else np.zeros(0, np.int64)
    entry = names[part[pair], where] if len(pair) else np.zeros(0, np.int64)
    point = part[pair] * n + place
    way = np.argsort(entry, kind="stable")
    way = way[np.argsort(far[way], kind="stable")]
    way = way[np.argsort(point[way], kind="stable")]
    best = np.ones(len(way), dtype=bool)
    best[1:] = point[way][1:] != point[way][:-1]
    chosen = way[best]
    return Assigned(cells, (part[pair][chosen], place[chosen], entry[chosen]))


def sums_of(tree: Tree, found: Assigned, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) per part and entry."""
    parts, n, d = tree.x.shape
    counts, sums = np.zeros((parts, m), np.int64), np.zeros((parts, m, d), tree.x.dtype)
    for level, part, cell, entry in found.cells:
        np.add.at(counts, (part, entry), np.diff(bounds(n, level))[cell])
        np.add.at(sums, (part, entry), tree.levels[level][2][part, cell])
    part, place, entry = found.points
    np.add.at(counts, (part, entry), 1)
    np.add.at(sums, (part, entry), tree.x[part, place])
    return counts, sums


def codes_of(tree: Tree, found: Assigned) -> np.ndarray:
    """The entry of every part and place."""
    parts, n, _ = tree.x.shape
    out = np.empty((parts, n), dtype=np.int64)
    for level, part, cell, entry in found.cells:
        at = bounds(n, level)
        size = np.diff(at)[cell]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(part, size), np.repeat(at[cell], size) + inside] = np.repeat(entry, size)
    part, place, entry = found.points
    out[part, place] = entry
    return out


# ---- blocks on Spark -------------------------------------------------------------------------


def scaled(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x): usable vectors as whole doubles; floor of a double is exact at any size."""
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * float(SCALE)) < float("inf")))
    kept = vectors.where(F.col("embedding").isNotNull() & fine)
    return kept.select("vec_id", "label", F.transform("embedding", lambda c: c.cast("double")).alias("x"))


def narrow(x: np.ndarray) -> bool:
    return bool(np.abs(x).max(initial=0) < 1 << 31)


def kind_of(x: np.ndarray, book: np.ndarray):
    """64-bit numbers if no square of a distance can exceed them, else Python's."""
    most = max([int(np.abs(x).max(initial=0)), *(abs(v) for v in book.ravel().tolist())])
    return np.int64 if (2 * most) ** 2 * x.shape[2] < 1 << 62 else object


def blocks(rows: DataFrame, width: int) -> DataFrame:
    """One row per block: ids and labels as given; per part the order of its tree, its points and its cells."""
    kinds = dict(rows.dtypes)
    most = max(1, min(BLOCK, COMPONENTS // width))

    def build(batches):
        for whole in batches:
            for a in range(0, whole.num_rows, most):
                batch = whole.slice(a, most)
                n = batch.num_rows
                x = np.zeros((n, width))
                column = batch.column("x")
                size = column.value_lengths().to_numpy(zero_copy_only=False)
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                x[np.repeat(np.arange(n), size), inside] = column.flatten().to_numpy(zero_copy_only=False)
                x = np.floor(SCALE * x).reshape(n, PARTS, -1).transpose(1, 0, 2)
                order = planted(x, LEAF)
                x = np.take_along_axis(x, order[:, :, None], axis=1)
                small = narrow(x)
                tree = Tree.over(x.astype(np.int64), LEAF).levels if small else []
                cells = b"".join(np.ascontiguousarray(v).tobytes() for level in tree for v in level)
                points = np.ascontiguousarray(x.astype(np.int32) if small else x).tobytes()
                one = [pa.array([0, n], pa.int32())]
                yield pa.RecordBatch.from_arrays([
                    *(pa.ListArray.from_arrays(one[0], batch.column(c)) for c in ("vec_id", "label")), pa.array([n], pa.int32()),
                    pa.array([order.astype(np.int32).tobytes()]), pa.array([points]), pa.array([cells], pa.binary()),
                ], names=["ids", "labels", "n", "order", "points", "cells"])

    schema = f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, n int, order binary, points binary, cells binary"
    return rows.mapInArrow(build, schema)


def loaded(batch: pa.RecordBatch, book: np.ndarray) -> Iterator[tuple[int, Tree, Tree, np.ndarray]]:
    """(row, tree of the block, tree of the entries, their names) of each block of a batch."""
    d = book.shape[2]
    known: dict[type, tuple[Tree, np.ndarray]] = {}
    for row in range(batch.num_rows):
        n, points, cells = (batch.column(c)[row].as_py() for c in ("n", "points", "cells"))
        x = np.frombuffer(points, np.int32 if cells else np.float64).reshape(PARTS, n, d)
        kind = kind_of(x, book)
        if kind not in known:
            known[kind] = entry_tree(book.astype(kind))
        x = whole_numbers(x, kind)
        if cells and kind is not object:
            flat, at, levels = np.frombuffer(cells, np.int64), 0, []
            for level in range(depth_of(n, LEAF) + 1):
                size = PARTS * d << level
                levels.append(tuple(flat[at + k * size:at + (k + 1) * size].reshape(PARTS, -1, d) for k in range(3)))
                at += 3 * size
            tree = Tree(x, levels)
        else:
            tree = Tree.over(x, LEAF)
        yield row, tree, *known[kind]


def totals(held: DataFrame, book: np.ndarray) -> tuple[dict, dict]:
    """Counts by (part, entry) and sums by (part, entry, position) of one round."""
    m = book.shape[1]

    def work(batches):
        counts, sums = np.zeros((PARTS, m), np.int64), np.zeros(book.shape, dtype=object)
        for batch in batches:
            for _, tree, entries, names in loaded(batch, book):
                more, added = sums_of(tree, descend(tree, entries, names), m)
                counts += more
                sums = sums + added.astype(object)
        lines = [(p, e, -1, 0, int(counts[p, e])) for p, e in np.argwhere(counts).tolist()]
        for p, e, k in np.argwhere(sums != 0).tolist():
            value, piece = int(sums[p, e, k]), 0
            while value:
                # The highest piece has the sign.
                part = value if -(1 << PIECE) <= value < 1 << PIECE else value & ((1 << PIECE) - 1)
                lines.append((p, e, k, piece, part))
                value, piece = (value - part) >> PIECE, piece + 1
        columns = zip(*lines) if lines else [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, [pa.int32()] * 4 + [pa.int64()])], names=["part", "entry", "position", "piece", "value"])

    parts = held.select("n", "points", "cells").mapInArrow(work, "part int, entry int, position int, piece int, value long")
    counts, sums = {}, {}
    # One row per entry and component (and piece of 40 bits): the size of the codebooks.
    for p, e, k, piece, value in parts.groupBy("part", "entry", "position", "piece").agg(F.sum("value")).collect():
        if k < 0:
            counts[p, e] = value
        else:
            sums[p, e, k] = sums.get((p, e, k), 0) + (value << (PIECE * piece))
    return counts, sums


def moved(book: np.ndarray, counts: dict, sums: dict) -> np.ndarray:
    """Every entry at the floor of the mean of its parts; unused ones stay."""
    out = book.copy()
    for (p, e), n in counts.items():
        for k in range(book.shape[2]):
            out[p, e, k] = sums.get((p, e, k), 0) // n
    return out


def assigned(held: DataFrame, book: np.ndarray, kinds: dict[str, str]) -> DataFrame:
    """(vec_id, label, code, error) of every row of the blocks."""
    def work(batches):
        for batch in batches:
            for row, tree, entries, names in loaded(batch, book):
                n = tree.x.shape[1]
                order = np.frombuffer(batch.column("order")[row].as_py(), np.int32).reshape(PARTS, n)
                entry = codes_of(tree, descend(tree, entries, names))
                far = squares(tree.x - book.astype(tree.x.dtype)[np.arange(PARTS)[:, None], entry])
                code, error = np.empty((n, PARTS), np.uint8), np.zeros(n, dtype=tree.x.dtype)
                for p in range(PARTS):
                    code[order[p], p] = entry[p]
                    error[order[p]] += far[p]
                text = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(row, 1).flatten() for c in ("ids", "labels")),
                    pa.array([text[a:a + 2 * PARTS] for a in range(0, len(text), 2 * PARTS)], pa.string()),
                    pa.array([min(v, LARGEST) for v in error.tolist()], pa.int64()),
                ], names=["vec_id", "label", "code", "error"])

    return held.mapInArrow(work, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def first_book(rows: DataFrame, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids: (parts, entries, components) as Python's integers."""
    least = rows.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(ENTRIES).select("x").collect()
    x = np.zeros((len(least), width))
    for k, (v,) in enumerate(least):
        x[k, :len(v)] = v
    return whole_numbers(np.floor(SCALE * x), object).reshape(len(least), PARTS, -1).transpose(1, 0, 2)


def learned(vectors: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray] | None:
    """The staged blocks and the codebooks (parts, entries, components); None without a usable vector."""
    rows = scaled(vectors)
    longest = rows.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return None
    width = max(PARTS, -(-longest // PARTS) * PARTS)
    book = first_book(rows, width)
    held = stage(blocks(rows, width), "code-blocks")
    for _ in range(rounds):
        book = moved(book, *totals(held, book))
    return held, book


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position."""
    return sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every usable row of ``vectors``
    (vec_id, embedding, label)."""
    kinds = dict(vectors.dtypes)
    found = learned(vectors, rounds)
    if found is None:
        return vectors.where("false").select(
            "vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    held, book = found
    coded = stage(assigned(held, book, kinds), "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    out = join_back(coded, coded.groupBy("label").agg(total.alias("label_error")), ["label"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256"))
