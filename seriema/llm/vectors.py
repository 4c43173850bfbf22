"""Near-duplicates of vectors by an inverted multi-index.

Unit vectors are cut in halves, each half has its own codebook, and the pairs of code words make a grid of
cells. A vector lives in the cell of its nearest words and visits the cells nearest to it, in the order of
the sum of both distances (multi-sequence order). How many it visits is measured: so many that of sample
vectors and neighbours put at the limiting cosine in random directions, ``RECALL`` are met. In a cell, all
visitors are compared with all residents in double precision.

A pair is met in the later of its two cells, so a vector only visits cells behind its own, and every pair
is met at most once. Equal vectors are one node. Tasks compare at most ``RESIDENTS`` by ``VISITORS`` vectors;
cells with more are split. A task returns link counts and a spanning forest of the links, never the pairs.

The codebooks are learned from at most ``SAMPLE`` vectors of a length; all are indexed.

Every length of vectors has an index of its own, and vectors of different lengths are never linked.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components are linked with nothing and
stay. Repeated rows and equal
vectors are linked with each other. A NULL id never names a component unless all members have none. An
empty table gives an empty result. Columns: ``vec_id, n_links, component_id, kept``; others do not take part.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .components import components

COSINE = 0.95
SAMPLE = 20_000
#: Vectors in a cell, on average, and words in a codebook, at most.
PER_CELL, MOST_WORDS = 64, 4_096
RECALL, TRIALS = 0.998, 3_000
RESIDENTS, VISITORS = 2_048, 8_192
ROUNDS, SEED = 12, 11
#: Vectors whose distances to all words are held at once, and their places in the order of cells.
TOGETHER, PLACES = 512, 1 << 22


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, unit): the digest of the components, and the unit vector as doubles."""
    kind = dict(vectors.dtypes)["vec_id"]

    def parse(batches):
        for batch in batches:
            nodes, units = [], []
            for value in batch.column("embedding").to_pylist():
                x = np.array([np.nan if c is None else c for c in value or ()], dtype=np.float64)
                norm = float(np.linalg.norm(x)) if len(x) and np.isfinite(x).all() else 0.0
                if norm and not math.isfinite(norm):  # components too large to square
                    x = x / np.abs(x).max()
                    norm = float(np.linalg.norm(x))
                good = norm > 0
                nodes.append(blake2b(x.tobytes(), digest_size=16).digest() if good else None)
                units.append((x / norm).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(nodes, pa.binary()), pa.array(units, pa.binary())], names=["vec_id", "node", "unit"])

    return vectors.select("vec_id", "embedding").mapInArrow(parse, f"vec_id {kind}, node binary, unit binary")


def matrix(units) -> np.ndarray:
    return np.stack([np.frombuffer(u, np.float64) for u in units]) if len(units) else np.zeros((0, 0))


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (x**2).sum(1)[:, None] - 2 * x @ words.T + (words**2).sum(1)[None, :]


def nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The nearest word of each vector, some vectors at a time."""
    return np.concatenate([distances(x[a:a + TOGETHER], words).argmin(1) for a in range(0, max(1, len(x)), TOGETHER)])


def codebook(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means; a word that loses all its vectors moves to a random one."""
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        near = nearest(x, words)
        n = np.bincount(near, minlength=len(words))
        total = np.zeros_like(words)
        np.add.at(total, near, x)
        words = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), len(words))])
    return words


class Index:
    def __init__(self, sample: np.ndarray, k: int, recall: float, cosine: float):
        rng = np.random.default_rng(SEED)
        self.half = (sample.shape[1] + 1) // 2
        self.books = [codebook(sample[:, :self.half], k, rng), codebook(sample[:, self.half:], k, rng)]
        self.visits = len(self.books[0]) * len(self.books[1])
        x = sample[rng.integers(0, len(sample), TRIALS)]
        noise = rng.normal(size=x.shape)
        noise -= (noise * x).sum(1)[:, None] * x
        norm = np.linalg.norm(noise, axis=1)[:, None]
        y = cosine * x + math.sqrt(1 - cosine**2) * np.where(norm > 0, noise / np.where(norm > 0, norm, 1), 0)
        self.visits = int(np.quantile(self.places(x, y), recall, method="higher"))

    def places(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The place, from 1, of the cell of each ``y`` in the order of cells of ``x``; equal sums count as before it.

        The smaller of both ways would be less.
        """
        out = np.empty(len(x), dtype=np.int64)
        home = self.home(y)
        for a in range(0, len(x), TOGETHER):
            da, db = distances(x[a:a + TOGETHER, :self.half], self.books[0]), distances(x[a:a + TOGETHER, self.half:], self.books[1])
            for k in range(len(da)):
                i, j = divmod(int(home[a + k]), len(self.books[1]))
                # Sums are counted by sorted halves, so that no list of all cells is made.
                out[a + k] = np.searchsorted(np.sort(db[k]), da[k, i] + db[k, j] - da[k] + 1e-12, side="right").sum()
        return out

    def home(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, :self.half], self.books[0]) * len(self.books[1]) + nearest(x[:, self.half:], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The first ``visits`` cells of each vector in multi-sequence order.

        The cell of the i-th and j-th nearest words comes after the i * j cells of nearer ones, so only
        those with i * j <= visits can be among the first.
        """
        ka, kb = len(self.books[0]), len(self.books[1])
        i, j = np.meshgrid(np.arange(1, ka + 1), np.arange(1, kb + 1), indexing="ij")
        grid = np.argwhere((i * j <= self.visits)) if ka * kb <= 1 << 22 else np.array(
            [(a, b) for a in range(min(ka, self.visits)) for b in range(min(kb, self.visits // (a + 1)))])
        out = np.empty((len(x), min(self.visits, ka * kb)), dtype=np.int64)
        step = max(1, min(TOGETHER, PLACES // len(grid)))
        for at in range(0, len(x), step):
            part = x[at:at + step]
            da, db = distances(part[:, :self.half], self.books[0]), distances(part[:, self.half:], self.books[1])
            rows = np.arange(len(part))[:, None]
            wa, wb = da.argsort(1, kind="stable")[:, grid[:, 0]], db.argsort(1, kind="stable")[:, grid[:, 1]]
            order = (da[rows, wa] + db[rows, wb]).argsort(1, kind="stable")[:, :out.shape[1]]
            out[at:at + step] = np.take_along_axis(wa * kb + wb, order, 1)
        return out


def entries(nodes: DataFrame, indexes: dict[int, Index]) -> DataFrame:
    """(cell, node, unit, copies, resident): every node at home and in the cells it visits behind that.

    ``indexes`` is by the bytes of a unit vector; the cells of each are numbered after those of the ones before.
    """
    sizes = [len(i.books[0]) * len(i.books[1]) for i in indexes.values()]
    bases = dict(zip(indexes, np.cumsum([0, *sizes]).tolist()))

    def visit(batches):
        for whole in batches:
            lengths = np.array([len(u) for u in whole.column("unit").to_pylist()], dtype=np.int64)
            for n in np.unique(lengths).tolist():
                if n in indexes:
                    yield from visited(whole.take(pa.array(np.flatnonzero(lengths == n))), indexes[n], bases[n])

    def visited(batch, index, base):
        x = matrix(batch.column("unit").to_pylist())
        home, cells = index.home(x), index.cells(x)
        behind = cells > home[:, None]
        row = np.concatenate([np.arange(len(x)), np.nonzero(behind)[0]])
        cell = np.concatenate([home, cells[behind]]) + base
        take = pa.array(row)
        for a in range(0, len(row), 4_096):
            part = take[a:a + 4_096]
            yield pa.RecordBatch.from_arrays([
                pa.array(cell[a:a + 4_096]), *(batch.column(c).take(part) for c in ("node", "unit", "copies")),
                pa.array(np.arange(a, a + len(part)) < len(x)),
            ], names=["cell", "node", "unit", "copies", "resident"])

    return nodes.select("node", "unit", "copies").mapInArrow(visit, "cell long, node binary, unit binary, copies long, resident boolean")


def compare(cosine: float):
    """Of a group: (node, other, links): link counts, and for each linked node one it is joined with."""
    def roots(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        while True:  # smallest label along links, both ways, until nothing changes
            new_left = np.minimum(left, np.where(linked, right[None, :], len(left) + len(right)).min(1, initial=len(left) + len(right)))
            new_right = np.minimum(right, np.where(linked, new_left[:, None], len(left) + len(right)).min(0, initial=len(left) + len(right)))
            if (new_left == left).all() and (new_right == right).all():
                return left, right
            left, right = new_left, new_right

    def group(table: pa.Table) -> pa.Table:
        role = np.array(table.column("role").to_pylist())
        nodes = np.array(table.column("node").to_pylist(), dtype=object)
        copies = np.array(table.column("copies").to_pylist(), dtype=np.int64)
        units = np.array(table.column("unit").to_pylist(), dtype=object)
        here, there = np.flatnonzero(role == "R"), np.flatnonzero(role == "V")
        own = table.column("vpart")[0].as_py() == 0
        counts = np.zeros(len(role), dtype=np.int64)
        root = np.arange(len(role))
        x = matrix(units[here])
        if len(here) and own:
            linked = x @ x.T >= cosine
            np.fill_diagonal(linked, False)
            counts[here] += linked @ copies[here]
            np.fill_diagonal(linked, True)
            label, _ = roots(linked, np.arange(len(here)), np.arange(len(here)))
            root[here] = here[label]
        if len(here) and len(there):
            linked = x @ matrix(units[there]).T >= cosine
            counts[here] += linked @ copies[there]
            counts[there] += copies[here] @ linked
            # Links of residents among themselves are already in `root`; those with visitors are added.
            label, other = roots(linked, np.arange(len(here)), np.arange(len(here), len(role)))
            place = np.concatenate([here, there])
            add = np.concatenate([place[label], place[other]])
            extra = np.flatnonzero(add != place)
        else:
            place, extra, add = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        mine = np.flatnonzero(root != np.arange(len(role)))
        some = np.flatnonzero(counts)
        a = np.concatenate([some, mine, place[extra]]).astype(np.int64)
        other = [None] * len(some) + list(nodes[root[mine]]) + list(nodes[add[extra]])
        return pa.table({
            "node": pa.array(list(nodes[a]), pa.binary()), "other": pa.array(other, pa.binary()),
            "links": pa.array(np.concatenate([counts[some], np.zeros(len(a) - len(some), np.int64)])),
        })

    return group


def groups(found: DataFrame) -> DataFrame:
    """Entries dealt to groups of bounded size: (cell, rpart, vpart, role, node, unit, copies)."""
    sizes = found.groupBy("cell").agg(F.count(F.when(F.col("resident"), 1)).alias("r"), F.count(F.when(~F.col("resident"), 1)).alias("v"))
    sizes = stage(sizes.where("r > 0").select(
        "cell", F.ceil(F.col("r") / RESIDENTS).cast("int").alias("rparts"),
        # Residents visit the parts before their own, so they count as visitors where there are several.
        F.greatest(F.lit(1), F.ceil((F.col("v") + F.when(F.col("r") > RESIDENTS, F.col("r")).otherwise(0)) / VISITORS)).cast("int").alias("vparts"),
    ), "vector-cells")
    e = found.join(sizes, "cell")
    rpart, vpart = F.pmod(F.xxhash64("node"), F.col("rparts")).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("vparts")).cast("int")
    spot = lambda r, v, role: F.struct(r.alias("rpart"), v.alias("vpart"), F.lit(role).alias("role"))
    count = lambda n: F.sequence(F.lit(0), n - 1)
    at_home = F.transform(count(F.col("vparts")), lambda v: spot(rpart, v, "R"))
    before = F.when(rpart > 0, F.transform(count(rpart), lambda r: spot(r, vpart, "V"))).otherwise(F.array().cast("array<struct<rpart:int,vpart:int,role:string>>"))
    away = F.transform(count(F.col("rparts")), lambda r: spot(r, vpart, "V"))
    e = e.withColumn("spot", F.explode(F.when(F.col("resident"), F.concat(at_home, before)).otherwise(away)))
    return e.select("cell", "spot.*", "node", "unit", "copies")


def near_vectors(vectors: DataFrame, *, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding)."""
    rows = stage(nodes_of(vectors), "vector-rows")
    usable = rows.where("unit IS NOT NULL")
    plain = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    if usable.isEmpty():
        return plain
    nodes = stage(usable.groupBy("node").agg(F.first("unit").alias("unit"), F.count("*").alias("copies"), F.min("vec_id").alias("least")), "vector-nodes")
    indexes = {}
    # One row per length; a vector that is the only one of its length has no other to meet.
    for n, count in nodes.groupBy(F.length("unit")).count().where("count > 1").collect():
        sample = nodes.where(F.length("unit") == n).orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("unit").collect()
        words = min(MOST_WORDS, max(1, math.ceil(math.sqrt(count / PER_CELL))))
        indexes[n] = Index(matrix([bytes(r[0]) for r in sample]), words, recall, cosine)
    found = groups(stage(entries(nodes, indexes), "vector-entries")).groupBy("cell", "rpart", "vpart").applyInArrow(
        compare(cosine), "node binary, other binary, links long")
    found = stage(found, "vector-links")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    links = found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    named = nodes.select("node", "copies", "least").join(counts, "node", "left").join(components(links), "node", "left")
    named = named.select("node", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("root"))
    named = stage(named, "vector-named")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select("node", "n_links", "component", F.lit(True).alias("found"))
    out = rows.join(named, "node", "left")
    component = F.when(F.col("found"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
