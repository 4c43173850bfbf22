import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from seriema.llm import codes

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
    T.StructField("code", T.StringType()), T.StructField("x", T.StringType()),
])


def brute(rows, rounds=6):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c * 4096) for c in v)]
    if not kept:
        return []
    width = max(8, -(-max(len(v) for _, v, _ in kept) // 8) * 8)
    whole = [[math.floor(4096 * c) for c in v] + [0] * (width - len(v)) for _, v, _ in kept]
    d = width // 8
    parts = [[w[p * d:(p + 1) * d] for p in range(8)] for w in whole]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:16]
    book = [[parts[k][p] for k in first] for p in range(8)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [[min(range(len(first)), key=lambda e: (far(w[p], book[p][e]), e)) for p in range(8)] for w in parts]

    for _ in range(rounds):
        near = assign()
        for p in range(8):
            for e in range(len(first)):
                own = [w[p] for w, n in zip(parts, near) if n[p] == e]
                if own:
                    book[p][e] = [sum(c) // len(own) for c in zip(*own)]
    near = assign()
    error = [sum(far(w[p], book[p][n[p]]) for p in range(8)) for w, n in zip(parts, near)]
    digest = hashlib.sha256(",".join(str(c) for b in book for y in b for c in y).encode()).hexdigest()
    most = (1 << 63) - 1
    total = {lab: min(most, sum(min(e, most) for e, k in zip(error, kept) if k[2] == lab)) for lab in {k[2] for k in kept}}
    return sorted(((i, "".join(f"{e:02x}" for e in n), min(err, most), total[lab], digest)
                   for (i, _, lab), n, err in zip(kept, near, error)), key=repr)


def got(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "clash", "clash") for i, v, lab in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in codes.compress(df).collect()), key=repr)


def cloud(n, width, seed, scale=0.1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, width))
    return [(k, (scale * (centres[rng.integers(20)] + rng.choice([0, 0.05, 0.5]) * rng.normal(size=width))).tolist(), int(rng.integers(4))) for k in range(n)]


def test_codes_by_brute_force(spark):
    rows = cloud(700, 16, 1)
    rows += [(800 + k, rows[3][1], None) for k in range(50)] + [(900, None, 1), (901, [None] * 16, 1), (902, [float("nan")] * 16, 1)]
    rows += [(903, [float("inf")] + [0.0] * 15, 1), (904, [1e305] + [0.0] * 15, 1), (5, rows[7][1], None), (5, rows[8][1], 2), (None, rows[9][1], 2), (905, [], 3)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("width,scale", [(13, 0.1), (64, 0.05), (8, 0.0002), (8, 1e12), (8, 1e200)])
def test_ties_lengths_and_large_components(spark, width, scale):
    """Tiny scales make many equal distances, huge ones leave 64-bit numbers."""
    rows = cloud(150, width, width, scale)
    assert got(spark, rows) == brute(rows)


def test_few_and_no_vectors(spark):
    rows = [(3, [0.5] * 8, 1), (1, [-0.5] * 8, 1), (2, [0.5] * 8, None)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(1, None, 1)]) == []
    df = spark.createDataFrame([(1, [1.0], 1, "", "")], SCHEMA).limit(0)
    assert codes.compress(df).count() == 0 and codes.compress(df).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_descent_assigns_whole_cells_and_cuts_groups():
    """On points in clusters most cells are taken whole, from their kept sums."""
    rng = np.random.default_rng(3)
    centres = rng.integers(-4000, 4000, size=(codes.PARTS, 16, 8))
    x = np.stack([centres[p][rng.integers(16, size=4096)] + rng.integers(-20, 20, size=(4096, 8)) for p in range(codes.PARTS)])
    x = np.take_along_axis(x, codes.planted(x.astype(float), codes.LEAF)[:, :, None], axis=1)
    tree = codes.Tree.over(x, codes.LEAF)
    entries, names = codes.entry_tree(centres)
    found = codes.descend(tree, entries, names)
    assert len(found.points[0]) < 0.1 * codes.PARTS * 4096
    far = ((x[:, :, None, :] - centres[:, None, :, :]) ** 2).sum(-1)
    assert (codes.codes_of(tree, found) == far.argmin(2)).all()
    counts, sums = codes.sums_of(tree, found, 16)
    assert (counts == np.stack([np.bincount(far[p].argmin(1), minlength=16) for p in range(codes.PARTS)])).all()
    assert (sums.sum(1) == x.sum(1)).all()
