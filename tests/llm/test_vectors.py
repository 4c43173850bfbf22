import tracemalloc

import numpy as np
from pyspark.sql import types as T

from seriema.llm import vectors

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("node", T.StringType())])


def brute(rows, cosine=0.95):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    linked = x @ x.T >= cosine
    np.fill_diagonal(linked, False)
    reach = linked | np.eye(len(x), dtype=bool)
    for _ in range(8):
        reach = (reach.astype(int) @ reach.astype(int)) > 0
    out = {i: (0, i) for i, _ in rows}
    for k, (i, _) in enumerate(good):
        out[i] = (int(linked[k].sum()), min(good[j][0] for j in np.flatnonzero(reach[k])))
    return out


def near_rows(n=600, width=24, seed=2):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, width))
    rows = []
    for k in range(n):
        c = centres[k % len(centres)]
        rows.append((k, (c + rng.normal(size=width) * rng.choice([0.0, 0.1, 0.25, 0.4])).astype(np.float32).tolist()))
    return rows


def test_links_as_by_brute_force(spark, monkeypatch):
    rows = near_rows()
    rows += [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [None] + [1.0] * 23), (905, [1.0, 2.0])]
    rows += [(910 + k, rows[0][1]) for k in range(30)] + [(950, [2 * v for v in rows[5][1]])]
    want = brute([(i, v) for i, v in rows if i != 905]) | {905: (0, 905)}
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA)
    for residents, visitors in ((2_048, 8_192), (3, 5)):  # the second splits nearly every cell
        monkeypatch.setattr(vectors, "RESIDENTS", residents)
        monkeypatch.setattr(vectors, "VISITORS", visitors)
        got = vectors.near_vectors(df).collect()
        assert len(got) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in got)
        found, true = sum(r.n_links for r in got), sum(n for n, _ in want.values())
        assert found <= true and found >= 0.98 * true
        assert all(r.n_links <= want[r.vec_id][0] for r in got)
        assert sum((r.n_links, r.component_id) != want[r.vec_id] for r in got) <= 0.02 * len(got)


def test_every_length_is_linked_with_its_own(spark):
    short, long = near_rows(120, 8, 5), near_rows(120, 24, 6)
    rows = [(0, [1.0, 2.0, 3.0])] + [(1 + i, v) for i, v in long] + [(500 + i, v) for i, v in short]
    want = {0: (0, 0)} | brute(rows[1:121]) | brute(rows[121:])
    got = vectors.near_vectors(spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)).collect()
    assert len(got) == len(rows) and all(r.n_links <= want[r.vec_id][0] for r in got)
    for group in (rows[1:121], rows[121:]):
        true = sum(want[i][0] for i, _ in group)
        assert true > 100 and sum(r.n_links for r in got if r.vec_id in dict(group)) >= 0.98 * true
    assert sum((r.n_links, r.component_id) != want[r.vec_id] for r in got) <= 0.02 * len(got)


def test_visits_are_the_nearest_cells():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    index = vectors.Index(x, 6, 0.9, 0.95)
    index.visits = 11
    da, db = vectors.distances(x[:, :4], index.books[0]), vectors.distances(x[:, 4:], index.books[1])
    for row, cells in enumerate(index.cells(x)):
        total = (da[row][:, None] + db[row][None, :]).ravel()
        assert np.allclose(np.sort(total)[:11], total[cells])


def test_visits_are_measured_without_a_list_of_all_cells():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3_000, 8))
    x /= np.linalg.norm(x, axis=1)[:, None]
    tracemalloc.start()
    index = vectors.Index(x, 120, 0.998, 0.95)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # the order of 14,400 cells for 3,000 vectors takes 346 MB
    y = x + 0.1 * rng.normal(size=x.shape)
    places, home = index.places(x[:200], y[:200]), index.home(y[:200])
    index.visits = len(index.books[0]) * len(index.books[1])
    assert (places == (index.cells(x[:200]) == home[:, None]).argmax(1) + 1).all()


def test_empty_and_unusable(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, [0.0], "x")], SCHEMA)
    assert sorted(tuple(r) for r in vectors.near_vectors(df).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert vectors.near_vectors(df.limit(0)).count() == 0
