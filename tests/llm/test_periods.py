import hashlib
import random
import time
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from seriema.llm import periods
from tests.llm.corpora import corpus, frame, key


def brute(w, least=6, times=4):
    n, out = len(w), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                sub = w[i:j + q]
                if not any(sub[p:] == sub[:-p] for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w) if len(set(w)) < len(w) else []
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    rest = b" ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(rest).hexdigest())


def test_digests_by_brute_force(spark):
    rows = [(i, t) for i, t in corpus(4) if t is None or len(t) < 100_000]
    rows += [(1000 + k, " ".join(random.Random(k).choices("ab", k=80)) + " c" * k) for k in range(60)]
    got = periods.digests(frame(spark, rows, clashes=True), periods.seeded_period).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected(i, t) for i, t in rows), key=repr)
    assert sum(r.n_runs for r in got) > 60


small = st.lists(st.integers(0, 3), max_size=12)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(small, small, st.integers(0, 7), small), min_size=1, max_size=5))
def test_runs_by_brute_force(parts):
    texts = [a + b * k + b[:len(b) // 2] + c for a, b, k, c in parts]
    assert periods.runs_of([np.array(t, dtype=np.int64) for t in texts]) == [brute(t) for t in texts]


def test_long_and_periodic_texts_stay_cheap():
    fib, before = [0], [1]
    while len(fib) < 60_000:
        fib, before = fib + before, fib
    cases = {"one word": [0] * 100_000, "three words": [0, 1, 2] * 30_000, "no exponent of four": fib, "two runs": [0] * 40_000 + [1, 2] * 20_000}
    for name, text in cases.items():
        began = time.time()
        got = periods.runs_of([np.array(text, dtype=np.int64)])[0]
        assert time.time() - began < 20, name
        want = {"one word": [(0, 100_000, 1)], "three words": [(0, 90_000, 3)], "no exponent of four": [], "two runs": [(0, 40_000, 1), (40_000, 40_000, 2)]}
        assert got == want[name]


def test_collapsed_texts_keep_their_columns(spark):
    rows = [(1, "go go go go go go now"), (2, None), (3, " keeps  its\tblanks "), (None, "a b a b a b a b c")]
    got = {r.doc_id: r for r in periods.collapsed(frame(spark, rows, clashes=True)).collect()}
    assert {k: r.text for k, r in got.items()} == {1: "go now", 2: None, 3: " keeps  its\tblanks ", None: "a b c"}
    assert [tuple(x) for x in got[1].runs] == [(0, 6, 1)] and got[2].runs == [] and got[1].score == "clash"
    assert sorted(got, key=key) == [1, 2, 3, None]


def test_empty_table(spark):
    empty = frame(spark, [(1, "x")]).limit(0)
    assert periods.digests(empty).count() == 0 and periods.collapsed(empty).count() == 0
