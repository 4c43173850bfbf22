import hashlib
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from seriema.llm import recompression, suffixes
from tests.llm.corpora import corpus, frame


def cover(n, size, starts):
    gone = np.zeros(n + size + 1, dtype=int)
    for s in starts:
        gone[s] += 1
        gone[s + size] -= 1
    return np.cumsum(gone)[:n] > 0


def brute(rows, size, units):
    """Per row the units and the mask of those that go."""
    cut = [(i, units(t)) for i, t in rows]
    first = {}
    for i, u in cut:
        for k in range(len(u) - size + 1):
            w = tuple(u[k:k + size])
            if i is not None:
                first[w] = min(i, first.get(w, i))
    return [(i, u, cover(len(u), size, [
        k for k in range(len(u) - size + 1) if i is not None and first[tuple(u[k:k + size])] < i])) for i, u in cut]


@pytest.mark.parametrize("seed", [1, 2])
def test_words_as_by_brute_force(spark, seed):
    rows = corpus(seed)
    want = Counter(
        (i, len(u), int(g.sum()), hashlib.sha256(b" ".join(w for w, x in zip(u, g) if not x)).hexdigest())
        for i, u, g in brute(rows, 13, lambda t: (t or "").encode().split()))
    got = recompression.digests(frame(spark, rows, clashes=True)).collect()
    assert Counter(tuple(r) for r in got) == want
    assert sum(r.n_removed for r in got) > 500


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_as_by_brute_force(spark, seed):
    rows = [(i, t) for i, t in corpus(seed) if t is None or len(t) < 100_000] + [(90, "ab" * 300), (91, "ab" * 100 + "é" * 60), (92, "é" * 60)]
    want = Counter()
    for i, u, g in brute(rows, 50, lambda t: (t or "").encode()):
        edges = np.diff(np.concatenate([[0], g.astype(int), [0]]))
        want[(i, len(u), int(g.sum()), int((edges == 1).sum()), hashlib.sha256(bytes(b for b, x in zip(u, g) if not x)).hexdigest())] += 1
    got = suffixes.spans(frame(spark, rows, clashes=True)).collect()
    assert Counter(tuple(r) for r in got) == want


def test_bytes_of_very_long_texts_as_by_brute_force(spark):
    rows = corpus(1) + [(84, "y" * 150_000 + "z" * 60), (85, "ab" * 70_000)]
    cut = [(i, (t or "").encode()) for i, t in rows]
    names = [[hash(u[k:k + 50]) for k in range(len(u) - 49)] for _, u in cut]
    first = {}
    for (i, _), found in zip(cut, names):
        for h in found if i is not None else ():
            first[h] = min(i, first.get(h, i))
    want = Counter()
    for (i, u), found in zip(cut, names):
        g = cover(len(u), 50, [k for k, h in enumerate(found) if i is not None and first[h] < i])
        edges = np.diff(np.concatenate([[0], g.astype(int), [0]]))
        want[(i, len(u), int(g.sum()), int((edges == 1).sum()), hashlib.sha256(np.frombuffer(u, np.uint8)[~g].tobytes()).hexdigest())] += 1
    for hot in (suffixes.HOT, 10):
        got = suffixes.spans(frame(spark, rows, clashes=True), hot=hot).collect()
        assert Counter(tuple(r) for r in got) == want


@pytest.mark.parametrize("hot", [1, 6])
def test_strings_of_hot_minimizers_as_by_brute_force(spark, hot):
    rows = [(i, t) for i, t in corpus(3) if t is None or len(t) < 100_000] + [(90, "ab" * 300), (91, "ab" * 100 + "é" * 60), (92, "é" * 60)]
    want = Counter()
    for i, u, g in brute(rows, 50, lambda t: (t or "").encode()):
        edges = np.diff(np.concatenate([[0], g.astype(int), [0]]))
        want[(i, len(u), int(g.sum()), int((edges == 1).sum()), hashlib.sha256(bytes(b for b, x in zip(u, g) if not x)).hexdigest())] += 1
    got = suffixes.spans(frame(spark, rows, clashes=True), hot=hot).collect()
    assert Counter(tuple(r) for r in got) == want
    assert sum(r.n_removed for r in got) > 500


def test_fragments_of_a_shared_phrase_have_many_keys():
    rng = np.random.default_rng(4)
    phrase, buckets = "a phrase in every one of the texts", 16
    texts = ["".join(map(chr, rng.integers(97, 123, 40))) + phrase + "".join(map(chr, rng.integers(97, 123, 40))) for _ in range(4_000)]
    docs = [pa.table({"doc_id": pa.array(range(k, 4_000, 4)), "text": texts[k::4]}) for k in range(4)]

    def largest(hot):
        replies = [{} for _ in docs]
        for phase, ask, answer in (("copies", suffixes.ask_copies, recompression.answer_copies),
                                   ("minimizers", suffixes.ask_minimizers, partial(suffixes.answer_minimizers, hot=hot))):
            sent = [ask(d, r, buckets) for d, r in zip(docs, replies)]
            for k in range(buckets):
                to = [j for j, m in enumerate(sent) if m[k] is not None]
                for j, reply in zip(to, answer([sent[j][k] for j in to]) if to else []):
                    replies[j][phase, k] = reply
        keys = np.concatenate([suffixes.Bytes(d, r, buckets).fragments(r, buckets)[3] for d, r in zip(docs, replies)])
        return int(np.unique(keys, return_counts=True)[1].max())

    # Fragments with one key are sorted together: those around the phrase are different ones in each text.
    assert largest(1 << 30) > 300 and largest(100) < 100


def test_spans_and_kept_bytes(spark):
    shared = "a passage that is long enough to be removed from the second one"
    rows = [(1, shared + " one"), (2, "two: " + shared), (3, None)]
    got = {r.doc_id: r for r in suffixes.spans(frame(spark, rows), keep=True).collect()}
    assert got[1].spans == [] and bytes(got[1].kept).decode() == rows[0][1]
    assert got[2].spans == [[5, 5 + len(shared)]] and bytes(got[2].kept) == b"two: "
    assert got[3].n_bytes == 0 and bytes(got[3].kept) == b""


def test_two_stage_sorting_is_a_suffix_array():
    rng = np.random.default_rng(3)
    for alphabet in (2, 3, 200):
        text = np.append(rng.integers(1, alphabet + 1, 3_000).astype(np.uint8), np.zeros(suffixes.DEPTH + 8, np.uint8))
        want = np.zeros(len(text), dtype=bool)
        want[:3_001] = True
        got = suffixes.suffix_array(text, want)
        depth = suffixes.DEPTH
        sorted_ = sorted(range(3_001), key=lambda k: text[k:k + depth].tobytes())
        assert [text[k:k + depth].tobytes() for k in got] == [text[k:k + depth].tobytes() for k in sorted_]
        assert sorted(got.tolist()) == list(range(3_001))


def test_common_prefixes():
    text = np.frombuffer(b"banana" + b"\0" * 80, np.uint8)
    assert suffixes.common_prefixes(text, np.array([5, 3, 1, 0, 4, 2])).tolist() == [1, 3, 0, 0, 2]


def test_empty_tables(spark):
    empty = frame(spark, [(1, "x")]).limit(0)
    assert recompression.digests(empty).count() == 0 and suffixes.spans(empty).count() == 0


def test_texts_without_repeats_keep_their_form(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    rows = [(1, f"a  b\n{passage}"), (2, f"c\n\n{passage} d"), (3, passage), (4, None)]
    got = {r.doc_id: r.text for r in recompression.without_repeats(frame(spark, rows)).collect()}
    assert got == {1: rows[0][1], 2: "c d", 4: None}
