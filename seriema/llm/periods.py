"""Periodic runs of words, and texts in which each run is cut to its first period.

A run is a stretch of words with smallest period q, of at least ``LEAST`` words and ``TIMES`` periods, that no
neighbouring word extends. Documents are judged one by one, so nothing is shuffled; a task sorts the
suffixes of many documents together, the document being the first key, which gives each an enhanced suffix
array of its own:

1. suffixes are sorted by prefix doubling, groups that are told apart are left alone; the ranks of every round
   stay and give the common prefixes of neighbours (LCP) by descent;
2. every LCP interval of depth d is tested for branching squares: of the suffixes i in all its children but the
   largest, those where i + d or i - d lies in the interval too, in another child (a look into the inverse array, ISA);
   intervals are bounds in the arrays, no tree is made;
3. squares whose root is a power of a shorter one end where the run of that one ends and are left out; the others are
   rotated to the left as long as the word before fits, which gives the run.

The square at the right end of a run is its only branching one with the smallest period, so each run is found
once, and all are.

Defined cases: a NULL text, an empty one and one of blanks have no words and no run; a NULL id is judged like
others; equal ids and repeated rows are judged each by itself; of runs of equal length the first start, then the
smaller period is the longest; an empty table gives an empty result. A text of any length is sorted whole, at
some 200 bytes a word. Extra columns are kept by :func:`collapsed` (the columns that it adds replace those of the same
name) and ignored by :func:`digests`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .hashing import words_of

#: Words and periods that a run has at least.
LEAST, TIMES = 6, 4
#: Words whose suffixes are sorted together; a longer text is sorted alone.
TOGETHER = 1 << 17


class Numbers(dict):
    """Word -> number, by first occurrence."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def sorted_suffixes(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The order of the suffixes, and after each round the ranks by the first 1, 2, 4, ... symbols.

    ``x`` has a symbol in one document only; ``ends`` is, for each place, the end of its document. A suffix that
    ends is smaller than one that goes on.
    """
    n = len(x)
    order = np.argsort(x, kind="stable")
    rank = np.empty(n, dtype=np.int32)

    def name(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes in ``slots``, whose keys are in order; returns the slots still tied."""
        first = np.ones(len(slots), dtype=bool)
        first[1:] = keys[1:] != keys[:-1]
        rank[order[slots]] = np.repeat(slots[first], np.diff(np.append(np.flatnonzero(first), len(slots))))
        return slots[~(first & np.append(first[1:], True))]

    tied = name(np.arange(n), x[order])
    levels, width = [rank.copy()], 1
    while len(tied):
        at = order[tied]
        behind = at + width
        inside = behind < ends[at]
        then = np.where(inside, rank[np.where(inside, behind, 0)], -1)
        keys = rank[at].astype(np.int64) * (n + 1) + (then + 1)
        way = np.argsort(keys, kind="stable")
        order[tied] = at[way]
        tied = name(tied, keys[way])
        levels.append(rank.copy())
        width *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """LCP of every suffix with the one before it in the order; 0 for the first."""
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[at - 1].copy(), order[at].copy()
    for m in range(len(levels) - 1, -1, -1):
        live = np.flatnonzero((a < ends[order[at]]) & (b < ends[order[at]]))
        same = live[levels[m][a[live]] == levels[m][b[live]]]
        a[same] += 1 << m
        b[same] += 1 << m
        lcp[at[same]] += 1 << m
    return lcp


def smaller_before(v: np.ndarray) -> np.ndarray:
    """For each value above 0, the nearest place before with a smaller one, or -1; all places jump at once."""
    at = np.arange(len(v)) - 1
    open_ = np.flatnonzero((v > 0) & (at >= 0))
    while len(open_):
        open_ = open_[v[at[open_]] >= v[open_]]
        at[open_] = at[at[open_]]
        open_ = open_[at[open_] >= 0]
    return at


def branching_squares(order: np.ndarray, lcp: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows (period, place) of all squares that the word behind them does not continue.

    ``starts`` and ``ends`` bound the document of each place.
    """
    n = len(order)
    ks = np.flatnonzero(lcp > 0)
    if not len(ks):
        return np.zeros((0, 2), dtype=np.int64)
    isa = np.empty(n, dtype=np.int64)
    isa[order] = np.arange(n)
    depth = lcp[ks]
    left = smaller_before(lcp)[ks]
    right = n - 1 - smaller_before(lcp[::-1])[::-1][ks]
    # Children of an interval: cut at its places in the LCP, from the left bound to the right one.
    by = np.lexsort((ks, depth, left))
    ks, depth, left, right = ks[by], depth[by], left[by], right[by]
    head = np.ones(len(ks), dtype=bool)
    head[1:] = (left[1:] != left[:-1]) | (depth[1:] != depth[:-1])
    tail = np.append(head[1:], True)
    before = np.where(head, left, np.append(-1, ks[:-1]))
    group = np.cumsum(head) - 1
    begin = np.concatenate([before, ks[tail]])
    end = np.concatenate([ks, right[tail]])
    owner = np.concatenate([group, group[tail]])
    of = np.flatnonzero(head)
    d, low, high = depth[of], left[of], right[of]
    # All children but the largest of each.
    way = np.lexsort((end - begin, owner))
    last = np.append(owner[way][1:] != owner[way][:-1], True)
    small = way[~last]
    begin, end, owner = begin[small], end[small], owner[small]
    size = end - begin
    child = np.repeat(np.arange(len(small)), size)
    t = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + begin[child]
    i, d, low, high = order[t], d[owner][child], low[owner][child], high[owner][child]
    begin, end = begin[child], end[child]
    out = []
    for step, square in ((d, 0), (-d, -1)):
        j = i + step
        fits = np.flatnonzero((j >= starts[i]) & (j < ends[i]))
        spot = isa[j[fits]]
        hit = (spot >= low[fits]) & (spot < high[fits]) & ((spot < begin[fits]) | (spot >= end[fits]))
        found = fits[hit]
        out.append(np.stack([d[found], i[found] + square * d[found]], axis=1))
    return np.unique(np.concatenate(out), axis=0)


def rotated(x: np.ndarray, at: int, period: int, low: int) -> int:
    """How far left of ``at`` the words keep the period, not below ``low``; in growing strides."""
    stride = 16
    while at > low:
        step = min(stride, at - low)
        differ = np.flatnonzero(x[at - step:at] != x[at - step + period:at + period])
        if len(differ):
            return at - step + int(differ[-1]) + 1
        at -= step
        stride *= 2
    return low


def runs_of(texts: list[np.ndarray], least: int = LEAST, times: int = TIMES) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each sequence of numbers, by start, then period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not sizes.sum():
        return out
    words = np.concatenate(texts).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    firsts = np.cumsum(sizes) - sizes
    starts, ends = firsts[doc], (firsts + sizes)[doc]
    order, levels = sorted_suffixes(doc * (int(words.max()) + 1) + words, ends)
    lcp = common_prefixes(order, levels, ends)
    del levels
    squares = branching_squares(order, lcp, ends, starts)
    # A run of so many periods also has these words before its last square; all others need no rotation.
    d, i = squares[:, 0], squares[:, 1]
    back = np.maximum(i - (times - 2) * d, 0)
    likely = (i - (times - 2) * d >= starts[i]) if len(i) else np.zeros(0, dtype=bool)
    likely &= words[back] == words[i]
    known: dict[int, list[tuple[int, int]]] = {}  # end -> (period, start), smaller periods first
    for period, at in squares[likely].tolist():
        end = at + 2 * period
        if any(period % q == 0 and s <= at for q, s in known.get(end, ())):
            continue
        start = rotated(words, at, period, int(starts[at]))
        known.setdefault(end, []).append((period, start))
        if end - start >= max(least, times * period):
            out[doc[at]].append((start - int(starts[at]), end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def kept(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when each run is cut to its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


Document = tuple[int | None, list[bytes]]


def judged(documents: Iterator[Document], together: int = TOGETHER) -> Iterator[tuple[list[bytes], list]]:
    """(words, runs) of each document, in order."""
    held: list[list[bytes]] = []
    size = 0

    def done():
        numbers = Numbers()
        texts = [np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in held]
        return zip(list(held), runs_of(texts))

    for _, words in documents:
        if held and size + len(words) > together:
            yield from done()
            held.clear()
            size = 0
        held.append(words)
        size += len(words)
    if held:
        yield from done()


def seeded_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten, by its id, goes on in a period: the words that the registered query is asked to judge."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


Prepare = Callable[[int | None, list[bytes]], list[bytes]]


def _pairs(batch: pa.RecordBatch, prepare: Prepare | None) -> Iterator[Document]:
    for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
        key, words = doc_id.as_py(), words_of(text.as_py())
        yield key, prepare(key, words) if prepare else words


def digests(docs: DataFrame, prepare: Prepare | None = None) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every document."""
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    kind = dict(docs.dtypes)["doc_id"]

    def line(words, runs):
        keep = kept(len(words), runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        rest = words if not runs else [w for w, k in zip(words, keep.tolist()) if k]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha256(listed.encode()).hexdigest(),
                sha256(b" ".join(rest)).hexdigest())

    def work(batches):
        for batch in batches:
            columns = list(zip(*(line(w, r) for w, r in judged(_pairs(batch, prepare))))) or [[]] * len(names)
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types))], names=["doc_id", *names])

    schema = f"doc_id {kind}, " + ", ".join(f"{n} long" for n in names[:5]) + ", runs_sha256 string, collapsed_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def collapsed(docs: DataFrame) -> DataFrame:
    """Documents with ``text`` collapsed and their ``runs``: (start, length, period) in words of the input.

    A text without runs stays as it is; of another the words that stay are joined by one space.
    """
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    rest = [f for f in docs.schema.fields if f.name not in ("text", "runs")]
    schema = T.StructType([*rest, T.StructField("text", T.StringType()), T.StructField("runs", T.ArrayType(run))])

    def work(batches):
        for batch in batches:
            texts, found = [], []
            given = batch.column("text").to_pylist()
            for text, (words, runs) in zip(given, judged((None, words_of(t)) for t in given)):
                if runs:
                    keep = kept(len(words), runs).tolist()
                    text = b" ".join(w for w, k in zip(words, keep) if k).decode("utf-8", "surrogatepass")
                texts.append(text)
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in rest), pa.array(texts, pa.string()), pa.array(found, kind)], names=schema.names)

    return docs.select(*(f.name for f in rest), "text").mapInArrow(work, schema)
