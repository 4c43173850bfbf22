"""Removal of repeated word windows by recompression.

Two rounds of recompression parse every text: runs of one token are borders, and in each round every
symbol is a left or a right one by a bit of its name, and each left symbol followed by a right one becomes
one symbol, named after the pair. Names are 64-bit hashes of what they stand for, so they are global
without a table of names, and whether two symbols pair only depends on the two: equal passages get equal
symbols but for their edges. A passage of 13 words without a run keeps at least 7 words in whole symbols of
the second round, and so shares a chain of symbols of 4 to 7 words (``chains``). Spark rounds over the whole
corpus (see ``blocks``) then

1. find texts with equal words, of which the smallest id is the first one;
2. find the chains that occur in two of the remaining texts or more; they reveal where repeats can be;
3. verify: windows that hold such a chain, or a run, are compared by 160-bit names, and every block learns
   which of them start in a document with a smaller id.

A word is removed if a window that covers it also starts in a document with a smaller id. Windows never
cross documents and are judged on the input.

Defined cases: a NULL or blank text has no words; a text shorter than the window loses nothing; repeated
rows and rows with equal ids do not remove each other's words; rows with a NULL id lose nothing and remove
nothing; an empty table gives an empty result. Extra columns are kept with ``keep``.
"""

from __future__ import annotations

from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import Blocks, Replies, blocks
from .hashing import Names, joined, mixed, words_of

WINDOW = 13
#: A chain spans so many words at least; with the parse of two rounds it fits into every window.
CHAIN = 4
RIGHT = np.uint64(1 << 63)


def by_bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    """Borders of the buckets in sorted names; bucket k holds the k-th part of the name space."""
    place = (names >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(place, np.arange(buckets + 1, dtype=np.uint64))


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


class Parsed:
    """The words of a block's first texts, end to end."""

    def __init__(self, docs: pa.Table, replies: Replies, buckets: int, window: int = WINDOW):
        self.window = window
        self.ids = docs.column("doc_id").to_pylist()
        self.words = [words_of(t) for t in docs.column("text").to_pylist()]
        digests = [
            blake2b(b" ".join(w), digest_size=16).digest() if len(w) >= window and i is not None else None
            for w, i in zip(self.words, self.ids)
        ]
        known = sorted({d for d in digests if d is not None})
        self.digests = known
        least = dict.fromkeys(known)
        for d, i in zip(digests, self.ids):
            if d is not None and (least[d] is None or i < least[d]):
                least[d] = i
        self.least = least
        if self.digests and not any(phase == "copies" for phase, _ in replies):
            return
        first = {}
        at = self.digest_borders(buckets)
        for k in range(buckets):
            if at[k] < at[k + 1]:
                first.update(zip(known[at[k]:at[k + 1]], np.frombuffer(replies["copies", k], np.int64).tolist()))
        #: Texts that are equal to one with a smaller id.
        self.copy = [d is not None and first[d] < i for d, i in zip(digests, self.ids)]
        # Of the rest, rows that repeat in the block are parsed once; only texts with a window count.
        self.rows = [k for k, d in enumerate(digests) if d is not None and not self.copy[k]]
        lengths = np.array([len(self.words[k]) for k in self.rows], dtype=np.int64)
        self.starts = np.cumsum(lengths) - lengths
        names = Names()
        self.names = mixed(np.concatenate([names.of(self.words[k]) for k in self.rows])) if self.rows else np.zeros(0, np.uint64)
        del names
        self.doc = np.repeat(np.arange(len(self.rows)), lengths)
        self.doc_ids = np.array([self.ids[k] for k in self.rows], dtype=np.int64)

    def digest_borders(self, buckets: int) -> np.ndarray:
        heads = np.array([int.from_bytes(d[:8], "big") for d in self.digests], dtype=np.uint64)
        return by_bucket(heads, buckets)

    def chains(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Names, first words and ends of the chains of second-round symbols."""
        n = len(self.names)
        border = np.ones(n, dtype=bool)  # before this word no symbol goes on
        border[1:] = (self.doc[1:] != self.doc[:-1]) | (self.names[1:] == self.names[:-1])
        starts, names = np.arange(n), self.names
        for _ in range(2):
            left = (names & RIGHT) == 0
            pair = np.zeros(len(names), dtype=bool)
            pair[:-1] = left[:-1] & ~left[1:] & ~border[starts[1:]]
            after = np.zeros(len(names), dtype=bool)
            after[1:] = pair[:-1]
            new = names.copy()
            at = np.flatnonzero(pair)
            new[at] = joined(names[at], names[at + 1])
            starts, names = starts[~after], new[~after]
        ends = np.append(starts[1:], n)
        # The run of symbols from each one on until it spans CHAIN words, without a border inside.
        chain, end = names.copy(), ends.copy()
        open_ = np.ones(len(names), dtype=bool)
        stops = np.append(border[starts], True)
        for k in range(1, CHAIN):
            short = np.flatnonzero(open_ & (end - starts < CHAIN))
            on = short[np.where(short + k < len(names), ~stops[np.minimum(short + k, len(names))], False)]
            open_[np.setdiff1d(short, on, assume_unique=True)] = False
            chain[on] = joined(chain[on], names[on + k])
            end[on] = ends[on + k]
        good = open_ & (end - starts >= CHAIN)
        return mixed(chain[good]), starts[good], end[good]

    def chain_names(self):
        """Chains, their places among the distinct names, the names, and which occur in two texts here."""
        chain, start, end = self.chains()
        # Names are short: they only have to reveal candidates.
        chain = chain >> np.uint64(16)
        names, place = np.unique(chain, return_inverse=True)
        low = np.full(len(names), len(self.rows), dtype=np.int64)
        high = np.full(len(names), -1, dtype=np.int64)
        np.minimum.at(low, place, self.doc[start])
        np.maximum.at(high, place, self.doc[start])
        return start, end, place, names, low != high

    def candidates(self, replies: Replies, buckets: int) -> np.ndarray:
        """First words of windows that hold a chain found in several texts, or a run."""
        n, w = len(self.names), self.window
        start, end, place, names, several = self.chain_names()
        at = by_bucket(names << np.uint64(16), buckets)
        for k in range(buckets):
            if at[k] < at[k + 1]:
                several[at[k]:at[k + 1]] |= flags(replies["chains", k], at[k + 1] - at[k])
        hit = several[place]
        change = np.zeros(n + 1, dtype=np.int64)
        np.add.at(change, np.maximum(end[hit] - w, self.starts[self.doc[start[hit]]]), 1)
        np.add.at(change, start[hit] + 1, -1)
        inside = np.cumsum(change)[:n] > 0
        runs = np.zeros(n + 1, dtype=np.int64)
        runs[1:n] = np.cumsum((self.names[1:] == self.names[:-1]) & (self.doc[1:] == self.doc[:-1])) if n else 0
        runs[n:] = runs[n - 1] if n else 0
        fits = np.zeros(n, dtype=bool)
        if n >= w:
            fits[: n - w + 1] = self.doc[: n - w + 1] == self.doc[w - 1:]
        last = np.minimum(np.arange(n) + w - 1, n)
        return np.flatnonzero(fits & (inside | (runs[last] > runs[:n])))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two names per window (64 and 96 bits of it in all travel)."""
        one = np.zeros(len(at), dtype=np.uint64)
        two = np.zeros(len(at), dtype=np.uint64)
        for k in range(self.window):
            x = self.names[at + k]
            one = one * np.uint64(0xD6E8FEB86659FD93) + x
            two = (two ^ x) * np.uint64(0xA0761D6478BD642F) + (two >> np.uint64(29))
        return mixed(one), mixed(two) >> np.uint64(32)

    def distinct_windows(self, replies: Replies, buckets: int):
        """Candidates, their places among the distinct windows, these, and their smallest document here."""
        at = self.candidates(replies, buckets)
        one, two = self.windows(at)
        order = np.lexsort((self.doc_ids[self.doc[at]], two, one))
        a, b = one[order], two[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        place = np.empty(len(a), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        least = self.doc[at][order][new]
        return at, place, a[new], b[new], least


def ask_copies(docs: pa.Table, replies: Replies, buckets: int) -> list[bytes | None]:
    block = Parsed(docs, replies, buckets)
    at = block.digest_borders(buckets)
    out: list[bytes | None] = []
    for k in range(buckets):
        names = block.digests[at[k]:at[k + 1]]
        out.append(b"".join(names) + np.array([block.least[d] for d in names], np.int64).tobytes() if names else None)
    return out


def answer_copies(messages: list[bytes]) -> list[bytes]:
    """Per digest the smallest id of all blocks."""
    least: dict[bytes, int] = {}
    opened = []
    for m in messages:
        n = len(m) // 24
        names, ids = [m[16 * i: 16 * i + 16] for i in range(n)], np.frombuffer(m, np.int64, n, 16 * n).tolist()
        opened.append(names)
        for d, i in zip(names, ids):
            if i < least.get(d, i + 1):
                least[d] = i
    return [np.array([least[d] for d in names], np.int64).tobytes() for names in opened]


def ask_chains(docs: pa.Table, replies: Replies, buckets: int) -> list[bytes | None]:
    _, _, _, names, several = Parsed(docs, replies, buckets).chain_names()
    at = by_bucket(names << np.uint64(16), buckets)
    short = names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return [
        short[a:b].tobytes() + bits(several[a:b]) if a < b else None for a, b in zip(at, at[1:])
    ]


def answer_chains(messages: list[bytes]) -> list[bytes]:
    """Per chain whether two texts have it: two blocks, or two texts of one block."""
    names, several, sizes = [], [], []
    for m in messages:
        n = len(m) * 8 // 49  # six bytes and a bit each
        while 6 * n + -(-n // 8) < len(m):
            n += 1
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :6] = np.frombuffer(m, np.uint8, 6 * n).reshape(n, 6)
        names.append(wide.view("<u8").ravel())
        several.append(flags(m[6 * n:], n))
        sizes.append(n)
    names, several = np.concatenate(names), np.concatenate(several)
    order = np.argsort(names)
    x = names[order]
    same = x[1:] == x[:-1]
    found = several[order]
    found[1:] |= same
    found[:-1] |= same
    # A name that several texts of one block share is told to all blocks that have it: they are `same`.
    out = np.empty(len(names), dtype=bool)
    out[order] = found
    ends = np.cumsum(sizes)
    return [bits(out[e - n:e]) for e, n in zip(ends, sizes)]


def ask_windows(docs: pa.Table, replies: Replies, buckets: int) -> list[bytes | None]:
    block = Parsed(docs, replies, buckets)
    _, _, one, two, least = block.distinct_windows(replies, buckets)
    ids = block.doc_ids[least] if len(least) else np.zeros(0, np.int64)
    at = by_bucket(one, buckets)
    out: list[bytes | None] = []
    for a, b in zip(at, at[1:]):
        if a == b:
            out.append(None)
            continue
        # Ids as places in a list of them, which takes fewer bytes.
        known, place = np.unique(ids[a:b], return_inverse=True)
        width = np.uint16 if len(known) <= 1 << 16 else np.uint32
        head = np.array([b - a, len(known)], np.int64).tobytes()
        out.append(head + known.tobytes() + one[a:b].tobytes() + two[a:b].astype(np.uint32).tobytes() + place.astype(width).tobytes())
    return out


def answer_windows(messages: list[bytes]) -> list[bytes]:
    """Per window whether it starts in a document with a smaller id."""
    ones, twos, ids, sizes = [], [], [], []
    for m in messages:
        n, k = np.frombuffer(m, np.int64, 2).tolist()
        known = np.frombuffer(m, np.int64, k, 16)
        at = 16 + 8 * k
        ones.append(np.frombuffer(m, np.uint64, n, at))
        twos.append(np.frombuffer(m, np.uint32, n, at + 8 * n))
        ids.append(known[np.frombuffer(m, np.uint16 if k <= 1 << 16 else np.uint32, n, at + 12 * n)])
        sizes.append(n)
    one, two, doc = np.concatenate(ones), np.concatenate(twos), np.concatenate(ids)
    order = np.lexsort((doc, two, one))
    a, b, d = one[order], two[order], doc[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    least = d[new][np.cumsum(new) - 1]
    out = np.empty(len(a), dtype=bool)
    out[order] = d > least
    ends = np.cumsum(sizes)
    return [bits(out[e - n:e]) for e, n in zip(ends, sizes)]


def removed_words(block: Parsed, replies: Replies, buckets: int) -> list[np.ndarray | None]:
    """Per row of the block which words go; None where all of them stay."""
    out: list[np.ndarray | None] = [None] * len(block.ids)
    for k, copy in enumerate(block.copy):
        if copy:
            out[k] = np.ones(len(block.words[k]), dtype=bool)
    at, place, one, _, least = block.distinct_windows(replies, buckets)
    smaller = np.zeros(len(one), dtype=bool)
    borders = by_bucket(one, buckets)
    for k in range(buckets):
        a, b = borders[k], borders[k + 1]
        if a < b:
            smaller[a:b] = flags(replies["windows", k], b - a)
    doc = block.doc[at]
    here = block.doc_ids[doc] > block.doc_ids[least][place] if len(at) else np.zeros(0, bool)
    gone = at[here | smaller[place]]
    change = np.zeros(len(block.names) + 1, dtype=np.int64)
    np.add.at(change, gone, 1)
    np.add.at(change, gone + block.window, -1)
    covered = np.cumsum(change)[:-1] > 0
    for row, start in zip(block.rows, block.starts):
        mask = covered[start:start + len(block.words[row])]
        if mask.any():
            out[row] = mask
    return out


def kept_words(docs: pa.Table, replies: Replies, buckets: int):
    block = Parsed(docs, replies, buckets)
    for words, gone in zip(block.words, removed_words(block, replies, buckets)):
        yield len(words), int(gone.sum()) if gone is not None else 0, (
            words if gone is None else [w for w, g in zip(words, gone.tolist()) if not g])


def answered(docs: DataFrame) -> Blocks:
    """The blocks of ``docs`` with the replies of all three rounds."""
    found = blocks(docs).exchange("copies", ask_copies, answer_copies)
    found = found.exchange("chains", ask_chains, answer_chains)
    return found.exchange("windows", ask_windows, answer_windows)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs`` (doc_id, text)."""
    kind = dict(docs.dtypes)["doc_id"]

    def rows(table: pa.Table, replies: Replies, buckets: int) -> pa.Table:
        kept = list(kept_words(table, replies, buckets))
        return pa.table({
            "doc_id": table.column("doc_id"), "n_words": pa.array([n for n, _, _ in kept], pa.int64()),
            "n_removed": pa.array([r for _, r, _ in kept], pa.int64()),
            "kept_sha256": pa.array([sha256(b" ".join(w)).hexdigest() for _, _, w in kept], pa.string()),
        })

    return answered(docs.select("doc_id", "text")).finish(rows, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the words kept, joined by one space where some went; texts that lose all are left out.

    Other columns stay as they are. Texts that lose nothing keep their blanks.
    """
    def rows(table: pa.Table, replies: Replies, buckets: int) -> pa.Table:
        texts = table.column("text").to_pylist()
        kept = list(kept_words(table, replies, buckets))
        new = [t if not gone else b" ".join(w).decode("utf-8", "surrogatepass") for t, (_, gone, w) in zip(texts, kept)]
        stay = [not (gone and gone == n) for n, gone, _ in kept]
        at = table.schema.get_field_index("text")
        return table.set_column(at, "text", pa.array(new, table.schema.field(at).type)).filter(pa.array(stay, pa.bool_()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return answered(docs).finish(rows, schema)
