"""Removal of repeated byte strings by suffix arrays.

A suffix array of the whole corpus is built in parts. Every 50-byte string belongs to the smallest hash
among its 24-byte substrings (its minimizer), wherever it stands, so strings with equal minimizers can be
judged apart from all others. Spark rounds over the whole corpus (see ``blocks``)

1. find equal texts, of which the smallest id is the first one;
2. find the minimizers that occur in two of the remaining texts or more;
3. send the fragments around these, each the strings in a row that share a minimizer, to the bucket of the
   minimizer, where one suffix array of all its distinct fragments is made by two-stage sorting and its
   common prefixes tell, for each string, the smallest document that it starts in.

A minimizer with ``HOT`` fragments or more, as at the borders of a passage that many documents have, would make
one large suffix array. Its strings are sent one by one instead, each distinct one of a block once, to the bucket of
a hash of the whole string.

Two-stage sorting: suffixes smaller than their successor are sorted directly; the others are induced by
scanning the buckets of first bytes in order, each putting the predecessors of its suffixes at the front
of their own bucket. Then the common prefixes of neighbours are computed.

A byte is removed if a string of 50 bytes that covers it also starts in a document with a smaller id.
Strings never cross documents and are judged on the input.

Defined cases: a NULL text is an empty one; a text shorter than 50 bytes loses nothing; repeated rows and
rows with equal ids do not remove each other's bytes; rows with a NULL id lose nothing and remove nothing;
an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import Blocks, Replies, blocks
from .hashing import ODD, joined, mixed
from .recompression import answer_copies, bits, by_bucket, flags

LENGTH, GRAM = 50, 24
#: Strings in a row that can share a minimizer, and the bytes of the longest fragment.
RUN = LENGTH - GRAM + 1
WIDEST = LENGTH + RUN - 1
#: Suffixes are compared over so many bytes: a fragment's string, its minimizer's room, and some more.
DEPTH = 56
#: Bytes of texts that are hashed together, and of fragments that are sorted together.
PART = 1 << 20
#: Parts of the name space in a bucket; strings with one minimizer are in one of them.
SLICES = 256
#: Fragments of one minimizer, in all blocks, from which its strings are sent one by one.
HOT = 1 << 15


def gram_names(x: np.ndarray) -> np.ndarray:
    """A 64-bit name for each run of GRAM = 16 + 8 bytes, by doubling."""
    h = mixed(x.astype(np.uint64) + ODD)
    widths, parts = 1, {}
    while widths < 16:
        n = len(h) - widths
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = h[:n] * ODD + (h[widths:] ^ (h[widths:] >> np.uint64(29)))
        widths *= 2
        parts[widths] = h
    n = len(x) - GRAM + 1
    return mixed(parts[16][:n] * ODD + parts[8][16:16 + n]) if n > 0 else np.zeros(0, np.uint64)


def string_names(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit name for each string of LENGTH bytes that starts at ``at``, a part at a time."""
    out = np.empty(len(at), dtype=np.uint64)
    strings = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    for a in range(0, len(at), 1 << 16):
        rows = strings[at[a:a + (1 << 16)]]
        name = np.zeros(len(rows), np.uint64)
        for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
            name = joined(name, np.ascontiguousarray(rows[:, k:k + 8]).view("<u8").ravel())
        out[a:a + len(rows)] = name
    return out


def unlike(text: np.ndarray, at: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which strings of LENGTH bytes that start at ``at`` and ``other`` differ, a part at a time."""
    strings = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    return np.concatenate([np.zeros(0, dtype=bool), *(
        (strings[at[a:a + (1 << 16)]] != strings[other[a:a + (1 << 16)]]).any(1) for a in range(0, len(at), 1 << 16))])


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    have, least = 1, h
    while have * 2 <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    rest = width - have
    return np.minimum(least[:len(least) - rest], least[rest:]) if rest else least


def runs(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The rows of :meth:`Bytes._runs` for some texts end to end."""
    n = len(text)
    least = sliding_least(gram_names(text), RUN)  # one per start of a string
    fits = np.ones(len(least), dtype=bool)
    for s, m in zip(starts.tolist(), lengths.tolist()):
        fits[s + m - LENGTH + 1:s + m] = False
    new = np.ones(len(least), dtype=bool)
    new[1:] = least[1:] != least[:-1]
    new[starts] = True
    new &= fits
    at = np.flatnonzero(new)
    doc = np.searchsorted(starts, at, side="right") - 1
    ends = np.minimum(np.append(at[1:], n), (starts + lengths)[doc] - LENGTH + 1)
    # A minimizer that repeats inside a text can make longer rows. They are cut, which only makes more fragments.
    times = -(-(ends - at) // RUN)
    inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    at, ends, doc = np.repeat(at, times) + inside * RUN, np.repeat(ends, times), np.repeat(doc, times)
    return at, np.minimum(ends - at, RUN), least[at], doc


class Bytes:
    """The bytes of a block's first texts, end to end."""

    def __init__(self, docs: pa.Table, replies: Replies, buckets: int):
        self.ids = docs.column("doc_id").to_pylist()
        self.texts = [t.encode("utf-8", "surrogatepass") if t else b"" for t in docs.column("text").to_pylist()]
        digests = [
            blake2b(t, digest_size=16).digest() if len(t) >= LENGTH and i is not None else None
            for t, i in zip(self.texts, self.ids)
        ]
        self.digests = sorted({d for d in digests if d is not None})
        self.least: dict[bytes, int] = {}
        for d, i in zip(digests, self.ids):
            if d is not None and i < self.least.get(d, i + 1):
                self.least[d] = i
        if self.digests and not any(phase == "copies" for phase, _ in replies):
            return
        first = {}
        at = self.digest_borders(buckets)
        for k in range(buckets):
            if at[k] < at[k + 1]:
                first.update(zip(self.digests[at[k]:at[k + 1]], np.frombuffer(replies["copies", k], np.int64).tolist()))
        self.copy = [d is not None and first[d] < i for d, i in zip(digests, self.ids)]
        self.rows = [k for k, d in enumerate(digests) if d is not None and not self.copy[k]]
        lengths = np.array([len(self.texts[k]) for k in self.rows], dtype=np.int64)
        self.starts = np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(self.texts[k] for k in self.rows), np.uint8)
        self.doc_ids = np.array([self.ids[k] for k in self.rows], dtype=np.int64)
        self._runs(lengths)

    def digest_borders(self, buckets: int) -> np.ndarray:
        return by_bucket(np.array([int.from_bytes(d[:8], "big") for d in self.digests], dtype=np.uint64), buckets)

    def _runs(self, lengths: np.ndarray) -> None:
        """Strings in a row with one minimizer: first string, number of strings, minimizer, document.

        Hashes take many times the room of the bytes, so texts are hashed a part at a time.
        """
        found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        part = np.cumsum(lengths) // PART
        for rows in np.split(np.arange(len(lengths)), np.flatnonzero(part[1:] != part[:-1]) + 1) if len(lengths) else []:
            begin = int(self.starts[rows[0]])
            end = int(self.starts[rows[-1]] + lengths[rows[-1]])
            at, count, key, doc = runs(self.bytes[begin:end], self.starts[rows] - begin, lengths[rows])
            found.append((at + begin, count, key, doc + rows[0]))
        self.at, self.count, self.key, self.doc = (np.concatenate(x) for x in zip(*found))

    def keys(self):
        """Places among the distinct minimizers, these, which occur in two texts here, and how many fragments each has."""
        names, place, held = np.unique(self.key >> np.uint64(16), return_inverse=True, return_counts=True)
        low = np.full(len(names), len(self.rows), dtype=np.int64)
        high = np.full(len(names), -1, dtype=np.int64)
        np.minimum.at(low, place, self.doc)
        np.maximum.at(high, place, self.doc)
        return place, names, low != high, held

    def fragments(self, replies: Replies, buckets: int):
        """Fragments with a minimizer of several texts, and the distinct ones by bucket.

        The former are (at, count, doc), first string, number of strings and text of each, and the place of each among
        the latter; strings of hot minimizers are fragments by themselves. Distinct fragments are rows of bytes in the
        order of their keys, filled with 255, which UTF-8 never has; a key is the minimizer, or the name of the string
        if that is hot. ``least`` is the document here with the smallest id that has the fragment.
        """
        place, names, several, _ = self.keys()
        hot = np.zeros(len(names), dtype=bool)
        at = by_bucket(names << np.uint64(16), buckets)
        for k in range(buckets):
            if at[k] < at[k + 1]:
                n = at[k + 1] - at[k]
                reply = replies["minimizers", k]
                several[at[k]:at[k + 1]] |= flags(reply[:-(-n // 8)], n)
                hot[at[k]:at[k + 1]] = flags(reply[-(-n // 8):], n)
        run, cut = np.flatnonzero((several & ~hot)[place]), np.flatnonzero((several & hot)[place])
        whole = self._whole(run)
        if not len(cut):
            return (self.at[run], self.count[run], self.doc[run]), *whole
        pieces, *single = self._strings(cut)
        key = np.concatenate([whole[2], single[2]])
        order = np.argsort(key, kind="stable")
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        place = back[np.concatenate([whole[0], single[0] + len(whole[2])])]
        pieces = tuple(np.concatenate([x[run], y]) for x, y in zip((self.at, self.count, self.doc), pieces))
        return pieces, place, np.concatenate([whole[1], single[1]])[order], key[order], np.concatenate([whole[3], single[3]])[order]

    def _whole(self, run: np.ndarray):
        """Places, distinct rows, keys and least documents of the runs' fragments."""
        if not len(run):
            return run, np.zeros((0, WIDEST), np.uint8), np.zeros(0, np.uint64), run
        room = np.append(self.bytes, np.full(WIDEST, 255, np.uint8))
        rows = room[self.at[run][:, None] + np.arange(WIDEST)]
        rows[np.arange(WIDEST)[None, :] >= (self.count[run] + LENGTH - 1)[:, None]] = 255
        key = self.key[run]
        # One key before the bytes keeps fragments in the order of their minimizers.
        wide = np.concatenate([key.astype(">u8").view(np.uint8).reshape(-1, 8), rows], axis=1)
        order = np.lexsort((self.doc_ids[self.doc[run]], np.ascontiguousarray(wide).view(f"S{WIDEST + 8}").ravel()))
        sorted_ = wide[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (sorted_[1:] != sorted_[:-1]).any(1)
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        first = order[new]
        return place, rows[first], key[first], self.doc[run][first]

    def _strings(self, run: np.ndarray):
        """The runs' strings as (at, count, doc), and what _whole() gives for them."""
        times = self.count[run]
        at = np.repeat(self.at[run], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        doc = np.repeat(self.doc[run], times)
        key = string_names(self.bytes, at)
        order = np.lexsort((self.doc_ids[doc], key))
        new = np.ones(len(order), dtype=bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        # Different strings of one name stay apart.
        same = np.flatnonzero(~new)
        new[same] = unlike(self.bytes, at[order[same]], at[order[same - 1]])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        first = order[new]
        rows = np.full((len(first), WIDEST), 255, np.uint8)
        rows[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(self.bytes, LENGTH)[at[first]]
        return (at, np.ones(len(at), np.int64), doc), place, rows, key[first], doc[first]


def ask_copies(docs: pa.Table, replies: Replies, buckets: int) -> list[bytes | None]:
    block = Bytes(docs, replies, buckets)
    at = block.digest_borders(buckets)
    out: list[bytes | None] = []
    for k in range(buckets):
        names = block.digests[at[k]:at[k + 1]]
        out.append(b"".join(names) + np.array([block.least[d] for d in names], np.int64).tobytes() if names else None)
    return out


def ask_minimizers(docs: pa.Table, replies: Replies, buckets: int) -> list[bytes | None]:
    """Minimizers as six bytes, which occur in two texts, which have several fragments, and how many."""
    _, names, several, held = Bytes(docs, replies, buckets).keys()
    at = by_bucket(names << np.uint64(16), buckets)
    short = names.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    more = held > 1
    return [
        np.int64(b - a).tobytes() + short[a:b].tobytes() + bits(several[a:b]) + bits(more[a:b]) + held[a:b][more[a:b]].astype(np.uint32).tobytes()
        if a < b else None for a, b in zip(at, at[1:])
    ]


def answer_minimizers(messages: list[bytes], hot: int = HOT) -> list[bytes]:
    """Per minimizer whether two texts have it, and then whether it has ``hot`` fragments or more."""
    names, several, held, sizes = [], [], [], []
    for m in messages:
        n = int(np.frombuffer(m, np.int64, 1)[0])
        wide = np.zeros((n, 8), dtype=np.uint8)
        wide[:, :6] = np.frombuffer(m, np.uint8, 6 * n, 8).reshape(n, 6)
        names.append(wide.view("<u8").ravel())
        at = 8 + 6 * n
        several.append(flags(m[at:at + -(-n // 8)], n))
        at += -(-n // 8)
        more = flags(m[at:at + -(-n // 8)], n)
        count = np.ones(n, np.uint32)
        count[more] = np.frombuffer(m, np.uint32, int(more.sum()), at + -(-n // 8))
        held.append(count)
        sizes.append(n)
    names, several, held = np.concatenate(names), np.concatenate(several), np.concatenate(held)
    order = np.argsort(names)
    x = names[order]
    new = np.append(True, x[1:] != x[:-1])
    found = several[order]
    found[1:] |= ~new[1:]
    found[:-1] |= ~new[1:]
    starts = np.flatnonzero(new)
    large = np.add.reduceat(held[order], starts, dtype=np.int64) >= hot
    out, heavy = np.empty(len(names), dtype=bool), np.empty(len(names), dtype=bool)
    out[order] = found
    heavy[order] = np.repeat(large, np.diff(np.append(starts, len(x))))
    ends = np.cumsum(sizes)
    return [bits(out[e - n:e]) + bits(heavy[e - n:e]) for e, n in zip(ends, sizes)]


def ask_fragments(docs: pa.Table, replies: Replies, buckets: int) -> list[bytes | None]:
    import zstandard

    block = Bytes(docs, replies, buckets)
    _, _, rows, key, least = block.fragments(replies, buckets)
    at = by_bucket(key, buckets)
    slices = ((key >> np.uint64(32)) * np.uint64(buckets * SLICES) >> np.uint64(32)).astype(np.uint8)
    squeeze = zstandard.ZstdCompressor(level=3).compress
    out: list[bytes | None] = []
    for a, b in zip(at, at[1:]):
        if a == b:
            out.append(None)
            continue
        part = rows[a:b]
        sizes = (part != 255).sum(1).astype(np.uint8)
        known, place = np.unique(block.doc_ids[least[a:b]], return_inverse=True)
        head = np.array([b - a, len(known)], np.int64).tobytes()
        body = sizes.tobytes() + slices[a:b].tobytes() + place.astype(np.uint32).tobytes() + part[part != 255].tobytes()
        out.append(head + known.tobytes() + squeeze(body))
    return out


def answer_fragments(messages: list[bytes]) -> list[bytes]:
    """Per fragment a mask: bit j says that its j-th string starts in a document with a smaller id."""
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    sizes, ids, slices, text, counts = [], [], [], [], []
    for m in messages:
        n, k = np.frombuffer(m, np.int64, 2).tolist()
        known = np.frombuffer(m, np.int64, k, 16)
        body = expand(m[16 + 8 * k:])
        sizes.append(np.frombuffer(body, np.uint8, n))
        slices.append(np.frombuffer(body, np.uint8, n, n))
        ids.append(known[np.frombuffer(body, np.uint32, n, 2 * n)])
        text.append(np.frombuffer(body, np.uint8, len(body) - 6 * n, 6 * n))
        counts.append(n)
    size, doc, slice_, text = (np.concatenate(x) for x in (sizes, ids, slices, text))
    size = size.astype(np.int64)
    start = np.cumsum(size) - size
    text = np.append(text, np.full(WIDEST, 255, np.uint8))
    masks = np.zeros(len(size), dtype=np.uint32)
    # Slices are sorted one after another, small ones together, so that a large bucket takes no more room.
    held = np.bincount(slice_, weights=size, minlength=SLICES)
    group = np.concatenate([[0.0], np.cumsum(held)[:-1]]) // (4 * PART)
    for g in np.unique(group[slice_]):
        at = np.flatnonzero(group[slice_] == g)
        rows = text[start[at][:, None] + np.arange(WIDEST)]
        rows[np.arange(WIDEST)[None, :] >= size[at][:, None]] = 255
        masks[at] = judged(rows, size[at], doc[at])
    ends = np.cumsum(counts)
    return [masks[e - n:e].tobytes() for e, n in zip(ends, counts)]


def judged(rows: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """The masks of fragments that have whole minimizers among them."""
    # Equal fragments are one, of the smallest document.
    order = np.lexsort((doc, rows.view(f"S{WIDEST}").ravel()))
    sorted_ = rows[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (sorted_[1:] != sorted_[:-1]).any(1)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    first = order[new]
    least = least_documents(sorted_[new], size[first], doc[first])
    masks = np.zeros(len(doc), dtype=np.uint32)
    for j in range(RUN):
        masks |= (least[place, j] < doc).astype(np.uint32) << np.uint32(j)
    return masks


def least_documents(rows: np.ndarray, size: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each fragment and string in it, the smallest document in which the string starts."""
    none = np.iinfo(np.int64).max
    out = np.full((len(rows), RUN), none, dtype=np.int64)
    if not len(rows):
        return out
    text, origin = laid_out(rows, size)
    order = suffix_array(text, wanted(text, origin, size))
    fragment = np.searchsorted(origin, order, side="right") - 1
    inside = order - origin[fragment]
    starts = inside <= size[fragment] - LENGTH
    order, fragment, inside = order[starts], fragment[starts], inside[starts]
    new = np.ones(len(order), dtype=bool)
    new[1:] = common_prefixes(text, order) < LENGTH
    group = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[fragment], np.flatnonzero(new))
    out[fragment, inside] = least[group]
    return out


def laid_out(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fragments end to end, bytes raised by one, a zero after each; and where they begin."""
    raised = (rows + np.uint8(1)).astype(np.uint8)  # 255 becomes the zero
    wide = np.concatenate([raised, np.zeros((len(rows), 1), np.uint8)], axis=1)
    text = wide[np.arange(WIDEST + 1)[None, :] <= size[:, None]]
    return np.append(text, np.zeros(DEPTH + 8, np.uint8)), np.cumsum(size + 1) - size - 1


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successor (the last one counts as smaller)."""
    out = np.append(text[:-1] < text[1:], True)
    equal = np.flatnonzero(text[:-1] == text[1:])
    if len(equal):
        # In a run of one byte all are like its last, whose next byte is another one.
        last = np.append(equal[1:] != equal[:-1] + 1, True)
        ends = np.flatnonzero(last)
        out[equal] = np.repeat(out[equal[ends] + 1], np.diff(ends, prepend=-1))
    return out


def wanted(text: np.ndarray, origin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places to sort: the starts of strings, and on to the next suffix that is sorted directly."""
    direct = np.flatnonzero(smaller_than_next(text))
    last = direct[np.searchsorted(direct, origin + size - LENGTH)]
    change = np.zeros(len(text) + 1, dtype=np.int8)
    np.add.at(change, origin, 1)
    np.add.at(change, last + 1, -1)
    return np.cumsum(change, dtype=np.int8)[:-1] > 0


def suffix_array(text: np.ndarray, want: np.ndarray) -> np.ndarray:
    """The wanted suffixes in order (over their first DEPTH bytes), by two-stage sorting.

    With a suffix that is not smaller than its successor, the successor is wanted too.
    """
    direct = smaller_than_next(text)
    at = np.flatnonzero(want & direct)
    keys = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, DEPTH)[at]).view(f"S{DEPTH}").ravel()
    at = at[np.argsort(keys, kind="stable")]
    induced = want & ~direct
    borders = np.searchsorted(text[at], np.arange(257))
    fronts: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(suffixes: np.ndarray, byte: int) -> np.ndarray:
        """Puts the predecessors of ``suffixes`` into their buckets; those in this bucket are returned."""
        before = suffixes[suffixes > 0] - 1
        before = before[induced[before]]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cut = np.flatnonzero(first[1:] != first[:-1]) + 1
        same = before[:0]
        for part in np.split(before, cut) if len(before) else []:
            c = int(text[part[0]])
            if c == byte:
                same = part
            else:
                fronts[c].append(part)
        return same

    for byte in range(256):
        front = np.concatenate(fronts[byte]) if fronts[byte] else at[:0]
        while len(front):  # a run of one byte fills its own bucket step by step
            out.append(front)
            front = induce(front, byte)
        back = at[borders[byte]:borders[byte + 1]]
        if len(back):
            out.append(back)
            induce(back, byte)
    return np.concatenate(out) if out else at


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes, up to LENGTH, that each suffix in ``order`` but the first shares with the one before."""
    out = np.empty(max(0, len(order) - 1), dtype=np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    for a in range(0, len(out), 1 << 16):
        part = rows[order[a:a + (1 << 16) + 1]]
        same = part[1:] == part[:-1]
        out[a:a + len(same)] = np.where(same.all(1), LENGTH, same.argmin(1))
    return out


def removed_bytes(block: Bytes, replies: Replies, buckets: int) -> list[np.ndarray | None]:
    """Per row of the block which bytes go; None where all stay."""
    out: list[np.ndarray | None] = [None] * len(block.ids)
    for k, copy in enumerate(block.copy):
        if copy:
            out[k] = np.ones(len(block.texts[k]), dtype=bool)
    (begin, count, doc), place, rows, key, least = block.fragments(replies, buckets)
    masks = np.zeros(len(rows), dtype=np.uint32)
    at = by_bucket(key, buckets)
    for k in range(buckets):
        if at[k] < at[k + 1]:
            masks[at[k]:at[k + 1]] = np.frombuffer(replies["fragments", k], np.uint32)
    change = np.zeros(len(block.bytes) + 1, dtype=np.int32)
    if len(begin):
        # A document that shares a fragment with a smaller one of this block loses all its strings.
        here = block.doc_ids[doc] > block.doc_ids[least][place]
        every = (np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)
        mask = np.where(here, every, masks[place].astype(np.uint64))
        for j in range(RUN):
            start = begin[(mask >> np.uint64(j) & np.uint64(1)) == 1] + j
            np.add.at(change, start, 1)
            np.add.at(change, start + LENGTH, -1)
    covered = np.cumsum(change)[:-1] > 0
    for row, start in zip(block.rows, block.starts.tolist()):
        mask = covered[start:start + len(block.texts[row])]
        if mask.any():
            out[row] = mask
    return out


def answered(docs: DataFrame, hot: int = HOT) -> Blocks:
    found = blocks(docs.select("doc_id", "text")).exchange("copies", ask_copies, answer_copies)
    found = found.exchange("minimizers", ask_minimizers, partial(answer_minimizers, hot=hot))
    return found.exchange("fragments", ask_fragments, answer_fragments)


def spans(docs: DataFrame, keep: bool = False, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, spans, kept]) for every row of ``docs``.

    With ``keep``, also the removed spans (start, end) and the bytes that are left. ``hot`` is as in HOT.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def rows(table: pa.Table, replies: Replies, buckets: int) -> pa.Table:
        block = Bytes(table, replies, buckets)
        out = []
        for text, gone in zip(block.texts, removed_bytes(block, replies, buckets)):
            if gone is None:
                out.append((len(text), 0, 0, text, []))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            out.append((len(text), int(gone.sum()), len(edges) // 2, kept, edges))
        columns = {
            "doc_id": table.column("doc_id"), "n_bytes": pa.array([x[0] for x in out], pa.int64()),
            "n_removed": pa.array([x[1] for x in out], pa.int64()), "n_spans": pa.array([x[2] for x in out], pa.int64()),
            "kept_sha256": pa.array([sha256(x[3]).hexdigest() for x in out], pa.string()),
        }
        if keep:
            columns["spans"] = pa.array([[[int(a), int(b)] for a, b in zip(x[4][::2], x[4][1::2])] for x in out], pa.list_(pa.list_(pa.int64())))
            columns["kept"] = pa.array([x[3] for x in out], pa.binary())
        return pa.table(columns)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return answered(docs, hot).finish(rows, schema + (", spans array<array<long>>, kept binary" if keep else ""))
