"""Near-duplicates by MinHash: one permutation, optimal densification, bands and stars.

A text is the set of its shingles (``SHINGLE`` words in a row, ASCII letters in lower case). One hash
per shingle fills ``BANDS * ROWS`` bins with their minimum; an empty bin takes the value of another one
that a fixed random sequence of its own finds first. Texts that agree in a whole band share a bucket.
With 48 bands of 6 rows a pair of similarity 0.8 shares none with probability (1 - 0.8^6)^48 = 4.6e-7.

Texts with equal sets are one node from the start. In a bucket, every node is only paired with one, its
hub, so candidates grow with the members of buckets, not with their pairs. Pairs are confirmed on whole
sets: first one per node, then those between different components. Buckets that still hold several
components get new hubs, about ``HUBS`` a round, drawn by a hash of bucket and node; who was hub has met
all others and leaves the bucket. A round with fewer than one link among ``YIELD`` pairs is the last one.
So every pair of a bucket of up to ``HUBS`` members is met in the first round, and in a bucket of many a pair
of similarity 0.8, which shares 12 buckets on average, is missed only if neither of the two, nor a text that
links them, is a hub of any. This is a recall, not a proof; a test measures it on a cloud of near copies.

``exact=True`` goes by prefixes of rare shingles instead of new hubs. No pair that shares a bucket can join
two components after that. Where many near copies share changed words, those that meet grow with the square
of their number; a bound on how far they are apart leaves about the links in the join's rows.

Defined cases: a NULL or blank text has no shingles, is linked with nothing and stays; one with fewer
words than a shingle has one shingle, all its words. Repeated rows share their fate. A row with a NULL
id takes part, but never names a component unless all its members have none; such rows all stay. Equal
ids with different texts are different nodes. An empty table gives an empty result. Columns of the
result: ``doc_id, n_shingles, component_id, kept``.
"""

from __future__ import annotations

from functools import reduce
from hashlib import blake2b
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .components import components
from .hashing import Names, joined, mixed, words_of

SHINGLE = 5
BANDS, ROWS = 48, 6
#: Linked from this share in percent: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: New hubs that a bucket gets in a round, on average; rounds end with one of fewer than one link among YIELD pairs.
HUBS, YIELD = 3, 10_000
#: Bits of the parities that bound how far two sets are apart; a power of two, a multiple of 64.
PARITIES = 1_024


def shingles(text: str | None, names: Names, k: int) -> np.ndarray:
    """The sorted set of 64-bit shingle names of a whole text."""
    words = words_of(text.lower() if text and text.isascii() else text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if text and not text.isascii():
        words = b"\n".join(words).lower().split(b"\n")  # bytes.lower() only changes ASCII
    h = names.of(words)
    n = min(k, len(words))
    out = mixed(h[: len(h) - n + 1] + np.uint64(n))
    for i in range(1, n):
        out = joined(out, h[i: len(h) - n + 1 + i])
    return np.unique(out)


def donors(attempts: int, bins: int) -> np.ndarray:
    """The bins that each empty bin asks, in its order."""
    return np.random.default_rng(20_240_501).integers(0, bins, (attempts, bins), dtype=np.int64)


def signature(items: np.ndarray, bins: int, table: np.ndarray) -> np.ndarray:
    """Minimum per bin of a sorted set, empty bins densified by the order in ``table``."""
    place = ((items >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))  # sorted: the first is the least
    out = np.zeros(bins, dtype=np.uint64)
    full = np.zeros(bins, dtype=bool)
    out[place[first]] = items[first]
    full[place[first]] = True
    empty = np.flatnonzero(~full)
    at = 0
    while len(empty):
        asked = table[at: at + 32][:, empty]
        yes = full[asked]
        found = yes.any(0)
        out[empty[found]] = out[asked[yes.argmax(0), np.arange(len(empty))][found]]
        empty, at = empty[~found], at + 32
        if at >= len(table):  # one full bin among 288 is missed 4,096 times with probability 7e-7
            out[empty] = out[place[first[0]]]
            break
    return out


def band_keys(items: np.ndarray, bands: int, rows: int, table: np.ndarray) -> np.ndarray:
    parts = signature(items, bands * rows, table).reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        key = joined(key, parts[:, r])
    return key.view(np.int64)


def digest(items: np.ndarray) -> bytes:
    return blake2b(items.tobytes(), digest_size=16).digest()


def parities(items: np.ndarray) -> np.ndarray:
    """For every value of the low bits, whether a set holds an odd number of items with it; 64 to a number."""
    odd = np.bincount((items & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sketches(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, node, keys): the node is the digest of the set, NULL for an empty one."""
    kind = dict(docs.dtypes)["doc_id"]

    def sketch(batches):
        names, table = Names(), donors(4_096, bands * rows)
        for batch in batches:
            n, nodes, keys = [], [], []
            for text in batch.column("text"):
                items = shingles(text.as_py(), names, k)
                n.append(len(items))
                nodes.append(digest(items) if len(items) else None)
                keys.append(band_keys(items, bands, rows, table) if len(items) else np.zeros(0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(nodes, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ], names=["doc_id", "n_shingles", "node", "keys"])

    return docs.select("doc_id", "text").mapInArrow(sketch, f"doc_id {kind}, n_shingles long, node binary, keys array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, items, odd) for the documents in ``wanted`` (doc_id)."""
    def items_of(batches):
        names = Names()
        for batch in batches:
            sets = [shingles(t.as_py(), names, k) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                pa.array([parities(s) for s in sets], pa.list_(pa.int64())),
            ], names=["node", "items", "odd"])

    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("text")
    return rows.mapInArrow(items_of, "node binary, items array<long>, odd array<long>").where("node IS NOT NULL").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("items").alias(f"{c}_items"))
    both = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - both
    found = pairs.join(side("a"), "a").join(side("b"), "b").where(100 * both >= percent * union)
    return stage(found.select("a", "b"), "near-links")


def closing_pairs(members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that can still be similar enough, by prefixes of rare shingles.

    Only nodes of buckets that hold several components take part, and of two nodes one lies outside the
    largest component of such a bucket. Two sets of n and m items that share enough agree in an item
    that is early in both when items are put from rare to frequent: behind its places i and j there
    must be enough left to share. Copies that differ from a common text each in its own way have their
    own items first, so a large group of them makes no pairs.

    Where many copies share changed words they meet in those, most of them too far apart to be linked. Every parity in
    which two sets differ is an item that one of them lacks, so the join itself leaves out pairs with too many; this
    loses no link, and what it gives out is about the links between components.
    """
    at = members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    at = stage(at, "near-members")
    split = at.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(
        F.max(F.struct("c", "root"))["root"].alias("most"), F.count("*").alias("roots")
    ).where("roots > 1").select("key", "most")
    open_ = at.join(split, "key").groupBy("node").agg(
        F.first("n").alias("n"), F.first("root").alias("root"), F.max(F.col("root") != F.col("most")).alias("outside"))
    items = stage(open_.join(sets, "node").select("node", "n", "root", "outside", F.explode("items").alias("item")), "near-items")
    # Items of one node only are counted, not compared.
    shared = items.groupBy("item").agg(F.count("*").alias("c")).where("c > 1")
    by_node = Window.partitionBy("node")
    placed = items.join(shared, "item").withColumn(
        "i", F.col("n") - F.count("*").over(by_node) + F.row_number().over(by_node.orderBy("c", "item")) - 1)
    placed = placed.where(f"100 * (n - i) >= {percent} * n").drop("c")
    placed = stage(placed.join(sets.select("node", "odd"), "node"), "near-prefixes")
    x = placed.where("outside").select("item", F.col("node").alias("x"), F.col("root").alias("x_root"), F.col("n").alias("m"),
                                       F.col("i").alias("j"), F.col("odd").alias("x_odd"))
    enough = f"{100 + percent} * (n - i) >= {percent} * (n + m) AND {100 + percent} * (m - j) >= {percent} * (n + m)"
    apart = reduce(add, (F.bit_count(F.get("odd", F.lit(k)).bitwiseXOR(F.get("x_odd", F.lit(k)))) for k in range(PARITIES // 64)))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("m"))
    pairs = placed.join(x, "item").where((F.col("root") != F.col("x_root")) & F.expr(enough) & near)
    return pairs.select(F.greatest("node", "x").alias("a"), F.least("node", "x").alias("b")).distinct()


def new_stars(members: DataFrame, labels: DataFrame, nth: int) -> DataFrame:
    """Pairs (a, b) of different components: the new hubs of round ``nth`` with all that were no hub before.

    A member's place in its bucket is a hash in [0, 1); times the members over ``HUBS`` it gives the round in which
    the member is hub. So hubs need no order within a bucket, and those of two rounds are never the same.
    """
    place = F.expr("shiftrightunsigned(xxhash64(key, node), 11) / 9007199254740992D")
    left = members.where("node <> hub").withColumn("turn", F.floor(place * F.col("c") / HUBS)).where(F.col("turn") >= nth)
    at = left.join(labels, "node", "left").select("key", "node", "turn", F.coalesce("root", "node").alias("root"))
    at = stage(at, "near-members")
    open_ = at.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most")
    hubs = at.where(F.col("turn") == nth).join(open_.select("key"), "key").select(
        "key", F.col("node").alias("hub"), F.col("root").alias("hub_root"))
    new = (F.col("root") != F.col("hub_root")) & ((F.col("turn") > nth) | (F.col("node") > F.col("hub")))
    return at.join(hubs, "key").where(new).select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b"))


def merged(labels: DataFrame, found: DataFrame) -> DataFrame:
    """``labels`` (node, root) after the links in ``found`` (a, b); only roots that they join get a new one."""
    end = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    ends = found.join(end("a"), "a", "left").join(end("b"), "b", "left")
    joined_ = components(ends.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")))
    up = joined_.select(F.col("node").alias("root"), F.col("root").alias("up"))
    old = labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return stage(old.unionByName(joined_.join(labels, "node", "left_anti")), "near-labels")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS,
                    rows: int = ROWS, exact: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    rows_ = stage(sketches(docs, shingle, bands, rows), "near-sketches")
    nodes = stage(rows_.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc"), F.max("n_shingles").alias("n"), F.min_by("keys", "doc_id").alias("keys"),
        F.count("*").alias("copies"), F.first("keys").alias("any_keys"),
    ).withColumn("keys", F.coalesce("keys", "any_keys")).drop("any_keys"), "near-nodes")
    spread = nodes.select("node", "n", F.explode("keys").alias("key"))
    hubs = spread.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("c")).where("c > 1")
    members = stage(spread.join(hubs, "key"), "near-buckets")
    stars = members.where("node <> hub").groupBy(F.col("node").alias("a"), F.col("hub").alias("b")).agg(F.count("*").alias("c"))
    stars = stage(stars, "near-stars")
    first = stage(stars.groupBy("a").agg(F.max(F.struct("c", "b"))["b"].alias("b")), "near-first")
    wanted = nodes.join(members.select("node").distinct(), "node").select(F.col("doc").alias("wanted_id")).distinct()
    sets = stage(sets_of(docs, wanted, shingle), "near-sets")
    links = confirmed(first, sets, percent)
    labels = components(links)
    tried = first

    def search(more: DataFrame) -> tuple[int, int]:
        """Pairs that were not tried before, and how many of them are links; these join components."""
        nonlocal labels, tried
        pairs = stage(more.join(tried, ["a", "b"], "left_anti"), "near-pairs")
        n = pairs.count()
        found = confirmed(pairs, sets, percent) if n else pairs
        linked = found.count() if n else 0
        if n:
            tried = tried.unionAll(pairs)
        if linked:
            labels = merged(labels, found)
        return n, linked

    stars = between(stars.select("a", "b"), labels)
    if exact:
        search(stars)
        search(closing_pairs(members, sets, labels, percent))
    else:
        n, linked = search(stars.unionAll(new_stars(members, labels, 0)).distinct())
        nth = 1
        while linked and linked * YIELD >= n:
            n, linked = search(new_stars(members, labels, nth).distinct())
            nth += 1
    named = nodes.select("node", "doc").join(labels, "node", "left")
    named = named.select("node", "doc", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("doc").alias("component"))
    of_node = stage(named.join(least, "root").select("node", "component"), "near-components")
    out = rows_.drop("keys").join(of_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    end = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    out = pairs.join(end("a"), "a", "left").join(end("b"), "b", "left")
    return out.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")
