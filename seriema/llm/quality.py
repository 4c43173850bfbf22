"""Quality by a convolutional network over bytes, trained and applied in numpy.

A byte is embedded in ``EMBED`` numbers. Filters over 8 bytes at every 4th byte are max-pooled within
chunks of 256 bytes that overlap by half and cover the whole text. The chunks' maxima are combined by
their mean and their maximum over the text, and a small hidden layer turns them into one probability.

Training uses labelled documents in the order of the hash of their id, at most ``SAMPLE`` and until they have
``TRAIN_BYTES`` bytes in all. Of a text longer than ``LONGEST`` bytes it sees that many, in pieces spread evenly
over the whole text. Scoring takes every text whole, whatever its length.

Defined cases: a NULL or empty text is scored like a chunk of padding; repeated rows get scores equal but for rounding;
NULL ids are scored, never learned from, and not held out; labels that are NULL or contradict each other
are not learned from; without labels of both kinds every score is the share of label 1 (one half if there
are none); an empty table gives an empty result. Columns of ``docs`` are kept; ``score`` is added and
replaces a column so named.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Documents to learn from, their bytes in all, and those of one, at most; and of a piece of a longer one.
SAMPLE, TRAIN_BYTES, LONGEST, PIECE = 2_000, 16 << 20, 1 << 18, 1_024
EMBED, STEP, FILTERS, HIDDEN = 8, 4, 24, 16
#: Filters are pooled over half chunks of so many bytes; a chunk is two neighbours.
HOP = 128
EPOCHS, BATCH, RATE, SEED = 10, 16, 4e-3, 7
#: Small samples are passed over more often, up to so many texts in all.
PASSES, MOST_EPOCHS = 20_000, 40

Params = dict[str, np.ndarray]


def held_out(doc_id: str = "doc_id") -> Column:
    """The third of the ids that no model learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each padded with zeros to half chunks, and their numbers of half chunks."""
    hops = np.array([max(2, -(-(len(t) + 2 * STEP) // HOP)) for t in texts], dtype=np.int64)
    buffer = np.zeros(int(hops.sum()) * HOP, dtype=np.uint8)
    for text, start in zip(texts, (np.cumsum(hops) - hops) * HOP):
        buffer[start:start + len(text)] = np.frombuffer(text, dtype=np.uint8)
    return buffer, hops


def start_params(rng: np.random.Generator) -> Params:
    wide = STEP * EMBED
    return {
        "embed": rng.normal(0, 0.5, (256, EMBED)), "near": rng.normal(0, 0.25, (wide, FILTERS)),
        "far": rng.normal(0, 0.25, (wide, FILTERS)), "bias": np.zeros(FILTERS),
        "w1": rng.normal(0, 0.2, (2 * FILTERS, HIDDEN)), "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, 0.2, HIDDEN), "b2": np.zeros(1),
    }


def forward(p: Params, buffer: np.ndarray, hops: np.ndarray) -> tuple[np.ndarray, dict]:
    """Probabilities of the texts laid out in ``buffer``, and what the gradient needs."""
    groups = p["embed"][buffer].reshape(-1, STEP * EMBED)
    # A filter over 8 bytes is one over the first four plus one over the next four.
    # Behind the last four bytes of a text there is padding, not the next text.
    stops = np.cumsum(hops) * (HOP // STEP) - 1
    after = np.empty_like(groups)
    after[:-1] = groups[1:]
    after[stops] = np.tile(p["embed"][0], STEP)
    y = groups @ p["near"]
    y += after @ p["far"]
    y += p["bias"]
    y = y.reshape(len(buffer) // HOP, HOP // STEP, FILTERS)
    pooled = y.max(1)
    ends = np.cumsum(hops)
    last = np.zeros(len(pooled), dtype=bool)
    last[ends - 1] = True
    left = np.flatnonzero(~last)  # a chunk begins at every half chunk but a text's last
    chunks = np.maximum(np.maximum(pooled[left], pooled[left + 1]), 0)
    n = hops - 1
    starts = np.cumsum(n) - n
    mean = np.add.reduceat(chunks, starts) / n[:, None].astype(np.float32)
    top = np.maximum.reduceat(chunks, starts)
    feats = np.concatenate([mean, top], axis=1)
    hidden = np.tanh(feats @ p["w1"] + p["b1"])
    out = 1 / (1 + np.exp(-np.clip(hidden @ p["w2"] + p["b2"][0], -30, 30)))
    return out, {"groups": groups, "after": after, "stops": stops, "y": y, "pooled": pooled, "left": left, "chunks": chunks, "n": n,
                 "top": top, "feats": feats, "hidden": hidden}


def gradient(p: Params, buffer: np.ndarray, s: dict, error: np.ndarray) -> Params:
    """Gradients for ``error`` = probability - label."""
    g: Params = {"b2": np.array([error.sum()]), "w2": s["hidden"].T @ error}
    dh = error[:, None] * p["w2"][None, :] * (1 - s["hidden"] ** 2)
    g["w1"], g["b1"] = s["feats"].T @ dh, dh.sum(0)
    df = dh @ p["w1"].T
    doc = np.repeat(np.arange(len(s["n"])), s["n"])
    dc = df[doc, :FILTERS] / s["n"][doc, None].astype(np.float32)
    is_top = s["chunks"] == s["top"][doc]
    ties = np.add.reduceat(is_top, np.cumsum(s["n"]) - s["n"], dtype=np.float32)
    dc += is_top * (df[:, FILTERS:] / ties)[doc]
    dc *= s["chunks"] > 0
    dp = np.zeros_like(s["pooled"])
    first = s["pooled"][s["left"]] >= s["pooled"][s["left"] + 1]
    dp[s["left"]] += dc * first
    dp[s["left"] + 1] += dc * ~first
    dy = np.zeros_like(s["y"])
    np.put_along_axis(dy, s["y"].argmax(1)[:, None, :], dp[:, None, :], axis=1)
    dy = dy.reshape(-1, FILTERS)
    g["bias"] = dy.sum(0)
    g["near"], g["far"] = s["groups"].T @ dy, s["after"].T @ dy
    dg, da = dy @ p["near"].T, dy @ p["far"].T
    padding = da[s["stops"]].reshape(-1, EMBED).sum(0)
    da[s["stops"]] = 0
    dg[1:] += da[:-1]
    dg = dg.reshape(-1, EMBED)
    # Only bytes under a filter that won its half chunk have a gradient.
    hit = np.flatnonzero(dg.any(1))
    g["embed"] = np.stack(
        [np.bincount(buffer[hit], weights=dg[hit, e], minlength=256) for e in range(EMBED)], axis=1).astype(np.float32)
    g["embed"][0] += padding
    return g


def learn(texts: list[bytes], labels: np.ndarray) -> Params:
    """Adam over shuffled batches; the seed is fixed, so reruns agree."""
    rng = np.random.default_rng(SEED)
    p = {k: x.astype(np.float32) for k, x in start_params(rng).items()}
    labels = labels.astype(np.float32)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    step, epochs = 0, max(EPOCHS, min(MOST_EPOCHS, PASSES // max(1, len(texts))))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            # The gradient is a sum over texts, so a batch of long ones is taken in parts.
            part = np.cumsum([len(texts[i]) for i in rows]) // LONGEST
            g: Params = {}
            for some in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
                buffer, hops = lay_out([texts[i] for i in some])
                out, state = forward(p, buffer, hops)
                for k, x in gradient(p, buffer, state, (out - labels[some]) / len(rows)).items():
                    g[k] = g[k] + x if k in g else x
            step += 1
            rate = RATE * (1 - 0.9 * epoch / epochs)
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - np.float32(rate) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return p


def train(docs: DataFrame, labels: DataFrame) -> Params | float:
    """The network, or the share of label 1 where there is nothing to tell apart."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    one = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
    one = one.where("quality = most").select("doc_id", "quality")
    # Twice the sample, as some may have no text; at most so many pairs of numbers are broadcast.
    ids = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * SAMPLE)
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", body.alias("body")).join(F.broadcast(ids), "doc_id")
    pieces = LONGEST // PIECE
    spread = F.expr(f"aggregate(sequence(0, {pieces - 1}), X'', (a, k) -> concat(a, substring("
                    f"body, cast(k * (length(body) - {PIECE}L) div {pieces - 1} as int) + 1, {PIECE})))")
    rows = rows.withColumn("body", F.when(F.length("body") > LONGEST, spread).otherwise(F.col("body")))
    # Lengths first, so that no more texts reach the driver than fit the bytes.
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.length("body"), F.col("body")]
    sizes = rows.orderBy(*order).limit(SAMPLE).select(F.length("body").alias("n")).collect()
    fit = int((np.cumsum([r["n"] for r in sizes]) <= TRAIN_BYTES).sum()) if sizes else 0
    rows = rows.orderBy(*order).limit(fit).collect()
    y = np.array([r["quality"] for r in rows], dtype=float)
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    return learn([bytes(r["body"]) for r in rows], y)


def score(docs: DataFrame, params: Params | float, text: str = "text") -> DataFrame:
    """``docs`` with ``score``; texts go through the network in groups of about a megabyte."""
    kept = [f for f in docs.schema.fields if f.name != "score"]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType())])

    def probabilities(texts: list[bytes]) -> np.ndarray:
        if isinstance(params, float):
            return np.full(len(texts), params)
        out, group, size = [], [], 0
        for body in texts:
            group.append(body)
            size += len(body) + HOP
            if size >= 1 << 20:
                out.append(forward(params, *lay_out(group))[0])
                group, size = [], 0
        if group:
            out.append(forward(params, *lay_out(group))[0])
        return np.concatenate(out) if out else np.zeros(0)

    def scored(batches):
        for batch in batches:
            bodies = batch.column(text).cast(pa.binary()).to_pylist()
            p = probabilities([x or b"" for x in bodies]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(np.clip(p, 0, 1))], names=schema.names)

    return docs.mapInArrow(scored, schema)
