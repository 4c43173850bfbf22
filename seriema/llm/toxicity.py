"""Toxicity as severity grades, by cumulative-link ordinal regression.

Features are the counts of words, and of beginnings of words, from a lexicon that is learned from labelled
documents: those that are much more frequent in toxic ones. The model is ``P(grade > k) = logistic(x.w - t_k)`` with one
weight vector ``w`` for all ordered thresholds ``t_0 < t_1 < t_2``. The expected severity is the sum of
these probabilities; a document is toxic if ``P(grade > 0)`` is at least one half.

Labels only say toxic or not. Grades of toxic training documents follow from how many lexicon words
they hold (``GRADE_HITS``), clean ones have grade 0.

Learning uses at most ``SAMPLE`` labelled documents, those with the smallest hash of their id. Every
text is scored whole.

Defined cases: NULL and empty texts have no features and get the score of a text without lexicon
words; NULL ids are scored but never learned from; labels that are NULL or contradict each other for
one id are not learned from; repeated rows get equal scores; without labelled documents of both kinds
there is no lexicon and nothing is toxic; an empty table gives an empty result. Columns of ``docs`` are
kept; ``severity, p_toxic, toxic`` are added and replace columns so named.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents to learn from, at most.
SAMPLE = 20_000
#: Words in the lexicon, at most.
LEXICON = 4_096
#: A lexicon word occurs in so many toxic documents at least, and is so many times as frequent there.
LEAST_TOXIC, LEAST_RATIO = 3, 4.0
#: Lexicon words from which a toxic document has grade 2 and 3.
GRADE_HITS = (2, 4)

#: ASCII letters to lower case, everything else in ASCII but digits to blanks.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(FOLD).split() if text else []


#: Bytes of a word's beginning, which is a feature where the word is longer.
STEM = 4


def distinct(text: str | None) -> set[bytes]:
    """The features that a text has: its words and their beginnings, these with a star."""
    words = set(tokens(text))
    return words | {w[:STEM] + b"*" for w in words if len(w) > STEM}


@dataclass(frozen=True)
class Model:
    words: tuple[bytes, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for scores x, one column per threshold."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - x[:, None], -40, 40)))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts with labels (doc_id, text, toxic): the bounded sample."""
    # MIN = MAX: one verdict per id.
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(
        F.min("toxic").alias("toxic"), F.max("toxic").alias("most")
    ).where("toxic = most").select("doc_id", "toxic")
    ids = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # At most SAMPLE pairs of numbers, so the texts stay where they are.
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def _word_counts(batches):
    """Texts that have a feature; under the empty one, all texts."""
    for batch in batches:
        found = Counter()
        for text in batch.column("text").to_pylist():
            found.update(distinct(text))
        found[b""] = batch.num_rows
        yield pa.RecordBatch.from_arrays([
            pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def lexicon(sample: DataFrame) -> list[bytes]:
    """Words typical of toxic documents; counted by Spark over the whole sample."""
    texts = sample.groupBy("text").agg(F.max("toxic").alias("toxic"))  # a text counts once
    toxic = texts.where("toxic = 1").mapInArrow(_word_counts, "word binary, n long")
    toxic = toxic.groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= LEAST_TOXIC) | (F.length("word") == 0))
    # The empty feature has the largest count, so it is always among the collected ones.
    few = toxic.orderBy(F.desc("n"), "word").limit(16 * LEXICON).collect()
    counts = {bytes(r["word"]): r["n"] for r in few}
    n_toxic = counts.pop(b"", 0)
    wanted = frozenset(counts)
    if not wanted:
        return []

    def clean_counts(batches):
        for batch in batches:
            found = Counter()
            for text in batch.column("text").to_pylist():
                found.update(wanted & distinct(text))
            found[b""] = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])

    clean = texts.where("toxic = 0").mapInArrow(clean_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    clean = {bytes(r["word"]): r["n"] for r in clean.collect()}
    n_clean = clean.pop(b"", 0)
    if not n_clean:
        return []
    ratio = {w: ((n + 0.5) / (n_toxic + 1)) / ((clean.get(w, 0) + 0.5) / (n_clean + 1)) for w, n in counts.items()}
    good = [w for w, r in ratio.items() if r >= LEAST_RATIO]
    return sorted(good, key=lambda w: (-counts[w] * np.log(ratio[w]), w))[:LEXICON]


def fit(rows: list[tuple[dict[int, float], int]], n_words: int, steps: int = 600, ridge: float = 2e-4):
    """Weights and thresholds by full-batch Adam on the ordinal log likelihood."""
    y = np.array([g for _, g in rows])
    place = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
    word = np.array([k for x, _ in rows for k in x], dtype=np.int64)
    value = np.array([v for x, _ in rows for v in x.values()])
    levels = 1 + len(GRADE_HITS)
    above = (y[:, None] > np.arange(levels)[None, :]).astype(float)
    # t_k = first + sums of exp(gap): ordered by construction.
    p = np.zeros(n_words + levels)
    p[n_words] = 2.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, first, gaps = p[:n_words], p[n_words], np.exp(p[n_words + 1:])
        t = first + np.concatenate([[0.0], np.cumsum(gaps)])
        x = np.bincount(place, weights=w[word] * value, minlength=len(rows))
        s = 1 / (1 + np.exp(np.clip(t[None, :] - x[:, None], -30, 30)))  # P(grade > k)
        upper = np.concatenate([np.ones((len(rows), 1)), s], axis=1)
        lower = np.concatenate([s, np.zeros((len(rows), 1))], axis=1)
        prob = np.maximum((upper - lower)[np.arange(len(rows)), y], 1e-12)
        ds = s * (1 - s) / prob[:, None]
        # log P(y) = log(P(>y-1) - P(>y)): one threshold pulls up, the next one down.
        at_upper = (np.arange(levels)[None, :] == (y - 1)[:, None]) * ds
        at_lower = (np.arange(levels)[None, :] == y[:, None]) * ds
        g = at_upper - at_lower  # d log P / d (x - t_k)
        gx, gt = g.sum(1), -g.sum(0)
        grad = np.empty_like(p)
        grad[:n_words] = np.bincount(word, weights=value * gx[place], minlength=n_words) / len(rows) - ridge * w
        grad[n_words] = gt.sum() / len(rows)
        grad[n_words + 1:] = np.cumsum(gt[::-1])[::-1][1:] * gaps / len(rows)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        p += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    gaps = np.exp(p[n_words + 1:])
    return p[:n_words], p[n_words] + np.concatenate([[0.0], np.cumsum(gaps)])


def hits(text: str | None, index: dict[bytes, int]) -> dict[int, int]:
    """Places of lexicon words in the model -> times they occur in a whole text."""
    found = index.keys() & distinct(text)
    if not found:
        return {}
    words = tokens(text)
    stems = Counter(w[:STEM] + b"*" for w in words if len(w) > STEM)
    return {index[w]: n for w, n in (Counter(words) + stems).items() if w in found}


def train(docs: DataFrame, labels: DataFrame) -> Model:
    sample = labelled(docs, labels)
    words = tuple(lexicon(sample))
    index = {w: k for k, w in enumerate(words)}

    def features(batches):
        for batch in batches:
            found = [hits(t, index) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("toxic").cast(pa.int32()), pa.array([list(x) for x in found], pa.list_(pa.int32())),
                pa.array([list(x.values()) for x in found], pa.list_(pa.int32())),
            ], names=["toxic", "words", "counts"])

    rows = []
    if words:
        found = sample.mapInArrow(features, "toxic int, words array<int>, counts array<int>")
        # Equal rows are summed up by Spark; texts without a lexicon word are one or two of them.
        for r in found.groupBy("toxic", "words", "counts").count().orderBy("toxic", "words", "counts").collect():
            n = sum(r["counts"])
            grade = 0 if r["toxic"] == 0 else 1 + sum(n >= h for h in GRADE_HITS)
            rows += [({k: float(np.log2(1 + c)) for k, c in zip(r["words"], r["counts"])}, grade)] * r["count"]
    if not rows:
        return Model((), np.zeros(0), np.array([8.0, 9.0, 10.0]))
    weights, thresholds = fit(rows, len(words))
    return Model(words, weights, thresholds)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with severity (0 to 3), p_toxic and toxic."""
    index = {w: k for k, w in enumerate(model.words)}
    kept = [f for f in docs.schema.fields if f.name not in ("severity", "p_toxic", "toxic")]
    schema = T.StructType([*kept, T.StructField("severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()),
                           T.StructField("toxic", T.BooleanType())])

    def scored(batches):
        for batch in batches:
            x = np.array([
                sum(model.weights[k] * np.log2(1 + n) for k, n in hits(t, index).items())
                for t in batch.column(text).to_pylist()
            ], dtype=float)
            p = model.probabilities(x)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(p[:, 0] >= 0.5)],
                names=schema.names,
            )

    return docs.mapInArrow(scored, schema)
