"""Small documents with everything that an operator has to bear."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
#: Names that operators use themselves.
CLASHES = ("size", "kept", "node", "block", "body", "key", "target", "score", "toxic", "length", "cell", "rank", "n_words")


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}é" if rng.random() < 0.1 else f"w{rng.randrange(size)}" for _ in range(n)]


def corpus(seed=1):
    """(doc_id, text) with copies, near copies, shared passages, runs, blanks, repeated rows and NULLs."""
    rng = random.Random(seed)
    passage = words(rng, 40)
    base = words(rng, 120)
    out = []
    for k in range(40):
        text = words(rng, rng.randrange(0, 90))
        if k % 4 == 0:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + passage[rng.randrange(5):40 - rng.randrange(5)] + text[at:]
        if k % 7 == 0:
            text += ["ha"] * rng.randrange(2, 40)
        out.append((k, rng.choice([" ", "\n", " \t"]).join(text)))
    for k in range(40, 52):
        near = list(base)
        for _ in range(rng.randrange(0, 9)):
            near[rng.randrange(len(near))] = "changed"
        out.append((k, " ".join(near)))
    out += [(k, out[k - 60][1]) for k in range(60, 66)]  # copies
    out += [(70, None), (71, ""), (72, " \n\t "), (73, "one"), (74, "two words"), (None, out[4][1]), (None, None)]
    out += [(80, " ".join(base)), (80, " ".join(base)), (81, out[3][1]), (81, "other text of one id")]
    out.append((82, " ".join(words(rng, 30_000, 5_000)) + " " + " ".join(passage)))
    out.append((83, "x" * 200_000 + "\u0000\u0000" + "x" * 300))
    rng.shuffle(out)
    return out


def frame(spark, rows, clashes=False):
    full = [(i, t, None, None if k % 5 == 0 else f"s{k % 4}", None) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(full, DOCS).repartition(3)
    if clashes:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit("clash") for c in CLASHES})
    return df


def key(value):
    return (value is None, value)
