"""From documents to packed training sequences: five stages, each over all that the last one kept.

1. toxicity: documents that the severity model finds toxic go;
2. near_duplicates: of documents that are linked by shingles, the one with the smallest id stays;
3. repeats: words in windows that an earlier document has go, and documents that lose all their words;
4. mixing: sources are brought to their weights by repeating documents, the last repetition in part;
5. packing: what is left becomes pieces in sequences of 1,024 tokens.

NULL texts pass the first three stages and give no words to the mix. Rows with NULL ids pass the stages
that decide by id. Of repeated rows the second stage keeps one; rows with one id share its verdict. Further columns, whatever
their names, keep their values up to the last stage, which has columns of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriema.llm import minhash, mixing, packing, recompression
from seriema.llm import toxicity as severity
from seriema.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def set_aside(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with names for further columns that no operator uses, and how to name them again."""
    names = {c: f"_further_{k}" for k, c in enumerate(docs.columns) if c not in COLUMNS}
    return docs.withColumnsRenamed(names), {new: c for c, new in names.items()}


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the model learns from labelled documents of the same corpus."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own, names = set_aside(docs)
    scored = severity.score(own, severity.train(own, labels))
    return scored.where(~F.col("toxic")).select(own.columns).withColumnsRenamed(names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    found = minhash.near_duplicates(docs, exact=True)
    stay = found.where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # Both sides lie by id after the join, so that repeated rows fall together without another shuffle.
    one = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.where(F.col("doc_id").isNull())).select(docs.columns)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the word windows that earlier ones have; ``n_chars`` follows the text."""
    out = recompression.without_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a last repetition can be a part."""
    own, names = set_aside(docs)
    out = mixing.repeated(mixing.mix(own))
    out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(own.columns)
    return out.withColumnsRenamed(names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixing", mixture),
    ("packing", packed),
]

#: Training of the first stage and the tokenizer of the last are out of SQL's reach.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
