"""Mixing sources to target weights: capped water-filling, then seeded repetitions.

Every source has a size (the words of its documents) and a weight. The mix is as large as all
sources together. Its shares follow the weights, but no source gives more than ``max_epochs`` times
its size: sources above that are clamped, and what they cannot give is shared among the others by
weight, round by round, until none is above.

A source whose target is 2.4 times its size repeats each document twice, and takes four tenths of
its words once more: the documents in a seeded order up to the missing number of words, the last of
them in part.

Defined cases: a NULL source is a source of its own, the last in order; a NULL text has no words and
gives none; documents without words take 0; repeated rows each count, and where the last place falls
to rows alike in id and size they share it evenly (rounded down); a NULL doc_id is an id like any
other; an empty table gives an empty result. Extra columns are kept; helper columns are prefixed
with ``_mix_``, the added ones are ``size, source_size, target, taken`` and replace columns so named.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .words import word_count

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Sources up to this number are broadcast to the documents; beyond it they are joined by shuffle.
BROADCAST_SOURCES = 20_000


def order_key(doc_id: str, size: str, seed: str) -> Column:
    """The seeded place of a document in its source: 32 hexadecimal digits."""
    parts = [F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("?")), F.col(size).cast("string")]
    return F.md5(F.concat_ws(":", *parts))


def ranked(sources: DataFrame) -> DataFrame:
    """``_mix_rank`` from 0 by code point, NULL last, without one task that sees all sources."""
    spread = sources.repartitionByRange(F.col("_mix_source").asc_nulls_last())
    spread = stage(spread.withColumn("_mix_part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("_mix_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = spread.groupBy("_mix_part").agg(F.count("*").alias("n"))
    parts = parts.select("_mix_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_mix_before"))
    inside = Window.partitionBy("_mix_part").orderBy(F.col("_mix_source").asc_nulls_last())
    return spread.join(parts, "_mix_part").withColumn(
        "_mix_rank", F.col("_mix_before") + F.row_number().over(inside) - 1
    ).drop("_mix_part", "_mix_before")


def targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``target`` to rows (size, weight): shares of all sizes, clamped at ``max_epochs`` sizes.

    Each round brings one row to the driver: what is left to share and the weight it is shared by.
    The limit only falls on sources above their share, so rounds end when none is left above.
    """
    cap = F.col("source_size") * F.lit(max_epochs)
    # What is left to share becomes a literal, an int below 2^31; by an int weight the product would be one, too.
    weight = F.col("weight") * F.lit(1).cast("long")
    clamped = F.lit(False)
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, shared, before = total, 0, -1
    while True:
        row = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0)).alias("given"),
            F.coalesce(F.sum(F.when(~clamped, weight)), F.lit(0)).alias("shared"),
            F.count(F.when(clamped, 1)).alias("n"),
        ).first()
        if row["n"] == before:
            break
        left, shared, before = total - row["given"], row["shared"], row["n"]
        # Shares only rise from round to round, so who is above once stays clamped.
        clamped = F.lit(False) if not shared else weight * F.lit(left) / F.lit(shared) > cap
        if not shared:
            clamped = F.lit(True)
            break
    share = weight * F.lit(left) / F.lit(shared) if shared else cap.cast("double")
    return sources.withColumn("target", F.when(clamped, cap.cast("double")).otherwise(share))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken`` (see the module).

    The text is read once to measure and once when the result is read; only ids, sources and sizes
    are shuffled. ``weights`` repeat over the sources in their order.
    """
    sized = docs.withColumns({
        "size": word_count(text), "_mix_source": F.col(source), "_mix_doc": F.col(doc_id),
    }).withColumn("_mix_key", order_key("_mix_doc", "size", seed))
    slim = stage(sized.select("_mix_source", "size", "_mix_key"), "mix-sizes")
    cuts = stage(cut_points(slim, weights, max_epochs), "mix-cuts")
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    else:
        cuts = cuts.hint("merge")
    joined = sized.join(cuts, sized["_mix_source"].eqNullSafe(cuts["_cut_source"]), "left")
    key = F.col("_mix_key")
    part = (
        F.when(key < F.col("_cut_key"), F.col("size")).when(key == F.col("_cut_key"), F.col("_cut_take"))
        .otherwise(F.lit(0))
    )
    taken = (F.col("_cut_whole") * F.col("size") + part).cast("long")
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    return joined.select(
        *kept, "size", F.col("_cut_size").alias("source_size"), F.col("_cut_target").alias("target"),
        taken.alias("taken"),
    )


def cut_points(slim: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """Per source: whole repetitions, and the key and words at which the last repetition ends."""
    # Words by source and the first three digits of the key: at most 4,096 rows a source, so that
    # only the documents of one of them have to be put in order.
    cells = stage(slim.groupBy("_mix_source", F.substring("_mix_key", 1, 3).alias("_mix_cell"))
                  .agg(F.sum("size").alias("words")), "mix-cells")
    sources = ranked(cells.groupBy("_mix_source").agg(F.sum("words").alias("source_size")))
    cycle = F.array(*[F.lit(w) for w in weights])
    sources = stage(sources.withColumn(
        "weight", F.element_at(cycle, (F.col("_mix_rank") % len(weights) + 1).cast("int"))
    ), "mix-weights")
    size, target = F.col("source_size"), F.col("target")
    whole = F.when(size > 0, F.floor(target / size)).otherwise(F.lit(0)).cast("long")
    plan = targets(sources, max_epochs).withColumn("_cut_whole", whole).select(
        F.col("_mix_source").alias("_cut_source"), size.alias("_cut_size"), target.alias("_cut_target"), "_cut_whole",
        F.greatest(F.lit(0), F.round(target - F.col("_cut_whole") * size)).cast("long").alias("_cut_budget"),
    )
    upto = Window.partitionBy("_mix_source").orderBy("_mix_cell")
    cells = cells.withColumn("_upto", F.sum("words").over(upto))
    cell = plan.join(cells, F.col("_cut_source").eqNullSafe(F.col("_mix_source"))).where(
        (F.col("_upto") > F.col("_cut_budget")) & (F.col("_upto") - F.col("words") <= F.col("_cut_budget"))
    ).select("_cut_source", "_cut_budget", "_mix_cell", (F.col("_upto") - F.col("words")).alias("_start"))
    inside = slim.join(
        cell, F.col("_mix_source").eqNullSafe(F.col("_cut_source"))
        & (F.substring("_mix_key", 1, 3) == F.col("_mix_cell"))
    ).groupBy("_cut_source", "_cut_budget", "_start", "_mix_key").agg(
        F.sum("size").alias("words"), F.count("*").alias("n")
    )
    inside = inside.withColumn("_upto", F.col("_start") + F.sum("words").over(
        Window.partitionBy("_cut_source").orderBy("_mix_key")
    ))
    start = F.col("_upto") - F.col("words")
    place = inside.where((F.col("_upto") > F.col("_cut_budget")) & (start <= F.col("_cut_budget"))).select(
        F.col("_cut_source").alias("_at"), F.col("_mix_key").alias("_cut_key"),
        F.floor((F.col("_cut_budget") - start) / F.col("n")).cast("long").alias("_cut_take"),
    )
    # Without such a place the last repetition is whole; "g" stands behind every key.
    return plan.join(place, F.col("_cut_source").eqNullSafe(F.col("_at")), "left").select(
        "_cut_source", "_cut_size", "_cut_target", "_cut_whole",
        F.coalesce("_cut_key", F.lit("g")).alias("_cut_key"), F.coalesce("_cut_take", F.lit(0)).alias("_cut_take"),
    )


def repeated(mixed: DataFrame, text: str = "text") -> DataFrame:
    """One row per repetition of a mixed document: whole ones, then the part that remains.

    A part keeps its first words, joined by one space; documents that give no word are left out.
    """
    from .words import word_array

    size, taken = F.col("size"), F.col("taken")
    whole = F.when(size > 0, F.floor(taken / size)).otherwise(F.lit(0)).cast("int")
    rest = (taken - whole * size).cast("int")
    takes = F.concat(F.array_repeat(size.cast("int"), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    out = mixed.withColumn("_mix_take", F.explode(takes))
    cut = F.concat_ws(" ", F.slice(word_array(text), F.lit(1), F.col("_mix_take")))
    return out.withColumn(
        text, F.when(F.col("_mix_take") == size, F.col(text)).otherwise(cut)
    ).drop("_mix_take")
