"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; policies are versioned sets of rules, applied to the bits alone, so that a new policy or an
ablation never reads a text again.

Defined cases: a NULL or empty text has no words and fails the rule on length; repeated rows and ties
are judged each by itself; an empty table gives an empty ledger. Extra columns are kept; the columns
added here replace columns of the same name. NULLs in other columns have no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import word_array

WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: Name and failure condition over the measurements, in the order of their bits. Bits are never
#: reused: a rule that changes gets a new name at the end.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words AND n_symbols > 5"),
    ("repeated_lines", "10 * n_dup_lines > 5 * n_lines"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
    ("upper_case", "10 * n_upper > 6 * word_chars"),
    ("exclamations", "10 * n_exclamations > 3 * n_words"),
)

#: Version -> rules that reject. Versions are never edited, only added.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "v1": ("too_few_words", "repeated_windows", "many_symbols", "repeated_lines"),
    "v2": tuple(name for name, _ in RULES),
}
CURRENT = "v2"


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    n_upper, n_exclamations (all long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    out = docs.withColumns({"_words": word_array(text), "_lines": lines})
    out = out.withColumns({"n_words": F.size("_words").cast("long"), "n_lines": F.size("_lines").cast("long")})
    # One hash per word, then one per window from five numbers.
    out = out.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    words = F.col("_hashes")
    windows = F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]),
    )).otherwise(F.array().cast("array<bigint>"))
    out = out.withColumns({
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.regexp_count(body, F.lit(f"[{SYMBOLS}]")).cast("long"),
        "n_exclamations": F.regexp_count(body, F.lit("!")).cast("long"),
        "n_upper": F.regexp_count(body, F.lit("\\p{Lu}")).cast("long"),
        "n_dup_lines": (F.col("n_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": windows,
    })
    out = out.withColumn("_repeats", F.size("_windows") > F.size(F.array_distinct("_windows")))
    # Windows with their places in the order of their hashes; only texts that repeat one get here.
    placed = F.when(F.col("_repeats"), F.sort_array(
        F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ))
    out = out.withColumn("_placed", placed)
    at = lambda k: F.get(F.col("_placed"), k)["h"]
    twice = F.filter(F.col("_placed"), lambda x, k: (
        F.coalesce(at(k - 1) == x["h"], F.lit(False)) | F.coalesce(at(k + 1) == x["h"], F.lit(False))
    ))
    covered = F.aggregate(
        F.sort_array(F.transform(twice, lambda x: x["i"])),
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct((i + WINDOW).alias("end"), (a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n")),
        lambda a: a["n"],
    )
    out = out.withColumn(
        "n_repeat_words", F.when(F.col("_repeats"), covered).otherwise(F.lit(0)).cast("long")
    )
    return out.drop("_words", "_hashes", "_lines", "_windows", "_repeats", "_placed")


def bits(names: tuple[str, ...]) -> int:
    """The mask of some rules."""
    place = {name: 1 << k for k, (name, _) in enumerate(RULES)}
    return sum(place[n] for n in names)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Measurements and ``failed_bits``: bit k is set where rule k fails."""
    failed = F.lit(0).cast("long")
    for k, (_, condition) in enumerate(RULES):
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measure(docs, text).withColumn("failed_bits", failed)


def passes(policy: str = CURRENT) -> Column:
    """Whether a ledger row passes a policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(bits(POLICIES[policy])).cast("long")) == 0


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents it fails, those only it fails, and those kept without it.

    Counts first by mask (at most one row per combination of rules), then compares masks with bits.
    """
    names = POLICIES[policy]
    whole = bits(names)
    masks = entries.groupBy(F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long")).alias("mask")).agg(
        F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(bits((n,))).cast("long").alias("bit")) for n in names])
    rows = masks.withColumn("r", F.explode(rules)).select("mask", "n", "r.*")
    hit = F.col("mask").bitwiseAND(F.col("bit")) != 0
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return rows.groupBy("rule").agg(
        total(hit).alias("n_failed"), total(F.col("mask") == F.col("bit")).alias("n_only"),
        total((F.col("mask") == 0) | (F.col("mask") == F.col("bit"))).alias("n_kept_without"),
    )
