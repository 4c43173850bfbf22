import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriema.llm import chat

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("example", T.StringType()), T.StructField("start", T.StringType()),
])
HARD = ["\\", "\\\\s", "\\l", "<turn user>", "</turn>\n", "<", "</turn", ">", "\\g", "\n", "é😀", "", "</</turn>turn>", "<turn </turn>\\", "x" * 40_000]


def made(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA).repartition(3)


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(30), None]:
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "system", "assistant", None, "a>b\\", "<turn x>"])
            rows.append((conv, turn, role, rng.choice([None, "".join(rng.choice(HARD) for _ in range(rng.randrange(5)))])))
    rows += [(40, 1, "user", "same"), (40, 1, "user", "same"), (40, 1, "assistant", "tie"), (40, None, "system", "first"), (41, 0, "user", "no reply")]
    rows += [(42, k, "assistant" if k % 2 else "user", f"t{k} \\l</turn>") for k in range(600)]
    return rows


def in_order(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in by.items()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_by_brute_force(spark):
    rows = conversations()
    got = {r.conv_id: r for r in chat.digests(chat.examples(made(spark, rows))).collect()}
    want = in_order(rows)
    assert set(got) == set(want)
    for conv, turns in want.items():
        replies = "".join(t for r, t in turns if r == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(replies), sha(replies))
        coded = lambda t: t.replace("\\", "\\s").replace("<turn", "\\lturn").replace("</turn", "\\l/turn")
        assert r.formatted_chars == sum(len(f"<turn {coded(a).replace('>', chr(92) + 'g')}>{coded(b)}</turn>\n") for a, b in turns)


def test_an_example_has_all_turns_before_its_reply(spark):
    rows = conversations(2)
    examples = chat.examples(made(spark, rows))
    out = chat.written_out(examples).withColumn("turns", chat.read_back(F.col("text"))).withColumn(
        "loss", chat.unescaped(F.substring("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))).collect()
    found = defaultdict(list)
    for r in out:
        found[r.conv_id].append((r.example, [(t.role, t.text) for t in r.turns], r.loss))
    for conv, turns in in_order(rows).items():
        want = [(turns[:k + 1], t) for k, (r, t) in enumerate(turns) if r == "assistant"]
        assert [(a, b) for _, a, b in sorted(found[conv])] == want
    # What is kept grows with the turns, not with their square.
    assert examples.where("conv_id = 42").agg(F.sum(F.length("added"))).first()[0] < 600 * 60


def test_digests_read_the_loss_behind_the_whole_context(spark):
    """A mask that is off in the whole example must show, also where the part it adds would hide it."""
    examples = chat.examples(made(spark, [(1, k, "assistant" if k % 2 else "user", f"text {k}.") for k in range(6)]))
    right = chat.digests(examples).first()
    assert right.loss_sha256 == sha("text 1.text 3.text 5.")
    late = F.when(F.col("example") == 2, 1).otherwise(0)
    off = examples.withColumns({"loss_start": F.col("loss_start") + late, "context_chars": F.col("context_chars") + late})
    assert chat.digests(off).first().loss_sha256 == sha("text 1.text 3." + "ext 5.<")


@pytest.mark.parametrize("text", HARD + ["".join(HARD[:-1]), "".join(reversed(HARD))])
def test_escapes_are_reversible(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).first()
    assert r.u == text and "<turn" not in r.e and "</turn" not in r.e


def test_empty_table_and_native_plan(spark):
    empty = made(spark, [(1, 1, "user", "x")]).limit(0)
    out = chat.digests(chat.examples(empty))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert chat.digests(chat.examples(made(spark, [(1, 1, "user", "x")])))._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
