import re
from collections import Counter

from seriema.llm import rules
from tests.llm.corpora import corpus, frame


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {k + j for k in range(len(w) - 4) if seen[tuple(w[k:k + 5])] > 1 for j in range(5)}
    base = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), base


def test_measurements(spark):
    rows = corpus(6) + [(300, "a b c d e a b c d e f"), (301, "x\nx\n\n \nx y"), (302, "#a $b <c> & |"), (303, "a\rb\x0bc\x0cd e")]
    got = rules.ledger(frame(spark, rows, clashes=True)).collect()
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, bool(r.failed_bits & 3)) for r in got)
    assert found == Counter((i, *brute(t)) for i, t in rows)


def test_policies_read_bits_only(spark):
    ledger = spark.createDataFrame([(0,), (1,), (2,), (4,), (6,), (64,)], "failed_bits long")
    kept = lambda p: [r.failed_bits for r in ledger.where(rules.passes(p)).collect()]
    assert kept("base") == [0, 4, 64] and kept("v1") == [0, 64] and kept("v2") == [0]
    assert {n: rules.bits((n,)) for n in rules.POLICIES["base"]} == {"too_few_words": 1, "repeated_windows": 2}
    rows = {r["rule"]: (r.n_failed, r.n_only, r.n_kept_without) for r in rules.ablation(ledger, "v1").collect()}
    assert rows == {"too_few_words": (1, 1, 3), "repeated_windows": (2, 1, 3), "many_symbols": (2, 1, 3), "repeated_lines": (0, 0, 2)}


def test_empty_table(spark):
    empty = frame(spark, [(1, "x")]).limit(0)
    assert rules.ledger(empty).count() == 0 and all(r.n_failed == 0 for r in rules.ablation(rules.ledger(empty)).collect())
