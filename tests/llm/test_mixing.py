import pytest
from pyspark.sql import functions as F

from seriema.llm import mixing
from tests.llm.corpora import corpus, frame


def filled(sizes, weights, cap=3):
    capped, total = set(), sum(sizes)
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        left = total - sum(cap * sizes[k] for k in capped)
        share = {k: weights[k] * left / sum(weights[j] for j in free) for k in free}
        above = {k for k in free if share[k] > cap * sizes[k]}
        if not above:
            return [cap * sizes[k] if k in capped else share[k] for k in range(len(sizes))]
        capped |= above


def test_mix(spark):
    rows = corpus(5)
    df = frame(spark, rows, clashes=True)
    out = mixing.mix(df).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in out:
        assert r.size == len((r.text or "").encode().split()) and 0 <= r.taken <= 3 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = filled([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))])
    for s, target in zip(order, want):
        own = [r for r in out if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]} and own[0].target == pytest.approx(target, rel=1e-12)
        assert abs(sum(r.taken for r in own) - target) <= 1 + len(own)
    again = mixing.mix(df.repartition(5))
    assert sorted(map(str, out)) == sorted(map(str, again.collect()))


@pytest.mark.parametrize("words", [[100, 1, 1, 1], [1, 100, 100], [7], [0, 0], [3, 0, 50, 2, 9, 30]])
def test_targets(spark, words):
    sources = spark.createDataFrame([(k, n, (5, 2, 1)[k % 3]) for k, n in enumerate(words)], "k int, source_size long, weight int")
    got = {r.k: r.target for r in mixing.targets(sources).collect()}
    want = filled(words, [(5, 2, 1)[k % 3] for k in range(len(words))]) if sum(words) else [0.0] * len(words)
    assert [got[k] for k in range(len(words))] == pytest.approx(want)


@pytest.mark.parametrize("words", [
    [429_496_729], [429_496_730], [587_000_000] + [55_000_000] * 19, [2_147_483_647, 0, 1], [2_147_483_648, 900_000_000],
    [300, 600_000_000, 5, 700_000_000], [10 ** 11, 1, 10 ** 9, 10 ** 12],
])
def test_targets_of_large_sources(spark, words):
    weights = [(5, 2, 1)[k % 3] for k in range(len(words))]
    sources = spark.createDataFrame(list(zip(range(len(words)), words, weights)), "k int, source_size long, weight int")
    out = mixing.targets(sources)
    assert out.dtypes == [*sources.dtypes, ("target", "double")]
    got = {r.k: r.target for r in out.collect()}
    assert [got[k] for k in range(len(words))] == pytest.approx(filled(words, weights), rel=1e-12)


def test_mix_of_large_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "word_count", lambda text: F.length(text) * F.lit(5_000_000).cast("long"))
    out = mixing.mix(frame(spark, [(k, "x" * (k % 7 + 1)) for k in range(60)])).collect()
    sizes = {}
    for r in out:
        assert r.size == 5_000_000 * len(r.text) and 0 <= r.taken <= 3 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = sorted(sizes, key=lambda s: (s is None, s))
    want = filled([sizes[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))])
    assert len(out) == 60 and 2 ** 31 / 5 < sum(sizes.values()) < 2 ** 31
    for s, target in zip(order, want):
        own = [r for r in out if r.source == s]
        assert {r.source_size for r in own} == {sizes[s]} and own[0].target == pytest.approx(target, rel=1e-12)
        assert abs(sum(r.taken for r in own) - target) <= 0.5 + 1e-3


def test_repetitions(spark):
    rows = [(k, " ".join(f"w{k}_{j}" for j in range(10))) for k in range(30)]
    mixed = mixing.mix(frame(spark, rows))
    taken = {r.doc_id: r.taken for r in mixed.collect()}
    copies = mixing.repeated(mixed).groupBy("doc_id").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert {r.doc_id: r.n for r in copies} == {k: n for k, n in taken.items() if n}


def test_empty_table(spark):
    assert mixing.mix(frame(spark, [(1, "x")]).limit(0)).count() == 0
