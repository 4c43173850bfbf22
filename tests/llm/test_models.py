import numpy as np
import pytest
from pyspark.sql import functions as F

from seriema.llm import quality, toxicity
from tests.llm.corpora import corpus, frame

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_the_held_out_third(spark, tables):
    docs, labels = tables
    params = quality.train(docs, labels)
    scored = quality.score(docs, params).withColumn("held_out", quality.held_out()).join(labels, "doc_id").where("held_out")
    right = scored.select(((F.col("score") >= 0.5) == (F.col("quality") == 1)).cast("int").alias("right"), "quality")
    assert right.agg(F.avg("right")).first()[0] > 0.93
    assert right.where("quality = 1").agg(F.avg("right")).first()[0] > 0.97
    odd = quality.score(frame(spark, corpus(7), clashes=True), params).select("doc_id", "score", "text").collect()
    assert len(odd) == len(corpus(7)) and all(0 <= r.score <= 1 for r in odd)
    again = {r.text: r.score for r in odd}
    assert all(again[r.text] == pytest.approx(r.score, abs=1e-5) for r in odd)


def test_long_texts_are_learned_from(spark):
    texts = [(k, ("good words " if k % 2 else "bad luck ") * (40_000 if k < 4 else 1_200)) for k in range(60)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in texts], "doc_id long, quality int")
    params = quality.train(frame(spark, texts), labels)
    assert not isinstance(params, float)
    scores = {r.doc_id: r.score for r in quality.score(frame(spark, texts), params).collect()}
    assert all((scores[k] > 0.5) == (k % 2 == 1) for k, _ in texts)


def test_quality_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in quality.start_params(rng).items()}
    texts = [bytes(rng.integers(32, 120, n).astype(np.uint8)) for n in (5, 700, 300)]
    buffer, hops = quality.lay_out(texts)
    y = np.array([0.0, 1.0, 1.0])

    def loss():
        out, _ = quality.forward(p, buffer, hops)
        return -(y * np.log(out) + (1 - y) * np.log(1 - out)).sum()

    out, state = quality.forward(p, buffer, hops)
    g = quality.gradient(p, buffer, state, out - y)
    for name in p:
        at = tuple(rng.integers(0, n) for n in p[name].shape) if name != "embed" else (buffer[3], 2)
        old = p[name][at]
        p[name][at] = old + 1e-5
        up = loss()
        p[name][at] = old - 1e-5
        down = loss()
        p[name][at] = old
        assert g[name][at] == pytest.approx((up - down) / 2e-5, abs=2e-3), name


def test_a_long_text_is_read_to_its_end():
    p = {k: v.astype(np.float32) for k, v in quality.start_params(np.random.default_rng(1)).items()}
    a, b = b"a" * 300_000, b"a" * 299_900 + b"#$%&" * 25
    assert len({float(x) for x in quality.forward(p, *quality.lay_out([a, b]))[0]}) == 2


def test_toxicity(spark, tables):
    docs, labels = tables
    model = toxicity.train(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = toxicity.score(docs, model).select("doc_id", F.col("toxic").alias("found"), "severity").join(labels, "doc_id")
    assert found.where("toxic = 0 AND found").count() == 0
    assert found.where("toxic = 1").agg(F.avg(F.col("found").cast("int"))).first()[0] > 0.9
    odd = toxicity.score(frame(spark, corpus(8), clashes=True), model).collect()
    assert len(odd) == len(corpus(8)) and all(0 <= r.severity <= 3 for r in odd)


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(2)
    rows = [({0: float(n)}, min(n, 3)) for n in rng.integers(0, 5, 400)]
    weights, thresholds = toxicity.fit(rows, 1)
    assert weights[0] > 0 and (np.diff(thresholds) > 0).all()
    model = toxicity.Model((b"x",), weights, thresholds)
    severity = model.probabilities(weights[0] * np.arange(5)).sum(1)
    assert (np.diff(severity) > 0).all() and severity[0] < 0.5 and severity[4] > 2.5


def test_nothing_to_learn_from(spark, tables):
    docs, labels = tables
    none = labels.limit(0)
    assert {r.score for r in quality.score(docs.limit(5), quality.train(docs, none)).collect()} == {0.5}
    assert toxicity.score(docs, toxicity.train(docs, none)).where("toxic").count() == 0
    assert toxicity.score(docs.limit(0), toxicity.train(docs, labels)).count() == 0
