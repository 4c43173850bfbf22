import random
from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.corpora import CLASHES, corpus, frame, words
from tests.llm.test_minhash import brute as all_pairs
from tests.llm.test_mixing import filled

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    ids = {r.doc_id for r in docs.collect()}
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        docs = step(spark, docs, SF)
        rows = docs.collect()
        assert rows and {r.doc_id for r in rows} <= ids, name
        if k < 4:
            assert docs.columns == columns, name
        if k < 3:
            assert len(rows) <= n and len({r.doc_id for r in rows}) == len(rows), name
        ids, n = {r.doc_id for r in rows}, len(rows)
        docs = spark.createDataFrame(rows, docs.schema)


def test_run_is_registered(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    names = {q.split("_")[0] for q in __spark_entry__.queries()}
    assert {f"op{k}" for k in range(1, 11)} <= names


SLURS = [f"slur{k}" for k in range(6)]


def planted():
    """Documents (doc_id, text) and labels (doc_id, quality, toxic); unlabelled toxic ones have ids from 900."""
    rng = random.Random(8)
    rows, labels = corpus(5), []
    for k in range(120):
        text = words(rng, 40)
        toxic = k % 2
        if toxic:
            text[5:9] = rng.sample(SLURS, 4)
        rows.append((300 + k, " ".join(text)))
        labels.append((300 + k, 1 - toxic, toxic))
    for k in range(8):
        text = words(rng, 30)
        text[3:7] = rng.sample(SLURS, 4)
        rows.append((900 + k, " ".join(text)))
    return rows, labels


def without_repeated_windows(rows, size=13):
    """(doc_id, words kept) of all rows that keep any or had none."""
    texts = [(i, tuple((t or "").encode().split())) for i, t in rows]
    first = {}
    for i, w in texts:
        for at in range(len(w) - size + 1):
            if i is not None:
                first[w[at:at + size]] = min(i, first.get(w[at:at + size], i))
    out = Counter()
    for i, w in texts:
        gone = set()
        for at in range(len(w) - size + 1):
            if i is not None and first[w[at:at + size]] < i:
                gone.update(range(at, at + size))
        kept = tuple(x for k, x in enumerate(w) if k not in gone)
        if kept or not w:
            out[i, kept] += 1
    return out


def test_every_stage_as_by_brute_force(spark, monkeypatch, tmp_path):
    rows, labels = planted()
    docs = frame(spark, rows, clashes=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    done, plain = [], corpus_pipeline.stage

    def kept(df, label):
        done.append(plain(df, label))
        return done[-1]

    monkeypatch.setattr(corpus_pipeline, "stage", kept)
    corpus_pipeline.run(spark, str(tmp_path))
    clean, single, unrepeated, mixed, packed = [df.collect() for df in done]
    for df in done[:4]:
        assert df.columns == docs.columns
        assert df.select(*CLASHES).distinct().collect() == [("clash",) * len(CLASHES)]

    # Toxicity: what holds a slur goes, labelled or not; everything else stays.
    assert Counter((r.doc_id, r.text) for r in clean) == Counter((i, t) for i, t in rows if "slur" not in (t or ""))

    # Near-duplicates: by all pairs of whole shingle sets.
    rows = [(r.doc_id, r.text) for r in clean]
    stay = {i for i, _, _, kept_ in all_pairs(rows, 5) if kept_}
    want = Counter({(i, t) for i, t in rows if i is not None and i in stay}) + Counter((i, t) for i, t in rows if i is None)
    assert Counter((r.doc_id, r.text) for r in single) == want
    assert len(single) < len(clean)

    # Repeats: windows of 13 words that a smaller id has.
    rows = [(r.doc_id, r.text) for r in single]
    got = Counter((r.doc_id, tuple((r.text or "").encode().split())) for r in unrepeated)
    assert got == without_repeated_windows(rows) and got != Counter((i, tuple((t or "").encode().split())) for i, t in rows)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in unrepeated)

    # Mixing: every source comes to its target by a word for each of its documents, none beyond three times its size.
    size = lambda some: sum(len((r.text or "").encode().split()) for r in some)
    sources = sorted({r.source for r in unrepeated}, key=lambda s: (s is None, s))
    before = [size(r for r in unrepeated if r.source == s) for s in sources]
    for s, target in zip(sources, filled(before, [(5, 2, 1)[k % 3] for k in range(len(sources))])):
        n = sum(r.source == s for r in unrepeated)
        assert abs(size(r for r in mixed if r.source == s) - target) <= 1 + n
    for i in {r.doc_id for r in mixed}:
        assert size(r for r in mixed if r.doc_id == i) <= 3 * size(r for r in unrepeated if r.doc_id == i)

    # Packing: all tokens of the tokenizer, each sequence without gaps and not over its room.
    tokenizer = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tokens = Counter()
    for r in mixed:
        tokens[r.doc_id] += 1 + len(tokenizer.encode(r.text or "", add_special_tokens=False).ids)
    got, sequences = Counter(), {}
    for r in packed:
        got[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert got == tokens
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= 1.05 * sum(tokens.values()) / 1024 + 1


def test_stages_of_an_empty_table(spark):
    docs = frame(spark, [(1, "x")]).limit(0)
    for name, step in corpus_pipeline.STAGES[1:]:
        assert step(spark, docs, SF).count() == 0, name
