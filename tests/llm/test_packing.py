import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seriema.llm import packing
from tests.llm.corpora import corpus, frame


def test_pieces_and_places(spark):
    rows = corpus(3) + [(95, "a <|endoftext|> b"), (96, "日本語   ﷺ 👩‍🚀"), (97, "it's 10% — ½ ²")]
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want.update((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    out = packing.pack(frame(spark, rows, clashes=True), keep_ids=True).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    assert all(zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 for r in out)
    ends = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024
    assert len(ends) <= sum(r.length for r in out) / 1024 + 2


def test_the_plan_uses_every_piece_once():
    rng = random.Random(4)
    for top in (5, 60, 100):
        counts = Counter(rng.randrange(1, top + 1) for _ in range(2_000))
        plan = packing.minimum_bin_slack(counts, 100)
        used = Counter()
        for chosen, times in plan:
            assert sum(chosen) <= 100
            for n in chosen:
                used[n] += times
        assert used == counts and len(plan) <= 100
        bins = sum(t for _, t in plan)
        assert bins <= 1.05 * sum(n * c for n, c in counts.items()) / 100 + 2 or top == 100
    assert packing.minimum_bin_slack({}) == []


@pytest.mark.parametrize("seed", range(20))
def test_the_fullest_choice_is_the_best(seed):
    rng = random.Random(seed)
    items = [rng.randrange(1, 30) for _ in range(8)]
    room = rng.randrange(5, 80)
    counts = Counter(items)
    best = max(s for s in (sum(x for k, x in enumerate(items) if m >> k & 1) for m in range(256)) if s <= room)
    got = packing.fullest(counts, sorted(counts, reverse=True), room)
    assert sum(got) == best and not Counter(got) - counts


def test_empty_table(spark):
    assert packing.pack(frame(spark, [(1, "x")]).limit(0)).count() == 0
