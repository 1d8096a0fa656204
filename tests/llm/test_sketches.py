"""Sketches of shingle sets: bounds that lose no similar pair, and few sets that move."""

import random

import numpy as np
import pytest

from lipiflow.llm import simhash_dedup


@pytest.mark.parametrize("size", (0, 1, 5, 63, 300, 5_000))
def test_sketches_bound_shared_shingles(size):
    r = np.random.Generator(np.random.PCG64(size))
    for part in (0.0, 0.5, 0.9, 1.0):
        x = np.unique(r.integers(0, 1 << 64, size, np.uint64, endpoint=False))
        y = np.unique(np.concatenate([x[: int(part * len(x))], r.integers(0, 1 << 64, int(size * 0.7), np.uint64)]))
        a, b = simhash_dedup.sketch(x), simhash_dedup.sketch(y)
        assert a.sum() == len(x) and b.sum() == len(y)
        assert simhash_dedup.most_shared(a, b) >= len(np.intersect1d(x, y))
    if size >= 300:  # and tell unrelated sets from similar ones
        y = np.unique(r.integers(0, 1 << 64, size, np.uint64))
        assert simhash_dedup.most_shared(simhash_dedup.sketch(x), simhash_dedup.sketch(y)) < 0.85 * size


def test_only_sets_that_may_be_similar_move(make, monkeypatch):
    """Texts share a passage of 12 words, whose shingles are in their prefixes, but are not near copies."""
    r = random.Random(7)
    words = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    shared, texts = words(12), {}
    for i in range(60):
        own = words(80)
        texts[i] = " ".join(own[:40] + shared + own[40:])
    near = texts[7].split()
    texts[60] = " ".join([*near[:-2], "x", "y"])
    moved, stage = {}, simhash_dedup.stage

    def counted(df, name, **how):
        table = stage(df, name, **how)
        moved[name] = moved.get(name, 0) + table.count()
        return table

    monkeypatch.setattr(simhash_dedup, "stage", counted)
    got = {r.doc_id: r.component_id for r in simhash_dedup.near_duplicates(make(texts)).collect()}
    assert got == {i: 7 if i == 60 else i for i in texts}
    assert moved["near-content"] <= 4 and moved["near-able"] <= 4
