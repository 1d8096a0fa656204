"""Continuation counts of the toxicity models are exact, also of words with thousands of contexts."""

import random
from collections import defaultdict

import pyarrow as pa

from lipiflow.llm import toxicity, vector


def test_contexts_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(toxicity.ContextCounter.__init__, "__defaults__", (5_000,))  # several rows of a word from one task
    r, rows, texts_of, seen = random.Random(3), [], defaultdict(set), defaultdict(set)
    for i in range(120):
        w = [x for _ in range(60) for x in (f"w{r.randrange(9_000)}", "common")] + ["common", "rare" if i == 5 else "end"]
        fold, part = i % 2, i % toxicity.PARTS
        rows.append((" ".join(w), fold, part))
        for u, x in zip([None, *w], w):
            texts_of[x].add(i)
            seen[x, fold].add((u, part))
    got = {r.w: r for r in toxicity.counted(spark.createDataFrame(rows, "_text string, _fold int, _part int").repartition(3)).collect()}
    names = [x for x in texts_of if len(texts_of[x]) >= toxicity.LEAST]
    hashes = dict(zip(vector.words(pa.array([" ".join(names)]))[0].view("int64").tolist(), names))
    assert set(got) == set(hashes)
    for h, x in hashes.items():
        for k, m in enumerate(toxicity.MODELS):
            for c, fold in (("t", 0), ("p", 1)):
                assert got[h][f"{c}_{m}"] == len({u for u, part in seen[x, fold] if part != k - 1})
    common = next(got[h] for h, x in hashes.items() if x == "common")
    assert common.t_all > 2_200  # more than marks could tell
