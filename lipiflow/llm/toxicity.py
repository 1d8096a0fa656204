"""Toxicity by two class-conditional Kneser-Ney models, one of toxic and one of ordinary text.

As in the lower order of Kneser-Ney, a word's count is the number of distinct words
it follows, so copies of a text count once.  It is absolutely discounted and
interpolated with the backoff ``S`` that both classes share, made of their pooled
counts; ``share`` is the mass that discounting set free:

    P(w) = max(n(w) - D(w), 0) / N + share * S(w)

The discount is the part of a count that the pooled counts explain, and the whole
count where what is left may be chance, so a rare expression falls back on the
shared counts and says nothing.
Numbers of contexts grow slower than texts, so classes of unequal size can't be
compared by them: ordinary texts are dealt into folds of as many texts as the toxic
class, contexts are counted by fold, and the class's counts are the folds' sums.

A text's evidence is its toxic minus its ordinary log-likelihood over its number of
words.  A monotone fit turns it into a probability; for it labelled texts are dealt
into parts, and each is scored by the models of all parts but its own.

Counts cover all labelled rows and stay tables.  Only expressions with evidence are
sent to the executors, a part at a time if there are many.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.llm.common import documents, join_by_size, stage
from lipiflow.llm.vector import find, mix, pieces, words

#: Texts that hold a word of the models, at least: a word of one text tells that text, not a class.
LEAST = 2
#: Folds of ordinary texts, at most.
MOST_FOLDS = 64
#: A count beyond what the pooled counts explain stands if its log-likelihood under them (Poisson's, by
#: Chernoff's bound) is below minus this many times the logarithm of the number of words.
SURE = 0.75
#: Labelled rows that the probability is fitted on; of more, those with the smallest hash of their id.
MOST_FITTED = 200_000
#: Expressions with evidence that are broadcast at once (28 bytes each).
MODEL_ROWS = 4_000_000
THRESHOLD = 0.7

START = np.uint64(0x5851F42D4C957F2D)  # the word before a text
#: Models of all labelled texts, and for each part of them the models without it.
PARTS = 4
MODELS = ("all", *[f"no{k}" for k in range(PARTS)])


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(False))


def _labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(_id, _toxic, _part) of the labelled rows to learn from."""
    labels = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_toxic")).filter("_toxic in (0, 1) and _id is not null")
    labels = labels.groupBy("_id").agg(F.max("_toxic").alias("_toxic")).filter(~held_out("_id"))
    return stage(labels.withColumn("_part", F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(PARTS)).cast("int")), "toxic-labels")


def lefts(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The word before each word."""
    out = np.full(len(hashes), START, np.uint64)
    if len(hashes) > 1:
        out[1:] = np.where(rows[1:] == rows[:-1], hashes[:-1], START)
    return out


class ContextCounter:
    """The distinct words before each word by slot (fold and part), and texts."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.parts, self.size = most, [], 0

    def add(self, w, slot, left, texts) -> None:
        self.parts.append(self._grouped(w, slot, left, texts))
        self.size += len(self.parts[-1][0])

    @staticmethod
    def _grouped(w, slot, left, texts):
        if not len(w):
            return w, slot, left, texts
        order = np.lexsort((left, slot, w))
        w, slot, left = w[order], slot[order], left[order]
        at = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (slot[1:] != slot[:-1]) | (left[1:] != left[:-1])]))
        return w[at], slot[at], left[at], np.add.reduceat(texts[order], at)

    def merge(self) -> None:
        if len(self.parts) > 1:
            self.parts = [self._grouped(*map(np.concatenate, zip(*self.parts)))]
            self.size = len(self.parts[0][0])

    def full(self) -> bool:
        if self.size > self.most:
            self.merge()
        return self.size > self.most // 2

    def take(self) -> list[np.ndarray]:
        self.merge()
        out = self.parts[0] if self.parts else [np.zeros(0, k) for k in (np.uint64, np.int32, np.uint64, np.int64)]
        self.parts, self.size = [], 0
        return out


def _count_contexts(batches):
    """A row per word and slot: the distinct words before it, and how many texts hold it."""
    import pyarrow as pa

    counts = ContextCounter()

    def out():
        w, slot, left, texts = counts.take()
        new = np.ones(len(w), bool)
        new[1:] = (w[1:] != w[:-1]) | (slot[1:] != slot[:-1])
        at = np.flatnonzero(new)
        sums = np.add.reduceat(texts, at) if len(at) else texts
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(w)).astype(np.int32)), pa.array(left.view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(w[at].view(np.int64)), pa.array(slot[at]), lists, pa.array(sums)], ["w", "slot", "lefts", "texts"])

    for batch in batches:
        for piece in pieces(batch, "_text"):
            hashes, rows, *_ = words(piece.column("_text"))
            fold, part = (piece.column(c).to_numpy()[rows].astype(np.int32) for c in ("_fold", "_part"))
            order = np.lexsort((rows, hashes))
            first = np.ones(len(order), bool)  # of its word in its text
            first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (rows[order][1:] != rows[order][:-1])
            counts.add(hashes[order], (fold * PARTS + part)[order], lefts(hashes, rows)[order], first.astype(np.int64))
            if counts.full():
                yield out()
    yield out()


def _contexts(mask: Column) -> Column:
    """How many distinct words leave these marks in 64 groups (linear counting); an estimate that no count rests on any more."""
    empty = F.greatest(64 - F.bit_count(mask), F.lit(8))
    return F.round(F.log(F.lit(64.0) / empty) * 64, 2)


def counted(texts: DataFrame) -> DataFrame:
    """A row per word of LEAST texts: w, and for each model and class (t, p) the sum over folds of its distinct contexts, from (_text, _fold, _part).

    A word's contexts all meet in one task, where every pair of words is counted once for each fold and set of parts.
    """
    rows = texts.select("_text", "_fold", "_part").mapInArrow(_count_contexts, "w long, slot int, lefts array<long>, texts long")
    rows = rows.repartition("w").select("w", "slot", "texts", F.posexplode("lefts").alias("at", "left"))
    bit = F.call_function("shiftleft", F.lit(1), F.pmod("slot", F.lit(PARTS)))
    pairs = rows.groupBy("w", F.expr(f"slot div {PARTS}").alias("fold"), "left").agg(F.bit_or(bit).alias("parts"), F.sum(F.when(F.col("at") == 0, F.col("texts")).otherwise(0)).alias("texts"))
    every = (1 << PARTS) - 1
    within = (every, *[every ^ 1 << k for k in range(PARTS)])
    sums = [F.count_if(own & (F.col("parts").bitwiseAND(x) != 0)).cast("double").alias(f"{c}_{m}") for m, x in zip(MODELS, within) for c, own in (("t", F.col("fold") == 0), ("p", F.col("fold") > 0))]
    words = pairs.groupBy("w").agg(F.sum("texts").alias("texts"), *sums)
    return stage(words.filter(F.col("texts") >= LEAST).drop("texts"), "toxic-words")


def _excess(n: Column, expected: Column, least: Column) -> Column:
    """A count less its discount: what goes beyond the expected count, if that is no chance."""
    sure = (n > expected) & (n * F.log(n / F.greatest(expected, F.lit(1e-12))) - n + expected >= least)
    return F.when(sure, n - expected).otherwise(0.0)


def models(counts: DataFrame) -> DataFrame:
    """(key, all, no0, ...): the evidence of words in each model, 0 for all others."""
    seen = lambda m: F.col(f"t_{m}") + F.col(f"p_{m}") > 0
    total = counts.agg(*[F.sum(c).alias(c) for c in counts.columns[1:]], *[F.count_if(seen(m)).alias(f"n_{m}") for m in MODELS]).first().asDict()
    known = [m for m in MODELS if total[f"t_{m}"] and total[f"p_{m}"]]
    if not known:
        return counts.select(F.col("w").alias("key"), *[F.lit(0.0).alias(m) for m in MODELS]).limit(0)
    shared, excess = {}, []
    for m in known:
        n = {c: total[f"{c}_{m}"] for c in "tp"}
        shared[m] = (F.col(f"t_{m}") + F.col(f"p_{m}")) / (n["t"] + n["p"])
        least = F.lit(SURE * math.log(max(2, total[f"n_{m}"])))
        excess += [_excess(F.col(f"{c}_{m}"), shared[m] * n[c], least).alias(f"x_{c}_{m}") for c in "tp"]
    # Words without excess have the same probability in both but for the shares, which is no evidence.
    some = counts.select("*", *excess).filter(" or ".join(f"x_{c}_{m} > 0" for m in known for c in "tp"))
    some = stage(some, "toxic-excess")
    freed = some.agg(*[F.coalesce(F.sum(f"x_{c}_{m}"), F.lit(0.0)).alias(f"{c}_{m}") for m in known for c in "tp"]).first().asDict()
    values = []
    for m in MODELS:
        if m not in known:
            values.append(F.lit(0.0).alias(m))
            continue
        n = {c: total[f"{c}_{m}"] for c in "tp"}
        share = {c: 1 - freed[f"{c}_{m}"] / n[c] for c in "tp"}
        p = {c: F.col(f"x_{c}_{m}") / n[c] + F.lit(share[c]) * shared[m] for c in "tp"}
        says = F.col(f"x_t_{m}") + F.col(f"x_p_{m}") > 0
        values.append(F.when(says, F.log(p["t"] / p["p"]) - math.log(share["t"] / share["p"])).otherwise(0.0).alias(m))
    return stage(some.select(F.col("w").alias("key"), *values), "toxic-model")


def _evidence(model):
    """Per text and model: the sum over its words of toxic minus ordinary log-likelihood, and its words."""

    def run(batches):
        import pyarrow as pa

        keys, values = model.value
        for batch in batches:
            for piece in pieces(batch, "_text"):
                hashes, rows, *_ = words(piece.column("_text"))
                at = find(keys, hashes)
                hit = at >= 0
                sums = [np.bincount(rows[hit], v[at[hit]], minlength=piece.num_rows).astype(float) for v in values]
                n = np.bincount(rows, minlength=piece.num_rows).astype(np.int64)
                keep = [x for x in piece.schema.names if x != "_text"]
                yield pa.RecordBatch.from_arrays([*[piece.column(x) for x in keep], pa.array(n), *[pa.array(s) for s in sums]], [*keep, "_n", *MODELS])

    return run


def evidence(texts: DataFrame, model: DataFrame, name: str) -> DataFrame:
    """``texts(_id, _text)`` without the text, with its words ``_n`` and each model's evidence per word (0 without words)."""
    spark = texts.sparkSession
    kind = dict(texts.dtypes)["_id"]
    parts = -(-model.count() // MODEL_ROWS) or 1
    rows = texts.select(F.monotonically_increasing_id().alias("_row"), "_id", "_text") if parts > 1 else texts.select("_id", "_text")
    keep = ["_row"] * (parts > 1) + ["_id"]
    schema = ", ".join(["_row long"] * (parts > 1) + [f"_id {kind}", "_n long", *[f"{m} double" for m in MODELS]])
    out = None
    for part in range(parts):
        table = model.filter(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).toArrow().sort_by("key")
        keys = np.asarray(table["key"].to_numpy(), np.int64).view(np.uint64)
        order = np.argsort(keys)
        shared = spark.sparkContext.broadcast((keys[order], [np.asarray(table[m].to_numpy(), np.float32)[order] for m in MODELS]))
        scored = stage(rows.mapInArrow(_evidence(shared), schema), name)
        out = scored if out is None else out.union(scored)
    if parts > 1:
        out = out.groupBy(*keep, "_n").agg(*[F.sum(m).alias(m) for m in MODELS])
    return out.select("_id", "_n", *[(F.col(m) / F.greatest("_n", F.lit(1))).alias(m) for m in MODELS])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[DataFrame | None, DataFrame]:
    """The models (see ``models``; none if a class has no text), and the labelled rows."""
    labels = _labelled(labels, id_col, label_col)
    n = {r["_toxic"]: r["count"] for r in labels.groupBy("_toxic").count().collect()}
    if len(n) < 2:
        return None, labels
    folds = max(1, min(MOST_FOLDS, round(n[0] / n[1])))
    fold = F.when(F.col("_toxic") == 1, 0).otherwise(F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(folds)) + 1).cast("int")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = join_by_size(texts, labels.withColumn("_fold", fold), "_id", "inner").select("_text", "_fold", "_part")
    return models(counted(texts)), labels


def _monotone(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the best non-decreasing fit of y on x (pool adjacent violators): both ends of every level."""
    values, which = np.unique(x, return_inverse=True)
    blocks: list[list[float]] = []  # first x, last x, sum of y, rows
    for a, total, n in zip(values, np.bincount(which, y), np.bincount(which)):
        blocks.append([a, a, total, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    knots = [(end, (total + 0.02) / (n + 1)) for first, last, total, n in blocks for end in dict.fromkeys((first, last))]
    return np.array([k[0] for k in knots]), np.maximum.accumulate([k[1] for k in knots])


def _probability(value: Column, x: np.ndarray, y: np.ndarray) -> Column:
    """The monotone fit, straight between its levels."""
    at, p = _monotone(x, y)
    knots, probs = F.array(*[F.lit(float(v)) for v in at]), F.array(*[F.lit(float(v)) for v in p])
    i = F.size(F.filter(knots, lambda k: k <= value))
    low, high = F.get(knots, i - 1), F.get(knots, i)
    a, b = F.get(probs, i - 1), F.get(probs, i)
    fitted = F.when(i == 0, F.get(probs, F.lit(0))).when(i == len(at), F.get(probs, F.lit(len(at) - 1))).otherwise(a + (b - a) * (value - low) / (high - low))
    return F.least(F.greatest(fitted, F.lit(0.0)), F.lit(1.0)) * 0.999 + 0.001 / (1 + F.exp(-10 * value))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted.

    Null and empty texts, and texts of words that say nothing, have evidence 0.  Null
    labels and others than 0 and 1 are ignored, an id labelled twice is toxic if one
    label says so, rows that occur twice are scored twice.  Without labels of both
    classes every score is 0.  Labels of rows held out are never read; an empty
    table gives no rows.  Other columns of ``docs`` and ``labels`` are ignored.
    """
    model, labels = fit(docs, labels, id_col, text_col, label_col)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    fitted = F.lit(0.0)
    if model is None:
        values = texts.select("_id")
    else:
        values = evidence(texts, model, "toxic-evidence")
        sample = stage(labels.orderBy(F.xxhash64("_id"), "_id").limit(MOST_FITTED), "toxic-fitted")
        own = F.element_at(F.array(*MODELS[1:]), F.col("_part") + 1)
        # Repeated rows of an id are one row of the fit.
        seen = join_by_size(values, sample, "_id", "inner").groupBy("_id").agg(F.max(own).alias("x"), F.max("_toxic").alias("y")).select("x", "y").toArrow()
        x, y = np.asarray(seen["x"].to_numpy(), float), np.asarray(seen["y"].to_numpy(), float)
        if len(set(y.tolist())) == 2:
            fitted = _probability(F.col("all"), x, y)
    out = values.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), fitted.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
