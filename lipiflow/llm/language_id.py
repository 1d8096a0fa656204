"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter trigram is bound from
its letters' vectors, rotated by two, one and no places; a text is the sum
(bundle) of its trigrams; a language is the sum of its training texts.  The
language whose prototype has the largest cosine with the text is predicted.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.llm.common import documents
from lipiflow.llm.toxicity import held_out
from lipiflow.llm.vector import pieces

DIMENSIONS = 1024
SEED = 20_011
NO_LANGUAGE = "und"
#: Texts handled at once.
ROWS = 256

_cache: dict = {}


def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    if "letters" not in _cache:
        _cache["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _cache["letters"]


def letter_vector(code: int) -> np.ndarray:
    if code not in _cache:
        _cache[code] = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIMENSIONS, np.int8) * np.int8(2) - np.int8(1)
    return _cache[code]


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(counts by text and trigram, vectors of the trigrams, letters by text); words are set off by one space."""
    codes = [np.frombuffer(f" {(t or '').lower()} ".encode("utf-32-le", "replace"), np.uint32) for t in texts]
    rows = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    codes = np.concatenate(codes)
    letter = _letters()[codes]
    n_letters = np.bincount(rows, letter, minlength=len(texts))
    codes = np.where(letter, codes, 0)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1] | (rows[1:] != rows[:-1])
    codes, rows = codes[keep], rows[keep]
    alphabet = np.unique(codes)
    place = np.zeros(int(alphabet[-1]) + 1, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    at, n = place[codes], len(alphabet)
    grams = (at[:-2] * n + at[1:-1]) * n + at[2:]
    good = rows[:-2] == rows[2:]
    grams, rows = grams[good], rows[:-2][good]
    if n**3 <= 1 << 24:
        mark = np.zeros(n**3, bool)
        mark[grams] = True
        distinct = np.flatnonzero(mark)
        number = np.zeros(n**3, np.int32)
        number[distinct] = np.arange(len(distinct))
        grams = number[grams]
    else:
        distinct, grams = np.unique(grams, return_inverse=True)
    counts = np.bincount(rows * len(distinct) + grams, minlength=len(texts) * len(distinct)).reshape(len(texts), -1)
    letters = np.stack([letter_vector(int(c)) for c in alphabet])
    bound = np.roll(letters, 2, 1)[distinct // (n * n)] * np.roll(letters, 1, 1)[distinct // n % n] * letters[distinct % n]
    return counts.astype(np.float32), bound.astype(np.float32), n_letters


def _bundles(batches):
    """Sums of the training texts' vectors by language, one row per language and task."""
    import pyarrow as pa

    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for piece in pieces(batch, "_text", ROWS):
            counts, bound, _ = _trigrams(piece.column("_text").to_pylist())
            names, which = np.unique(piece.column("_lang").to_pylist(), return_inverse=True)
            by_lang = np.zeros((len(names), counts.shape[1]), np.float32)
            np.add.at(by_lang, which, counts)
            for name, vector in zip(names.tolist(), (by_lang @ bound).astype(float)):
                sums[name] = sums.get(name, 0) + vector
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "bundle"])


def prototypes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Language names and unit vectors, learned from all rows not held out; their number is that of the languages."""
    rows = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sums = rows.select(F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).mapInArrow(_bundles, "lang string, bundle array<double>")
    sums = sums.select("lang", F.posexplode("bundle").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v"))
    sums = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "v"))).alias("v")).orderBy("lang").select("lang", "v.v").collect()
    names = [r.lang for r in sums]
    vectors = np.array([r.v for r in sums], float).reshape(len(names), DIMENSIONS)
    return names, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def _predict(model):
    def run(batches):
        import pyarrow as pa

        names, vectors = model.value
        vectors = vectors.T.astype(np.float32)
        for batch in batches:
            for piece in pieces(batch, "_text", ROWS):
                counts, bound, n_letters = _trigrams(piece.column("_text").to_pylist())
                texts = counts @ bound
                cosine = texts @ vectors / np.maximum(np.linalg.norm(texts, axis=1, keepdims=True), 1e-9)
                known = (n_letters > 0) & bool(names)
                best = cosine.argmax(axis=1) if names else np.zeros(len(texts), int)
                lang = [names[i] if k else NO_LANGUAGE for i, k in zip(best, known)]
                score = np.where(known, np.clip(cosine.max(axis=1, initial=0), 0, 1), 0).astype(float)
                yield pa.RecordBatch.from_arrays([piece.column("_id"), piece.column("_held"), pa.array(lang, pa.string()), pa.array(score)], ["_id", "_held", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score (cosine, not below 0).

    Null texts and texts without a letter get ``und`` and score 0, as does every
    text when there is nothing to learn from; null languages teach nothing.  Of
    equal cosines the first language by code point wins.  Repeated rows are
    predicted alike; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(prototypes(docs, id_col, text_col, lang_col))
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("_held"), F.col(text_col).alias("_text"))
    out = rows.mapInArrow(_predict(model), f"_id {kind}, _held boolean, lang_pred string, score double")
    return out.select(F.col("_id").alias(id_col), F.col("_held").alias("held_out"), "lang_pred", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(documents(spark, sf_dir).select("doc_id", "text", "lang"))
