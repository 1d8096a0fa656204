"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Word trigrams of the test items are looked up in every text, and all that a text
shares with an item are seeds, however often they occur elsewhere: which of an
item's trigrams an edited copy keeps doesn't depend on how many texts hold them.
Around the seeds the passage is aligned with the item, so edited and paraphrased
copies score by what they keep; passages with too few of the item's words to reach
the score are passed over.

Items are taken in blocks with a bounded number of trigrams; a block is broadcast
and met by all texts, so no text moves between executors.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lipiflow.llm.common import documents, running_total, stage
from lipiflow.llm.vector import find, mix, pieces, words

SEED_WORDS = 3
MATCH, MISMATCH, SPACE = 2, -1, -1
#: Alignments of this part of the best possible score and more are leaks.
LEAK = 0.5
BLOCK_TRIGRAMS = 500_000
MARKS = 1 << 22


def grams(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of every run of n words within a row."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(hashes) - n + 1
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x100000001B3) + hashes[k : k + count]
    at = np.flatnonzero(rows[:count] == rows[n - 1 :])
    return mix(out[at]), at


def align(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman: best local score and the passage position after its end."""
    places = np.arange(1, len(passage) + 1)
    row = np.zeros(len(passage) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        new = np.maximum(np.maximum(row[:-1] + step, row[1:] + SPACE), 0)
        new = np.maximum.accumulate(new - SPACE * places) + SPACE * places
        row = np.concatenate([[0], new])
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _block(items: list) -> tuple:
    """Sorted trigrams with the (item, position) pairs that hold them, and the items' words."""
    import pyarrow as pa

    hashes, rows, *_ = words(pa.array([r["_item_text"] for r in items], pa.string()))
    ends = np.searchsorted(rows, np.arange(len(items) + 1))
    keys, at = grams(hashes, rows, SEED_WORDS)
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    table, first = np.unique(keys, return_index=True)
    marks = np.zeros(MARKS, bool)
    marks[(table & np.uint64(MARKS - 1)).astype(np.int64)] = True
    return table, np.append(first, len(keys)), rows[at], at - ends[rows[at]], [hashes[a:b] for a, b in zip(ends, ends[1:])], marks


def _hits(block, hashes, rows):
    """(position, trigram number) of all block trigrams in the words."""
    table, marks = block[0], block[5]
    keys, at = grams(hashes, rows, SEED_WORDS)
    maybe = np.flatnonzero(marks[(keys & np.uint64(MARKS - 1)).astype(np.int64)])
    number = find(table, keys[maybe])
    return at[maybe][number >= 0], number[number >= 0]


def _passages(at: np.ndarray, offset: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Word ranges around seed hits; hits further apart than an item are passages of their own."""
    starts = np.sort(at - offset)
    cuts = np.flatnonzero(np.diff(starts) > length) + 1
    slack = max(4, length // 2)
    return [(int(part[0]) - slack, int(part[-1]) + length + slack) for part in np.split(starts, cuts)]


def _leaks(shared, leak: float):
    def run(batches):
        import pyarrow as pa

        block, names = shared.value
        _, first, items, offsets, texts, _ = block
        known = [np.unique(t) for t in texts]
        for batch in batches:
            out = []
            for piece in pieces(batch, "_text"):
                hashes, rows, *_ = words(piece.column("_text"))
                borders = np.searchsorted(rows, np.arange(piece.num_rows + 1))
                at, number = _hits(block, hashes, rows)
                # Each hit becomes one row for every item that has the trigram.
                n = first[number + 1] - first[number]
                each = np.repeat(np.arange(len(number)), n)
                entry = first[number][each] + np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                item, row = items[entry], rows[at[each]]
                order = np.lexsort((item, row))
                pair = row[order] * len(texts) + item[order]
                starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else []
                for group in np.split(order, starts[1:]) if len(pair) else []:
                    i, r = int(item[group[0]]), int(row[group[0]])
                    goal, low, high = texts[i], borders[r], borders[r + 1]
                    best = (0, 0)
                    for a, b in _passages(at[each[group]], offsets[entry[group]], len(goal)):
                        a, b = max(a, low), min(b, high)
                        if np.count_nonzero(find(known[i], hashes[a:b]) >= 0) < leak * len(goal):
                            continue  # even if all these words match, the score is less
                        score, end = align(hashes[a:b], goal)
                        best = max(best, (score, a + end - low))
                    score = best[0] / (MATCH * len(goal))
                    if score >= leak:
                        out.append((piece.column("_id")[r].as_py(), names[i], score, best[1], len(group)))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.column("_id").type), pa.array(cols[1], names_type(names)), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], ["_id", "_item", "score", "end_word", "seeds"])

    return run


def names_type(names: list):
    import pyarrow as pa

    return pa.string() if any(isinstance(n, str) for n in names) else pa.int64()


def leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", leak: float = LEAK) -> DataFrame:
    """One row per text and test item that it holds: id, item id, score, end_word, seeds.

    ``score`` is the alignment's part of the best possible score; ``end_word`` is
    the word after the aligned passage; ``seeds`` counts seed hits.  Null texts are
    empty and hold nothing.  Items without SEED_WORDS words, null ones included,
    have no seed and are not searched; equal items are found each on its own.
    Repeated rows are reported each.  An empty table on either side gives no row.
    Other columns of either table are ignored.
    """
    spark = docs.sparkSession
    items = items.select(F.col(item_col).alias("_item"), F.col(item_text_col).alias("_item_text")).filter("_item_text is not null")
    items = running_total(items.withColumn("_size", F.length("_item_text").cast("long")), [], ["_item", "_item_text"], "_size", "leak-items")
    items = stage(items.withColumn("_block", F.floor(F.col("before") / BLOCK_TRIGRAMS)), "leak-blocks")
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind, item_kind = dict(texts.dtypes)["_id"], dict(items.dtypes)["_item"]
    schema = f"_id {kind}, _item {'string' if item_kind == 'string' else 'long'}, score double, end_word long, seeds long"
    found = []
    for (number,) in items.select("_block").distinct().orderBy("_block").toLocalIterator():
        rows = items.filter(F.col("_block") == number).select("_item", "_item_text").collect()  # at most BLOCK_TRIGRAMS characters and an item
        block = _block(rows)
        if not len(block[0]):
            continue
        model = spark.sparkContext.broadcast((block, [r["_item"] for r in rows]))
        found.append(stage(texts.mapInArrow(_leaks(model, leak), schema), "leaks"))
    if not found:
        return spark.createDataFrame([], schema).select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), "score", "end_word", "seeds")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), "score", "end_word", "seeds")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
