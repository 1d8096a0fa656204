"""Shared plumbing of the training-data operators: stage tables, skew-safe joins, totals, components.

Lineage is cut by writing a table into the folder that all executors share
(``spark.checkpoint.dir``), never by keeping blocks on executors, so a lost
executor costs a re-read and nothing else.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of at most this many rows may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 50_000
#: The same for tables of one id and at most one number, about 32 bytes a row in memory.
BROADCAST_IDS = 300_000
#: Keys holding over 1/HOT_PARTS of all rows are joined by broadcast.  By the
#: pigeonhole principle there are fewer than HOT_PARTS of them, whatever the data.
HOT_PARTS = 1_000
#: Edges whose components one task may find, 16 bytes each and their ids.
FOREST_EDGES = 1_000_000
#: Bits of a bitmap per marked key, and at most (32 MiB, broadcast).  A fuller bitmap only lets more rows through.
KEY_BITS, MOST_BITS = 16, 1 << 28
SLICE_BITS = 32_768  # of Spark's bitmap functions


def stage_root(spark: SparkSession) -> str:
    """The shared folder for stage tables; a local one only where none is configured and all runs in one process (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="lipiflow-stage-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/lipiflow-{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, *, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` into the shared folder and read it back."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.stage_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove stage tables that nothing to be computed reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.stage_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_stages(spark: SparkSession) -> None:
    """Remove this application's stage tables, once their results have been written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(stage_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def join_small(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a table that is usually tiny: broadcast it if its rows are few, else shuffle."""
    few = right.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if few else right, on, how)


def join_by_size(rows: DataFrame, table: DataFrame, key: str, how: str) -> DataFrame:
    """Join texts to a stage table of ids: broadcast up to BROADCAST_IDS rows, shuffled beyond."""
    few = table.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return rows.join(F.broadcast(table) if few else table, key, how)


def without_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows of these ids; rows of a null id stay."""
    return join_by_size(docs, stage(ids.distinct(), "dropped-ids"), key, "left_anti")


def marks(keys: DataFrame, key: str, name: str) -> tuple[DataFrame, int]:
    """A bitmap of hashed ``keys`` as a stage table of slices, sized by their number, and its bits."""
    wanted = KEY_BITS * keys.count()
    bits = min(MOST_BITS, max(SLICE_BITS, 1 << wanted.bit_length()))
    slot = F.pmod(F.xxhash64(key), F.lit(bits)).cast("long")
    slices = keys.select((slot / SLICE_BITS).cast("long").alias("_slice"), F.pmod(slot, F.lit(SLICE_BITS)).alias("_bit"))
    return stage(slices.groupBy("_slice").agg(F.bitmap_construct_agg("_bit").alias("_bits")), name), bits


def marked(rows: DataFrame, key: str, bitmap: tuple[DataFrame, int], flag: str) -> DataFrame:
    """Add ``flag``: whether the bit of ``key`` is set, which it is for every key in the bitmap and few others."""
    slices, bits = bitmap
    slot = F.pmod(F.xxhash64(key), F.lit(bits)).cast("long")
    rows = rows.withColumn("_slice", (slot / SLICE_BITS).cast("long")).withColumn("_at", F.pmod(slot, F.lit(SLICE_BITS)).cast("int"))
    rows = rows.join(F.broadcast(slices), "_slice", "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.expr("_at div 8 + 1"), F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, _at % 8) & 1 = 1")
    return rows.withColumn("_byte", byte).withColumn(flag, F.coalesce(bit, F.lit(False))).drop("_slice", "_at", "_bits", "_byte")


def join_skewed(rows: DataFrame, table: DataFrame, key: str, count: str, total: int, spread: Column, hint: str | None = None) -> DataFrame:
    """Left join ``rows`` to ``table`` (unique ``key``) when a few keys hold most rows.

    ``table[count]`` is how many rows carry the key.  Keys over ``total / HOT_PARTS``
    rows number fewer than HOT_PARTS and are broadcast; their rows then travel
    under a filler that spreads them evenly, all others meet by key.  Both
    tables should be stage tables, as each is read once per branch.
    """
    values = [c for c in table.columns if c != key]
    limit = max(1, total // HOT_PARTS)
    hot = table.filter(F.col(count) > limit).select(F.col(key).alias("_hot"), F.struct(*values).alias("_h"))
    cold = table.filter(F.col(count) <= limit).select(F.col(key), F.lit(0).cast("long").alias("_fill"), F.struct(*values).alias("_c"))
    out = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    out = out.withColumn("_fill", F.when(F.col("_h").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(spread).bitwiseOR(F.lit(1).cast("long"))))
    out = out.join(cold.hint(hint) if hint else cold, [key, "_fill"], "left").withColumn("_v", F.coalesce("_h", "_c"))
    return out.select(*rows.columns, *[F.col(f"_v.{c}").alias(c) for c in values])


def running_total(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add ``before``: the sum of ``value`` over earlier rows of the same group.

    Rows are dealt into sorted ranges, each range adds up its own rows, and one
    row per (range, group) carries the offset on.  No task holds a whole group.
    The ranges are staged, so every later read sees the same split.
    """
    spark = df.sparkSession
    n = shuffle_parts(spark)
    cols = [*group, *order]
    fields = df.schema

    def add_up(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        part, last, total = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            keys = list(zip(*[batch.column(g).to_pylist() for g in group])) if group else [()] * batch.num_rows
            before = []
            for key, v in zip(keys, pc.fill_null(batch.column(value), 0).to_pylist()):
                if key != last:
                    last, total = key, 0
                before.append(total)
                total += v
            table = pa.Table.from_batches([batch])
            table = table.append_column("_part", pa.array([part] * batch.num_rows, pa.int32())).append_column("before", pa.array(before, pa.int64()))
            yield from table.to_batches()

    from pyspark.sql import types as T

    out = T.StructType([*fields.fields, T.StructField("_part", T.IntegerType()), T.StructField("before", T.LongType())])
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols).mapInArrow(add_up, out)
    ranged = stage(ranged, name)
    sums = ranged.groupBy(*group, "_part").agg(F.sum(F.coalesce(F.col(value), F.lit(0))).alias("_sum"))
    if group:
        sums = sums.withColumn("_key", F.xxhash64(*group, *[F.col(g).isNull() for g in group]))
    else:
        sums = sums.withColumn("_key", F.lit(0).cast("long"))
    from pyspark.sql import Window

    w = Window.partitionBy(*(group or ["_key"])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_key", "_part", F.coalesce(F.sum("_sum").over(w), F.lit(0)).alias("_offset"))
    offsets = stage(offsets, f"{name}-offsets")
    ranged = ranged.withColumn("_key", F.xxhash64(*group, *[F.col(g).isNull() for g in group]) if group else F.lit(0).cast("long"))
    joined = join_small(ranged, offsets, ["_key", "_part"])
    return joined.select(*df.columns, (F.col("before") + F.coalesce("_offset", F.lit(0))).alias("before"))


def lowest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node reachable from each of n nodes over the edges (a, b)."""
    label = np.arange(n)
    while True:
        far = label[a] != label[b]
        if not far.any():
            return label
        a, b = a[far], b[far]
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]


def _forest(batches):
    """(a, b): every id of the edges met, FOREST_EDGES at a time, with the smallest id it reaches by these."""
    import pyarrow as pa

    def joined(parts: list):
        table = pa.Table.from_batches(parts)
        ends = np.concatenate([table.column(c).to_numpy() for c in ("a", "b")])
        ids, at = np.unique(ends, return_inverse=True)
        low = lowest(at[: len(table)], at[len(table) :], len(ids))
        kind = table.schema.field("a").type
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(ids[low], kind)], ["a", "b"])

    parts, held = [], 0
    for batch in batches:
        parts, held = [*parts, batch], held + batch.num_rows
        if held >= FOREST_EDGES:
            yield from joined(parts)
            parts, held = [], 0
    if held:
        yield from joined(parts)


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(id, component)``, component = smallest id reachable.

    Each task first replaces the edges it holds by those of a forest that connects
    the same ids.  If fewer than FOREST_EDGES are left, one task joins these.  Else
    large-star and small-star steps alternate, each one narrow shuffle with
    map-side minima, until no edge changes; every round is a stage table.  Ids
    without an edge do not occur.  Self-loops and repeated edges are harmless.
    """
    kind = dict(edges.dtypes)["a"]
    e = edges.select("a", "b").filter("a <> b").mapInArrow(_forest, f"a {kind}, b {kind}")
    e = stage(e, f"{name}-forest")
    if e.limit(FOREST_EDGES + 1).count() < FOREST_EDGES:
        return e.coalesce(1).mapInArrow(_forest, f"a {kind}, b {kind}").select(F.col("a").alias("id"), F.col("b").alias("component"))
    e = stage(e.filter("a > b").distinct(), f"{name}-edges")
    seen = None
    while True:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("n"))
        least = stage(least, f"{name}-least")
        large = join_skewed(both.filter("b > a"), least, "a", "n", 2 * e.count(), F.col("b"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()
        large = stage(large, f"{name}-large")
        least = stage(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), f"{name}-least")
        small = join_skewed(large, least, "a", "n", large.count(), F.col("b"))
        small = small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        e = stage(small.filter("a > b").distinct(), f"{name}-small")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.lit(0)).alias("h")).first()
        if seen == (now.n, now.h):
            break
        seen = (now.n, now.h)
    heads = e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(heads)
