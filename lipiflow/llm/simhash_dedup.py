"""SimHash near-dedup with vantage-point trees.

``hamming_edges`` links fingerprints that differ in at most RADIUS bits.  A tree
of vantage points, grown on a bounded sample, deals the fingerprints to shards:
those within a node's distance of its vantage point go inside, the others
outside, and by the triangle inequality only fingerprints from the last RADIUS
distances inside can be near one outside, so these alone go to both.  Every
linked pair thus meets in a shard.  A shard goes on the same way until few
fingerprints are left, which are compared one with another.  A shard yields, for
each connected lump of it, links to the lump's first member: as many links as
members, however dense the lump, and the same components.

Where splitting doesn't part a lump (a ball of fingerprints nearer to each other
than any vantage point can tell), its links come from an exact rule instead: two
fingerprints are within two bits if and only if some value is within one bit of
both.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lipiflow.llm.common import BROADCAST_IDS, components, discard, documents, join_skewed, join_small, marked, marks, stage
from lipiflow.llm.vector import Counter, find, mix, pieces, words

RADIUS = 2
#: Fingerprints per shard, and sample rows the tree is grown on.
SHARD, SAMPLE = 16_384, 65_536
#: A shard beyond this many fingerprints is linked by the exact rule, as a query over all executors.
MOST = 400_000
FEW = 384

# The stage's near copies: word shingles and their similarity (Jaccard), see ``near_duplicates``.
SHINGLE, SIMILARITY = 5, 0.8
#: Sets whose shingles are counted for the order of prefixes, and common shingles broadcast (16 bytes each).
COUNTED_SETS, COMMON_SHINGLES = 16_384, 100_000
#: Rounds of comparing with one text of a prefix shingle, rows per task of the last round, parts of the hash range.
STARS, BUCKET_ROWS, CELLS = 2, 20_000, 64
#: Rows of prefix shingles that lead to one group; a larger one is dealt into blocks, and every two blocks meet.
MOST_ROWS = 60_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles (XXH64, seed 42), repeats included."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    data = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    hash64 = xxhash.xxh64_intdigest
    if len(parts) <= shingle:
        hashes = [hash64(data, 42)]
    else:
        hashes = [hash64(data[a:b], 42) for a, b in zip(starts[: 1 - shingle].tolist(), ends[shingle - 1 :].tolist())] if shingle > 1 else [hash64(p, 42) for p in parts]
    h = np.array(hashes, np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            values = np.array([fingerprint(t, shingle) for t in batch.column("_text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(values.view(np.int64))], ["_id", "fp"])

    return run


def grow(sample: np.ndarray, leaves: int) -> list[tuple]:
    """Nodes (vantage point, distance, inside, outside) of a tree over a sample; leaves are negative numbers."""
    nodes: list[tuple] = []
    made = 0

    def node(points: np.ndarray, want: int) -> int:
        nonlocal made
        if want > 1 and len(points) >= 32:
            far = np.bitwise_count(points ^ points[0])
            cut = int(np.median(far))
            inside = far <= cut
            if 0 < inside.sum() < len(points):
                nodes.append(())
                at = len(nodes) - 1
                nodes[at] = (points[0], cut, node(points[inside], want // 2), node(points[~inside], want - want // 2))
                return at
        made += 1
        return -made

    root = node(sample, leaves)
    return nodes if root >= 0 else []


def route(nodes: list[tuple], fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(index, shard) of all places the fingerprints go to."""
    index, shard = [], []
    todo = [(0 if nodes else -1, np.arange(len(fps)))]
    while todo:
        at, rows = todo.pop()
        if at < 0:
            index.append(rows)
            shard.append(np.full(len(rows), -at))
            continue
        point, cut, inside, outside = nodes[at]
        far = np.bitwise_count(fps[rows] ^ point)
        todo.append((inside, rows[far <= cut]))
        todo.append((outside, rows[far > cut - radius]))
    return np.concatenate(index), np.concatenate(shard)


def _by_neighbours(fps: np.ndarray, rows: np.ndarray, bits: int, links: list) -> None:
    """Links of fingerprints within two bits: each to the first that shares a value within one bit of both."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(bits, dtype=np.uint64)]).astype(np.uint64)
    parts = max(1, len(rows) // 50_000)
    for part in range(parts):
        keys, who = [], []
        for flip in flips:
            key = fps[rows] ^ flip
            own = mix(key) % np.uint64(parts) == part if parts > 1 else slice(None)
            keys.append(key[own])
            who.append(rows[own])
        keys, who = np.concatenate(keys), np.concatenate(who)
        order = np.lexsort((who, keys))
        keys, who = keys[order], who[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        head = who[np.flatnonzero(new)[np.cumsum(new) - 1]]
        pairs = np.unique(np.stack([who, head], axis=1)[who != head], axis=0)
        links.append(pairs)


def shard_links(fps: np.ndarray, bits: int = 64, radius: int = RADIUS) -> np.ndarray:
    """(k, 2) row pairs that connect the components of distinct fingerprints within ``radius`` bits."""
    links: list[np.ndarray] = []
    todo = [np.arange(len(fps))]
    while todo:
        rows = todo.pop()
        if len(rows) < 2:
            continue
        if len(rows) <= FEW:
            near = np.bitwise_count(fps[rows][:, None] ^ fps[rows][None, :]) <= radius
            if np.count_nonzero(near) == len(rows):
                continue
            head = np.arange(len(rows))
            while True:
                new = np.where(near, head[None, :], len(rows)).min(axis=1)
                if (new == head).all():
                    break
                head = new
            linked = np.flatnonzero(head != np.arange(len(rows)))
            links.append(np.stack([rows[linked], rows[head[linked]]], axis=1))
            continue
        point = fps[rows[len(rows) // 2]]
        far = np.bitwise_count(fps[rows] ^ point)
        cut = np.median(far)
        inside, outside = rows[far <= cut], rows[far > cut - radius]
        if max(len(inside), len(outside)) > 0.85 * len(rows):
            _by_neighbours(fps, rows, bits, links)
        else:
            todo += [inside, outside]
    return np.concatenate(links) if links else np.zeros((0, 2), np.int64)


def hamming_edges(fps: DataFrame, name: str, bits: int = 64, most: int = MOST, shard: int = SHARD) -> DataFrame:
    """Edges (a, b) between ids of fingerprints within two bits, from ``fps(space, fp, id)``, distinct in (space, fp).

    Fingerprints meet within a space only.  The edges connect what the full graph
    connects: each is either a link of the graph or joins members of one component.
    """
    import pandas as pd

    spark = fps.sparkSession
    spaces = fps.groupBy("space").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    leaves = -(-spaces // shard)
    sample = [r.fp for r in fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()] if leaves > 1 else []
    nodes = grow(np.unique(np.array(sample, np.int64)).view(np.uint64)[np.random.Generator(np.random.PCG64(3)).permutation(len(set(sample)))], leaves) if sample else []

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            index, leaf = route(nodes, np.asarray(batch.column("fp").to_numpy(), np.int64).view(np.uint64))
            part = batch.take(pa.array(index))
            yield pa.RecordBatch.from_arrays([part.column("space"), pa.array(leaf.astype(np.int32)), part.column("fp"), part.column("id")], ["space", "leaf", "fp", "id"])

    kind = dict(fps.dtypes)["id"]
    dealt = stage(fps.select("space", "fp", "id").mapInArrow(deal, f"space int, leaf int, fp long, id {kind}"), f"{name}-shards")
    large = [(r.space, r.leaf) for r in dealt.groupBy("space", "leaf").count().filter(F.col("count") > most).limit(10_000).collect()]

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = shard_links(pdf["fp"].to_numpy(np.int64).view(np.uint64), bits)
        ids = pdf["id"].to_numpy()
        return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    key = F.struct("space", "leaf")
    is_large = key.isin([F.struct(F.lit(s), F.lit(x)) for s, x in large]) if large else F.lit(False)
    edges = dealt.filter(~is_large).groupBy("space", "leaf").applyInPandas(search, f"a {kind}, b {kind}")
    if large:
        flips = [0, *[1 << i if i < 63 else -(1 << 63) for i in range(bits)]]
        near = F.array(*[F.col("fp").bitwiseXOR(F.lit(f).cast("long")) for f in flips])
        keyed = dealt.filter(is_large).select("space", "leaf", "id", F.explode(near).alias("key"))
        first = keyed.groupBy("space", "leaf", "key").agg(F.min("id").alias("first"))
        edges = edges.union(keyed.join(first, ["space", "leaf", "key"]).filter("id <> first").select(F.col("id").alias("a"), F.col("first").alias("b")))
    return stage(edges.distinct(), f"{name}-edges")


def hamming_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (hex), component_id.

    Fingerprints within RADIUS bits are linked; component_id is the smallest id
    reachable.  A text of fewer than ``shingle`` words is one shingle; null and
    empty texts have fingerprint zero and are linked like any other.  Equal ids
    count as separate rows with one name.  Other columns are ignored; an empty
    table gives an empty result.
    """
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(_fingerprints(shingle), f"_id {kind}, fp long")
    rows = stage(rows, "simhash-rows")
    distinct = stage(rows.groupBy("fp").agg(F.min("_id").alias("id"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    edges = hamming_edges(distinct.filter("id is not null").select(F.lit(0).alias("space"), "fp", "id"), "simhash")
    reached = components(edges, "simhash")
    table = stage(distinct.join(reached, "id", "left").select("fp", "n", F.coalesce("component", "id").alias("component_id")), "simhash-table")
    out = join_skewed(rows, table, "fp", "n", rows.count(), F.col("_id"))
    return out.select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of k words; a row of fewer words is one shingle, one of none has none."""
    grams = np.zeros(max(len(hashes) - k + 1, 0), np.uint64)
    for j in range(k):
        grams = grams * np.uint64(0x100000001B3) + hashes[j : j + len(grams)]
    at = np.flatnonzero(rows[: len(grams)] == rows[k - 1 :]) if len(grams) else np.zeros(0, np.int64)
    n = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(n) - n
    short = np.flatnonzero((n > 0) & (n < k))
    whole = np.array([mix(np.sum(hashes[first[r] : first[r] + n[r]] * np.uint64(2 * k + 1) ** np.arange(n[r], dtype=np.uint64), dtype=np.uint64)) for r in short], np.uint64)
    grams, where = np.concatenate([mix(grams[at]), whole]), np.concatenate([rows[at], short])
    order = np.argsort(where, kind="stable")
    return grams[order], where[order]


def sketch(own: np.ndarray) -> np.ndarray:
    """How many shingles of a set have each value of their last bits: a power of two of cells, at most about four a cell."""
    cells = max(CELLS, 1 << (len(own) // 4).bit_length())
    while True:
        counts = np.bincount((own & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
        if not len(own) or counts.max() < 256:
            return counts.astype(np.uint8)
        cells *= 2


def fold(cells: np.ndarray, n: int) -> np.ndarray:
    """A sketch's counts in only ``n`` cells."""
    return cells.reshape(-1, n).sum(axis=0, dtype=np.int64)


def most_shared(x: np.ndarray, y: np.ndarray) -> int:
    """At least as many shingles as two sets share, from their sketches."""
    n = min(len(x), len(y))
    return int(np.minimum(fold(x, n), fold(y, n)).sum())


def _sets(shingle: int, whole: bool):
    """Per row (with its ``n``) its shingle set's size and the set itself (ascending hashes), or else the set's hash, SimHash and sketch."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "_text"):
                hashes, rows, *_ = words(piece.column("_text"))
                grams, where = shingles(hashes, rows, piece.num_rows, shingle)
                borders = np.searchsorted(where, np.arange(piece.num_rows + 1))
                sets = [np.unique(grams[a:b]) for a, b in zip(borders, borders[1:])]
                sizes = pa.array([len(x) for x in sets], pa.int64())
                if whole:
                    yield pa.RecordBatch.from_arrays([piece.column("_id"), piece.column("n"), sizes, pa.array([x.tobytes() for x in sets], pa.binary())], ["id", "n", "size", "shingles"])
                    continue
                ones = [np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64) for x in sets]
                fps = np.array([np.packbits(n * 2 > len(x), bitorder="little").view(np.uint64)[0] for n, x in zip(ones, sets)], np.uint64)
                names = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in sets], np.uint64)
                cells = pa.array([sketch(x).tobytes() for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(names.view(np.int64)), pa.array(fps.view(np.int64)), cells], ["id", "set_id", "fp", "cells"])

    return run


def _count_shingles(batches):
    import pyarrow as pa

    counts = Counter(1)

    def out():
        keys, values = counts.take()
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(values[0])], ["token", "n"])

    for batch in batches:
        for x in batch.column("shingles").to_pylist():
            own = np.frombuffer(x, np.uint64)
            counts.add(own, [np.ones(len(own), np.int64)])
            if counts.full():
                yield out()
    yield out()


def _prefixes(common, least: float):
    """(token, id, size, at): the first shingles of a set, in one order for all sets, that a set similar to it can't all miss."""

    def run(batches):
        import pyarrow as pa

        table, weight = common.value
        for batch in batches:
            tokens, row, sizes, places = [], [], [], []
            for r, x in enumerate(batch.column("shingles").to_pylist()):
                own = np.frombuffer(x, np.uint64)
                if not len(own):
                    continue
                k = len(own) - int(np.ceil(least * len(own) - 1e-9)) + 1
                seen = find(table, own)
                order = np.argsort(np.where(seen >= 0, weight[seen], 0) if len(table) else seen, kind="stable")[:k]
                tokens.append(own[order])
                row.append(np.full(len(order), r))
                sizes.append(np.full(len(order), len(own)))
                places.append(np.arange(len(order)))
            flat = lambda parts, kind: np.concatenate(parts).astype(kind, copy=False) if parts else np.zeros(0, kind)
            yield pa.RecordBatch.from_arrays([pa.array(flat(tokens, np.uint64).view(np.int64)), batch.column("id").take(pa.array(flat(row, np.int64))), pa.array(flat(sizes, np.int64)), pa.array(flat(places, np.int64))], ["token", "id", "size", "at"])

    return run


def _borders(token: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])), len(token)) if len(token) else np.zeros(0, np.int64)


def _candidates(least: float):
    """(_group, id) of the sets that may be similar to one of another component which shares a token, by the bounds below and sketches.

    Two sets already found so aren't looked at again, so a lump of copies costs few comparisons.
    """
    import pandas as pd

    def run(met: pd.DataFrame, sketches: pd.DataFrame) -> pd.DataFrame:
        cells = [np.frombuffer(x, np.uint8) for x in sketches["cells"]]
        coarse = np.array([fold(x, CELLS) for x in cells], np.int64).reshape(-1, CELLS)
        place = {i: n for n, i in enumerate(sketches["id"])}
        met = met.sort_values(["token", "size"])
        token, size, at = (met[c].to_numpy(np.int64) for c in ("token", "size", "at"))
        who = np.array([place[i] for i in met["id"]], np.int64)
        label = pd.factorize(met["comp"])[0]
        wanted, failed = np.zeros(len(cells), bool), set()
        borders = _borders(token)
        for low, high in zip(borders, borders[1:]):
            for i in range(low, high - 1):
                own = int(who[i])
                j = np.arange(i + 1, low + np.searchsorted(size[low:high], size[i] / least + 1e-9, "right"))
                j = j[label[j] != label[i]]
                if wanted[own]:
                    j = j[~wanted[who[j]]]
                need = least * (size[i] + size[j]) / (1 + least) - 1e-6
                good = np.minimum(size[i] - at[i], size[j] - at[j]) >= need
                j, need = j[good], need[good]
                good = np.minimum(coarse[own], coarse[who[j]]).sum(axis=1) >= need
                for k, enough in zip(who[j[good]].tolist(), need[good].tolist()):
                    pair = (own, k) if own < k else (k, own)
                    if wanted[own] and wanted[k] or pair in failed:
                        continue
                    if most_shared(cells[own], cells[k]) >= enough:
                        wanted[own] = wanted[k] = True
                    else:
                        failed.add(pair)
        ids = sketches["id"].to_numpy()[wanted]
        return pd.DataFrame({"_group": np.full(len(ids), met["_group"].iloc[0] if len(met) else 0, np.int64), "id": ids})

    return run


def _bucket_links(least: float):
    """Links that join the components of all similar sets which share a token; sets already joined aren't compared.

    No bound used here rules out a similar pair: sizes, places of the token in the
    two prefixes, and shingle counts by part of the hash range.
    """
    import pandas as pd

    def run(met: pd.DataFrame, content: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(x, np.uint64) for x in content["shingles"]]
        place = {i: n for n, i in enumerate(content["id"])}
        cells = np.array([np.bincount((x % np.uint64(CELLS)).astype(np.int64), minlength=CELLS) for x in sets], np.int64).reshape(-1, CELLS)
        met = met.sort_values(["token", "size"])
        token, size, at = (met[c].to_numpy(np.int64) for c in ("token", "size", "at"))
        who = np.array([place[i] for i in met["id"]], np.int64)
        label = np.zeros(len(sets), np.int64)
        label[who] = pd.factorize(met["comp"])[0]
        failed, links = set(), []
        borders = _borders(token)
        for low, high in zip(borders, borders[1:]):
            for i in range(low, high - 1):
                j = np.arange(i + 1, low + np.searchsorted(size[low:high], size[i] / least + 1e-9, "right"))
                j = j[label[who[j]] != label[who[i]]]
                need = least * (size[i] + size[j]) / (1 + least) - 1e-6
                good = np.minimum(size[i] - at[i], size[j] - at[j]) >= need
                j, need = j[good], need[good]
                j = j[np.minimum(cells[who[i]], cells[who[j]]).sum(axis=1) >= need]
                for k in who[j].tolist():
                    own = int(who[i])
                    pair = (own, k) if own < k else (k, own)
                    if label[own] == label[k] or pair in failed:
                        continue
                    x, y = sets[own], sets[k]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= least * (len(x) + len(y) - both) - 1e-9:
                        links.append(pair)
                        label[label == label[k]] = label[own]
                    else:
                        failed.add(pair)
        ids = content["id"].to_numpy()
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    return run


def _able(least: float):
    """The pairs whose sketches allow them to be similar: no similar pair fails."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                keep.append(most_shared(x, y) >= least * (int(x.sum()) + int(y.sum())) / (1 + least) - 1e-6)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _similar(least: float):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "x"):
                keep = []
                for x, y in zip(piece.column("x").to_pylist(), piece.column("y").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both >= least * (len(x) + len(y) - both) - 1e-9)
                yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: id, component_id; near copies share the smallest id of their group.

    Texts are near copies from a Jaccard similarity of ``similarity`` of their
    shingle sets (words are letters and digits with A-Z lowered); all such pairs
    are found.  SimHashes within RADIUS bits, found by the trees, link the nearest
    copies first.  At 0.8 a SimHash differs in about ten bits, where a tree prunes
    nothing, so the rest comes from prefixes: of two similar sets in one order of
    all shingles, some shingle is among the first fifth of both.  Shingles common
    in a sample come last in that order.  Texts that share such a shingle are
    compared with one of them for STARS rounds, which join large groups by a pair
    a text; then those still in different groups are compared, until each is joined
    with or told from all others.  The exact similarity decides on every pair.  Texts without words, null ones included,
    are copies of each other.  Rows of equal id are one row.  Other columns are
    ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = stage(texts.mapInArrow(_sets(shingle, False), f"id {kind}, set_id long, fp long, cells binary"), "near-rows")
    sets = stage(rows.groupBy("set_id").agg(F.min("id").alias("id"), F.min("fp").alias("fp"), F.min("cells").alias("cells"), F.count(F.lit(1)).alias("n")), "near-sets")
    named = sets.filter("id is not null")
    total = named.count()
    links, comps = None, None

    def content_of(ids: DataFrame) -> DataFrame:
        """The sets of the ids in a stage table (id, n), made from their texts; no other text moves."""
        table = ids.select(F.col("id").alias("_id"), "n")
        if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
            some = texts.join(F.broadcast(table), "_id")
        else:
            some = marked(texts, "_id", marks(ids.select("id"), "id", "near-marks"), "_in").filter("_in").drop("_in").join(table, "_id")
        return some.mapInArrow(_sets(shingle, True), f"id {kind}, n long, size long, shingles binary")

    def each_set() -> DataFrame:
        """A text of every set; beyond the broadcast bound a bitmap may let copies through, which cost time and change nothing."""
        some = texts.filter("_id is not null").withColumn("n", F.lit(1).cast("long"))
        if total <= BROADCAST_IDS:
            return some.join(F.broadcast(named.select(F.col("id").alias("_id")).distinct()), "_id", "left_semi")
        return marked(some, "_id", marks(named.select("id"), "id", "near-marks"), "_in").filter("_in").drop("_in")

    def ends_of(pairs: DataFrame) -> DataFrame:
        return stage(pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n")), "near-ends")

    def with_both(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
        """Pairs with their ends' values x and y, from a table (id, n, value)."""
        total = max(1, pairs.count())
        for end, column in (("a", "x"), ("b", "y")):
            pairs = join_skewed(pairs, table.select(F.col("id").alias(end), "n", F.col(value).alias(column)), end, "n", total, F.struct("a", "b")).drop("n")
        return pairs

    def verify(pairs: DataFrame) -> None:
        """Keeps the pairs that are similar, and joins components by them; sets move only where sketches don't decide."""
        nonlocal links, comps
        met = stage(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-pairs")
        ends = ends_of(met)
        drafts = stage(ends.join(named.select("id", "cells"), "id"), "near-drafts")
        able = stage(with_both(met, drafts, "cells").mapInArrow(_able(similarity), f"a {kind}, b {kind}"), "near-able")
        discard(met, ends, drafts)
        ends = ends_of(able)
        content = stage(content_of(ends), "near-content")
        pairs = with_both(able, content, "shingles")
        found = stage(pairs.mapInArrow(_similar(similarity), f"a {kind}, b {kind}"), "near-links")
        discard(able, ends, content)
        links = found if links is None else links.union(found)
        comps = stage(components(links, "near"), "near-components")

    heads = stage(named.groupBy("fp").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("n")), "near-heads")
    equal = join_skewed(named.select("id", "fp"), heads.filter("n > 1"), "fp", "n", sets.count(), F.col("id")).filter("head <> id").select(F.col("id").alias("a"), F.col("head").alias("b"))
    verify(hamming_edges(heads.select(F.lit(0).alias("space"), "fp", F.col("head").alias("id")), "near").union(equal))

    # Any order of the shingles is right; with the common ones last few texts meet that aren't similar.
    part = min(1.0, COUNTED_SETS / max(1, total))
    make = _sets(shingle, True)  # in the worker that reads the sets, so no set leaves it and a task has one worker
    sample = each_set().filter(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(part * 1_000_000))
    counted = sample.mapInArrow(lambda batches: _count_shingles(make(batches)), "token long, n long")
    counted = stage(counted.groupBy("token").agg(F.sum("n").alias("n")).filter("n > 1"), "near-counted")
    # The most frequent ones, as many as may be broadcast; counts are at most those of the sample.
    often = sorted(counted.groupBy("n").count().collect(), reverse=True)
    so_far = np.cumsum([r["count"] for r in often])
    least = min((r["n"] for r, t in zip(often, so_far) if t <= COMMON_SHINGLES), default=COUNTED_SETS + 1)
    counted = counted.filter(F.col("n") >= least).toArrow()
    keys, weight = np.asarray(counted["token"].to_numpy(), np.int64).view(np.uint64), np.asarray(counted["n"].to_numpy(), np.int64)
    order = np.argsort(keys)
    common = spark.sparkContext.broadcast((keys[order], weight[order]))
    first = _prefixes(common, similarity)
    met = each_set().mapInArrow(lambda batches: first(make(batches)), f"token long, id {kind}, size long, at long")
    met = met.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("token"))).filter("_n > 1").drop("_n")
    met = stage(met, "near-met")

    def apart(met: DataFrame) -> DataFrame:
        """The rows of tokens that meet in more than one component, with a row to compare with and the first component."""
        now = met.select("token", "id", "size", "at").join(comps.select("id", F.col("component").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        now = stage(now.select("token", "id", "size", "at", "comp"), "near-apart")
        head = F.min(F.struct(F.xxhash64("comp").alias("x"), F.xxhash64("id", F.lit(step)).alias("y"), "id", "size", "at", "comp")).alias("head")
        tokens = stage(now.groupBy("token").agg(head, F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").drop("high"), "near-tokens")
        rest = stage(join_skewed(now, tokens, "token", "n", now.count(), F.col("id")).filter("head is not null"), "near-met")
        discard(met, now, tokens)
        return rest

    for step in range(STARS):
        met = apart(met)
        reach = F.least(F.col("size") - F.col("at"), F.col("head.size") - F.col("head.at")) >= F.lit(similarity / (1 + similarity)) * (F.col("size") + F.col("head.size")) - 1e-6
        stars = met.filter(F.col("comp") != F.col("head.comp")).filter(reach)
        verify(stars.groupBy("id").agg(F.min("head").alias("head")).select(F.col("id").alias("a"), F.col("head.id").alias("b")))

    # Tokens of the same first component go together, as mostly the same texts have them, so a text's content goes to few tasks.
    step = STARS
    met = apart(met)
    groups = max(1, met.count() // BUCKET_ROWS)
    large = stage(met.groupBy("low").agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / MOST_ROWS).cast("int")).filter("blocks > 1"), "near-large")
    met = join_small(met, large.select("low", "blocks"), ["low"])
    own_block = F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.xxhash64("low", F.least(own_block, k), F.greatest(own_block, k)))
    met = met.withColumn("_group", F.explode(F.when(F.col("blocks").isNull(), F.array(F.pmod(F.xxhash64("low"), F.lit(groups)))).otherwise(meets)))
    met = stage(met.select("_group", "token", "id", "size", "at", "comp"), "near-grouped")
    places = stage(met.select("_group", "id").distinct(), "near-places")
    drafts = places.join(named.select("id", "cells"), "id")
    able = met.groupBy("_group").cogroup(drafts.groupBy("_group")).applyInPandas(_candidates(similarity), f"_group long, id {kind}")
    places = stage(able, "near-able")  # only these sets move
    met = met.join(places, ["_group", "id"], "left_semi")
    content = places.join(content_of(stage(places.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "near-place-ids")), "id")
    found = met.groupBy("_group").cogroup(content.groupBy("_group")).applyInPandas(_bucket_links(similarity), f"a {kind}, b {kind}")
    comps = stage(components(links.union(stage(found, "near-links")), "near"), "near-components")

    table = stage(sets.join(comps, "id", "left").select("set_id", "n", F.coalesce("component", "id").alias("component_id")), "near-table")
    out = join_skewed(rows.select("id", "set_id"), table, "set_id", "n", rows.count(), F.col("id"))
    return out.select(F.col("id").alias(id_col), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_components(documents(spark, sf_dir))
