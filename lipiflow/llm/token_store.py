"""Token ids in a content-addressed store.

Each text becomes a stream of ids that a rolling hash cuts into chunks.  A chunk
is stored once, under the hash of its bytes.  A recipe lists a document's chunks
in order and carries their Merkle root.  Recipes are written as parts, ranges of
ids in ascending order; the manifest has a line per part, with the root over its
documents and where its ids begin in the whole stream.  Reading checks every chunk
against its address, every recipe against its root, and every part against the
manifest, so lost, added and changed files are all noticed.

The store is a folder of Parquet tables:
    store/kind=chunk    hashes [address binary(16)], n int, data binary (little-endian unsigned
                        16-bit ids, 32-bit where one needs it: width int)
    recipes/kind=recipe part, nr (from 0), doc_id, offset (ids before it in the part), n_tokens, root, addresses
    manifest/           part, first_id, last_id, start, n_docs, n_tokens, root
"""

from __future__ import annotations

import gc
import hashlib
import os
import re
from array import array
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lipiflow.llm.common import documents, join_skewed, shuffle_parts, stage, stage_path

END_ID = 2
#: A chunk ends where the rolling hash of the last WINDOW ids is in the lowest MEAN-th of its range,
#: but has LEAST to MOST ids.
WINDOW, LEAST, MEAN, MOST = 16, 64, 256, 1024
#: Words (in each of two generations) and stems whose ids a Python worker remembers, the letters of the longest such word,
#: and chunks a task knows it has emitted.
WORDS_KEPT, STEMS_KEPT, LETTERS_KEPT = 200_000, 50_000, 40
CHUNKS_KEPT = 50_000
#: Bytes of text whose words are looked up at a time (one longer text is alone), and rows and bytes of a batch a worker gives back.
BYTES_IN, ROWS_OUT, BYTES_OUT = 4 << 20, 1_000, 1 << 20
#: Plain and accented Latin letters, without U+0130, whose small form is two characters.
LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u024F"
#: A plain word, of such letters and ASCII characters: letters, punctuation without an apostrophe, and the rest.
PLAIN = re.compile(f"([{LETTERS}]*)([!-&(-/:-@\\[-`{{-~]*)([!-~{LETTERS}]*)").fullmatch

_worker: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """The tokenizer, with the ids of words remembered.

    Its normaliser and its splitter never look across white space, so a text's
    ids are those of its words (cut at space and newline) one after another.  A
    word of ASCII characters and accented Latin letters stays as normalisation
    leaves it but for its case, so it is lowered and split here, and its parts go
    to the tokenizer's BPE model; every other word takes the whole tokenizer.
    Arrow tells the words of many texts apart, and then the parts of these, so
    only different parts and different other words are looked up.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the executors' tasks are the parallel ones
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = _Words(self.word)
        self.stems: dict[str, bytes] = {}
        self.letters = self._bytes_of_letters()
        # Fixed value: such a tokenizer's split of a plain word; each part goes to the model on its own.
        self.parts = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}\u0250-\uFFFF]+|[0-9]|[^0-9{LETTERS}\u0250-\uFFFF]+"
        self.split = re.compile(self.parts).findall
        # Tokens that the tokenizer looks for before anything else, in their own case.
        self.tokens = added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) if added else "(?!)").search
        # Such a tokenizer marks word ends, lowers letters and drops white space.
        self.by_word = getattr(self.model, "end_of_word_suffix", None) == "</w>" and self.tokenizer.normalizer.normalize_str(" A\n") == " a "
        self.by_word &= not any(re.search(r"\s", t) or re.fullmatch(r"\w*", t) for t in added)

    def _bytes_of_letters(self) -> dict[int, str]:
        """The letters of the byte alphabet for the small form of every accented Latin letter (some lie beyond the class)."""
        from tokenizers.pre_tokenizers import ByteLevel

        split = ByteLevel(add_prefix_space=False, use_regex=False)
        small = {ord(c) for code in range(0xC0, 0x250) for c in chr(code).lower()}
        return {c: split.pre_tokenize_str(chr(c))[0][0] for c in small if c > 0x7F}

    def merged(self, stem: str) -> bytes:
        """Ids of a lowered part of a word by the model."""
        return array("I", [t.id for t in self.model.tokenize(stem if stem.isascii() else stem.translate(self.letters))]).tobytes()

    def stem(self, stem: str) -> bytes:
        """The same, remembered."""
        found = self.stems.get(stem) or self.known.get(stem)
        if found is None:
            found = self.merged(stem)
            if len(stem) <= LETTERS_KEPT:
                if len(self.stems) > STEMS_KEPT:
                    self.stems.clear()
                self.stems[stem] = found
        return found

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha() and word.islower():
            return self.merged(word)
        found = PLAIN(word)
        front, marks, rest = found.groups() if found else ("", "", word)
        if not found or (marks or rest) and self.added(word):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if rest:
            return b"".join(map(self.stem, self.split(word.lower())))
        if not marks:
            low = front.lower()  # a small word is remembered among the words known
            return (self.merged(low) if low == word else self.stem(low)) if front else b""
        return self.stem(front.lower()) + self.stem(marks) if front else self.stem(marks)

    def batch(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of an Arrow array of texts one after another, and where those of each end.  Null counts as empty."""
        import pyarrow.compute as pc

        texts = texts.fill_null("")
        if not self.by_word:
            found = [array("I", self.tokenizer.encode(t, add_special_tokens=False).ids).tobytes() for t in texts.to_pylist()]
            return _joined(found)
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = words.flatten().dictionary_encode()
        return _taken(*self._words(coded.dictionary), coded.indices, words)

    def _words(self, words) -> tuple[np.ndarray, np.ndarray]:
        """The same for an Arrow array of words."""
        import pyarrow.compute as pc

        plain = pc.match_substring_regex(words, f"^[!-~{LETTERS}]*$")
        for token in self.tokens:
            plain = pc.and_not(plain, pc.match_substring(words, token))
        cut = pc.utf8_rtrim(pc.replace_substring_regex(pc.utf8_lower(words), self.parts, "\\0 "), " ")
        parts = pc.split_pattern(pc.if_else(plain, cut, words), " ")
        coded = parts.flatten().dictionary_encode()
        found = [*map(self.known.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False).tolist())]
        return _taken(*_joined(found), coded.indices, parts)

    def ids(self, text: str) -> np.ndarray:
        import pyarrow as pa

        return self.batch(pa.array([text], pa.string()))[0]


def _joined(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Unsigned 32-bit numbers from their bytes, one list after another, and where each list ends."""
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return np.frombuffer(b"".join(found), np.uint32), np.cumsum(sizes // 4)


def _taken(values: np.ndarray, ends: np.ndarray, places, lists) -> tuple[np.ndarray, np.ndarray]:
    """Of such lists, those at ``places`` one after another, and where each of ``lists`` of places ends (none is empty)."""
    at = places.to_numpy()
    taken = np.diff(ends, prepend=0)[at]
    after = np.cumsum(taken)
    from_ = np.repeat(ends[at] - after, taken)
    from_ += np.arange(len(from_))
    return values[from_], after[lists.offsets.to_numpy()[1:] - 1]


class _Words(dict):
    """Ids of words met so far; a word not met is encoded.  Beyond WORDS_KEPT words only those met again stay, and none of over LETTERS_KEPT letters."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, word: str) -> bytes:
        if len(word) > LETTERS_KEPT:
            return self.encode(word)
        if len(self) > WORDS_KEPT:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode(word)
        self[word] = ids
        return ids


def _gear() -> np.ndarray:
    if "gear" not in _worker:
        _worker["gear"] = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 32, 1 << 16, np.uint32)
    return _worker["gear"]


def cut(ids: np.ndarray) -> list[int]:
    """Ends of the chunks of an id stream."""
    n = len(ids)
    if n <= LEAST:
        return [n]
    sums = np.cumsum(_gear()[ids & 0xFFFF], dtype=np.uint32)
    sums[WINDOW:] -= sums[:-WINDOW].copy()
    hits = (np.flatnonzero(sums * np.uint32(0x9E3779B1) < np.uint32((1 << 32) // MEAN)) + 1).tolist()
    ends, at = [], 0
    while n - at > LEAST:
        i = bisect_left(hits, at + LEAST)
        end = min(hits[i] if i < len(hits) else n, at + MOST, n)
        ends.append(end)
        at = end
    if at < n:
        ends.append(n)
    return ends


def address(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merkle(hashes: list[bytes]) -> bytes:
    """Root of a binary hash tree; an odd node moves up as it is."""
    level = [hashlib.blake2b(b"\0" + h, digest_size=16).digest() for h in hashes] or [hashlib.blake2b(b"", digest_size=16).digest()]
    while len(level) > 1:
        up = [hashlib.blake2b(b"\1" + a + b, digest_size=16).digest() for a, b in zip(level[::2], level[1::2])]
        level = up + level[len(up) * 2 :]
    return level[0]


STAGED = "kind string, _deal long, _id {id}, n int, width int, hashes array<binary>, data binary"


def _slices(batch):
    """A batch in pieces of about BYTES_IN of text: a batch may hold hundreds of MB, and its words are many times as large."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
    whole = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = whole[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(whole, before + BYTES_IN, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _encoder(path: str) -> Encoder:
    """The encoder of this worker, kept from task to task.

    A function of the module, as Spark sends functions made within others with
    copies of what they name: a dict named there would be new in every task.
    """
    if path not in _worker:
        _worker[path] = Encoder(path)
        gc.freeze()  # the collector needn't look through the remembered words again and again
    return _worker[path]


def _encode(path: str):
    def run(batches):
        import pyarrow as pa

        encoder = _encoder(path)
        seen: set[bytes] = set()
        end = np.array([END_ID], np.uint32)

        def out(rows):
            kind, deal, ids, n, width, hashes, data = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(deal, pa.int64()), pa.array(ids, ids_type), pa.array(n, pa.int32()), pa.array(width, pa.int32()), pa.array(hashes, pa.list_(pa.binary())), pa.array(data, pa.binary())], ["kind", "_deal", "_id", "n", "width", "hashes", "data"])

        def encoded(batch):
            for few in _slices(batch):
                ids, ends = encoder.batch(few.column("_text"))
                yield from zip(few.column("_id").to_pylist(), np.split(ids, ends[:-1]))

        for batch in batches:
            ids_type, rows, held = batch.column("_id").type, [], 0
            for doc_id, ids in encoded(batch):
                ids = np.concatenate([ids, end])
                at, hashes = 0, []
                for stop in cut(ids):
                    part = ids[at:stop]
                    width = 2 if part.max() < 1 << 16 else 4
                    raw = part.astype(np.uint16 if width == 2 else np.uint32).tobytes()
                    key = address(raw)
                    hashes.append(key)
                    if key not in seen:
                        if len(seen) > CHUNKS_KEPT:
                            seen.clear()
                        seen.add(key)
                        rows.append(("chunk", int.from_bytes(key[:8], "little", signed=True), None, stop - at, width, [key], raw))
                        held += len(raw)
                    at = stop
                root = merkle(hashes)
                deal = int.from_bytes(address(root + str(doc_id).encode())[:8], "little", signed=True)
                rows.append(("recipe", deal, doc_id, len(ids), 0, hashes, root))
                if len(rows) > ROWS_OUT or held > BYTES_OUT:
                    yield out(rows)
                    rows, held = [], 0
            if rows:
                yield out(rows)

    return run


class Merkle:
    """The root that ``merkle`` gives, from hashes that come one by one: whole subtrees wait for their right neighbour."""

    def __init__(self):
        self.peaks: list[tuple[int, bytes]] = []

    def add(self, one: bytes) -> None:
        height, node = 0, hashlib.blake2b(b"\0" + one, digest_size=16).digest()
        while self.peaks and self.peaks[-1][0] == height:
            node = hashlib.blake2b(b"\1" + self.peaks.pop()[1] + node, digest_size=16).digest()
            height += 1
        self.peaks.append((height, node))

    def root(self) -> bytes:
        if not self.peaks:
            return merkle([])
        node = self.peaks[-1][1]
        for _, left in reversed(self.peaks[:-1]):
            node = hashlib.blake2b(b"\1" + left + node, digest_size=16).digest()
        return node


def _once(batches):
    """Of a partition's chunks, sorted so that copies are neighbours, the first of each."""
    import pyarrow as pa

    last, seen = None, set()  # the chunks that share the last row's deal
    for batch in batches:
        deal = batch.column("_deal").to_numpy()
        again = np.concatenate([[deal[0] == last], deal[1:] == deal[:-1]]) if len(deal) else np.zeros(0, bool)
        pairs = again | np.append(again[1:], True)  # rows with a neighbour of the same deal, and the batch's last
        keep = np.ones(len(deal), bool)
        for i in np.flatnonzero(pairs):
            if not again[i]:
                seen = set()
            if batch.column("kind")[i].as_py() == "chunk":
                key = batch.column("hashes")[i][0].as_py()
                keep[i] = key not in seen
                seen.add(key)
            last = deal[i]
        yield batch.filter(pa.array(keep))


RECIPE = "kind string, part int, nr long, doc_id {id}, last_id {id}, offset long, n_tokens long, root binary, addresses array<binary>"


def _number(batches):
    """Recipes of a sorted part, numbered and with the ids before them, and after them the part's line of the manifest."""
    import pyarrow as pa
    from pyspark import TaskContext

    part, nr, total, tree, first, last, kinds = TaskContext.get().partitionId(), 0, 0, Merkle(), None, None, None
    names = ["kind", "part", "nr", "doc_id", "last_id", "offset", "n_tokens", "root", "addresses"]
    for batch in batches:
        n, ids = batch.num_rows, batch.column("_id")
        if not n:
            continue
        kinds = (ids.type, batch.column("root").type, batch.column("addresses").type)
        sizes = batch.column("n_tokens").to_numpy()
        after = np.cumsum(sizes)
        for root in batch.column("root").to_pylist():
            tree.add(root)
        first = ids[0].as_py() if nr == 0 else first
        last = ids[n - 1].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array(["recipe"] * n), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(nr, nr + n)), ids, pa.nulls(n, ids.type), pa.array(total + after - sizes), batch.column("n_tokens"), batch.column("root"), batch.column("addresses")], names
        )
        nr, total = nr + n, total + int(after[-1])
    if nr:
        yield pa.RecordBatch.from_arrays(
            [pa.array(["part"]), pa.array([part], pa.int32()), pa.array([nr]), pa.array([first], kinds[0]), pa.array([last], kinds[0]), pa.array([0]), pa.array([total]), pa.array([tree.root()], kinds[1]), pa.nulls(1, kinds[2])], names
        )


def write(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the store of ``docs`` to ``path`` (a folder that all executors share)."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = STAGED.format(id=kind)
    rows = rows.mapInArrow(_encode(tokenizer or default_tokenizer()), schema)
    rows = rows.repartition(shuffle_parts(spark), "_deal").sortWithinPartitions("_deal").mapInArrow(_once, schema)
    rows.write.option("compression", "zstd").partitionBy("kind").parquet(f"{path}/store")
    stored = spark.read.schema(schema).parquet(f"{path}/store")
    recipes = stored.filter("kind = 'recipe'").select("_id", F.col("n").cast("long").alias("n_tokens"), F.col("data").alias("root"), F.col("hashes").alias("addresses"))
    # Rows alike are told apart by their place, so that many of them fill several parts.
    order = ["_id", "root", "_place"]
    recipes = recipes.withColumn("_place", F.monotonically_increasing_id())
    recipes = recipes.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order).drop("_place").mapInArrow(_number, RECIPE.format(id=kind))
    recipes.write.option("compression", "zstd").partitionBy("kind").parquet(f"{path}/recipes")
    parts = spark.read.schema(RECIPE.format(id=kind)).parquet(f"{path}/recipes").filter("kind = 'part'")
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row per part
    parts = parts.select("part", F.col("doc_id").alias("first_id"), "last_id", F.coalesce(before, F.lit(0)).alias("start"), F.col("nr").alias("n_docs"), "n_tokens", "root")
    parts.coalesce(1).write.parquet(f"{path}/manifest")


def _roots(batches):
    """(part, n_docs, n_tokens, root) of recipes sorted by part and number; a number missing or doubled spoils the root."""
    import pyarrow as pa

    part, nr, total, tree = None, 0, 0, Merkle()

    def out():
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([nr]), pa.array([total]), pa.array([tree.root()], pa.binary())], ["part", "n_docs", "n_tokens", "root"])

    for batch in batches:
        for p, i, offset, n, root in zip(*[batch.column(c).to_pylist() for c in ("part", "nr", "offset", "n_tokens", "root")]):
            if p != part:
                if part is not None:
                    yield out()
                part, nr, total, tree = p, 0, 0, Merkle()
            tree.add(root if (i, offset) == (nr, total) else b"")
            nr, total = nr + 1, total + n
    if part is not None:
        yield out()


def _shift_tables() -> list[np.ndarray]:
    """For each k, what 2**k zero bytes after a CRC-32 make of it, as four tables by byte."""
    if "shift" not in _worker:
        # One zero byte: r -> table[r & 255] ^ r >> 8 on the plain register.
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
        step = lambda r: table[r & 0xFF] ^ r >> np.uint32(8)
        unit = np.arange(256, dtype=np.uint32)
        tables = [np.stack([step(unit << np.uint32(8 * b)) for b in range(4)])]
        for _ in range(39):
            t = tables[-1]
            tables.append(np.stack([_apply(t, t[b]) for b in range(4)]))
        _worker["shift"] = tables
    return _worker["shift"]


def _apply(t: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return t[0][crc & 0xFF] ^ t[1][crc >> np.uint32(8) & 0xFF] ^ t[2][crc >> np.uint32(16) & 0xFF] ^ t[3][crc >> np.uint32(24)]


def shift(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 parts moved in front of ``n_bytes`` further bytes; their XOR is the whole's CRC-32."""
    crc = crc.astype(np.uint32)
    for k, t in enumerate(_shift_tables()):
        on = n_bytes >> k & 1 == 1
        if on.any():
            crc[on] = _apply(t, crc[on])
    return crc


def _verify(batches):
    """Of each stored chunk: address, ids, CRC-32 of the ids as unsigned 32-bit; fails on bytes that don't fit the address."""
    import zlib

    import pyarrow as pa

    for batch in batches:
        keys, n, crc = [], [], []
        for hashes, width, data in zip(*[batch.column(c).to_pylist() for c in ("hashes", "width", "data")]):
            if address(data) != hashes[0]:
                raise ValueError(f"chunk {hashes[0].hex()} does not fit its address")
            ids = np.frombuffer(data, np.uint16 if width == 2 else np.uint32).astype("<u4")
            keys.append(hashes[0])
            n.append(len(ids))
            crc.append(zlib.crc32(ids.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["address", "n", "crc"])


def _rooted(batches):
    """Recipes as they are; fails on one whose chunks don't fit its root."""
    for batch in batches:
        for root, addresses in zip(batch.column("root").to_pylist(), batch.column("addresses").to_pylist()):
            if merkle(addresses) != root:
                raise ValueError("a recipe does not fit its root")
        yield batch.drop_columns(["root"])


def _assemble(batches):
    import pyarrow as pa

    for batch in batches:
        parts = batch.column("parts")
        sizes = np.array([len(p) for p in parts], np.int64)
        flat = parts.flatten()
        n = np.asarray(flat.field("n").fill_null(-1).to_numpy(zero_copy_only=False), np.int64)
        if (n < 0).any() or len(n) != sizes.sum():
            raise ValueError("a recipe names a chunk that is not in the store")
        crc = np.asarray(flat.field("crc").to_numpy(zero_copy_only=False), np.int64)
        rows = np.repeat(np.arange(len(sizes)), sizes)
        done = np.cumsum(n)
        ends = np.cumsum(sizes)
        total = np.bincount(rows, n, minlength=len(sizes)).astype(np.int64)
        after = done[ends - 1][rows] - done
        moved = shift(crc, after * 4)
        whole = np.bitwise_xor.reduceat(moved, ends - sizes) if len(moved) else moved
        if (total != np.asarray(batch.column("n_tokens").to_numpy())).any():
            raise ValueError("a document does not fit its recipe")
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(total), pa.array(whole.astype(np.int64))], ["doc_id", "start", "n_tokens", "ids_crc32"])


def _decode(batches):
    import pyarrow as pa

    for batch in batches:
        ids = [[i for p in parts for i in np.frombuffer(p["data"], np.uint16 if p["width"] == 2 else np.uint32).tolist()] for parts in batch.column("parts").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "start", "ids"])


def _recipes(spark: SparkSession, path: str) -> DataFrame:
    """The recipes (_row, doc_id, start, n_tokens, root, addresses), once their parts fit the manifest."""
    manifest = spark.read.parquet(f"{path}/manifest")
    recipes = spark.read.schema(RECIPE.format(id=dict(manifest.dtypes)["first_id"])).parquet(f"{path}/recipes").filter("kind = 'recipe'")
    sorted_parts = recipes.select("part", "nr", "offset", "n_tokens", "root").repartition(shuffle_parts(spark), "part").sortWithinPartitions("part", "nr")
    found = sorted_parts.mapInArrow(_roots, "part int, n_docs long, n_tokens long, root binary")
    said = manifest.select("part", F.struct("n_docs", "n_tokens", "root").alias("said"))
    wrong = found.select("part", F.struct("n_docs", "n_tokens", "root").alias("found")).join(said, "part", "full_outer").filter(~F.col("said").eqNullSafe(F.col("found")))
    # Where a part's ids begin follows from the parts before it.
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    moved = manifest.withColumn("_before", F.coalesce(before, F.lit(0))).filter("start <> _before")
    for row in wrong.select("part").union(moved.select("part")).limit(1).collect():
        raise ValueError(f"part {row.part} of the recipes does not fit the manifest")
    starts = manifest.select("part", F.col("start").alias("_start"))  # a row per part
    rows = recipes.join(F.broadcast(starts), "part")
    rows = rows.select((F.col("part").cast("long") * F.lit(1 << 40) + F.col("nr")).alias("_row"), "doc_id", (F.col("_start") + F.col("offset")).alias("start"), "n_tokens", "root", "addresses")
    return rows


def _with_chunks(spark: SparkSession, path: str, recipes: DataFrame, chunks: DataFrame, fields: list[str]) -> DataFrame:
    """(doc_id, start, n_tokens, parts): ``fields`` of each document's chunks in order."""
    rooted = recipes.select("_row", "root", "addresses").mapInArrow(_rooted, "_row long, addresses array<binary>")
    each = stage(rooted.select("_row", F.posexplode("addresses").alias("at", "address")), "token-refs")
    used = each.groupBy("address").agg(F.count(F.lit(1)).alias("used"))
    table = stage(chunks.join(used, "address"), "token-chunks")
    each = join_skewed(each, table, "address", "used", each.count(), F.struct("_row", "at"))
    parts = each.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", F.struct(*fields).alias("p")))).alias("parts")).select("_row", F.transform("parts", lambda p: p["p"]).alias("parts"))
    return recipes.select("_row", "doc_id", "start", "n_tokens").join(parts, "_row").select("doc_id", "start", "n_tokens", "parts")


def _chunks(spark: SparkSession, path: str, kind: str) -> DataFrame:
    stored = spark.read.schema(STAGED.format(id=kind)).parquet(f"{path}/store")
    return stored.filter("kind = 'chunk'").select("hashes", "width", "data")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a store: doc_id, start, n_tokens, ids_crc32, all taken from its files.

    Every stored chunk is read once; a document's CRC-32 is put together from its
    chunks' without moving ids between executors.
    """
    recipes = _recipes(spark, path)
    kind = dict(recipes.dtypes)["doc_id"]
    chunks = _chunks(spark, path, kind).mapInArrow(_verify, "address binary, n long, crc long")
    return _with_chunks(spark, path, recipes, chunks, ["n", "crc"]).mapInArrow(_assemble, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def read_ids(spark: SparkSession, path: str, doc_ids: list | None = None) -> DataFrame:
    """(doc_id, start, ids): the ids of all documents, or of some, put together from their chunks."""
    recipes = _recipes(spark, path)
    if doc_ids is not None:
        recipes = recipes.filter(F.col("doc_id").isin(doc_ids))
    kind = dict(recipes.dtypes)["doc_id"]
    chunks = _chunks(spark, path, kind).select(F.col("hashes")[0].alias("address"), "width", "data")
    return _with_chunks(spark, path, recipes, chunks, ["width", "data"]).select("doc_id", "start", "parts").mapInArrow(_decode, f"doc_id {kind}, start long, ids array<long>")


def store_and_read(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` to a store and read it back.

    Null and empty texts are the end id alone.  Rows come in ascending id order
    (null first); repeated rows are repeated in the stream.  An empty table makes
    an empty store.  Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    path = path or stage_path(spark, "token-store")
    write(docs, path, tokenizer, id_col, text_col)
    return read(spark, path).withColumnRenamed("doc_id", id_col)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store_and_read(documents(spark, sf_dir))
