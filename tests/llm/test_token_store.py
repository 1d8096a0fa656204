"""The token store against the tokenizer, an exact round trip, and files damaged in every table."""

import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lipiflow.llm import token_store


@pytest.fixture(scope="module")
def encoder():
    return token_store.Encoder(token_store.default_tokenizer())


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(token_store.default_tokenizer())


def test_every_letter(encoder, tokenizer):
    for code in range(0x21, 0x250):
        c = chr(code)
        for word in (c, f"a{c}kar", f"x {c}b", f"don'{c}3.", f"{c}'ll!"):
            assert encoder.ids(word).tolist() == tokenizer.encode(word, add_special_tokens=False).ids, (hex(code), word)


def test_random_strings(encoder, tokenizer):
    r = random.Random(5)
    letters = [chr(c) for c in range(0x20, 0x250)] + [*"\n\t  ab'sl1́İẞ中٣é"] * 12
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 14))) for _ in range(20_000)]
    for text, whole in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert encoder.ids(text).tolist() == whole.ids, text


def test_added_tokens(encoder, tokenizer):
    for text in ("<|endoftext|>stop!", "a<|startoftext|>b", "<|ENDOFTEXT|> A", "A <|endoftext|> <|EndOfText|>", "é<|endoftext|>É", "<|endoftext |>"):
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_are_forgotten_rightly(tokenizer, monkeypatch):
    monkeypatch.setattr(token_store, "WORDS_KEPT", 5)
    monkeypatch.setattr(token_store, "STEMS_KEPT", 3)
    encoder = token_store.Encoder(token_store.default_tokenizer())
    text = " ".join(f"w{i % 17} and{i % 5}" for i in range(60))
    assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_merkle_one_by_one():
    for n in range(40):
        hashes = [bytes([i]) * 16 for i in range(n)]
        tree = token_store.Merkle()
        for h in hashes:
            tree.add(h)
        assert tree.root() == token_store.merkle(hashes)


def test_round_trip(spark, make, tmp_path, tokenizer):
    r = random.Random(2)
    texts = [(i, " ".join(r.choice("one two three four five".split()) for _ in range(r.randint(0, 3000)))) for i in range(12)]
    texts += [(3, "twice"), (3, "twice"), (20, None), (None, "no id")]
    path = str(tmp_path / "s")
    token_store.write(make(texts), path)
    got = token_store.read_ids(spark, path).orderBy("start").collect()
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [token_store.END_ID]
    assert sorted((r.doc_id or -1, r.ids) for r in got) == sorted((i or -1, ids(t)) for i, t in texts)
    at = 0
    for r in got:
        assert r.start == at
        at += len(r.ids)
    assert [r.doc_id for r in got] == sorted((i for i, _ in texts), key=lambda i: (i is not None, i))
    assert [r.ids for r in token_store.read_ids(spark, path, [20]).collect()] == [[token_store.END_ID]]
    manifest = spark.read.parquet(f"{path}/manifest").orderBy("part").collect()
    assert sum(m.n_docs for m in manifest) == len(texts) and sum(m.n_tokens for m in manifest) == at and len(manifest) > 1


def _change(spark, path, table, change):
    """Write the table anew as ``change`` makes it."""
    df = change(spark.read.parquet(f"{path}/{table}"))
    parts = ["kind"] if "kind" in df.columns else []
    df.write.partitionBy(*parts).parquet(f"{path}/new")
    spark._jvm.org.apache.commons.io.FileUtils.deleteDirectory(spark._jvm.java.io.File(f"{path}/{table}"))
    spark._jvm.java.io.File(f"{path}/new").renameTo(spark._jvm.java.io.File(f"{path}/{table}"))


DAMAGE = {
    "a chunk's bytes": ("store", lambda t: t.withColumn("data", F.when(F.col("kind") == "chunk", F.encode(F.lit("xx"), "utf-8")).otherwise(F.col("data"))), "does not fit its address"),
    "a chunk gone": ("store", lambda t: t.filter("kind = 'recipe' or n < 50"), "not in the store"),
    "a recipe gone": ("recipes", lambda t: t.filter("doc_id <> 4 or kind = 'part'"), "does not fit the manifest"),
    "recipes exchanged": ("recipes", lambda t: t.withColumn("nr", F.when(F.col("kind") == "recipe", F.lit(1) - F.col("nr")).otherwise(F.col("nr"))), "does not fit the manifest"),
    "a recipe's chunks": ("recipes", lambda t: t.withColumn("addresses", F.when(F.col("doc_id") == 4, F.reverse("addresses")).otherwise(F.col("addresses"))), "does not fit its root"),
    "the manifest's root": ("manifest", lambda t: t.withColumn("root", F.when(F.col("part") == 1, F.encode(F.lit("x" * 16), "utf-8")).otherwise(F.col("root"))), "does not fit the manifest"),
    "a line of the manifest gone": ("manifest", lambda t: t.filter("part <> 1"), "does not fit the manifest"),
    "the manifest's starts": ("manifest", lambda t: t.withColumn("start", F.col("start") + F.col("part")), "does not fit the manifest"),
}


@pytest.mark.parametrize("name", DAMAGE)
def test_damage_is_noticed(spark, make, tmp_path, name):
    table, change, message = DAMAGE[name]
    path = str(tmp_path / "s")
    r = random.Random(1)
    token_store.write(make({i: " ".join(r.choice("one two three four five six".split()) for _ in range(900)) for i in range(8)}), path)
    _change(spark, path, table, change)
    with pytest.raises(Exception, match=message):
        token_store.read(spark, path).collect()
