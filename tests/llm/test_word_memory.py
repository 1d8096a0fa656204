"""What an encoder remembers: a plain small word once, and the same ids whatever is remembered."""

import pickle
import random
import re

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from lipiflow.llm import token_store


def test_words_are_kept_once(monkeypatch):
    encoder = token_store.Encoder(token_store.default_tokenizer())
    words = [f"{a}{b}" for a in ("wort", "zebra", "élan", "quux") for b in ("ab", "cde", "x")]
    encoder.ids(" ".join(words))
    assert not encoder.stems and len(encoder.known) == len(words)
    text = " ".join(f"{w.title()}, ({w})! {w}'s 12{w} {w}" for w in words)
    assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(token_store, "WORDS_KEPT", 3)
    monkeypatch.setattr(token_store, "STEMS_KEPT", 3)
    parts = text.split() * 3
    random.Random(1).shuffle(parts)
    text = " ".join(parts)
    assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_a_worker_keeps_one_encoder(monkeypatch):
    made, init = [], token_store.Encoder.__init__
    monkeypatch.setattr(token_store.Encoder, "__init__", lambda self, path: (made.append(path), init(self, path))[1])
    monkeypatch.setattr(token_store, "_worker", {})
    path = token_store.default_tokenizer()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["one word", None])], ["_id", "_text"])
    for sent in [cloudpickle.dumps(token_store._encode(path))] * 3:
        assert sum(b.num_rows for b in pickle.loads(sent)(iter([batch]))) == 4
    assert made == [path]


def test_long_words_are_not_kept():
    encoder = token_store.Encoder(token_store.default_tokenizer())
    words = ["z" * 50 + chr(97 + i) for i in range(20)] + ["語" * 60, "!" * 70, "Q" * 45]
    text = "\n".join(words)
    assert encoder.ids(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert not encoder.known and not encoder.stems


def test_many_texts_at_once(monkeypatch):
    encoder = token_store.Encoder(token_store.default_tokenizer())
    letters = [chr(c) for c in range(0x21, 0x250) if re.match(f"[!-~{token_store.LETTERS}]", chr(c))] + [" ", "\n", "\t", "\r", "é", "İ", "Σ", "語", "x×", "😀", "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>"]
    dice = random.Random(2)
    texts = [None, "", " ", "\n\n", *["".join(dice.choices(letters, k=dice.randrange(40))) for _ in range(3000)], *(f"a{c} {c}b\n{c}" for c in letters)]
    array = pa.array(["left out", *texts])[1:]
    monkeypatch.setattr(token_store, "BYTES_IN", 500)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), array], ["_id", "_text"])
    found = []
    for few in token_store._slices(batch):
        ids, ends = encoder.batch(few.column("_text"))
        found += [part.tolist() for part in np.split(ids, ends[:-1])]
    assert found == [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
