"""Encoding and decoding against the tokenizers library."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_SMALL
from tokenizers import Tokenizer

from starloom.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def ours():
    with open(PATH, encoding="utf-8") as file:
        return bpe.WordBpe(json.load(file))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts():
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz'!?.,<>|/w éüßñΣς漢字😀0123456789\t\n\x1c "
    yield from ["", " ", "don't I'LL 'S", "İstanbul ΟΔΟΣ.", "a\x1cb\x85c d", "<|endoftext|>Hi<|startoftext|> <|endoftext", "é ́a e\u0301",
                "12 3²½Ⅷ ٣", "a" * 3000, "😀👍🏽🇩🇪 </w> <w>", "日本語 한국어", "x" * 20000 + " y"]
    for _ in range(1500):
        yield "".join(rng.choice(letters) for _ in range(rng.randint(1, 60)))


def test_ids_and_text_equal_the_library(ours, library):
    texts = list(odd_texts())
    got = [row for at in range(0, len(texts), 100) for row in ours.encode_rows(texts[at:at + 100])]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [g.tolist() for g in got] == expected
    decoded = ours.decode_rows(bpe._list_array(got)).to_pylist()
    assert decoded == [library.decode(e, skip_special_tokens=False) for e in expected]


def test_compatibility_is_what_merging_says(ours):
    """A pair of pieces is compatible exactly when merging their bytes gives the pair back."""
    rng = np.random.default_rng(1)
    inner = np.flatnonzero([not n.endswith("</w>") for n in ours.names[:-2]])
    final = np.flatnonzero([n.endswith("</w>") for n in ours.names[:-2]])
    a, b = rng.choice(inner, 3000), rng.choice(final, 3000)
    byte_of = {c: i for i, c in enumerate(bpe.byte_alphabet())}
    words = [[byte_of[c] for c in ours.names[x] + ours.names[y][:-4]] for x, y in zip(a, b)]
    ids, owner = ours.merge(np.concatenate(words).astype(np.int64), np.repeat(np.arange(len(words)), list(map(len, words))))
    merged = np.split(ids, np.flatnonzero(np.diff(owner)) + 1)
    assert ours.compatible(a, b).tolist() == [m.tolist() == [x, y] for m, x, y in zip(merged, a, b)]


def test_cache_is_emptied_without_changing_results(ours, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 40)
    small = bpe.WordBpe(json.load(open(PATH, encoding="utf-8")))
    texts = [" ".join(f"word{i * j} thing" for j in range(60)) for i in range(12)]
    got = [small.encode_rows([t])[0].tolist() for t in texts]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_whole_documents_and_edge_rows(spark, library):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "again"), (-3, "again"), (None, "no id")], "doc_id long, text string")
    rows = bpe.with_tokens(docs.unionByName(odd), PATH).collect()
    assert len(rows) == docs.count() + 5
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == ids and r.decoded == library.decode(ids, skip_special_tokens=False)


def test_clashing_columns_and_empty_table(spark):
    clash = spark.createDataFrame([(1, "a b", "old", 5)], "doc_id long, text string, decoded string, ids int")
    row = bpe.with_tokens(clash, PATH).first()
    assert row.decoded == "a</w> b</w>" and len(row.ids) == 2
    assert bpe.digests(bpe.with_tokens(clash.limit(0), PATH)).count() == 0
