"""The positional index against plain scans."""

import random
import re

import pytest

from starloom.llm import phrase_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(text, width):
    w = words(text)
    size = min(width, len(w))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if w else set()


def plain(docs, items, width, slop):
    """Sorted (doc_id, n_words, hit positions, items, items nearby)."""
    out = []
    for doc_id, text in docs:
        w, hit, exact, near = words(text), set(), set(), set()
        for item_id, item in items:
            for window in windows(item, width):
                for i in range(len(w) - len(window) + 1):
                    if tuple(w[i:i + len(window)]) == window:
                        hit.update(range(i, i + len(window)))
                        exact.add(item_id)
                span = len(window) + slop
                if any(set(window) <= set(w[i:i + span]) for i in range(len(w))):
                    near.add(item_id)
        out.append((doc_id, len(w), sorted(hit), sorted(exact - {None}), sorted(near - {None})))
    return sorted(out, key=str)


def found(spark, docs, items, width, slop):
    frame = phrase_index.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                       spark.createDataFrame(items, "item_id long, text string"), width, slop)
    rows = frame.withColumn("n", phrase_index.covered(frame["spans"])).collect()
    out = []
    for r in rows:
        hit = sorted({p for s in r.spans for p in range(s.start, s.end)})
        assert r.n == len(hit)
        out.append((r.doc_id, r.n_words, hit, sorted(r["items"]), sorted(r.near)))
    return sorted(out, key=str)


DOCS = [(1, None), (2, ""), (3, "... !"), (4, "The quick, BROWN fox! jumps over the lazy dog"), (4, "The quick, BROWN fox! jumps over the lazy dog"),
        (None, "brown quick the"), (5, "a a a a a b a a a"), (6, "Übung macht den Meister 日本語 Übung"), (7, "dog the lazy")]
ITEMS = [(1, "quick brown fox"), (1, "lazy dog"), (2, "a a a"), (3, "den MEISTER 日本語"), (4, None), (5, ""), (6, "..."), (None, "jumps over"), (7, "dog"),
         (8, "missing words here"), (9, "the quick brown fox jumps over the lazy dog again")]


@pytest.mark.parametrize("width, segment, candidates", [(3, 4_000_000, 1_000_000), (2, 30, 3), (10, 30, 1)])
def test_odd_rows(spark, monkeypatch, width, segment, candidates):
    monkeypatch.setattr(phrase_index, "SEGMENT_BYTES", segment)
    monkeypatch.setattr(phrase_index, "CANDIDATES", candidates)
    assert found(spark, DOCS, ITEMS, width, 2) == plain(DOCS, ITEMS, width, 2)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts_in_blocks_of_items(spark, monkeypatch, seed):
    """Few words, so that lists are long and windows overlap; several blocks of items meet in a document."""
    monkeypatch.setattr(phrase_index, "SEGMENT_BYTES", 150)
    monkeypatch.setattr(phrase_index, "ITEM_BYTES", 60)
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choice("abcde") for _ in range(rnd.randrange(n)))
    docs, items = [(i, text(40)) for i in range(40)], [(i, text(9)) for i in range(12)]
    assert found(spark, docs, items, 4, 3) == plain(docs, items, 4, 3)


def test_empty_tables_and_clashing_columns(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    for frame in (phrase_index.contamination(docs, items.limit(0)), phrase_index.contamination(docs.limit(0), items)):
        assert all(not r.spans and not r["items"] for r in frame.collect())
    extra = docs.selectExpr("*", "1 as segment", "'x' as items", "2 as ordinal", "text as spans")
    got = phrase_index.contamination(extra, items.selectExpr("*", "7 as doc_id"))
    assert got.count() == len(DOCS)
    with pytest.raises(ValueError):
        phrase_index.search(phrase_index.build_index(docs), items, width=60, slop=10)
