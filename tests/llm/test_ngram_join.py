"""The shingle join against all pairs on small corpora."""

import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from starloom.llm import ngram_join
from starloom.llm.components import components
from starloom.llm.shingles import shingle_sets


def plain_sets(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} - {()}


def plain_components(rows, k, percent):
    sets = [plain_sets(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, n, sizes, edits, groups, passage=0):
    """Groups of edited copies of a few texts, with a passage that many texts share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    shared = [word() for _ in range(passage)]
    bases = [[word() for _ in range(rng.choice(sizes))] for _ in range(groups)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.randint(0, edits)):
            at = rng.randrange(len(words) + 1)
            if words and rng.random() < 0.5:
                words[at % len(words)] = word()
            else:
                words.insert(at, word())
        rows.append((i * 3 + 1, " ".join(shared + words)))
    return rows


def result(spark, rows, k, percent):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(tuple(r) for r in ngram_join.jaccard_components(docs, k, percent).collect())


ODD = [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "One two"), (9005, "one TWO"), (9006, "one"), (9007, "é É x y z"),
       (9008, "same text again and again here"), (9009, "same text again and again here"), (9010, "w " * 4000)]


@pytest.mark.parametrize("seed, n, sizes, edits, groups, passage, k, percent", [
    (1, 150, range(3, 18), 1, 12, 0, 4, 85),   # light sets and the boundary
    (2, 120, range(30, 90), 3, 6, 30, 4, 85),  # heavy sets that share a passage
    (3, 120, range(8, 40), 2, 8, 5, 2, 80),
])
def test_components_equal_all_pairs(spark, seed, n, sizes, edits, groups, passage, k, percent):
    rows = corpus(seed, n, sizes, edits, groups, passage) + ODD
    assert result(spark, rows, k, percent) == plain_components(rows, k, percent)


def test_every_boundary_gives_the_same(spark, monkeypatch):
    rows = corpus(5, 90, range(4, 20), 1, 8) + ODD
    expected = plain_components(rows, 3, 85)
    for boundary in (0, 9):
        monkeypatch.setattr(ngram_join, "light_boundary", lambda *a, b=boundary: b)
        assert result(spark, rows, 3, 85) == expected


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n int, component long")
    assert ngram_join.jaccard_components(docs, 4, 85).count() == 0
    rows = [(4, "a b c d e f"), (4, "a b c d e f"), (2, "A B c d e f")]
    assert result(spark, rows, 4, 85) == [(2, 3, 2), (4, 3, 2), (4, 3, 2)]


def test_rows_without_an_id_link_at_every_size(spark):
    """A set that only rows without an id have is the bridge between two documents."""
    for size in (14, 120):
        words, edits = [f"w{i}" for i in range(size)], size // 20 + 1
        ends = [words + [f"{side}{i}" for i in range(edits)] for side in ("a", "b")]
        rows = [(5, " ".join(ends[0])), (None, " ".join(words)), (8, " ".join(ends[1])), (9, "something else that is quite different")]
        sets = [plain_sets(t, 2) for _, t in rows]
        linked = lambda i, j: 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])
        assert linked(0, 1) and linked(1, 2) and not linked(0, 2)
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs, 2, 90).collect()}
        assert got == {5: 5, None: 5, 8: 5, 9: 9}, size


def test_shingle_hashes_tell_sets_apart():
    texts = [t for _, t in corpus(7, 300, range(1, 60), 4, 20)] + ["a b c", "A b C", "a\x0bb c", "ab c", "", None]
    plain = [frozenset(plain_sets(t, 4)) for t in texts]
    hashed = [s.tobytes() for s in shingle_sets(pa.array(texts), 4)]
    assert [len(p) * 8 for p in plain] == [len(h) for h in hashed]
    assert len(set(plain)) == len(set(zip(plain, hashed))) == len(set(hashed))


def test_cost_sets_the_boundary():
    assert ngram_join.light_boundary({3: 1000, 5: 1000}, 85) >= 5
    assert ngram_join.light_boundary({30: 1000}, 85) < 30
    for n in range(1, 60):
        for m in ngram_join.partner_sizes(n, 85):
            t = ngram_join.least_overlap(n, m, 85)
            assert 100 * t >= 85 * (n + m - t) and 100 * (t - 1) < 85 * (n + m - t + 1)


def test_components_of_chains_and_hubs(spark):
    rng = np.random.default_rng(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(80)] + [(500, 500)] + [(900, 901), (901, 900)]
    rng.shuffle(links)
    got = {r.node: r.component for r in components(spark.createDataFrame([tuple(map(int, x)) for x in links], "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[200 + i] == 100 for i in range(80))
    assert got[500] == 500 and got[901] == 900 and len(got) == 61 + 81 + 1 + 2


def test_long_lists_are_compared_in_blocks(spark, monkeypatch):
    """Every list counts as long and every block is small: the result is the same."""
    rows = corpus(11, 130, range(20, 50), 6, 3, 8) + ODD
    monkeypatch.setattr(ngram_join, "STAR_ROUNDS", 1)
    monkeypatch.setattr(ngram_join, "CROWD", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 9)
    assert result(spark, rows, 4, 85) == plain_components(rows, 4, 85)


def test_keys_carry_no_more_than_they_need(spark):
    """A list entry's prefix length follows from its set's size, and is not shuffled with it."""
    sizes = spark.range(1, 3000).selectExpr("cast(id as int) n")
    for percent in (50, 80, 85, 100):
        rows = sizes.select("n", ngram_join.prefix_column(percent).alias("p")).collect()
        assert all(r.p == ngram_join.prefix_length(r.n, percent) for r in rows)
    docs = spark.createDataFrame([(" ".join(map(str, range(60))),)], "text string")
    counts = spark.sparkContext.broadcast(np.zeros(1 << ngram_join.BIN_BITS, np.int64))
    keys = ngram_join.keys_of(docs, 4, 85, 10, counts)
    assert keys.columns == ["kind", "key", "set_id", "n"]
    assert keys.count() == ngram_join.prefix_length(57, 85)


def test_clashing_columns(spark):
    rows = corpus(3, 40, range(8, 30), 1, 4) + ODD
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows],
                                 "doc_id long, text string, n int, set_id int, text_id int, component int, key int").repartition(3)
    assert sorted(tuple(r) for r in ngram_join.jaccard_components(docs, 4, 85).collect()) == plain_components(rows, 4, 85)


def test_whole_sets_are_shuffled_once(spark):
    """Repeated ids, rows without an id and texts without words: each wanted set comes once, over one exchange."""
    rows = [(1, "a b c d e"), (1, "a b c d e"), (1, "f g h i j"), (None, "k l m n o"), (None, "k l m n o"), (2, ""), (3, None), (4, "p q r s t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    first = ngram_join.signatures(docs, 4).filter("bin is null").select("doc_id", "text_id", "n", "set_id")
    wanted = first.filter("set_id is not null and (doc_id is null or doc_id < 4)").select("set_id")
    sets = ngram_join.whole_sets(docs, first, wanted, 4)
    assert sets._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    got = {r.set_id: bytes(r.shingles) for r in sets.collect()}
    assert len(got) == sets.count() and {r.set_id for r in wanted.collect()} <= set(got)
    texts = pa.array(["a b c d e", "f g h i j", "k l m n o"])
    for shingles in shingle_sets(texts, 4):
        assert got[ngram_join.set_id(shingles)] == shingles.tobytes()


def test_a_block_that_meets_itself_is_compared_once_sent(spark):
    """One side marked as both gives the links of the two sides sent apart."""
    sets = [s for s in shingle_sets(pa.array([t for _, t in corpus(13, 60, range(20, 40), 2, 6)]), 4)]
    rows = [{"set_id": i, "component": i, "shingles": s.tobytes()} for i, s in enumerate(sets)]
    once = pd.DataFrame([{**r, "side": ngram_join.BOTH} for r in rows])
    twice = pd.DataFrame([{**r, "side": side} for side in (0, 1) for r in rows])
    links = [ngram_join._block_links(85)(None, group) for group in (once, twice)]
    assert len(links[0]) and links[0].equals(links[1])
