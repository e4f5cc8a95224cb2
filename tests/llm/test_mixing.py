"""Mixing: targets, exact budgets, repeats, odd rows."""

import pytest
from pyspark.sql import functions as F

from starloom.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        level = left / max(1, sum(weight[s] for s in free))
        above = {s for s in free if weight[s] * level > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else weight[s] * level for s in names}
        capped |= above


def test_targets_budgets_and_limits(spark):
    rows = [(i, ("hot", "a", "b", None, "tiny", "zz")[min(5, i % 9)], (i * 37) % 50) for i in range(900)]
    rows += [(7, "hot", 12), (7, "hot", 12), (None, "a", 4), (1000, "empty", 0), (1001, "a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(5)
    got = mixing.mix(frame).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, source, size in rows:
        sizes[source] = sizes.get(source, 0) + (size or 0)
    targets = plain_targets(sizes)
    for source, size in sizes.items():
        own = [r for r in got if r.source == source]
        assert all(r.source_size == size and r.target == pytest.approx(targets[source]) for r in own)
        assert sum(r.taken for r in own) == int(targets[source] + 1e-9)
        assert all(0 <= r.taken <= 3 * (r.size or 0) for r in own)
    again = mixing.mix(frame.repartition(2)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size or 0, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_rows_of_the_mix(spark):
    frame = spark.createDataFrame([(1, "s", " a b  c d e", 11, 5), (2, "t", "x y", 3, 2), (3, "u", "", 0, 0)],
                                  "doc_id long, source string, text string, n_chars long, size long")
    mixed = mixing.mix(frame)
    words = mixed.agg(F.sum("taken")).first()[0]
    rows = mixing.mixed_rows(mixed).collect()
    assert sum(len(r.text.split()) for r in rows) == words
    assert all(r.n_chars == len(r.text) for r in rows) and all(r.doc_id != 3 for r in rows)


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(frame).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(frame.withColumn("taken", F.lit(1)))
