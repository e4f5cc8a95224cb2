"""The range join against all pairs."""

import numpy as np
import pytest

from starloom.llm import embedding_join


def plain(rows, cosine):
    def unit(v):
        if v is None or not len(v) or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.linalg.norm(v)

    units = [unit(v) for _, v in rows]
    n, root = len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * n
    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((rows[i][0], links[i], least[find(i)], rows[i][0] == least[find(i)]) for i in range(n))


@pytest.mark.parametrize("cell, block, tile", [(1024, 1024, 256), (12, 7, 3), (40, 1000, 5)])
def test_links_equal_all_pairs(spark, monkeypatch, cell, block, tile):
    monkeypatch.setattr(embedding_join, "CELL", cell)
    monkeypatch.setattr(embedding_join, "BLOCK", block)
    monkeypatch.setattr(embedding_join, "TILE", tile)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 6))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + rng.normal(scale=0.25, size=6)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(20)]  # one common vector
    rows += [(300, None), (301, [0.0] * 6), (302, [1.0, float("nan"), 0.0, 0.0, 0.0, 0.0]), (303, [float("inf")] + [1.0] * 5), (304, []),
             (305, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (306, [3.0, 4.0]), (307, [3.0, 4.1]), (308, [1e30] * 6), (309, [1e-30] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = sorted(tuple(r) for r in embedding_join.range_join(frame, 0.95).collect())
    assert got == plain(rows, 0.95)


def test_empty_and_unusable_tables(spark):
    frame = spark.createDataFrame([(5, None), (6, [0.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in embedding_join.range_join(frame, 0.95).collect()) == [(5, 0, 5, True), (6, 0, 6, True)]
    assert embedding_join.range_join(frame.limit(0), 0.95).count() == 0


@pytest.mark.parametrize("spread", [0.02, 0.06, 0.12])
def test_no_link_is_lost_near_the_threshold(spread):
    """Chains and dense groups, most pairs near the threshold: the pairs of a tile equal those of double precision."""
    rng = np.random.default_rng(int(spread * 100))
    rows = np.repeat(rng.normal(size=(20, 24)), 15, axis=0)
    rows += rng.normal(scale=spread * np.sqrt(24) / 2, size=rows.shape)
    x = embedding_join._unit(rows)
    want = (x @ x.T >= 0.95)
    got = np.zeros_like(want)
    for start in range(0, len(x), 64):
        i, j = embedding_join._linked_pairs(x, x, 0.95, slice(start, start + 64), x.astype(np.float32), x.astype(np.float32))
        got[i, j] = True
    assert (got == want).all() and want.sum() > len(x)


def test_other_columns_do_not_clash(spark):
    rows = [(1, [1.0, 0.0], 5), (2, [1.0, 0.01], 5), (3, [0.0, 1.0], 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int").selectExpr("*", "1 as id", "2 as vector", "3 as copies", "4 as component")
    assert sorted(tuple(r) for r in embedding_join.range_join(frame, 0.95).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_clashing_columns_and_missing_ids(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])]
    frame = spark.createDataFrame([(*r, 5, 6, 7, 8) for r in rows], "vec_id long, embedding array<float>, n_links int, component_id int, cell int, node int")
    assert sorted(tuple(r) for r in embedding_join.range_join(frame, 0.95).collect()) == plain(rows, 0.95)
