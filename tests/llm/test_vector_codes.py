"""Vector codes against plain searches."""

import math

import numpy as np
import pytest

from starloom.llm import vector_codes
from starloom.llm.vector_codes import Codebooks


def plain(rows, parts, entries, rounds):
    """Sorted (id, code, error, label_error) and the codebooks, by plain loops over Python integers."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][1]) // parts if kept else 0
    cut = lambda v, p: v[p * size:(p + 1) * size]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0], r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(v, p):
        return min((sum((x - y) ** 2 for x, y in zip(cut(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        members = [[[] for _ in books[p]] for p in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                members[p][nearest(v, p)[1]].append(cut(v, p))
        books = [[[sum(c) // len(m) for c in zip(*m)] if m else e for e, m in zip(books[p], members[p])] for p in range(parts)]
    out = []
    for i, v, label in kept:
        found = [nearest(v, p) for p in range(parts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), label))
    total = {}
    for _, _, error, label in out:
        total[label] = total.get(label, 0) + error
    return sorted(((i, c, e, total[label]) for i, c, e, label in out), key=str), books


def coded(frame, parts, entries, rounds):
    rows, books = vector_codes.compress(frame, parts=parts, entries=entries, rounds=rounds)
    out = vector_codes.with_label_error(rows).collect()
    return sorted(((r.id, r.code, r.error, r.label_error) for r in out), key=str), books


@pytest.mark.parametrize("parts, entries, spread", [(4, 8, 1.0), (2, 30, 0.01), (8, 200, 3.0)])
def test_codes_equal_plain_search(spark, parts, entries, spread):
    """Coarse components give many ties, equal sums and repeated entries; a label is null, rows repeat."""
    rng = np.random.default_rng(parts)
    rows = [(int(i), [float(np.float32(x)) for x in np.round(rng.normal(scale=spread, size=8), 2)], None if i % 5 == 0 else int(i % 3)) for i in rng.permutation(120)]
    rows += [(500 + i, rows[0][1], 1) for i in range(30)] + [(7, rows[3][1], 2), (None, rows[4][1], 2)]
    rows += [(600, None, 1), (601, [1.0, None] * 4, 1), (602, [float("nan")] * 8, 1), (603, [float("inf")] * 8, 1), (604, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got, books = coded(frame, parts, entries, 2)
    want, plain_books = plain(rows, parts, entries, 2)
    assert got == want
    assert books[8].entries.tolist() == plain_books


def test_search_is_exact_for_any_entries():
    rng = np.random.default_rng(2)
    for size, high in ((1, 3), (4, 2), (4, 1 << 22), (3, 50)):
        books = Codebooks(rng.integers(-high, high, (5, 40, size)))
        rows = rng.integers(-high, high, (300, 5, size))
        index, apart = books.nearest(rows)
        all_pairs = ((rows[:, :, None, :] - books.entries[None]) ** 2).sum(-1)
        assert (apart == all_pairs.min(2)).all() and (index == all_pairs.argmin(2)).all()


def test_lengths_have_codebooks_of_their_own_and_codes_can_be_restored(spark):
    rows = [(i, [i / 4.0] * 4, 0) for i in range(3)] + [(10 + i, [float(i)] * 8, 0) for i in range(3)] + [(20, [1.0] * 3, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out, books = vector_codes.compress(frame, parts=4, entries=64)
    codes = {r.id: r.code for r in out.collect()}
    assert sorted(codes) == [0, 1, 2, 10, 11, 12] and sorted(books) == [4, 8]
    assert vector_codes.restored([codes[1]], books[4]).tolist() == [[0.25] * 4] and vector_codes.restored([codes[12]], books[8]).tolist() == [[2.0] * 8]


def test_empty_table_clashing_columns_and_huge_components(spark):
    frame = spark.createDataFrame([(1, [1e30, -1e30], 3)], "vec_id long, embedding array<float>, label int")
    wide = frame.selectExpr("*", "1 as id", "'x' as code", "2 as error", "3 as v")
    assert coded(wide, 2, 4, 2)[0] == [(1, "0000", 0, 0)]
    assert coded(frame.limit(0), 2, 4, 2)[0] == []
