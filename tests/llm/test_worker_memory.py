"""What the Python side of a step holds at a time does not follow the size of a batch."""

import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from starloom.llm import shingles, toxicity
from starloom.llm.common import memory_returned


def texts(rows: int, words: int) -> list[str]:
    rng = np.random.default_rng(8)
    return [" ".join(f"w{chr(97 + x % 26)}ord{chr(97 + x // 26 % 26)}{chr(97 + x // 676)}" for x in rng.integers(0, 9000, words)) for _ in range(rows)]


def peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_shingles_of_a_batch_are_made_piece_by_piece(monkeypatch):
    monkeypatch.setattr(shingles, "_powers", [np.ones(1, np.uint64), np.ones(1, np.uint64)])
    batch = pa.array(texts(1000, 300))
    assert batch.nbytes > 2_000_000
    assert peak_mb(lambda: [None for _ in shingles.shingle_sets(batch, 5)]) < 30


def test_pieces_do_not_change_the_sets(monkeypatch):
    batch = pa.array([*texts(300, 200), None, "", "one", "x " * 200_000])
    expected = [s.tolist() for s in shingles.shingle_sets(batch, 5)]
    monkeypatch.setattr(shingles, "ROWS_BYTES", 10_000_000)
    assert [s.tolist() for s in shingles.shingle_sets(batch, 5)] == expected


def test_terms_of_labelled_texts_are_counted_piece_by_piece():
    rows = texts(1000, 300)
    batch = pd.DataFrame({"_key": range(1000), "_text": rows, "_label": 0})
    assert peak_mb(lambda: [None for _ in toxicity.counted(iter([batch]))]) < 30
    got = pd.concat(toxicity.counted(iter([batch])))
    row, term, n = toxicity._counts(rows, toxicity._Terms(None).__getitem__)
    assert got["id"].tolist() == [str(i) for i in range(1000)]
    assert np.concatenate(got["term"].tolist()).tolist() == term.tolist() and np.concatenate(got["n"].tolist()).tolist() == n.tolist()


def test_memory_is_returned_after_the_rows():
    assert list(memory_returned(lambda batches: (2 * b for b in batches))(iter([1, 2]))) == [2, 4]
    with pytest.raises(ZeroDivisionError):
        list(memory_returned(lambda batches: (1 // b for b in batches))(iter([1, 0])))
