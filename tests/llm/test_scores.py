"""Toxicity and quality: held-out accuracy, odd rows, no labels."""

import numpy as np
import pytest

from starloom.llm import quality, toxicity
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("query, label, least", [("op8_toxicity", "toxic", 0.93), ("op9_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, query, label, least):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES[query](spark, SF).cache()
    assert rows.count() == docs.count() and rows.filter("score < 0 or score > 1 or score is null").count() == 0
    held = rows.filter("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    rows.unpersist()
    assert np.mean([r.predicted == r[label] for r in held]) >= least


def test_pairs_matter_beyond_single_terms():
    """Two terms that are harmless alone: the factors find what single weights cannot."""
    labels = np.array([0, 0, 0, 1.0] * 100)
    row = np.concatenate([[i] * (i % 4 == 1) + [i] * (i % 4 == 2) + [i, i] * (i % 4 == 3) for i in range(400)]).astype(int)
    at = np.concatenate([[0] * (i % 4 == 1) + [1] * (i % 4 == 2) + [0, 1] * (i % 4 == 3) for i in range(400)]).astype(int)
    model = toxicity.fit_machine(labels, row, at, np.ones(len(at)), np.array([10, 20]), steps=600)
    margin = model.margins(row, at, np.ones(len(at)), 400)
    assert ((margin > 0) == (labels == 1)).all() and model.factors[0] @ model.factors[1] > 1


def test_a_signal_of_pairs_alone_is_learned_from_texts(spark):
    """Either word alone marks a document, both or none do not: no single word tells anything."""
    words = [w for i in range(40) for w in [f"filler{i}"]]
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1_200):
        a, b = i % 2, i // 2 % 2
        rows.append((i, " ".join([*rng.choice(words, 6), *["wolf"] * a, *["moon"] * b]), int(a != b)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    machine = toxicity.train(frame.select("doc_id", "text"), frame.filter("doc_id < 900").select("doc_id", "toxic"))
    got = toxicity.score(frame, machine).filter("doc_id >= 900").collect()
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in got]) > 0.9


def plain_score(machine, text):
    """The machine's formula, pair by pair."""
    counts = {}
    for word in toxicity._LETTERS.findall((text or "").lower()):
        for term in toxicity.terms_of(word):
            counts[term] = counts.get(term, 0) + 1
    place = {int(t): i for i, t in enumerate(machine.terms)}
    x = [(place[t], n ** 0.5) for t, n in counts.items() if t in place]
    margin = machine.base + sum(machine.weights[i] * v for i, v in x)
    margin += sum(machine.factors[i] @ machine.factors[j] * v * w for k, (i, v) in enumerate(x) for j, w in x[:k])
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def test_scores_equal_the_formula(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    machine = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), labels)
    for r in toxicity.score(docs, machine).collect():
        assert r.score == pytest.approx(plain_score(machine, r.text), abs=1e-9)


def test_rows_that_repeat_an_id_teach_once(spark):
    docs = spark.createDataFrame([(i, "good words" if i % 2 else "bad words") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(40)], "doc_id long, toxic int")
    once, many = toxicity.train(docs, labels), toxicity.train(docs.unionByName(docs).unionByName(docs.filter("doc_id = 1")), labels)
    assert (once.terms == many.terms).all() and np.allclose(once.weights, many.weights)


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9.0), (2, "", 9.0), (2, "", 9.0), (None, "word " * 9000, 9.0)], "doc_id long, text string, score double")
    none = toxicity.train(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    rows = toxicity.score(docs, none).collect()
    assert len(rows) == 4 and all(r.score < 1e-9 for r in rows)
    assert toxicity.score(docs.limit(0), none).count() == 0
    mixed = toxicity.train(docs, spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int"))
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, mixed).collect())


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "word " * 9000), (4, "\ud7ff é\n\n")], "doc_id long, text string")
    stats = quality.with_statistics(docs)
    for labels in ([], [(1, 1)], [(1, 1), (3, 0)]):
        known = spark.createDataFrame(labels, "doc_id long, label int")
        model = quality.train(stats, stats.join(known, "doc_id").select("stats", "label"))
        scores = [r.score for r in quality.score(stats, model).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert quality.score(quality.with_statistics(docs.limit(0)), model).count() == 0


def test_pooling_gives_the_least_squares_order():
    got = quality.pool_adjacent_violators(np.array([1, 1, 2, 1.0]), np.array([0.2, 0.8, 0.5, 0.9]))
    assert got == pytest.approx([0.2, 0.6, 0.6, 0.9])


def test_quality_equals_plain_ridge_and_pooling(spark):
    """The model from Spark's sums against one built from the whole matrix, calibrated out of fold."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(240):
        good = i % 2
        words = rng.choice(["alpha", "beta", "gamma", "delta", "click", "HERE", "$$$", "!!"], 30, p=[0.2 - 0.1 * (not good)] * 4 + [0.05 + 0.1 * (not good)] * 4)
        rows.append((i, " ".join(words) + ("." if good else "!!!") * int(rng.integers(0, 3)), good))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(4)
    stats = quality.with_statistics(docs).join(docs.select("doc_id", "label"), "doc_id")
    found = stats.select("stats", "label", quality.fold_of("stats").alias("fold")).collect()
    model = quality.train(stats.select("stats"), stats.select("stats", "label"))
    x, y, fold = np.array([r.stats for r in found]), np.array([r.label for r in found], float), np.array([r.fold for r in found])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.where(x.std(0) > 1e-9, x.std(0), 1))

    def solved(rows):
        z = np.hstack([np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((x[rows] - model.mean) / model.scale, -8, 8) @ model.projection + model.phase), np.ones((rows.sum(), 1))])
        return z, np.linalg.solve(z.T @ z + quality.RIDGE * rows.sum() * np.diag([1.0] * quality.FEATURES + [0.0]), z.T @ y[rows])

    everything = np.ones(len(y), bool)
    z, weights = solved(everything)
    assert np.allclose(model.weights, weights, atol=1e-6)
    raw = np.array([z[i] @ solved(fold != fold[i])[1] for i in range(len(y))])
    at = np.round(raw * quality.BINS)
    knots = np.unique(at)
    plain = [max(min(np.mean(y[(at >= a) & (at <= b)]) for b in knots[knots >= k]) for a in knots[knots <= k]) for k in knots]
    assert np.allclose(model.knots, knots / quality.BINS, atol=2e-3) and np.allclose(model.levels, plain, atol=0.02)


def test_clashing_columns_and_missing_ids(spark, tmp_path):
    docs = spark.createDataFrame([(i if i else None, f"some text {i}", 7, 8, 9) for i in range(30)],
                                 "doc_id long, text string, score int, stats int, label int")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(30)], "doc_id long, toxic int, quality int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for query in ("op8_toxicity", "op9_quality"):
        rows = QUERIES[query](spark, str(tmp_path)).collect()
        assert len(rows) == 30 and all(0 <= r.score <= 1 for r in rows)
        assert [r.held_out for r in rows if r.doc_id is None] == [False]
