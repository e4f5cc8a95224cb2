"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Each whole text gives ``STATISTICS``.  Standardised over the corpus, they are mapped to cosines of random
projections, whose inner products approximate a Gaussian kernel.  Every labelled row that may be
learned from adds to the normal equations of its fold: tasks sum them over their rows, a shuffle by fold and matrix row adds the
tasks' sums, and the driver solves systems of fixed size, of all folds and of all but each.  Labelled rows then give a
histogram by label (at most 3 * ``BINS`` rows) of scores from the weights that their fold had no part in, from which
pool-adjacent-violators makes a monotone map to probabilities.  A fold holds rows of equal statistics, so copies of a text share one.

Defined cases: a null or empty text has statistics of 0 and is scored like any; without labels every score is 0.5,
with labels of one kind that label; a row without an id is scored and not held out; repeated rows are scored each; an id labelled more than once
counts its largest label; other columns stay, those named like results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored, table
from starloom.llm.toxicity import fold

STATISTICS = ["chars", "words", "word_chars", "upper", "digits", "stops", "symbols", "exclaims", "bars", "quotes",
              "spaces", "high", "distinct_words", "distinct_lines", "line_words", "capital_words", "top_word", "repeats"]
FEATURES = 256
WIDTH = 5.0  # of the Gaussian kernel, in standard deviations of the statistics
RIDGE = 1e-3  # times the number of rows
BINS = 1_000
FOLDS = 3
TRACE = 0.01
# Classes of ASCII bytes.
_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "stops": b".,;:?", "symbols": b"#$%&*+=@^_~<>{}[]\\/",
            "exclaims": b"!", "bars": b"|", "quotes": b"\"'()-", "spaces": b" \t\n\r\x0b\x0c"}
_CLASS_OF = np.zeros((len(_CLASSES) + 1, 256))
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[_i, list(_bytes)] = 1
_CLASS_OF[-1, 128:] = 1


def statistics(text: str) -> list[float]:
    """``STATISTICS`` of a text, each of moderate size whatever the text's length."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n, n_words, n_lines = max(1, len(raw)), max(1, len(words)), max(1, len(lines))
    shares = _CLASS_OF @ np.bincount(raw, minlength=256) / n
    codes = np.fromiter(map(hash, words), np.int64, len(words))
    _, counts = np.unique(codes, return_counts=True)
    top = counts.max() if len(counts) else 0
    pairs = codes[:-1] * 31 + codes[1:]
    repeats = 1 - len(np.unique(pairs)) / max(1, len(pairs)) if len(pairs) else 0.0
    return [np.log1p(len(raw)), np.log1p(len(words)), np.log1p(len(raw) / n_words), *shares,
            len(counts) / n_words, len(set(lines)) / n_lines, np.log1p(len(words) / n_lines),
            sum(map(str.istitle, words)) / n_words, top / n_words, repeats]


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, stats array<double>) of each row."""
    @F.arrow_udf("array<double>")
    def stats(texts: pa.Array) -> pa.Array:
        rows = [statistics(t or "") for start in range(0, len(texts), 512) for t in texts.slice(start, 512).to_pylist()]
        return pa.array(rows, pa.list_(pa.float64()))

    return docs.select(F.col(key), stats(F.col(text)).alias("stats"))


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # fitted scores
    levels: np.ndarray  # their probabilities

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8) @ self.projection + self.phase
        return np.hstack([np.sqrt(2 / len(self.phase)) * np.cos(z), np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def probability(self, stats: np.ndarray) -> np.ndarray:
        """The calibrated level, with a trace of the fitted score so that a level's rows stay in order."""
        raw = self.raw(stats)
        return (1 - TRACE) * np.clip(np.interp(raw, self.knots, self.levels), 0, 1) + TRACE / (1 + np.exp(2 - 4 * raw))


def pool_adjacent_violators(weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence of least weighted squares."""
    blocks: list[list[float]] = []
    for w, m in zip(weight, mean):
        blocks.append([w, m, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, m2, n2 = blocks.pop()
            w1, m1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * m1 + w2 * m2) / (w1 + w2), n1 + n2]
    return np.concatenate([np.full(int(n), m) for _, m, n in blocks]) if blocks else np.zeros(0)


def _matrix(frame: DataFrame) -> np.ndarray:
    return np.array([list(r) for r in frame.collect()], float)


def fold_of(stats) -> Column:
    """The fold of a labelled row."""
    return F.pmod(F.xxhash64(stats), F.lit(FOLDS)).cast("int")


def normal_equations(rows: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """(Z'Z, Z'y) by fold over ``rows`` (stats, label, fold): summed in tasks, then by fold and matrix row."""
    size = len(model.weights)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {}
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                z = model.features(np.stack(part["stats"].to_numpy()))
                total[fold] = total.get(fold, 0) + z.T @ np.hstack([z, part["label"].to_numpy(float)[:, None]])
        for fold, matrix in total.items():
            yield pd.DataFrame({"fold": fold, "i": np.arange(size), "part": list(matrix)})

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": group["fold"][:1], "i": group["i"][:1], "part": [np.stack(group["part"].to_numpy()).sum(0)]})

    schema = "fold int, i long, part array<double>"
    total = np.zeros((FOLDS, size, size + 1))
    for r in rows.mapInPandas(summed, schema).groupBy("fold", "i").applyInPandas(added, schema).collect():
        total[r["fold"], r["i"]] = r["part"]
    return total[:, :, :-1], total[:, :, -1]


def ridge(zz: np.ndarray, zy: np.ndarray) -> np.ndarray:
    penalty = RIDGE * zz[-1, -1] * np.eye(len(zz))
    penalty[-1, -1] = 0
    return np.linalg.solve(zz + penalty, zy)


def train(stats: DataFrame, labelled: DataFrame) -> QualityModel:
    """``stats`` (.., stats) of the corpus, ``labelled`` (stats, label) of the rows to learn from."""
    n = len(STATISTICS)
    moments = stats.agg(*[F.avg(F.get("stats", i)) for i in range(n)], *[F.stddev_pop(F.get("stats", i)) for i in range(n)]).first()
    mean = np.array([v or 0.0 for v in moments[:n]])
    scale = np.array([v if v and v > 1e-9 else 1.0 for v in moments[n:]])
    random = np.random.default_rng(29)
    model = QualityModel(mean, scale, random.normal(0, 1 / WIDTH, (n, FEATURES)), random.uniform(0, 2 * np.pi, FEATURES),
                         np.zeros(FEATURES + 1), np.array([0.0]), np.array([0.5]))
    folded = labelled.select("stats", "label", fold_of("stats").alias("fold"))
    zz, zy = normal_equations(folded, model)
    if not zz[:, -1, -1].sum():
        return model
    weights = ridge(zz.sum(0), zy.sum(0))
    others = [ridge(zz.sum(0) - zz[f], zy.sum(0) - zy[f]) if (zz.sum(0) - zz[f])[-1, -1] > 0.5 else weights for f in range(FOLDS)]
    unseen = np.stack(others, axis=1)  # a column a fold: weights without it

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                raw = (model.features(np.stack(batch["stats"].to_numpy())) @ unseen)[np.arange(len(batch)), batch["fold"]]
                yield pd.DataFrame({"bin": np.clip(np.round(raw * BINS), -BINS, 2 * BINS).astype(np.int64), "label": batch["label"].astype(float)})

    bins = _matrix(folded.mapInPandas(binned, "bin long, label double").groupBy("bin")
                   .agg(F.count(F.lit(1)), F.avg("label")).orderBy("bin"))
    levels = pool_adjacent_violators(bins[:, 1], bins[:, 2])
    return QualityModel(model.mean, model.scale, model.projection, model.phase, weights, bins[:, 0] / BINS, levels)


def score(stats: DataFrame, model: QualityModel, out: str = "score") -> DataFrame:
    """``stats`` with ``out``, the calibrated probability of label 1, instead of the statistics."""
    sent = stats.sparkSession.sparkContext.broadcast(model)  # a few hundred KB, fixed by FEATURES and BINS

    @F.arrow_udf("double")
    def scored(rows: pa.Array) -> pa.Array:
        flat = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        return pa.array(sent.value.probability(flat) if len(flat) else np.zeros(0))

    return stats.select(*[c for c in stats.columns if c not in (out, "stats")], scored(F.col("stats")).alias(out))


def op9_quality(spark, sf_dir: str) -> DataFrame:
    stats = stored(with_statistics(table(spark, sf_dir, "documents")))
    learnable = (table(spark, sf_dir, "labels").filter((fold(F.col("doc_id"), 3) != 1) & F.col("quality").isNotNull())
                 .groupBy("doc_id").agg(F.max("quality").alias("label")))
    model = train(stats, stats.join(learnable, "doc_id").select("stats", "label"))
    return score(stats, model).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
