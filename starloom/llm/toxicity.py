"""Toxicity by a factorization machine over hashed terms.

A term is a lower-cased run of letters, or the first 4 to 7 letters of a longer one; it is
hashed to one of 2**20 buckets.  score = sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j) with
x = sqrt(occurrences): the factors learn pairs of terms that matter together, which single weights
miss.  The machine is fitted on the driver on at most ``SAMPLE`` labelled rows, those with the least hash
of their id; only hashed counts leave the executors.  A term enters by its chi-square with the label over that sample, or, since
a term may matter only together with another, by a pair: of the ``FREQUENT`` most frequent terms all pairs are tested for
an interaction (label 1 is more, or less, frequent with both than either term alone explains).  All frequent terms at once would
only add noise.  Every whole text is scored.

Defined cases: a null or empty text has no terms and gets the base rate; without labels of both kinds
the score is the share of label 1 (0 without any); repeated rows are scored each; a label table that repeats an
id counts its largest label, and a document table that repeats an id teaches by its least row; rows with a null label or id teach nothing; other columns stay, those
named like results are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import least_hash_sample, memory_returned, stored, table

BUCKETS = 1 << 20
PREFIXES = (4, 5, 6, 7)
SAMPLE = 12_000  # most labelled rows that the fit looks at
TERMS = 8_192  # most terms of a model
FREQUENT = 512  # terms whose pairs are tested
PAIR_Z = 6.0  # standard deviations from which on a pair's interaction counts: chance does not reach it among all pairs
MIN_ROWS = 3  # rows of the sample that a term must occur in
FACTORS = 4
CACHE_WORDS = 150_000  # words that a task remembers; then it starts anew
ROWS_AT_ONCE = 128  # texts whose terms are counted together
_LETTERS = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[int]:
    """Buckets of a word and its prefixes."""
    out = [zlib.crc32(word.encode("utf-8")) % BUCKETS]
    for n in PREFIXES:
        if len(word) > n:
            out.append(zlib.crc32(f"{n}:{word[:n]}".encode()) % BUCKETS)
    return out


def _counts(texts: list[str], lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, occurrences) of texts; ``lookup`` gives a word's terms (maybe none)."""
    rows, terms = [], []
    for at, text in enumerate(texts):
        hits = [t for got in map(lookup, _LETTERS.findall(text.lower())) if got for t in got]
        rows.append(np.full(len(hits), at, np.int64))
        terms.append(np.array(hits, np.int64))
    row, term = np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *terms])
    codes, n = np.unique(row * BUCKETS + term, return_counts=True)
    return codes // BUCKETS, codes % BUCKETS, n


class _Terms(dict):
    """Word to terms, filled on demand and emptied when full."""

    def __init__(self, position: dict[int, int] | None):
        super().__init__()
        self.position = position

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHE_WORDS:
            self.clear()
        got = terms_of(word)
        if self.position is not None:
            got = [self.position[t] for t in got if t in self.position]
        self[word] = tuple(got)
        return self[word]


@dataclass(frozen=True)
class FactorizationMachine:
    base: float
    terms: np.ndarray  # buckets, ascending
    weights: np.ndarray
    factors: np.ndarray  # terms x FACTORS

    def margins(self, row: np.ndarray, at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        out = self.base + np.bincount(row, self.weights[at] * x, n)
        for f in range(self.factors.shape[1]):
            vx = self.factors[at, f] * x
            out += 0.5 * (np.bincount(row, vx, n) ** 2 - np.bincount(row, vx ** 2, n))
        return out


def fit_machine(labels: np.ndarray, row: np.ndarray, at: np.ndarray, count: np.ndarray, terms: np.ndarray,
                steps: int = 150, rate: float = 0.05, decay: float = 3e-5) -> FactorizationMachine:
    """Logistic loss, full-batch Adam from a fixed seed; ``at`` are positions in ``terms``."""
    n, m = len(labels), len(terms)
    share = float(labels.mean()) if n else 0.0
    base = -30.0 if share == 0 else 30.0 if share == 1 else float(np.log(share / (1 - share)))
    if share in (0.0, 1.0) or not m:
        return FactorizationMachine(base, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    x = np.sqrt(count)
    random = np.random.default_rng(17)
    params = [np.array([base]), np.zeros(m), random.normal(0, 0.05, (m, FACTORS))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        bias, w, v = params
        sums = np.stack([np.bincount(row, v[at, f] * x, n) for f in range(FACTORS)], 1)
        squares = np.stack([np.bincount(row, (v[at, f] * x) ** 2, n) for f in range(FACTORS)], 1)
        margin = bias[0] + np.bincount(row, w[at] * x, n) + 0.5 * (sums ** 2 - squares).sum(1)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / n
        gw = np.bincount(at, error[row] * x, m) + decay * w
        gv = np.stack([np.bincount(at, error[row] * x * (sums[row, f] - v[at, f] * x), m) for f in range(FACTORS)], 1)
        for i, g in enumerate((np.array([error.sum()]), gw, gv + decay * v)):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g ** 2
            params[i] = params[i] - rate * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    return FactorizationMachine(float(params[0][0]), terms, params[1], params[2])


def fold(doc_id: Column, parts: int) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(parts))


def sample_labels(labels: DataFrame, label: str, key: str = "doc_id", most: int = SAMPLE) -> DataFrame:
    """At most ``most`` labelled ids, those of least hash: a bounded, repeatable sample."""
    known = (labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(key).alias("_key")).agg(F.max(F.col(label)).cast("int").alias("_label")))
    return least_hash_sample(known, F.xxhash64("_key"), most).select("_key", "_label")


def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(id, label, term, n) of labelled texts, ``ROWS_AT_ONCE`` at a time."""
    terms = _Terms(None)
    for batch in (whole[i:i + ROWS_AT_ONCE] for whole in batches for i in range(0, len(whole), ROWS_AT_ONCE)):
        row, term, n = _counts([t or "" for t in batch["_text"]], terms.__getitem__)
        cut = np.searchsorted(row, np.arange(len(batch) + 1))
        yield pd.DataFrame({"id": batch["_key"].astype(str), "label": batch["_label"],
                            "term": [term[a:b] for a, b in zip(cut, cut[1:])], "n": [n[a:b] for a, b in zip(cut, cut[1:])]})


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
          most: int = SAMPLE) -> FactorizationMachine:
    """Fit on the labelled documents among ``docs``; the broadcast side has at most ``most`` ids."""
    wanted = sample_labels(labels, label, key, most)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(wanted), "_key")

    sample = stored(rows.mapInPandas(memory_returned(counted), "id string, label int, term array<int>, n array<int>"))
    size = sample.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("ids")).first()
    if size["rows"] > size["ids"]:
        sample = stored(sample.groupBy("id").agg(F.min(F.struct("label", "term", "n")).alias("least")).select("id", "least.*"))
    chosen = np.sort(np.array(telling_terms(sample), np.int64))
    got = narrowed(sample, chosen)
    at, n = [np.frombuffer(r["at"], np.int32) for r in got], [np.frombuffer(r["n"], np.int32) for r in got]
    empty = np.zeros(0, np.int64)
    return fit_machine(np.array([r["label"] for r in got], float), np.repeat(np.arange(len(got)), list(map(len, at))),
                       np.concatenate([empty, *at]).astype(np.int64), np.concatenate([empty, *n]).astype(float), chosen)


def narrowed(sample: DataFrame, terms: np.ndarray) -> list:
    """(id, label, at, n) of all rows of the sample, with those terms only (``at``: their places), in a fixed order."""
    sent = sample.sparkSession.sparkContext.broadcast(terms)  # at most TERMS numbers

    def run(batches):
        for batch in batches:
            at, n = [], []
            for t, c in zip(batch["term"], batch["n"]):
                place = np.searchsorted(sent.value, t)
                keep = sent.value[np.minimum(place, len(sent.value) - 1)] == t if len(sent.value) else np.zeros(len(t), bool)
                at.append(place[keep].astype(np.int32).tobytes())
                n.append(np.asarray(c, np.int32)[keep].tobytes())
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "at": at, "n": n})

    got = sample.mapInPandas(memory_returned(run), "id string, label int, at binary, n binary").collect()
    return sorted(got, key=lambda r: (r["id"], r["label"], r["at"], r["n"]))


def interacting(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Which columns of ``x`` (0 or 1) have a pair whose interaction on the labels is beyond ``PAIR_Z``."""
    n, one, y = len(x), x.sum(0), x.T @ labels
    both, y_both = x.T @ x, x.T @ (x * labels[:, None])
    cells = [(both, y_both, 1), (one[:, None] - both, y[:, None] - y_both, -1), (one[None, :] - both, y[None, :] - y_both, -1),
             (n - one[:, None] - one[None, :] + both, labels.sum() - y[:, None] - y[None, :] + y_both, 1)]
    effect, variance = 0.0, 0.0
    for count, positive, sign in cells:
        share = (positive + 0.5) / (count + 1)
        effect, variance = effect + sign * share, variance + share * (1 - share) / (count + 1)
    z = np.abs(effect) / np.sqrt(variance)
    np.fill_diagonal(z, 0)
    return (z > PAIR_Z).any(axis=1)


def telling_terms(sample: DataFrame) -> list[int]:
    """The at most ``TERMS`` terms that enter: those of pairs that interact, and those of highest chi-square above its 5 % point."""
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")).first()
    n, share = size["n"], (size["positive"] or 0) / max(1, size["n"])
    if share in (0.0, 1.0):
        return []
    expected = F.col("df") * share
    chi = (F.col("df1") - expected) ** 2 / (expected * (1 - F.col("df") / (n + 1)) * (1 - share))
    counted = stored(sample.select("label", F.explode("term").alias("term")).groupBy("term")
                     .agg(F.count(F.lit(1)).alias("df"), F.sum("label").alias("df1")).filter(F.col("df") >= MIN_ROWS)
                     .select("term", "df", chi.alias("chi")))
    frequent = np.sort(np.array([r["term"] for r in counted.orderBy(F.desc("df"), "term").limit(FREQUENT).collect()], np.int64))
    telling = [r["term"] for r in counted.filter("chi > 3.84").orderBy(F.desc("chi"), "term").limit(TERMS).collect()]
    rows = narrowed(sample, frequent)
    x = np.zeros((len(rows), len(frequent)), np.float32)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], np.int32)] = 1
    paired = frequent[interacting(x, np.array([r["label"] for r in rows], np.float32))].tolist()
    return paired + [t for t in telling if t not in set(paired)][:TERMS - len(paired)]


def score(docs: DataFrame, machine: FactorizationMachine, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability of label 1, from whole texts."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)  # at most TERMS x (2 + FACTORS) numbers

    @F.arrow_udf("double")
    @memory_returned
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        lookup = _Terms({int(t): i for i, t in enumerate(model.terms)})  # the task's own: nothing stays in the worker
        for texts in batches:
            out = [np.zeros(0)]
            for start in range(0, len(texts), ROWS_AT_ONCE):
                some = [t or "" for t in texts.slice(start, ROWS_AT_ONCE).to_pylist()]
                row, at, n = _counts(some, lookup.__getitem__)
                margin = model.margins(row, at, np.sqrt(n), len(some))
                out.append(1 / (1 + np.exp(-np.clip(margin, -30, 30))))
            yield pa.array(np.concatenate(out))

    return docs.select(*[c for c in docs.columns if c != out], scored(F.col(text)).alias(out))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    learnable = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 5) != 0)
    machine = train(docs, learnable)
    return score(docs, machine).select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
