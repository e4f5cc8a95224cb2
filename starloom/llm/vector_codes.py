"""Vector code compression: codebooks by part, nearest entries by equal-average search.

Components become integers floor(``SCALE`` * x), vectors are cut into ``parts`` equal consecutive parts, and
each part position has a codebook of ``entries`` integer vectors.  Codebooks start as the parts of the vectors of least
id and are refined ``rounds`` times: every part is assigned to its nearest entry, then an entry becomes the
componentwise floor of its parts' mean.

The nearest entry of a part is found by equal-average search.  A codebook's entries are sorted by the sum of
their components; a search starts at the part's own sum and goes outward on both sides, the smaller gap first.  By the
Cauchy-Schwarz inequality a squared distance is at least the squared gap of the sums over the dimension, so the search ends
where that strictly exceeds the best distance (entries at exactly the best may still tie with a lower index).
All parts of a batch search together, one entry a turn; those that have ended drop out.

A round sends the codebooks (``parts`` * ``entries`` vectors) to the tasks; each task returns one sum and count an entry, which
Spark adds.  Vectors are read where they are stored and are never shuffled.

All arithmetic is on integers.  Components saturate at +-2**22 after scaling, so that nothing overflows in vectors of up
to 4,096 components.

Defined cases: vectors that are null or hold null or non-finite components, and vectors that cannot be cut into
``parts`` equal parts, are dropped; vectors of another length have codebooks of their own; rows without an id come after
all ids and rows of equal ids in the order of their components; fewer vectors than ``entries`` give so many entries;
null labels are one label; an empty table gives an empty result; other columns are not returned.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored, table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256.0
MOST = float(1 << 22)  # scaled components are held within this
ROWS_AT_ONCE = 4_096


def scaled(vector: Column) -> Column:
    """``vector`` as integers."""
    return F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * SCALE, F.lit(-MOST)), F.lit(MOST))).cast("int"))


def usable(vector: Column, parts: int) -> Column:
    """Whether all components are finite and make ``parts`` equal parts."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & (F.size(vector) % parts == 0) & ~bad, F.lit(False))


@dataclass(frozen=True)
class Codebooks:
    """``entries``: integers by part, entry and position."""

    entries: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry for each part of each row (row, part, position)."""
        n, parts, size = rows.shape
        count = self.entries.shape[1]
        sums = self.entries.sum(2)
        order = np.argsort(sums, axis=1, kind="stable")
        sums = np.take_along_axis(sums, order, 1)
        own = rows.sum(2)
        right = np.empty((n, parts), np.int64)  # the next entry, in order of sums, above and below
        for part in range(parts):
            right[:, part] = np.searchsorted(sums[part], own[:, part])
        right, own, flat = right.ravel(), own.ravel(), rows.reshape(n * parts, size)
        left, part = right - 1, np.tile(np.arange(parts), n)
        best, index = np.full(n * parts, (1 << 62) // size), np.full(n * parts, count)
        todo, none = np.arange(n * parts), 1 << 31  # a gap that stands for no entry left
        while len(todo):
            p, lo, hi, s = part[todo], left[todo], right[todo], own[todo]
            gap_low = np.where(lo >= 0, s - sums[p, np.maximum(lo, 0)], none)
            gap_high = np.where(hi < count, sums[p, np.minimum(hi, count - 1)] - s, none)
            low = gap_low <= gap_high
            gap = np.where(low, gap_low, gap_high)
            over = (gap == none) | (gap * gap > best[todo] * size)
            todo, p, lo, hi, low = todo[~over], p[~over], lo[~over], hi[~over], low[~over]
            entry = order[p, np.where(low, lo, hi)]
            apart = flat[todo] - self.entries[p, entry]
            d = (apart * apart).sum(1)
            closer = (d < best[todo]) | ((d == best[todo]) & (entry < index[todo]))
            best[todo[closer]], index[todo[closer]] = d[closer], entry[closer]
            left[todo[low]] -= 1
            right[todo[~low]] += 1
        return index.reshape(n, parts), best.reshape(n, parts)


def _rows(column: pa.Array, parts: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return values.reshape(len(column), parts, -1)


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the vectors of least id."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    return Codebooks(np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy())


def refined(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round over all ``vectors``."""
    parts, entries, size = books.entries.shape
    sent = vectors.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        sums, counts = np.zeros((parts * entries, size), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                rows = _rows(batch.column("v").slice(at, ROWS_AT_ONCE), parts)
                index, _ = sent.value.nearest(rows)
                slot = (index + entries * np.arange(parts)).ravel()
                np.add.at(sums, slot, rows.reshape(-1, size))
                counts += np.bincount(slot, minlength=len(counts))
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used), pa.array(counts[used]), pa.FixedSizeListArray.from_arrays(pa.array(sums[used].ravel()), size).cast(pa.list_(pa.int64()))],
                              names=["slot", "n", "sums"])

    by_task = vectors.select("v").mapInArrow(run, "slot long, n long, sums array<long>")
    total = by_task.groupBy("slot").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums"))
    out = books.entries.reshape(parts * entries, size).copy()
    for row in total.collect():  # a row an entry
        out[row["slot"]] = np.array(row["sums"], np.int64) // row["n"]
    return Codebooks(out.reshape(parts, entries, size))


def assigned(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(id, label, code, error, codebooks_sha256) a row; a code has two hex digits a part."""
    parts = books.entries.shape[0]
    sent, digits = vectors.sparkSession.sparkContext.broadcast(books), max(2, len(f"{max(books.entries.shape[1] - 1, 0):x}"))

    def run(batches):
        hexes = np.array([f"{i:0{digits}x}" for i in range(sent.value.entries.shape[1])])
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                index, apart = sent.value.nearest(_rows(some.column("v"), parts))
                code = np.ascontiguousarray(hexes[index]).view(f"<U{digits * parts}").ravel() if len(index) else np.zeros(0, "<U1")
                yield pa.record_batch([some.column("id"), some.column("label"), pa.array(code.tolist(), pa.string()), pa.array(apart.sum(1))],
                                      names=["id", "label", "code", "error"])

    kind = dict(vectors.dtypes)["label"]
    return (vectors.select("id", "label", "v").mapInArrow(run, f"id long, label {kind}, code string, error long")
            .withColumn("codebooks_sha256", F.lit(books.sha256())))


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, dict[int, Codebooks]]:
    """(id, label, code, error, codebooks_sha256) of all usable vectors, stored, and the codebooks by length of vector."""
    kept = stored(vectors.filter(usable(F.col(vector), parts)).select(
        F.col(key).cast("long").alias("id"), F.col(label).alias("label"), scaled(F.col(vector)).alias("v")))
    books, coded = {}, None
    for size in sorted(r["size"] for r in kept.select(F.size("v").alias("size")).distinct().collect()):
        some = kept.filter(F.size("v") == size)
        book = first_codebooks(some, parts, entries)
        for _ in range(rounds):
            book = refined(some, book)
        books[size], part = book, assigned(some, book)
        coded = part if coded is None else coded.unionByName(part)
    if coded is None:
        coded = kept.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))
    return stored(coded), books


def restored(codes: list[str], books: Codebooks) -> np.ndarray:
    """The vectors that ``codes`` stand for, in the scale of the input."""
    parts, entries, size = books.entries.shape
    digits = max(2, len(f"{max(entries - 1, 0):x}"))
    index = np.array([[int(c[i:i + digits], 16) for i in range(0, digits * parts, digits)] for c in codes], np.int64).reshape(len(codes), parts)
    return books.entries[np.arange(parts), index].reshape(len(codes), parts * size) / SCALE


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the error summed over equal labels, nulls together.

    The sums are written before the join, so that adaptive execution can split a label that holds a large
    share of the rows, or broadcast the sums when they prove small.
    """
    total = stored(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return coded.join(total, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    coded, _ = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


OP13_SQL = r"""
WITH kept AS (
  SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % 16 = 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
  SELECT vec_id, label, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS v FROM kept, range(16) AS t(p)
), book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, v FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64
), nearest0 AS (
  SELECT x.vec_id, x.p, x.v, arg_min(b.e, d * 64 + b.e) AS e
  FROM parts x JOIN book0 b ON b.p = x.p, LATERAL (SELECT list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) FOR i IN range(1, len(x.v) + 1)])::BIGINT AS d)
  GROUP BY x.vec_id, x.p, x.v
), book1 AS (
  SELECT b.p, b.e, COALESCE(m.v, b.v) AS v FROM book0 b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
      SELECT p, e, i, ((sum(c) - ((sum(c) % count(*) + count(*)) % count(*))) // count(*))::BIGINT AS m
      FROM (SELECT p, e, unnest(v) AS c, unnest(range(1, len(v) + 1)) AS i FROM nearest0) GROUP BY p, e, i) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
), nearest1 AS (
  SELECT x.vec_id, x.p, x.v, arg_min(b.e, d * 64 + b.e) AS e
  FROM parts x JOIN book1 b ON b.p = x.p, LATERAL (SELECT list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) FOR i IN range(1, len(x.v) + 1)])::BIGINT AS d)
  GROUP BY x.vec_id, x.p, x.v
), book2 AS (
  SELECT b.p, b.e, COALESCE(m.v, b.v) AS v FROM book1 b LEFT JOIN (
    SELECT p, e, list(m ORDER BY i) AS v FROM (
      SELECT p, e, i, ((sum(c) - ((sum(c) % count(*) + count(*)) % count(*))) // count(*))::BIGINT AS m
      FROM (SELECT p, e, unnest(v) AS c, unnest(range(1, len(v) + 1)) AS i FROM nearest1) GROUP BY p, e, i) GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
), coded AS (
  SELECT x.vec_id, x.label, x.p, arg_min(b.e, d * 64 + b.e) AS e, min(d) AS d
  FROM parts x JOIN book2 b ON b.p = x.p, LATERAL (SELECT list_sum([(x.v[i] - b.v[i]) * (x.v[i] - b.v[i]) FOR i IN range(1, len(x.v) + 1)])::BIGINT AS d)
  GROUP BY x.vec_id, x.label, x.p
), rows_ AS (
  SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM coded GROUP BY vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM rows_, digest
"""
