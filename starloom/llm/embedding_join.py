"""Near-duplicate embeddings by an exact metric range join.

Unit vectors link when their cosine is at least ``cosine``, i.e. when they lie within eps = sqrt(2 - 2 * cosine).
Equal vectors are one node from the start.  Pivots partition the nodes into cells, each node in the cell of its
nearest pivot.  By the triangle inequality a node v can link into the cell of pivot p only if
d(v, p) <= radius(p) + eps, and only if it lies within eps of the plane between p and its own pivot; it is
copied to the cells of lower number for which both hold, so every pair of cells is joined once.  A cell is
joined on its own, in blocks of ``BLOCK`` rows (at most ``BLOCK_BYTES``) a side, so that neither a large cell nor a hot one
meets in one task.  A block multiplies ``TILE`` rows at a time in single precision; pairs within ``LOOSE`` of the threshold, far more
than that can err, are decided in double precision.  It gives each node's number of links and, instead of all pairs, edges
that connect what the links connect: a node's least known label to a lesser one, when it changes.

Pivots are the nodes of least hash: one for ``CELL`` nodes, at most ``MOST_PIVOTS``, which bounds
the broadcast.  Their choice changes the work, never the links.  Where vectors lie evenly in many dimensions, bounds by distance
prune little, whatever the pivots, and most cells meet: the join then costs a product of all vectors in blocks.  Cells
are therefore as large as a block, so that a node is copied seldom.

Defined cases: a vector that is null, zero or has null or non-finite components links with
nothing; vectors of different length do not link; repeated rows are vectors of their own; an empty table
gives an empty result; other columns are not returned.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored, table
from starloom.llm.components import components

CELL = 8_192
MOST_PIVOTS = 4_096
BLOCK = 8_192
BLOCK_BYTES = 8_000_000  # in double precision; longer vectors come in fewer rows
TILE = 256
LOOSE = 1e-4
SLACK = 1e-6  # widens eps against rounding; links are decided by the cosine itself


def _matrix(column) -> np.ndarray:
    """Unit rows of a list array without nulls, all of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))
    return _unit(rows)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True) if rows.size else rows  # keeps squares in range
    return rows / np.sqrt((rows ** 2).sum(axis=1, keepdims=True)) if rows.size else rows


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def usable(vector: Column) -> Column:
    """Whether a vector can link: not null, not zero, all components finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """(node, vector, copies): a row for each different usable vector; ``node`` is its least id."""
    return (vectors.filter(usable(F.col("vector"))).groupBy("vector")
            .agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")))


def choose_pivots(nodes: DataFrame, count: int) -> list[np.ndarray]:
    rows = nodes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(count).select("vector").collect()
    return [_unit(np.array([r["vector"]], float))[0] for r in rows]


def in_cells(nodes: DataFrame, pivots, eps: float, radii=None) -> DataFrame:
    """Nodes with their home ``cell`` and distance; with ``radii`` also a row for each cell they can link into."""
    def run(batches):
        centres = pivots.value
        apart = _distances(centres, centres)
        reach = None if radii is None else radii.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2_048):
                some = batch.slice(at, 2_048)
                d = _distances(_matrix(some.column("vector")), centres)
                home = d.argmin(axis=1)
                own = d[np.arange(len(home)), home]
                row, cell, visit = np.arange(len(home)), home, np.zeros(len(home), bool)
                if reach is not None:
                    gap = apart[home]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        plane = np.where(gap > 0, (d ** 2 - own[:, None] ** 2) / (2 * gap), 0.0)
                    near = (d <= reach[None, :] + eps) & (plane <= eps) & (np.arange(len(centres))[None, :] < home[:, None])
                    more_row, more_cell = np.nonzero(near)
                    row, cell = np.concatenate([row, more_row]), np.concatenate([cell, more_cell])
                    visit = np.concatenate([visit, np.ones(len(more_row), bool)])
                    own = own[row]
                got = some.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [got.column("node"), got.column("copies"), got.column("vector"), pa.array(cell.astype(np.int32)), pa.array(visit), pa.array(own)],
                    names=["node", "copies", "vector", "cell", "visits", "distance"])

    kind = dict(nodes.dtypes)["vector"]
    return (nodes.select("node", "copies", "vector")
            .mapInArrow(run, f"node long, copies long, vector {kind}, cell int, visits boolean, distance double"))


def _linked_pairs(x: np.ndarray, y: np.ndarray, cosine: float, tile: slice, x4: np.ndarray, y4: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of the rows of ``x`` in the tile and of ``y`` that reach ``cosine``."""
    near = x4[tile] @ y4.T >= cosine - LOOSE
    if near.sum() * 16 > near.size:
        i, j = np.nonzero(near & (x[tile] @ y.T >= cosine))
        return i + tile.start, j
    i, j = np.nonzero(near)
    i += tile.start
    keep = [np.einsum("rc,rc->r", x[i[k:k + 20_000]], y[j[k:k + 20_000]]) >= cosine for k in range(0, len(i), 20_000)]
    keep = np.concatenate([np.zeros(0, bool), *keep])
    return i[keep], j[keep]


def _block_links(cosine: float):
    def run(group: pa.Table) -> pa.Table:
        """Links between the two sides of a block pair: (node, links, node) rows, and (label, 0, lesser label) rows."""
        right_side = group.column("side").to_numpy() == 1
        left, right = group.filter(pa.array(~right_side)), group.filter(pa.array(right_side))
        a, b = left.column("node").to_numpy(), right.column("node").to_numpy()
        x, y = _matrix(left.column("vector")), _matrix(right.column("vector"))
        x4, y4 = x.astype(np.float32), y.astype(np.float32)
        copies_left, copies_right = left.column("copies").to_numpy(), right.column("copies").to_numpy()
        visits = right.column("visits").to_numpy(zero_copy_only=False)
        n_left, n_right = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        low, high, edges = a.copy(), b.copy(), [np.zeros((2, 0), np.int64)]
        for start in range(0, len(a) if len(b) else 0, TILE):
            i, j = _linked_pairs(x, y, cosine, slice(start, start + TILE), x4, y4)
            other = a[i] != b[j]
            i, j = i[other], j[other]
            if not len(i):
                continue
            n_left += np.bincount(i, copies_right[j], len(a)).astype(np.int64)
            # a pair at home is met from both sides, a pair with a visitor from this one only
            n_right += np.bincount(j, copies_left[i] * visits[j], len(b)).astype(np.int64)
            old_low, old_high = low.copy(), high.copy()
            while True:
                least = np.minimum(low[i], high[j])
                if (low[i] == least).all() and (high[j] == least).all():
                    break
                np.minimum.at(low, i, least)
                np.minimum.at(high, j, least)
            for old, new in ((old_low, low), (old_high, high)):
                edges.append(np.unique(np.stack([old, new])[:, old != new], axis=1))
        label, lesser = np.concatenate(edges, axis=1)
        some_left, some_right = n_left > 0, n_right > 0
        node = np.concatenate([a[some_left], b[some_right], label])
        return pa.table({"node": node, "links": np.concatenate([n_left[some_left], n_right[some_right], np.zeros(len(label), np.int64)]),
                         "root": np.concatenate([a[some_left], b[some_right], lesser])})
    return run


def join_cells(cells: DataFrame, cosine: float, block: int) -> DataFrame:
    """(node, links, root) from each block pair of each cell, in blocks of ``block`` rows."""
    sizes = cells.groupBy("cell").agg(
        F.ceil(F.sum((~F.col("visits")).cast("long")) / block).cast("int").alias("lefts"),
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("rights"))
    rows = (cells.drop("distance").join(F.broadcast(sizes), "cell")  # a row a cell: at most MOST_PIVOTS
            .withColumn("l", F.pmod(F.xxhash64("node"), F.col("lefts")).cast("int"))
            .withColumn("r", F.pmod(F.xxhash64("node", F.lit(1)), F.col("rights")).cast("int")))
    lefts = rows.filter("not visits").withColumn("other", F.explode(F.expr("sequence(0, rights - 1)")))
    rights = rows.withColumn("other", F.explode(F.expr("sequence(0, lefts - 1)")))
    met = (lefts.select("cell", "l", F.col("other").alias("r"), F.lit(0).alias("side"), "node", "copies", "visits", "vector")
           .unionByName(rights.select("cell", F.col("other").alias("l"), "r", F.lit(1).alias("side"), "node", "copies", "visits", "vector")))
    return met.groupBy("cell", "l", "r").applyInArrow(_block_links(cosine), "node long, links long, root long")


def range_join(vectors: DataFrame, cosine: float, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``."""
    spark = vectors.sparkSession
    eps = math.sqrt(2 - 2 * cosine) + SLACK
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
    nodes = stored(distinct_vectors(rows))
    parts = []
    for r in nodes.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect():
        some = nodes.filter(F.size("vector") == r["dim"])
        centres = choose_pivots(some, min(MOST_PIVOTS, max(1, -(-r["n"] // CELL))))
        pivots = spark.sparkContext.broadcast(np.array(centres))
        spread = in_cells(some, pivots, eps).groupBy("cell").agg(F.max("distance").alias("r")).collect()
        radii = np.full(len(centres), -1.0)  # an empty cell is reached by none
        radii[[s["cell"] for s in spread]] = [s["r"] for s in spread]
        cells = stored(in_cells(some, pivots, eps, spark.sparkContext.broadcast(radii)))
        parts.append(stored(join_cells(cells, cosine, max(1, min(BLOCK, BLOCK_BYTES // (8 * r["dim"]))))))
    found = spark.createDataFrame([], "node long, links long, root long") if not parts else parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("component", "_component")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_node = (nodes.select("node", "copies", "vector").join(counts, "node", "left").join(labels, "node", "left")
               .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("_component", "node").alias("component_id")))
    # the vector itself is the key of equal rows; rows that cannot link have none
    keyed = rows.withColumn("vector", F.when(usable(F.col("vector")), F.col("vector")))
    out = keyed.join(of_node, "vector", "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def op7_embedding_join(spark, sf_dir: str) -> DataFrame:
    return range_join(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), cosine=0.95)


OP7_SQL = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, COALESCE(c.n, 0)::BIGINT AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = e.vec_id
"""
