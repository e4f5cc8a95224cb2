"""Gap-free surrogate keys ``start, start+1, ...`` in a value-defined order.

``row_number() over (order by ...)`` without a partition runs in one task, and
``monotonically_increasing_id()`` leaves gaps of 2^33 between partitions.  This
operator numbers rows in parallel, the same way at every size:

1. ``repartitionByRange`` on the keys (a range exchange whose bounds are
   sampled from the data) and ``sortWithinPartitions``, so partition ``i``
   holds only keys below those of partition ``i + 1``, in order;
2. tag each row with its partition id and its position inside the partition
   (``monotonically_increasing_id`` is ``pid << 33 | position``), and write
   the tagged rows, so positions are fixed once and for all;
3. count rows per partition (one row per partition reaches the driver, a
   list bounded by the partition count, never the data) and turn the counts
   into running offsets, as Spark's own ``RDD.zipWithIndex`` does;
4. key = start + offset[pid] + position, a projection over the written rows: the
   offsets are an array literal, so no join follows.

Sampling the bounds runs the stage that feeds the range exchange a second time: everything after its last
shuffle (shuffle files are read again, not made again).  The rows are written once only.

Several tables with the same columns are numbered together: the table is the first sort key, and a
table's keys count from the position of its first row.

The order keys should determine a row up to identical rows; ties between
identical rows do not change the numbered result.  An optional ``tiebreak``
column (a deterministic per-row value) spreads a run of identical keys over
several range partitions instead of one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.materialize import stored

_PID = "_dense_pid"
_POS = "_dense_pos"


@dataclass(frozen=True)
class Numbered:
    """A numbered frame and its exact row count (known without another job)."""

    df: DataFrame
    rows: int


def _sort_key(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.asc_nulls_first()


def _tagged(source: DataFrame, keep: list[str], keys: list[Column], num_partitions: int | None) -> DataFrame:
    """The rows in key order, written with the partition and position of each."""
    ranged = source.repartitionByRange(num_partitions, *keys) if num_partitions else source.repartitionByRange(*keys)
    return stored(ranged.sortWithinPartitions(*keys)
                  .select(*keep, F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_POS)), "zstd")


def _place(counts: dict[int, int]) -> Column:
    """A row's position among all rows, from the rows per partition."""
    offsets, running = [], 0
    for pid in range(max(counts, default=-1) + 1):
        offsets.append(str(running))
        running += counts.get(pid, 0)
    offset = F.get(F.split(F.lit(",".join(offsets) or "0"), ",").cast("array<bigint>"), F.col(_PID))
    return offset + F.col(_POS) - F.shiftleft(F.col(_PID).cast("long"), 33)


def with_dense_ids(df: DataFrame, order_by: list[str], id_col: str, start: int = 1,
                   tiebreak: list[str] | None = None, num_partitions: int | None = None) -> Numbered:
    """Prepend ``id_col`` (bigint) numbering ``df`` by ``order_by`` ascending, NULLs first.

    ``tiebreak`` columns take part in the order but are dropped from the
    output.  Columns of ``df`` are kept in their order after the key.
    """
    tiebreak = list(tiebreak or [])
    keep = [c for c in df.columns if c not in tiebreak and c != id_col]
    keys = [_sort_key(c) for c in list(order_by) + tiebreak]
    tagged = _tagged(df.select(*keep, *tiebreak), keep, keys, num_partitions)
    counts = {r[_PID]: r["n"] for r in tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).collect()}
    key = (F.lit(start).cast("long") + _place(counts)).alias(id_col)
    return Numbered(tagged.select(key, *keep), sum(counts.values()))


def with_dense_ids_by_group(df: DataFrame, group: str, groups: int, order_by: list[str], id_col: str, start: int = 1) -> list[Numbered]:
    """For each ``group`` value 0, 1, ... ``groups`` - 1 of ``df``: its rows, keyed ``start``, ``start`` + 1, ...
    by ``order_by`` ascending, NULLs first.  One range sort serves all."""
    keep = [c for c in df.columns if c != id_col]
    tagged = _tagged(df.select(*keep), keep, [_sort_key(c) for c in [group, *order_by]], None)
    per_part: dict[int, int] = {}
    sizes = [0] * groups
    for r in tagged.groupBy(_PID, group).agg(F.count(F.lit(1)).alias("n")).collect():
        per_part[r[_PID]] = per_part.get(r[_PID], 0) + r["n"]
        sizes[r[group]] += r["n"]
    place, out = _place(per_part), []
    for g, rows in enumerate(sizes):
        key = (F.lit(start - sum(sizes[:g])).cast("long") + place).alias(id_col)
        out.append(Numbered(tagged.filter(F.col(group) == g).select(key, *[c for c in keep if c != group]), rows))
    return out
