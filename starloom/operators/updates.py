"""Table updates re-expressed as DataFrame rewrites.

Plain Parquet tables cannot be updated in place, so an update reads the old
frame and returns a new one with the same rows; the caller overwrites a path.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.materialize import stored

_MATCHED = "_update_matched"


def conditional_update(df: DataFrame, assignments: Mapping[str, Column | object], where: Column) -> DataFrame:
    """``UPDATE df SET col = value, ... WHERE where`` as a projection.

    Rows failing ``where`` (false or NULL) keep their values; the row count and
    the column order are unchanged.  A narrow, shuffle-free rewrite.
    """
    cols = []
    for name in df.columns:
        if name in assignments:
            value = assignments[name]
            value = value if isinstance(value, Column) else F.lit(value)
            cols.append(F.when(where, value).otherwise(F.col(name)).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def _chosen(columns: list[str], tie: str) -> Column:
    """One whole row of a group: the least (or greatest) by ``columns`` in order, NULLs last."""
    if len(columns) == 1:
        return F.struct((F.min if tie == "min" else F.max)(columns[0]).alias(columns[0]))
    if tie == "min":
        order = F.struct(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])
        return F.min_by(F.struct(*columns), order)
    order = F.struct(*[x for c in columns for x in (F.col(c).isNotNull(), F.col(c))])
    return F.max_by(F.struct(*columns), order)


def update_from(target: DataFrame, source: DataFrame, on: list[str],
                assign: Mapping[str, str], tie: str = "min") -> DataFrame:
    """``UPDATE target SET t = s.col FROM source s WHERE target.on = s.on``.

    The database picks an arbitrary matching source row when several match;
    here the choice is fixed by ``tie``: the row that is least (``min``) or greatest
    (``max``) by the assigned columns in their order, NULLs last; all values come from
    that one row.  ``source`` is reduced to one row per key *before* the join
    (a grouped aggregate, combined map-side, so a key with many source rows
    costs one row per task in the shuffle) and written, and the left join then
    keeps every target row exactly once.  Unmatched rows keep their old value, or
    get NULL when ``target`` does not have the column yet.

    The written reduction is what lets adaptive execution split a key that holds a large
    share of the target rows: an aggregate between its exchange and the join would
    forbid it.  A reduction that turns out small is broadcast at run time.
    """
    sources = list(dict.fromkeys(assign.values()))
    reduced = stored(source.groupBy(*on).agg(_chosen(sources, tie).alias("_row"))
                     .select(*on, *[F.col(f"_row.{src}").alias(f"_new_{dst}") for dst, src in assign.items()])
                     .withColumn(_MATCHED, F.lit(True)), "zstd")
    joined = target.join(reduced, on=on, how="left")
    out = []
    for name in target.columns:
        if name in assign:
            out.append(F.when(F.col(_MATCHED), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    for dst in assign:
        if dst not in target.columns:
            out.append(F.col(f"_new_{dst}").alias(dst))
    return joined.select(*out)
