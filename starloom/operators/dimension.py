"""Generic dimension builder: distinct natural attributes plus a dense key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.dense_ids import Numbered, with_dense_ids_by_group

# Dimension and fact keys start after this base (key = base + row number).
KEY_BASE = 100

_GROUP = "_dimension"


def build_dimensions(source: DataFrame, dimensions: Mapping[str, tuple[Mapping[str, str], str]],
                     start: int = KEY_BASE + 1) -> dict[str, Numbered]:
    """For each name of ``dimensions`` (attributes, key column): one row per distinct attribute tuple
    of ``source``, keyed ``start, start+1, ...``.

    ``attributes`` maps source column -> dimension column (renames bind by
    name).  NULLs are one value for the distinct, as in SQL ``DISTINCT``.
    All dimensions come from one scan of their columns: a grouped aggregate over *grouping sets*, one set a
    dimension.  Its map-side combine leaves at most one row per tuple per task for the one shuffle, and
    ``grouping_id`` tells a column that a set leaves out from a NULL in the data.  The distinct rows of all
    dimensions are then numbered by one range sort, the dimension as its first key.
    """
    sets = {name: list(attributes) for name, (attributes, _) in dimensions.items()}
    columns = list(dict.fromkeys(c for attributes in sets.values() for c in attributes))
    for name, attributes in sets.items():
        if [c for c in columns if c in attributes] != attributes:
            raise ValueError(f"{name}: shared attributes must have one order in all dimensions")
    # bit i, from the right, of the grouping id is set where column i from the right is left out
    ids = {name: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in attributes) for name, attributes in sets.items()}
    if len(set(ids.values())) < len(ids):
        raise ValueError("two dimensions have the same attributes")
    place = F.lit(None).cast("int")
    for i, name in enumerate(sets):
        place = F.when(F.col("_gid") == ids[name], F.lit(i)).otherwise(place)
    rows = (source.select(*columns).groupingSets(list(sets.values()), *columns).agg(F.grouping_id().alias("_gid"))
            .select(place.alias(_GROUP), *columns))
    numbered = with_dense_ids_by_group(rows, _GROUP, len(sets), columns, "_key", start)
    return {name: Numbered(part.df.select(F.col("_key").alias(key), *[F.col(c).alias(dst) for c, dst in attributes.items()]), part.rows)
            for (name, (attributes, key)), part in zip(dimensions.items(), numbered)}


def build_dimension(source: DataFrame, attributes: Mapping[str, str], id_col: str,
                    start: int = KEY_BASE + 1) -> Numbered:
    """One dimension, by :func:`build_dimensions`."""
    return build_dimensions(source, {id_col: (attributes, id_col)}, start)[id_col]
