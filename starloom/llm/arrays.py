"""Array functions that cost about linear time in the length of one row's arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["let", "running", "slices"]

BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimizer moves into lambdas."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each item, ``merge`` of ``zero`` and all items before it; then one more item for all of them.

    ``merge`` must be associative, with ``zero`` neutral.  Items are merged within blocks of ``BLOCK`` and the
    blocks' totals once more, so the copies that a growing array needs are made once a block only.
    """
    def within(v: Column) -> Column:
        block = lambda i: F.slice(v, i * BLOCK + 1, F.lit(BLOCK))
        blocks = F.ceil((F.size(v) + 1) / F.lit(BLOCK)).cast("int")
        totals = F.transform(F.sequence(F.lit(0), blocks - 1), lambda i: F.aggregate(block(i), zero, merge))
        offsets = F.aggregate(totals, F.struct(zero.alias("at"), F.slice(F.array(zero), 1, 0).alias("out")),
                              lambda s, t: F.struct(merge(s["at"], t).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])
        place = lambda o: F.transform(F.sequence(F.lit(0), F.size(v)), lambda i: F.aggregate(
            F.slice(v, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK), F.get(o, F.floor(i / BLOCK).cast("int")), merge))
        return let(offsets, place)

    return let(values, within)


def slices(text: Column, cuts: Column) -> Column:
    """The parts of ``text`` named by ``cuts``: an ascending array of structs (start, end), code points, end exclusive.

    A part is cut from the stretch of text that ``BLOCK`` neighbours share, so the text is not read from its start for each.
    """
    def from_block(c: Column, i: Column) -> Column:
        some = F.slice(c, i * BLOCK + 1, F.lit(BLOCK))
        first = F.get(some, 0)["start"]
        stretch = F.substring(text, first + 1, F.array_max(F.transform(some, lambda x: x["end"])) - first)
        return let(F.struct(some.alias("some"), first.alias("first"), stretch.alias("stretch")),
                   lambda b: F.transform(b["some"], lambda x: F.substring(b["stretch"], x["start"] - b["first"] + 1, x["end"] - x["start"])))

    blocks = lambda c: F.ceil(F.size(c) / F.lit(BLOCK)).cast("int")
    return let(cuts, lambda c: F.when(F.size(c) > 0, F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(blocks(c) - 1, F.lit(0))), lambda i: from_block(c, i))))
               .otherwise(F.expr("cast(array() as array<string>)")))
