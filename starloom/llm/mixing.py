"""Mix sources to target weights.

Every document gets a hash-random key.  Within its source the documents are
put in key order by range: the key's first three hex digits name one of 4,096
equal ranges, so the largest source is sorted by thousands of tasks and no
sampling is needed.  A window inside each range and a running sum over the
range totals (at most 4,096 rows a source) give every document the words that
precede it in its source.  A source's budget is then cut exactly: as many whole
epochs as fit, and the rest from the head of the key order.

Defined cases: a null text or a text without words has size 0 and takes 0; a
null source is a source of its own, last in order; repeated rows count each;
an empty table gives an empty result.  All input columns are kept, in front of the
result columns; the result columns must not be among them (``ValueError``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import table, word_count
from starloom.operators.dense_ids import with_dense_ids
from starloom.operators.materialize import materialize

RANGE_DIGITS = 3  # hex digits of the key: 16 ** 3 ranges a source
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
RESULT = ["source_size", "target", "taken"]


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS,
                   budget: int | None = None) -> DataFrame:
    """``sizes`` (_null, _source, source_size: a row a source) with each source's ``target`` double.

    Sources by code point, null last, weigh ``weights`` repeating.  ``budget``
    words (default: all) are shared by weight; a target stops at ``max_epochs``
    times its source's size and the excess is reshared by weight until none
    is above.  Only sums over the sources reach the driver, once a pass.
    """
    numbered = with_dense_ids(sizes, ["_null", "_source"], "_n").df
    at = (F.col("_n") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (at + 1).cast("int")).cast("long")
    sources = materialize(numbered.select("_null", "_source", "source_size", weight.alias("_weight")))
    most = F.lit(max_epochs) * F.col("source_size")

    def shared(level: float) -> tuple[Column, Column]:
        even = F.col("_weight") * F.lit(level)
        return even, even > most

    start = sources.agg(F.sum("source_size").alias("size"), F.sum("_weight").alias("weight")).first()
    total = (start["size"] or 0) if budget is None else budget
    level, capped = total / (start["weight"] or 1), 0
    while True:
        _, above = shared(level)
        now = sources.agg(F.count(F.when(above, 1)).alias("n"),
                          F.coalesce(F.sum(F.when(above, most)), F.lit(0)).alias("held"),
                          F.sum(F.when(~above, F.col("_weight"))).alias("open")).first()
        if now["n"] == capped or not now["open"]:
            break
        level, capped = (total - now["held"]) / now["open"], now["n"]
    even, above = shared(level)
    return sources.select("_null", "_source", "source_size",
                          F.when(above, most.cast("double")).otherwise(even).alias("target"))


def mix(docs: DataFrame, size: str = "size", source: str = "source", key: str = "doc_id",
        weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, budget: int | None = None,
        seed: str = "mix") -> DataFrame:
    """``docs`` with ``source_size`` long, ``target`` double (its source's) and ``taken`` long.

    ``taken`` is the number of the document's words in the mix, repeats
    counted: at most ``max_epochs`` times ``docs[size]``.  Ties in the random
    key are ordered by ``key`` and size.
    """
    clash = sorted(set(RESULT) & set(docs.columns))
    if clash:
        raise ValueError(f"columns {clash} are results of mix; rename them first")
    columns = list(docs.columns)
    drawn = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit(""))))
    keyed = docs.select(*columns, F.col(source).isNull().alias("_null"),
                        F.coalesce(F.col(source), F.lit("")).alias("_source"), drawn.alias("_key"))
    keyed = keyed.withColumn("_range", F.substring("_key", 1, RANGE_DIGITS))
    size_col = F.coalesce(F.col(size), F.lit(0)).cast("long")

    ranges = materialize(keyed.groupBy("_null", "_source", "_range").agg(F.sum(size_col).alias("_in_range")))
    targets = source_targets(ranges.groupBy("_null", "_source").agg(F.sum("_in_range").alias("source_size")),
                             weights, max_epochs, budget)
    over = Window.partitionBy("_null", "_source").orderBy("_range")
    offsets = (ranges.withColumn("_offset", F.sum("_in_range").over(over) - F.col("_in_range"))
               .drop("_in_range").join(targets, ["_null", "_source"]))

    inside = (Window.partitionBy("_null", "_source", "_range")
              .orderBy("_key", key, size_col).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = keyed.withColumn("_before", F.sum(size_col).over(inside) - size_col)
    budgeted = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(F.lit(0))
    rest = budgeted - epochs * F.col("source_size") - (F.col("_offset") + F.col("_before"))
    taken = epochs * size_col + F.greatest(F.lit(0), F.least(rest, size_col))
    return (placed.join(offsets, ["_null", "_source", "_range"])
            .select(*columns, "source_size", "target", taken.cast("long").alias("taken")))


def mixed_rows(mixed: DataFrame, size: str = "size", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The mix itself: a row for each time a document is taken, ``_copy`` from 0.

    The one document at a source's cut contributes the words that are left of the
    budget, as a text that ends after them.
    """
    copies = F.expr(f"sequence(0, cast((taken - 1) div {size} as int))")
    rows = mixed.filter(F.col("taken") > 0).withColumn("_copy", F.explode(copies))
    left = F.col("taken") - F.col("_copy") * F.col(size)
    words = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    head = F.array_join(F.slice(words, F.lit(1), left.cast("int")), "")
    cut = left < F.col(size)
    rows = rows.withColumn(text, F.when(cut, head).otherwise(F.col(text)))
    return rows.withColumn(n_chars, F.when(cut, F.length(text).cast("long")).otherwise(F.col(n_chars)))


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || CAST(doc_id AS VARCHAR)) AS k
  FROM documents
), sources AS (
  SELECT source, SUM(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM sized GROUP BY source
), steps AS (
  SELECT source, source_size, w, 3 * source_size / w AS ratio,
         row_number() OVER (ORDER BY 3 * source_size / w, source) AS pos,
         (SUM(source_size) OVER () - COALESCE(SUM(3 * source_size) OVER before, 0))::DOUBLE
           / (SUM(w) OVER () - COALESCE(SUM(w) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
  SELECT arg_min(level, pos) FILTER (WHERE level <= ratio) AS level FROM steps
), targets AS (
  SELECT source, source_size,
         CASE WHEN w * level > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE w * level END AS target
  FROM sources, chosen
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before,
         floor(t.target)::BIGINT AS budget
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size ELSE 0 END
        + greatest(0, least(size, CASE WHEN source_size > 0 THEN budget % source_size ELSE 0 END - before)))::BIGINT
         AS taken
FROM placed
"""
