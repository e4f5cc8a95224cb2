"""The star schema: dimensions, calendar, sales fact and its enrichments.

A :class:`Warehouse` holds the inputs (staging lines, returns list, managers)
and builds each table lazily, once.  Staging is written to the checkpoint
folder a single time, as columns; the repaired lines are a projection over it, and the
dimensions, the fact and the manager lookup each scan only the columns they need.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import copy_context
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.dates import date_key
from starloom.operators.dense_ids import Numbered, with_dense_ids
from starloom.operators.dimension import KEY_BASE, build_dimension, build_dimensions
from starloom.operators.materialize import stored, stored_in_buckets
from starloom.operators.updates import conditional_update, update_from
from starloom.plans.calendar import CALENDAR_END, CALENDAR_START, calendar_dim, covering_bounds
from starloom.sources.seeds import fixture_returns, managers_seed
from starloom.sources.staging import STAGING_COLUMNS, fixture_dates, fixture_staging, read_staging
from starloom.sources.tables import LINE_COL, line_salt

# The data-quality repair.  Lines in this city that have no
# postal code get this code.
GAP_CITY = "Burlington"
GAP_POSTAL_CODE = "05401"

# Natural attributes of each dimension: staging column -> dimension column.
SHIPPING_ATTRS = {"ship_mode": "shipping_mode"}
CUSTOMER_ATTRS = {"customer_id": "customer_id", "customer_name": "customer_name"}
GEO_ATTRS = {"country": "country", "city": "city", "state": "state", "postal_code": "postal_code"}
PRODUCT_ATTRS = {"product_id": "product_id", "product_name": "product_name", "category": "category",
                 "subcategory": "sub_category", "segment": "segment"}

DIMENSIONS = {
    "shipping": (SHIPPING_ATTRS, "ship_id"),
    "customer": (CUSTOMER_ATTRS, "cust_id"),
    "geo": (GEO_ATTRS, "geo_id"),
    "product": (PRODUCT_ATTRS, "prod_id"),
}

FACT_COLUMNS = ["sales_id", "cust_id", "order_date_id", "ship_date_id", "prod_id", "ship_id", "geo_id",
                "order_id", "sales", "profit", "quantity", "discount"]
# Order that defines sales_id: the order id first, then every other column.
FACT_ORDER = ["order_id", "order_date_id", "ship_date_id", "cust_id", "prod_id", "ship_id", "geo_id",
              "sales", "profit", "quantity", "discount"]


def repair_postal_codes(df: DataFrame) -> DataFrame:
    """Give lines of the gap city without a postal code the known code."""
    where = (F.col("city") == GAP_CITY) & F.col("postal_code").isNull()
    return conditional_update(df, {"postal_code": GAP_POSTAL_CODE}, where)


def _lineage(df: DataFrame) -> list[str]:
    return [LINE_COL] if LINE_COL in df.columns else []


# A dimension of at most so many rows, by their exact count, is broadcast; as codes and keys (16 bytes a row) one of at most so many.
BROADCAST_ROWS, BROADCAST_CODES = 50_000, 1_000_000
# A line's tiebreak takes this many values: enough to spread identical lines over ranges, and few bytes in a shuffle.
TIEBREAKS = 1 << 16
# Buckets of staging are joined where they lie if the largest has at most so many times the lines of an average one.
EVEN_BUCKETS = 4


def code_seed(df: DataFrame, columns: list[str]) -> int:
    """A seed under which :func:`code` tells all rows of ``df`` (different, without NULLs) apart.  A clash of 64 bits
    is rare; where one occurs the next seed is tried."""
    seed = 0
    while not df.groupBy(code(columns, seed).alias("_code")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        seed += 1
    return seed


def code(columns: list[str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def _known(dim: Numbered, attributes: dict[str, str], key: str) -> DataFrame:
    """``key`` and the attributes under their staging names; a row with a NULL attribute matches no line."""
    known = dim.df.select(key, *[F.col(dst).alias(src) for src, dst in attributes.items()])
    return known.filter(_all_known(list(attributes)))


def _all_known(columns: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def _with_keys(lines: DataFrame, dims: dict[str, Numbered], bucket: str | None = None) -> DataFrame:
    """``lines`` with each dimension's key in place of its attributes; lines with a NULL attribute match no row.

    Small dimensions are broadcast.  For the others, what moves must be narrow: before the first of their joins, lines get a
    64-bit code of the attributes of each in place of all the texts.  A code tells the rows of its dimension apart (checked), and
    the dimension holds every tuple of ``lines``, so equal codes mean equal attributes.

    Where ``lines`` lie in buckets of the attribute ``bucket``, its dimension comes first and is joined by it too: the lines
    stay where they are.
    """
    for name, dim in dims.items():
        lines = lines.filter(_all_known(list(DIMENSIONS[name][0])))
    for name, dim in dims.items():
        if dim.rows <= BROADCAST_ROWS:
            columns = list(DIMENSIONS[name][0])
            lines = lines.join(F.broadcast(_known(dim, *DIMENSIONS[name])), columns, "inner").drop(*columns)
    large = {name: _known(dim, *DIMENSIONS[name]) for name, dim in dims.items() if dim.rows > BROADCAST_ROWS}
    codes = {name: code(list(DIMENSIONS[name][0]), code_seed(known, list(DIMENSIONS[name][0]))) for name, known in large.items()}
    texts = [c for name in large for c in DIMENSIONS[name][0] if c != bucket]
    lines = lines.select(*[c for c in lines.columns if c not in texts], *[c.alias(f"_code_{name}") for name, c in codes.items()])
    for name, known in sorted(large.items(), key=lambda named: (bucket not in DIMENSIONS[named[0]][0], dims[named[0]].rows)):
        # the row count is known: no broadcast from a guess of the bytes; a sorted join's hot keys can be split
        how = "broadcast" if dims[name].rows <= BROADCAST_CODES else "merge"
        on = [c for c in [bucket] if c in DIMENSIONS[name][0]]
        coded = known.select(DIMENSIONS[name][1], *on, codes[name].alias(f"_code_{name}"))
        lines = lines.join(coded.hint(how), [*on, f"_code_{name}"], "inner").drop(*on, f"_code_{name}")
    return lines


@contextmanager
def _joins_by_some_keys(spark: SparkSession) -> Iterator[None]:
    """Lets a join by several keys use lines that already lie by one of them."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def star_join(staging: DataFrame, shipping: Numbered, geo: Numbered, product: Numbered,
              customer: Numbered, bucket: str | None = None) -> DataFrame:
    """Staging lines joined to the four dimensions (built from them) by their natural keys.

    Inner joins with plain equality: a line whose key has a NULL (e.g. a
    missing postal code) matches no dimension row and is dropped, which is
    why the repair runs first.  Columns are bound by name.  Result:
    dimension keys, date keys, order id, measures (and the
    lineage column when staging carries it).
    """
    lines = staging.select(
        *dict.fromkeys(c for attributes, _ in DIMENSIONS.values() for c in attributes),
        date_key(F.col("order_date")).alias("order_date_id"),
        date_key(F.col("ship_date")).alias("ship_date_id"),
        "order_id", "sales", "profit", "quantity", "discount",
        *[F.pmod(LINE_COL, F.lit(TIEBREAKS)).alias(LINE_COL) for _ in _lineage(staging)])
    lines = _with_keys(lines, {"shipping": shipping, "geo": geo, "product": product, "customer": customer}, bucket)
    return lines.select(*[c for c in FACT_COLUMNS if c != "sales_id"], *_lineage(staging))


class Warehouse:
    """Builds every warehouse table from the three inputs, each at most once."""

    def __init__(self, spark: SparkSession, staging_raw: DataFrame, returns_seed: DataFrame,
                 managers: DataFrame, calendar_start: dt.date = CALENDAR_START,
                 calendar_end: dt.date = CALENDAR_END, share_staging: bool = True,
                 dates: DataFrame | None = None, bucket: str | None = None):
        """``share_staging`` writes a *derived* staging plan (joins) once, as columns, for
        its several consumers; a caller that needs a single table from it, or
        whose staging is already a stored table, skips the write.  ``dates`` holds the
        dates the calendar must cover (default: those of staging).  ``bucket`` is a product attribute by
        which the staging plan deals its lines, if any: staging is then written in buckets of it."""
        self.spark = spark
        self.share_staging = share_staging
        self.staging_raw = staging_raw
        self.returns_seed = returns_seed
        self.managers_dim = managers
        self.calendar_start = calendar_start
        self.calendar_end = calendar_end
        self.dates = dates
        self.bucket = bucket

    @classmethod
    def from_fixture(cls, spark: SparkSession, root: str, share_staging: bool = True) -> "Warehouse":
        return cls(spark, fixture_staging(spark, root, by_product=share_staging), fixture_returns(spark, root), managers_seed(spark),
                   share_staging=share_staging, dates=fixture_dates(spark, root), bucket="product_id" if share_staging else None)

    @classmethod
    def from_staging_table(cls, spark: SparkSession, staging_path: str, returns: DataFrame,
                           managers: DataFrame, fmt: str = "parquet") -> "Warehouse":
        """A warehouse over a stored staging table (Parquet, or CSV with a
        header, holding the staging columns).  A Parquet table is scanned by its
        consumers directly; CSV is parsed and checked once, into a columnar copy."""
        return cls(spark, read_staging(spark, staging_path, keep_line=True, fmt=fmt), returns, managers,
                   share_staging=fmt != "parquet")

    def build(self, *names: str) -> "Warehouse":
        """Build independent tables at the same time.

        Each name is a cached table of this object (``"fact"``, ``"returns"``,
        ...).  They are built from separate driver threads, so their Spark
        jobs run side by side instead of one after another; the names must
        not share an unbuilt input (the fact and the returns do not).
        """
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            for future in [pool.submit(copy_context().run, getattr, self, n) for n in names]:
                future.result()
        return self

    # -- staging -------------------------------------------------------------
    @cached_property
    def staging_base(self) -> DataFrame:
        """Staging as read, written once to the checkpoint folder.  Lines that come without
        a lineage value have that of their place in the written files, which no shuffle before carries."""
        if not self.share_staging:
            return self.staging_raw
        base = stored_in_buckets(self.staging_raw, self.bucket, "zstd") if self.bucket else stored(self.staging_raw, "zstd")
        return base if LINE_COL in base.columns else base.withColumn(LINE_COL, line_salt())

    @property
    def staging(self) -> DataFrame:
        """Repaired staging: a narrow projection over the written staging."""
        return repair_postal_codes(self.staging_base)

    @property
    def staging_public(self) -> DataFrame:
        return self.staging.select(*STAGING_COLUMNS)

    @cached_property
    def even_bucket(self) -> str | None:
        """``bucket`` where no bucket of the written staging is much larger than the others: hot products are joined by codes
        that a shuffle deals and adaptive execution splits."""
        if not (self.share_staging and self.bucket):
            return None
        files = self.staging_base.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("lines"))
        most = files.agg(F.max("lines").alias("most"), F.sum("lines").alias("lines")).first()
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self.bucket if most["most"] is not None and most["most"] * buckets <= EVEN_BUCKETS * most["lines"] else None

    # -- dimensions ----------------------------------------------------------
    @cached_property
    def dimensions(self) -> dict[str, Numbered]:
        """All four dimensions from one scan of staging, numbered by one sort."""
        return build_dimensions(self.staging, DIMENSIONS)

    def _dimension(self, name: str) -> Numbered:
        """One dimension: of all four where they are built, else alone, from its own columns."""
        if "dimensions" in self.__dict__:
            return self.dimensions[name]
        return build_dimension(self.staging, *DIMENSIONS[name])

    @cached_property
    def shipping(self) -> Numbered:
        return self._dimension("shipping")

    @cached_property
    def customer(self) -> Numbered:
        return self._dimension("customer")

    @cached_property
    def geo(self) -> Numbered:
        return self._dimension("geo")

    @cached_property
    def product(self) -> Numbered:
        return self._dimension("product")

    @cached_property
    def geo_unrepaired(self) -> Numbered:
        """Geography numbered before the repair (NULL postal codes included)."""
        return build_dimension(self.staging_base, GEO_ATTRS, "geo_id")

    @property
    def geo_repaired_in_place(self) -> DataFrame:
        """The unrepaired geography with the repair applied to its rows."""
        return repair_postal_codes(self.geo_unrepaired.df)

    # -- calendar ------------------------------------------------------------
    def calendar(self, cover_data: bool = True) -> DataFrame:
        """Calendar over the configured bounds, widened to every order and
        ship date of staging when ``cover_data``."""
        start, end = self.calendar_start, self.calendar_end
        if cover_data:
            dates = self.staging.select("order_date", "ship_date") if self.dates is None else self.dates
            start, end = covering_bounds(dates, start, end)
        return calendar_dim(self.spark, start, end)

    # -- fact ----------------------------------------------------------------
    @cached_property
    def fact(self) -> Numbered:
        self.dimensions
        bucket = self.even_bucket if self.product.rows > BROADCAST_CODES else None
        lines = star_join(self.staging, self.shipping, self.geo, self.product, self.customer, bucket)
        with _joins_by_some_keys(self.spark):
            numbered = with_dense_ids(lines, FACT_ORDER, "sales_id", start=KEY_BASE + 1, tiebreak=_lineage(lines))
        return Numbered(numbered.df.select(*FACT_COLUMNS), numbered.rows)

    @property
    def sales_fact(self) -> DataFrame:
        return self.fact.df

    def unrepaired_fact_lines(self) -> DataFrame:
        """The star join run on staging before the repair (geo unrepaired)."""
        return star_join(self.staging_base.drop(LINE_COL), self.shipping, self.geo_unrepaired,
                         self.product, self.customer)

    # -- returns -------------------------------------------------------------
    @cached_property
    def returns(self) -> Numbered:
        numbered = with_dense_ids(self.returns_seed, ["order_id", "returned"], "return_id", start=1,
                                  tiebreak=_lineage(self.returns_seed))
        return Numbered(numbered.df.select("return_id", "returned", "order_id"), numbered.rows)

    @property
    def returns_dim(self) -> DataFrame:
        return self.returns.df

    def add_returns(self, fact_rows: DataFrame) -> DataFrame:
        """``fact_rows`` with ``return_id``: the lowest return key of the order, or NULL."""
        return update_from(fact_rows, self.returns_dim, ["order_id"], {"return_id": "return_id"})

    @cached_property
    def sales_fact_with_returns(self) -> DataFrame:
        return self.add_returns(self.sales_fact)

    # -- managers ------------------------------------------------------------
    def order_managers(self) -> DataFrame:
        """``(order_id, manager_id)`` for every staging line whose region has a manager."""
        managers = self.managers_dim.select("manager_id", "region")
        return self.staging.select("order_id", "region").join(managers, ["region"], "inner").select("order_id", "manager_id")

    @cached_property
    def order_updates(self) -> DataFrame:
        """``(order_id, return_id, manager_id)``, each the lowest of its order: both updates' sources,
        reduced by one aggregate and written."""
        returned = self.returns_dim.select("order_id", "return_id", F.lit(None).cast("long").alias("manager_id"))
        managed = self.order_managers().select("order_id", F.lit(None).cast("long").alias("return_id"), "manager_id")
        return stored(returned.unionByName(managed).groupBy("order_id")
                      .agg(F.min("return_id").alias("return_id"), F.min("manager_id").alias("manager_id")), "zstd")

    @cached_property
    def sales_fact_with_managers(self) -> DataFrame:
        """The fact with ``return_id`` and ``manager_id`` (the lowest manager key among the regions of the
        order's staging lines; NULL for regions without one): one left join to the written reduction.  Of more than a few
        orders, counted from the files' footers, it is a sorted one: their texts are many times the files' bytes."""
        updates = self.order_updates
        if updates.count() > BROADCAST_ROWS:
            updates = updates.hint("merge")
        return self.sales_fact.join(updates, ["order_id"], "left").select(*FACT_COLUMNS, "return_id", "manager_id")
