"""Hand-written staging, returns and managers frames for unit tests."""

import datetime as dt
from decimal import Decimal

from starloom.sources.seeds import RETURNS_SCHEMA, managers_seed
from starloom.sources.staging import STAGING_SCHEMA

DEFAULTS = dict(
    order_id="CA-2016-000001", order_date=dt.date(2016, 11, 8), ship_date=dt.date(2016, 11, 11),
    ship_mode="Second Class", customer_id="C0000001", customer_name="Claire Gute", segment="Consumer",
    country="United States", city="Henderson", state="Kentucky", postal_code="42420", region="AFRICA",
    product_id="P-00000001", product_name="Bush Somerset Collection Bookcase", category="Furniture",
    subcategory="Bookcases", sales=Decimal("261.9600"), profit=Decimal("41.9136"), quantity=2,
    discount=Decimal("0.00"),
)


def staging(spark, rows):
    """Build a staging frame; each row is a dict of overrides of DEFAULTS."""
    names = [f.name for f in STAGING_SCHEMA.fields]
    data = [tuple({**DEFAULTS, **r}[n] for n in names) for r in rows]
    return spark.createDataFrame(data, STAGING_SCHEMA)


def returns(spark, order_ids):
    return spark.createDataFrame([("Yes", o) for o in order_ids], RETURNS_SCHEMA)


def managers(spark, rows=None):
    return managers_seed(spark, rows)
