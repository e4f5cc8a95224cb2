"""starloom: a PySpark job that models flat retail order lines as a star schema.

The job builds shipping, customer, geography and product dimensions with dense,
deterministic surrogate keys, a generated calendar, a sales fact joined from the
staging lines, enriches the fact with returns and regional managers, and audits
the result.  Everything runs as DataFrame plans; see ``README.md``.
"""

from starloom.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
