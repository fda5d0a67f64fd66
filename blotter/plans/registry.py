"""Import every query module so they register, then expose the catalog."""

from __future__ import annotations

from blotter.plans import catalog
from blotter.plans import bands, feed, geo, integration, trends  # noqa: F401


def queries():
    return dict(catalog.QUERIES)


def oracle_sql():
    return dict(catalog.ORACLE)
