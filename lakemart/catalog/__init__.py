"""Registered queries: every operator run over the driver tables, with its SQL equivalent."""

from lakemart.catalog import columns, core, joins, landing, marts, streams, tables  # noqa: F401
from lakemart.catalog.registry import REGISTRY  # noqa: F401
