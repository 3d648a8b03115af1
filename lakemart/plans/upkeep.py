"""Maintenance over every table: fewer, larger files, and expired versions removed."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from lakemart import spec
from lakemart.plans.ads import AdsMart
from lakemart.plans.sales import SalesMart
from lakemart.plans.snapshots import ProjectionsMart, SheetSalesMart, SubscriptionsMart
from lakemart.sources.tables import PartitionedTable, SnapshotTable


def all_tables(spark: SparkSession, root: str) -> list[SnapshotTable | PartitionedTable]:
    """Every table of every mart below ``root``, existing or not."""
    marts = [AdsMart(spark, root, level) for level in spec.ADS_LEVELS]
    marts += [mart(spark, root) for mart in (SalesMart, SubscriptionsMart, SheetSalesMart, ProjectionsMart)]
    return [table for mart in marts for table in mart.tables()]


def maintain(
    tables: Iterable[SnapshotTable | PartitionedTable], retention_hours: int = spec.RETENTION_HOURS
) -> list[str]:
    """Compact and expire every table that exists; returns the paths visited."""
    visited = []
    for table in tables:
        if not table.exists():
            continue
        table.compact()
        table.expire(retention_hours)
        visited.append(table.path)
    return visited
