"""Every query this library answers on the shared tables, with the SQL that checks it."""

from seasonflow.catalog import evaluation, features, ingestion, learning, reports, serving  # noqa: F401
from seasonflow.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
