"""Spark jobs for marketplace order data: ingest, de-duplicate, model, report, check."""

from lakemart.lake import Lake

__all__ = ["Lake"]
