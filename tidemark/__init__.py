"""Layered batch ingestion on Spark: landing -> bronze -> silver, with quality rules and history."""

from tidemark.retail import RETAIL, spec
from tidemark.spec import Batch, Column, TableSpec

__all__ = ["RETAIL", "Batch", "Column", "TableSpec", "spec"]
