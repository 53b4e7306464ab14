"""Per-location sales analytics as Spark jobs."""

from storeledger.config import Config

__all__ = ["Config"]
