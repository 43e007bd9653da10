"""martstar: a daily market-data warehouse as PySpark DataFrame operators."""

from .tables import Tables, read_warehouse, write_warehouse  # noqa: F401

__all__ = ["Tables", "read_warehouse", "write_warehouse"]
