"""Warehouse tables as Parquet (read, write) and under their names for SQL."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

from ..tables import Tables, read_warehouse, write_warehouse

__all__ = ["read_warehouse", "write_warehouse", "register_views", "fact_scan"]

VIEW_NAMES = {"dim_stocks": "dim_stocks", "dim_date": "dim_date", "dim_currency": "dim_currency",
              "prices": "fact_stock_prices", "rates": "fact_currency_rates",
              "stock_prices": "stock_prices", "exchange_rates": "exchange_rates", "etl_logs": "etl_logs"}


def register_views(t: Tables) -> None:
    """Expose the warehouse under the reference's table names for SQL users."""
    for attr, name in VIEW_NAMES.items():
        df = getattr(t, attr)
        if df is not None:
            df.createOrReplaceTempView(name)


def fact_scan(t: Tables, start_id: int, end_id: int, columns: Sequence[str]) -> DataFrame:
    """Price rows of [start_id, end_id] straight from the partitioned fact: whole years are
    pruned before any file is opened, and the ``date_id`` range reaches the Parquet reader."""
    return t.prices_where(start_id, end_id).select(*columns)
