"""Schemas of the warehouse tables, landing records and payload shapes."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 4)
RETURN_PCT = T.DecimalType(8, 6)
RATE = T.DecimalType(10, 6)
# converted prices (price * rate) keep four places after rounding
CONVERTED = T.DecimalType(18, 4)

DIM_STOCKS = T.StructType([
    T.StructField("stock_id", T.IntegerType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("company_name", T.StringType(), True),
    T.StructField("sector", T.StringType(), True),
    T.StructField("market_cap_category", T.StringType(), True),
    T.StructField("is_active", T.BooleanType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

DIM_DATE = T.StructType([
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("date_value", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("quarter", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("day_of_week", T.IntegerType(), False),
    T.StructField("day_of_year", T.IntegerType(), False),
    T.StructField("week_of_year", T.IntegerType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
    T.StructField("is_holiday", T.BooleanType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

DIM_CURRENCY = T.StructType([
    T.StructField("currency_id", T.IntegerType(), False),
    T.StructField("currency_code", T.StringType(), False),
    T.StructField("currency_name", T.StringType(), False),
    T.StructField("is_base_currency", T.BooleanType(), True),
    T.StructField("is_active", T.BooleanType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

FACT_STOCK_PRICES = T.StructType([
    T.StructField("stock_id", T.IntegerType(), False),
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("opening_price", PRICE, False),
    T.StructField("high_price", PRICE, False),
    T.StructField("low_price", PRICE, False),
    T.StructField("closing_price", PRICE, False),
    T.StructField("volume", T.LongType(), False),
    T.StructField("adjusted_close", PRICE, True),
    T.StructField("daily_return", RETURN_PCT, True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

FACT_CURRENCY_RATES = T.StructType([
    T.StructField("from_currency_id", T.IntegerType(), False),
    T.StructField("to_currency_id", T.IntegerType(), False),
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("exchange_rate", RATE, False),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

# the last row of each stock in each year: what the first row of a later year is compared with
YEAR_ENDS = T.StructType([
    T.StructField("stock_id", T.IntegerType(), False),
    T.StructField("date_id", T.IntegerType(), False),
    T.StructField("closing_price", PRICE, False),
])

# backfill tables keyed by natural keys
STOCK_PRICES = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open_price", PRICE, True),
    T.StructField("high_price", PRICE, True),
    T.StructField("low_price", PRICE, True),
    T.StructField("close_price", PRICE, True),
    T.StructField("volume", T.LongType(), True),
    T.StructField("adjusted_close", PRICE, True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

EXCHANGE_RATES = T.StructType([
    T.StructField("from_currency", T.StringType(), False),
    T.StructField("to_currency", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("rate", RATE, True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("updated_at", T.TimestampType(), True),
])

ETL_LOGS = T.StructType([
    T.StructField("operation_type", T.StringType(), False),
    T.StructField("table_name", T.StringType(), False),
    T.StructField("operation_timestamp", T.TimestampType(), False),
    T.StructField("records_affected", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("details", T.StringType(), True),
])

# Landing records are read as all-string columns so that nothing is lost
# before validation; numbers in JSON keep their text form.
LANDING_STOCK = T.StructType([
    T.StructField(n, T.StringType(), True) for n in
    ("symbol", "data_date", "open_price", "high_price", "low_price", "close_price",
     "volume", "source", "created_at")
] + [T.StructField("_corrupt_record", T.StringType(), True)])

LANDING_RATE = T.StructType([
    T.StructField(n, T.StringType(), True) for n in
    ("from_currency", "to_currency", "data_date", "exchange_rate", "source", "created_at")
] + [T.StructField("_corrupt_record", T.StringType(), True)])

# vendor series payloads: {date -> {field -> text}}
SERIES_MAP = "map<string,map<string,string>>"
