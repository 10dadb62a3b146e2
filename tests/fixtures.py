"""Inline micro-fixtures: typed sales / orders / products frames."""
from __future__ import annotations

import datetime as dt
from decimal import Decimal

SALES_SCHEMA = (
    "customer_id BIGINT, product_id BIGINT, transaction_date DATE, quantity DOUBLE, "
    "total_amount DECIMAL(17,4), region STRING, sales_rep STRING"
)
ORDERS_SCHEMA = "customer_id BIGINT, transaction_date TIMESTAMP_NTZ, total_amount DECIMAL(18,2)"
PRODUCTS_SCHEMA = (
    "product_id BIGINT, product_name STRING, category STRING, brand STRING, "
    "profit_margin DOUBLE, stock_quantity BIGINT, is_active INT"
)


def sale(cust, prod, day, qty=1.0, amount="10", region="EU", rep="rep1"):
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    return (cust, prod, day, float(qty), Decimal(str(amount)), region, rep)


def order(cust, when, amount="10"):
    if isinstance(when, str):
        when = dt.datetime.fromisoformat(when)
    return (cust, when, Decimal(str(amount)))


def product(pid, stock=100, active=1, margin=20.0, name=None, category="cat", brand="b"):
    return (pid, name or f"p{pid}", category, brand, float(margin), stock, active)


def sales_df(spark, rows):
    return spark.createDataFrame(rows, SALES_SCHEMA)


def orders_df(spark, rows):
    return spark.createDataFrame(rows, ORDERS_SCHEMA)


def products_df(spark, rows):
    return spark.createDataFrame(rows, PRODUCTS_SCHEMA)
