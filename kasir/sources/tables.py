"""Base-table readers.

``read_table`` reads a catalog table or a parquet path and keeps only the
columns the job needs, so the scan's ReadSchema is exactly those columns and
filters written later reach the parquet reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kasir.config import STORE_ATTRS

# Columns each job reads from each source table.
NEEDED: dict[str, tuple[str, ...]] = {
    "bills": ("Sales Date", "Branch", "Visit Purpose", "Bill Number", "Net Sales"),
    "sales_value": ("Date", "RESTO", "Order_Type", "Value"),
    "sales_tc": ("Date", "RESTO", "Order_Type", "Value"),
    "store": ("NEW_CODE_STORE", "STORE", *STORE_ATTRS),
    "targets": ("code", "date_daily", "target_sales_nett"),
    "adjustments": ("date", "RESTO", "percentage_gap", "sales_taf"),
    "productmix": ("Date", "Code", "Product", "QTY"),
    "menu_report": ("Sales Date", "Branch", "Menu Name", "Qty"),
    "lookup_legacy": ("product", "product_cleaned", "category", "product_cleaned_2"),
    "lookup_modern": ("product", "product_cleaned", "category", "product_cleaned_2"),
}

# Catalog names of the inputs (the tables the jobs read today).
TABLES: dict[str, str] = {
    "bills": "sales_data.esb_sales_recapitulation_report",
    "sales_value": "sales_data.sales_value",
    "sales_tc": "sales_data.sales_tc",
    "store": "data_stores.master_data",
    "targets": "sales_data.target_sales_2025",
    "adjustments": "sales_data.data_sales_taf",
    "productmix": "sales_data.productmix",
    "menu_report": "sales_data.esb_menu_recapitulation_report",
    "lookup_legacy": "data_stores.prodmix_category_named",
    "lookup_modern": "data_stores.prodmix_esb_category_named",
}


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table (``db.table``) or a parquet path, pruned to ``columns``.
    A missing column fails here, at analysis time, before any job runs."""
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if columns:
        missing = [c for c in columns if c.lower() not in {x.lower() for x in df.columns}]
        if missing:
            raise ValueError(f"{name}: missing columns {missing}")
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    return df


@dataclass
class SalesInputs:
    bills: DataFrame
    sales_value: DataFrame
    sales_tc: DataFrame
    store: DataFrame
    targets: DataFrame
    adjustments: DataFrame


@dataclass
class MenuInputs:
    productmix: DataFrame
    menu_report: DataFrame
    lookup_legacy: DataFrame
    lookup_modern: DataFrame
    store: DataFrame


def load_sales(spark: SparkSession, tables: dict[str, str] | None = None) -> SalesInputs:
    t = {**TABLES, **(tables or {})}
    return SalesInputs(**{k: read_table(spark, t[k], NEEDED[k]) for k in
                          ("bills", "sales_value", "sales_tc", "store", "targets", "adjustments")})


def load_menu(spark: SparkSession, tables: dict[str, str] | None = None) -> MenuInputs:
    t = {**TABLES, **(tables or {})}
    return MenuInputs(**{k: read_table(spark, t[k], NEEDED[k]) for k in
                         ("productmix", "menu_report", "lookup_legacy", "lookup_modern", "store")})
