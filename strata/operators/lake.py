"""The CSV lake (SRC7) and the report over it (LAK1, JN4, JN5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_lake_csv, write_lake_csv
from .joins import fan_out_join

#: Lake tables and their columns, in file order: the files have no header.
COLUMNS = {
    "trx": ("nid", "dinsertion", "nproductid", "namount", "noperationfee", "nshopid"),
    "product": ("nid", "sname"),
    "shop": ("nid", "sname", "ncityid"),
    "city": ("nid", "sname"),
    "facturation": ("nid", "nshopid", "dinsertion", "sbillerid", "namount"),
}


def store_tables(frames: Mapping[str, DataFrame], base: str) -> None:
    """Write each frame as a folder of header-less CSV files, every value as text."""
    for name, columns in COLUMNS.items():
        write_lake_csv(frames[name].select(*columns), f"{base}/{name}")


def open_tables(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Lazy all-text scans of the lake's folders."""
    return {name: read_lake_csv(spark, f"{base}/{name}", columns) for name, columns in COLUMNS.items()}


def key(column: str) -> Column:
    """A key column as a number: text that is none matches nothing instead of failing the scan."""
    return F.col(column).try_cast("bigint")


def transaction_report(tables: Mapping[str, DataFrame], cell: int = 4096) -> DataFrame:
    """LAK1: transactions with an amount, of named shops, with product, shop, city and every bill of the shop.

    Keys are compared as numbers, values stay the text of the files.  The dimensions
    are joined first and unnamed shops dropped before bills multiply the rows.
    """
    trx = tables["trx"].filter(F.col("namount").isNotNull()).select(
        F.col("nid").alias("transaction_id"), F.col("dinsertion").alias("transaction_date"),
        F.col("namount").alias("transaction_amount"), F.col("noperationfee").alias("operation_fee"),
        key("nproductid").alias("product"), key("nshopid").alias("shop"),
    )
    product = tables["product"].select(key("nid").alias("product"), F.col("sname").alias("product_name"))
    shop = tables["shop"].filter(F.col("sname").isNotNull()).select(
        key("nid").alias("shop"), F.col("sname").alias("shop_name"), key("ncityid").alias("city")
    )
    city = tables["city"].select(key("nid").alias("city"), F.col("sname").alias("city_name"))
    bills = tables["facturation"].select(
        key("nshopid").alias("bill_shop"), F.col("namount").alias("facturation_amount"),
        F.col("dinsertion").alias("facturation_date"), F.col("nid").alias("bill_id"),
    )
    star = trx.join(shop, "shop").join(product, "product", "left").join(city, "city", "left")
    joined = fan_out_join(
        star, bills, "shop", "bill_shop", F.xxhash64("transaction_id", "product", "transaction_amount"), F.xxhash64("bill_id"), cell,
        left_keys=trx.select("shop"),
    )
    return joined.select(
        "transaction_id", "transaction_date", "transaction_amount", "operation_fee", "product_name", "shop_name", "city_name",
        "facturation_amount", "facturation_date",
    )
