"""Reference files: CSV with a header line and empty fields as NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill import schemas

SEED_FILES = {
    "customers_crm": (schemas.CUSTOMER_CSV, "crm"),
    "customers_web": (schemas.CUSTOMER_CSV, "web"),
    "customers_pos": (schemas.CUSTOMER_POS_CSV, "pos"),
    "products_erp": (schemas.PRODUCT_ERP_CSV, "erp"),
    "products_web": (schemas.PRODUCT_WEB_CSV, "web"),
    "stores": (schemas.STORE_CSV, None),
}


def read_csv(spark: SparkSession, path: str, schema: str, source_system: str | None = None) -> DataFrame:
    """Declared columns only; a line that does not fit them fails the read."""
    rows = (
        spark.read.schema(schema).option("header", True).option("nullValue", "").option("mode", "FAILFAST").csv(path)
    )
    if source_system is None:
        return rows
    return rows.withColumns({"source_system": F.lit(source_system), "loaded_at": F.current_timestamp()})


def read_seed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema, system = SEED_FILES[name]
    return read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schema, system)
