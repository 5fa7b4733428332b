"""Full refresh of the three layers as tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from ..operators.key_maps import KeyMap
from ..operators.quality import require_unique
from ..operators.staging import materialize, removed_afterwards
from ..sources.catalog import LAYERS, init_layers, write_table
from ..sources.files import BAD_RECORD, ingest_all
from ..sources.schemas import SOURCES
from ..streaming.ingest import BATCH, ingest_sources
from . import gold, silver


def ingestion_items(folders: dict[str, str]) -> list[dict[str, str]]:
    """Items for ``ingest_all``: every known source, with ``folders`` by source system."""
    return [
        {"source": s.system, "path": f"{folders[s.system]}/{s.file}", "table": s.table, "schema": s.schema}
        for s in SOURCES
        if s.system in folders
    ]


def refresh_bronze(spark: SparkSession, folders: dict[str, str], bronze: str = "bronze") -> dict[str, str]:
    """Load all sources; rows that do not fit their columns are kept with the original line."""
    return ingest_all(spark, ingestion_items(folders), bronze)


def load_bronze(spark: SparkSession, folders: dict[str, str], checkpoints: str, bronze: str = "bronze") -> None:
    """Append the source files that are not loaded yet, each by its own header, one partition per batch.

    ``checkpoints`` is the folder that remembers them. ``folders`` may hold patterns for folders of deliveries.
    """
    ingest_sources(spark, folders, bronze, checkpoints, [s for s in SOURCES if s.system in folders])


def refresh_silver(spark: SparkSession, bronze: str = "bronze", silver_schema: str = "silver") -> None:
    for table, (source, build) in silver.BUILDERS.items():
        rows = spark.table(f"{bronze}.{source}").drop(BAD_RECORD, BATCH, "_ingest_timestamp", "_source_file")
        write_table(build(rows), f"{silver_schema}.{table}", sized=True)


def refresh_gold(
    spark: SparkSession, silver_schema: str = "silver", gold_schema: str = "gold", versions: str = "latest",
    stable_keys: bool = False, effective: dt.date | None = None,
) -> None:
    """Customers, products, then facts, which look up the keys just written.

    With ``stable_keys`` customers and products keep their numbers from refresh to refresh (tables ``customer_keys`` and
    ``product_keys``). With ``effective`` the table ``product_history`` gets the changes of the products as versions that
    begin on that day. Raises if a dimension holds a looked-up key twice, as facts would then be doubled.
    """
    customer_map = KeyMap(spark, ["customer_id"], "customer_key", f"{gold_schema}.customer_keys") if stable_keys else None
    product_map = KeyMap(spark, ["product_number"], "product_key", f"{gold_schema}.product_keys") if stable_keys else None

    def read(table: str):
        return spark.table(f"{silver_schema}.{table}")

    customers = gold.dim_customers(read("crm_customers"), read("erp_customers"), read("erp_customer_location"),
                                   customer_map)
    write_table(customers, f"{gold_schema}.dim_customers")
    products = gold.dim_products(read("crm_products"), read("erp_product_category"), versions, key_map=product_map)
    write_table(products, f"{gold_schema}.dim_products")
    if versions == "latest":
        require_unique(spark.table(f"{gold_schema}.dim_products"), ["product_number"])
    require_unique(spark.table(f"{gold_schema}.dim_customers"), ["customer_id"])
    facts = gold.fact_sales(
        read("crm_sales"), spark.table(f"{gold_schema}.dim_products"), spark.table(f"{gold_schema}.dim_customers")
    )
    write_table(facts, f"{gold_schema}.fact_sales", sized=True)
    if effective:
        refresh_history(spark, effective, silver_schema, gold_schema)


def refresh_history(
    spark: SparkSession, effective: dt.date, silver_schema: str = "silver", gold_schema: str = "gold"
) -> None:
    """Bring the table ``product_history`` up to date with the products, as of ``effective``.

    The history is merged aside before it replaces the table; a repeated refresh of one day changes nothing.
    """
    name, batch = f"{gold_schema}.product_history", gold.product_batch(spark.table(f"{silver_schema}.crm_products"))
    if spark.catalog.tableExists(name):
        merged = gold.product_history(spark.table(name), batch, effective)
    else:
        merged = gold.first_history(batch, effective)
    write_table(materialize(merged, "history"), name, comment="Products as versions, by the day a change took effect")


def refresh(
    spark: SparkSession, folders: dict[str, str], prefix: str = "", stable_keys: bool = False,
    effective: dt.date | None = None, checkpoints: str | None = None,
) -> None:
    """Create the layers and rebuild all tables; ``prefix`` goes before the schema names (see ``refresh_gold``).

    With ``checkpoints`` only new source files are loaded, in addition to those of earlier runs (``load_bronze``).
    """
    init_layers(spark, {prefix + name: comment for name, comment in LAYERS.items()})
    if checkpoints:
        load_bronze(spark, folders, checkpoints, f"{prefix}bronze")
    else:
        refresh_bronze(spark, folders, f"{prefix}bronze")
    with removed_afterwards(spark):
        refresh_silver(spark, f"{prefix}bronze", f"{prefix}silver")
        refresh_gold(spark, f"{prefix}silver", f"{prefix}gold", stable_keys=stable_keys, effective=effective)
