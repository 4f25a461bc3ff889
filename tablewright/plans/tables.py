"""The tables that the registered queries read, and their catalog."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from tablewright.session import shared_root
from tablewright.sources import files
from tablewright.sources.folders import Catalog, crawl_folder, open_catalog

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
# Which steps a table task runs; the empty name is the default row.
TASK_SETTINGS = (
    ("", "extract_by_query", "load_atomic", 1),
    ("lineitem", "extract_by_scan", "load_atomic", 2),
    ("events", "extract_by_scan", "load_batched", 1),
)
TASK_COLUMNS = "table_name string, extract_step string, load_step string, table_order int"
#: What each folder looked like when its catalog was last brought up to date.
_SEEN: dict[str, str] = {}
VIEWS = {"open_orders": ("orders", "o_orderstatus = 'O'")}


def folder_catalog(spark: SparkSession, root: str) -> Catalog:
    """Tables and fields of a folder; stored for the application, and brought up to date where files have changed."""
    store = f"{shared_root(spark)}/tablewright/{spark.sparkContext.applicationId}/catalog-{hashlib.md5(root.encode()).hexdigest()}"
    state = files.state(spark, root)
    if _SEEN.get(store) == state:
        return open_catalog(spark, store)
    found = crawl_folder(spark, root, store, views=VIEWS)
    _SEEN[store] = state
    return found


def stored_catalog(spark: SparkSession, root: str) -> DataFrame:
    """The fields of all tables and views."""
    return folder_catalog(spark, root).fields


def task_settings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TASK_SETTINGS), TASK_COLUMNS)
