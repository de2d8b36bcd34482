"""Load once, query many: the star schema of a data folder, kept in the shared folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

from storelens.plans.etl import run_etl
from storelens.session import files_fingerprint, remove, scratch_path
from storelens.sources.binding import bind_test_tables
from storelens.sources.warehouse import Warehouse, open_warehouse

_built: dict[tuple[str, str], tuple[str, str]] = {}


def warehouse_for(spark: SparkSession, directory: str, start: str | None = None, end: str | None = None) -> Warehouse:
    """Run the ETL on first use in an application and whenever files of the folder have changed, then read its tables back."""
    key = (spark.sparkContext.applicationId, directory)
    files = files_fingerprint(spark, directory)
    known, path = _built.get(key, ("", ""))
    if known != files:
        if path:
            remove(spark, path)
        path = scratch_path(spark, "warehouse")
        run_etl(spark, bind_test_tables(spark, directory), path, start, end)
        _built[key] = (files, path)
    return open_warehouse(spark, path)
