"""Target tables of the catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tagwright.schemas import STORED_POST


def ensure_table(
    spark: SparkSession, database: str, table: str, reset: bool = False, location: str | None = None
) -> str:
    """Create the stored posts' table if it is missing. Its rows are dropped only on request.

    ``location`` is the folder of a new database, by default the catalog's own.
    """
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`" + (f" LOCATION '{location}'" if location else ""))
    if reset:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"{field} STRING" for field in STORED_POST.names)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
    return name
