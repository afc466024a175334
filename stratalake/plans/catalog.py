"""The layers of a stored lake under SQL names.

Silver and gold become tables of a database, staging becomes views over silver;
plain SQL then reads the lake.  Only names are kept in the catalog: tables are
external, their files stay where the pipeline wrote them.
"""

from __future__ import annotations

from .. import TABLES
from ..sources.lake import current_folder
from ..sources.schemas import STAGED_TYPES
from .incremental import MONTH
from .pipeline import Pipeline

DATABASE = "stratalake"
MARTS = ("dim_customer", "dim_product", "dim_date", "fact_sales")


def table_exists(spark, name: str, database: str = DATABASE) -> bool:
    """S9 by name."""
    return spark.catalog.tableExists(f"{database}.{name}")


def register(pipe: Pipeline, database: str = DATABASE) -> None:
    """Name the current tables of a lake; called again after a build, it names the new ones.

    Tables: ``silver_<table>`` and the marts.  Views: ``stg_<table>`` (S8)."""
    spark, lake = pipe.spark, pipe.lake
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{lake.root.rstrip('/')}/catalog'")

    def table(name: str, path: str) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} USING {lake.fmt} LOCATION '{current_folder(spark, path)}'")
        if lake.fmt != "delta" and lake.partitioned(spark, path, MONTH):
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")

    for t in TABLES:
        table(f"silver_{t}", lake.silver_path(t))
        casts = ", ".join(f"CAST({c} AS {kind}) AS {c}" for c, kind in STAGED_TYPES[t].items())
        spark.sql(f"CREATE OR REPLACE VIEW {database}.stg_{t} AS SELECT {casts} FROM {database}.silver_{t}")
    for t in MARTS:
        table(t, lake.gold_path(t))
