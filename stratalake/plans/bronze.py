"""Bronze: land raw extracts unchanged, plus lineage columns (P1, BR1, U1)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import EXTRACT_DATE, INGESTED_AT, RAW


def ingest_stamp() -> str:
    """The one ingest time of a batch, taken once on the driver."""
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat(sep=" ")


def stamp_lineage(raw: DataFrame, extract_date: str, ingested_at: str) -> DataFrame:
    """The raw columns unchanged plus ``_extract_date`` / ``_ingested_at``
    literals (the same values on every row and every table of the batch)."""
    return raw.withColumns({
        EXTRACT_DATE: F.lit(extract_date).cast("date"),
        INGESTED_AT: F.lit(ingested_at).cast("timestamp_ntz"),
    })


def conform_raw(raw: DataFrame, table: str) -> DataFrame:
    """Enforce the declared raw schema (column set, order and types)."""
    schema = RAW[table]
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
