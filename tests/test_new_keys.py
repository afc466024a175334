"""What a batch of new keys writes, and the codec of the lake's files."""

import glob

import pyarrow.parquet as pq

from stratalake.plans.incremental import MONTH, IncrementalState
from stratalake.sources.lake import Lake, scratch_lake
from stratalake.sources.schemas import BRONZE


def test_batch_of_new_lines_is_stored_once(spark, scratch):
    """New keys meet no older row and no line follows an order: the changes are the batch, written once."""
    state = IncrementalState(spark, Lake(scratch))
    cells = "DATE'2024-01-02' AS _extract_date, TIMESTAMP_NTZ'2024-01-02 01:00:00' AS _ingested_at"
    orders = spark.sql(f"SELECT id AS order_id, id AS customer_id, '2024-01-01 00:00:00' AS order_ts, 'NEW' AS status, {cells} FROM range(5)")
    lines = spark.sql(f"SELECT id AS order_item_id, id % 6 AS order_id, id AS product_id, 1L AS quantity, "
                      f"CAST(2 AS DECIMAL(12,2)) AS unit_price, {cells} FROM range(20)")
    o = state._kept(state._changed_orders(state._kept(orders.select(*BRONZE["orders"].fieldNames()), "newest_orders")), "orders")
    top = state._kept(lines.select(*BRONZE["order_items"].fieldNames()), "newest_order_items")
    written, kept = [], state._kept
    state._kept = lambda df, name: written.append(name) or kept(df, name)
    found = state._changed_lines(top, o)
    assert written == ["batch_lines"]
    assert sorted((r["order_item_id"], r[MONTH], r["old_month"]) for r in found.collect()) == [
        (i, "none" if i % 6 == 5 else "2024-01", None) for i in range(20)]


def test_lake_files_are_zstd(spark, scratch):
    lake = scratch_lake(spark)
    lake.overwrite(spark.range(10), lake.silver_path("t"))
    lake.append(spark.range(10), lake.bronze_path("t"))
    files = glob.glob(f"{lake.root.removeprefix('file:')}/**/*.parquet", recursive=True)
    assert files and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
