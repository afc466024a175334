"""Storage round trips: append history, overwrite, existence."""

from pyspark.sql import functions as F

from stratalake.plans.bronze import stamp_lineage
from stratalake.sources.lake import Lake, table_history, table_version


def test_append_twice_gives_version_one(spark, scratch):
    lake = Lake(scratch)
    path = lake.bronze_path("t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    second = spark.createDataFrame([(3, "c")], "id long, v string")
    lake.append(stamp_lineage(first, "2024-01-01", "2024-01-01 01:00:00"), path,
                partition_by=["_extract_date"])
    lake.append(stamp_lineage(second, "2024-01-02", "2024-01-02 01:00:00"), path,
                partition_by=["_extract_date"])
    df = lake.read(spark, path)
    v = table_version(df).first()
    assert v.version == 1 and v.rows == 3
    hist = table_history(df).orderBy("version").collect()
    assert [(h.version, h.rows) for h in hist] == [(0, 2), (1, 1)]


def test_overwrite_replaces(spark, scratch):
    lake = Lake(scratch)
    path = lake.silver_path("t")
    lake.overwrite(spark.createDataFrame([(1,), (2,), (3,)], "id long"), path)
    lake.overwrite(spark.createDataFrame([(9,)], "id long"), path)
    assert [r.id for r in lake.read(spark, path).collect()] == [9]


def test_missing_table_does_not_exist(spark, scratch):
    lake = Lake(scratch)
    assert not lake.exists(spark, lake.silver_path("nothing"))
    lake.overwrite(spark.range(1), lake.silver_path("there"))
    assert lake.exists(spark, lake.silver_path("there"))


def test_partition_pruning_on_extract_date(spark, scratch):
    lake = Lake(scratch)
    path = lake.bronze_path("t")
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    lake.append(stamp_lineage(df, "2024-01-01", "2024-01-01 01:00:00"), path, ["_extract_date"])
    q = lake.read(spark, path).where(F.col("_extract_date") == F.lit("2024-01-01").cast("date"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_extract_date" in plan


def test_failed_overwrite_keeps_the_old_table(spark, scratch):
    import pytest
    from pyspark.sql import functions as F

    from stratalake.sources.lake import Lake
    lake, path = Lake(scratch), f"{scratch}/t"
    lake.overwrite(spark.range(10), path)
    with pytest.raises(Exception, match="on purpose"):
        lake.overwrite(spark.range(5).select(F.raise_error(F.lit("on purpose")).cast("long").alias("id")), path)
    assert lake.read(spark, path).count() == 10
    lake.overwrite(lake.read(spark, path).where("id < 3"), path)
    assert lake.read(spark, path).count() == 3


def test_two_appends_of_one_stamp_are_two_versions(spark, scratch):
    from stratalake.sources.lake import append_history, append_version
    lake = Lake(scratch)
    path = lake.bronze_path("t")
    for values in ([(1, "a"), (2, "b")], [(3, "c")]):
        lake.append(stamp_lineage(spark.createDataFrame(values, "id long, v string"), "2024-01-01",
                                  "2024-01-01 01:00:00"), path, partition_by=["_extract_date"])
    version = append_version(spark, path)
    assert tuple(version.first()) == (1, 3)
    assert [(h.version, h.rows) for h in append_history(spark, path).orderBy("version").collect()] == [(0, 2), (1, 1)]
    # the counts come from the footers
    assert "PushedAggregation: [COUNT(*)]" in version._jdf.queryExecution().executedPlan().toString()


def test_overwrite_that_broke_off_is_not_read(spark, scratch):
    """A version without Spark's commit mark is ignored, and removed by the next overwrite."""
    import os
    lake = Lake(scratch)
    path = lake.silver_path("t")
    lake.overwrite(spark.range(4), path)
    os.makedirs(f"{path}/v=00000002")
    spark.range(9).write.parquet(f"{path}/v=00000002/half")
    assert lake.read(spark, path).count() == 4
    lake.overwrite(lake.read(spark, path).where("id > 0"), path)   # reads what it replaces
    assert lake.read(spark, path).count() == 3
    lake.overwrite(spark.range(1), path)
    assert sorted(os.listdir(path)) == ["v=00000002", "v=00000003"]   # the last and the one before


def test_partitions_left_empty_go(spark, scratch):
    lake = Lake(scratch)
    path = lake.silver_path("t")
    lake.overwrite(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, p string"), path, ["p"])
    lake.overwrite_partitions(lake.read(spark, path).where("id = 2 OR id = 3").where("p != 'c'"), path, "p", ["a", "b", "c"])
    assert sorted(tuple(r) for r in lake.read(spark, path).select("id", "p").collect()) == [(2, "b")]
    lake.overwrite_partitions(spark.createDataFrame([(9, "a")], "id long, p string"), path, "p", {"a"})
    assert sorted(tuple(r) for r in lake.read(spark, path).select("id", "p").collect()) == [(2, "b"), (9, "a")]


def test_export_lies_in_ranges(spark, scratch):
    """Files of an export do not overlap in the column they are ranged by, so a predicate skips most of them."""
    import glob

    import pyarrow.parquet as pq

    from stratalake.sources.lake import current_folder
    lake = Lake(scratch)
    days = spark.range(5000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") * 7919 % 400).cast("int"))
                                    .alias("day"))
    lake.export(days, lake.serving_path("t"), "day", rows_per_file=700)
    bounds = []
    for f in glob.glob(f"{current_folder(spark, lake.serving_path('t'))}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        assert meta.num_rows <= 700
        stats = meta.row_group(0).column(1).statistics
        bounds.append((stats.min, stats.max))
    bounds.sort()
    assert len(bounds) >= 8 and all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))
    assert lake.read(spark, lake.serving_path("t")).count() == 5000
