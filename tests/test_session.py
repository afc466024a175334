"""Session settings: the checkpoint folder is the cluster's, never a local one."""

from stratalake.session import ensure_checkpoint_dir, shuffle_partitions_for


def test_local_session_gets_a_checkpoint_folder(spark):
    # local mode (tests): a scratch folder is set when none is configured
    assert spark.sparkContext.master.startswith("local")
    assert ensure_checkpoint_dir(spark)


def test_shuffle_partitions_scale_with_input():
    assert shuffle_partitions_for(1) == 200
    assert shuffle_partitions_for(100 * 1024 ** 4) == 200_000     # 100 TB hits the ceiling
    assert shuffle_partitions_for(1024 ** 4) == 8192              # 1 TB / 128 MB
