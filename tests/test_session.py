"""Session helpers: cluster sizing and the shared scratch folder."""

from godown.session import checkpoint_root, cluster_conf, scratch_path


def test_cluster_conf_scales_with_input():
    small = cluster_conf(1 << 30)
    big = cluster_conf(100 * (1 << 40))                      # 100 TB
    assert int(small["spark.sql.shuffle.partitions"]) == 200
    assert int(big["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20) + 1
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)


def test_scratch_is_under_the_session_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert a != b and a.startswith(root.replace("file:", ""))
