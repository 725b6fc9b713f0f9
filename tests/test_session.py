"""Session handling: the cluster's settings win; scratch space lives under the checkpoint folder."""

from tabflow.session import checkpoint_dir, configure, scratch_path


def test_existing_checkpoint_dir_is_kept(spark):
    before = checkpoint_dir(spark)
    configure(spark)
    assert checkpoint_dir(spark) == before
    assert scratch_path(spark, "x/y").startswith(before.rstrip("/"))


def test_configure_keeps_explicit_settings(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    configure(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == old
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_cluster_without_a_shared_folder_is_refused():
    from tabflow.session import needs_shared_folder
    assert needs_shared_folder("spark://host:7077", None) and needs_shared_folder("yarn", "")
    assert needs_shared_folder("local-cluster[3,2,2000]", None)
    assert not needs_shared_folder("local[8]", None) and not needs_shared_folder("yarn", "hdfs:///ckpt")
