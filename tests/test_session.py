"""The session policy the plans rely on."""

from zonekit.session import checkpoint_root, ensure_checkpoint_dir, scratch_path


def test_scale_settings_are_applied(spark):
    c = spark.conf
    assert c.get("spark.sql.autoBroadcastJoinThreshold") == "10m"          # no estimate-based broadcast
    assert c.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "64m"
    assert c.get("spark.sql.adaptive.enabled") == "true"
    assert c.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.sparkContext.getConf().get("spark.serializer").endswith("KryoSerializer")
    assert c.get("spark.ui.enabled") == "false"


def test_checkpoint_folder_comes_from_the_session(spark):
    root = checkpoint_root(spark)
    assert root and ensure_checkpoint_dir(spark) == root
    assert scratch_path(spark, "a", "b").startswith(root.rstrip("/") + "/zonekit/a/b")
