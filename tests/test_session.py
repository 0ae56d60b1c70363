"""Session settings the scale design relies on."""

from platehub.session import SCALE_CONF, checkpoint_dir


def test_scale_settings_are_applied(spark):
    for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.adaptive.coalescePartitions.enabled"):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get("spark.ui.enabled") == "false"
    assert SCALE_CONF["spark.sql.autoBroadcastJoinThreshold"] == "32MB"


def test_existing_checkpoint_dir_is_kept(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured
    assert checkpoint_dir(spark) == configured
