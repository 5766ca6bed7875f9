from strata.session import SCALE_SETTINGS, checkpoint_dir, ensure_checkpoint_dir, state_location


def test_checkpoint_dir_is_kept(spark):
    before = ensure_checkpoint_dir(spark)
    assert before and ensure_checkpoint_dir(spark) == before
    assert checkpoint_dir(spark) == before
    # streaming state lies beside, not below, the session's own folder: a new
    # session with the same setting finds it
    base = spark.conf.get("spark.checkpoint.dir", None) or before.rstrip("/").rpartition("/")[0]
    assert state_location(spark, "intake/t") == f"{base.rstrip('/')}/intake/t"


def test_scale_settings_applied(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert set(SCALE_SETTINGS) >= {"spark.sql.autoBroadcastJoinThreshold"}
