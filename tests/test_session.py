"""Session helpers: explicit settings win, defaults fill in, checkpoints go where configured."""

from cabline.session import DEFAULT_CONF, checkpoint_dir


def test_explicit_settings_win_and_defaults_fill_in(spark):
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"       # the fixture's argument
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    for key in ["spark.sql.codegen.hugeMethodLimit",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize"]:
        assert spark.conf.get(key) == DEFAULT_CONF[key]


def test_checkpoint_dir_uses_the_session_setting(spark):
    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    assert checkpoint_dir(spark, "jobs/x") == base.rstrip("/") + "/jobs/x"


def test_an_existing_session_keeps_its_settings(spark):
    from cabline.session import get_spark
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "12345")
    try:
        assert get_spark() is spark
        assert spark.conf.get(key) == "12345"
    finally:
        spark.conf.set(key, before)
