"""The shared folder comes from the session; one is made only when none is set."""

from recordlake.session import shared_dir, staging_path


def test_shared_dir_uses_the_session_setting(spark):
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    d = shared_dir(spark)
    if configured:
        assert d == configured.rstrip("/")
    else:
        assert current is not None and d == current.rstrip("/")
    # calling again never replaces it
    assert shared_dir(spark) == d
    assert staging_path(spark, "x").startswith(d + "/recordlake/x-")
