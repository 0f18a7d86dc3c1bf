from evstar.session import CLUSTER_SETTINGS, SESSION_DEFAULTS, scratch_dir, shared_root


def test_setting_names_are_known_to_spark(spark):
    known = {r.key for r in spark.sql("SET -v").collect()}
    core = {
        "spark.ui.enabled",
        "spark.ui.showConsoleProgress",
        "spark.sql.streaming.stateStore.providerClass",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    }
    for key in {**SESSION_DEFAULTS, **CLUSTER_SETTINGS}:
        assert key in known or key in core, key


def test_shared_root_reads_session_setting(spark):
    root = shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(root + "/x-")
