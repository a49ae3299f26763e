from dimweave.session import SETTINGS, configure, fresh_folder, shared_folder


def test_settings(spark, conf):
    conf("spark.sql.mapKeyDedupPolicy", "EXCEPTION")
    configure(spark)
    assert {n: spark.conf.get(n) for n in SETTINGS} == SETTINGS


def test_shared_folder_is_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "a", "b") == f"{root}/a/b"
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    assert fresh_folder(spark, "x").startswith(f"{root}/dimweave/x-")
