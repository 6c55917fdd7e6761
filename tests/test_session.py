from flowtally.session import SETTINGS, work_dir


def test_settings_are_active(spark):
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())


def test_work_dir_is_new_and_below_the_shared_folder(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        assert first.startswith(root)
