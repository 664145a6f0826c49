from rentscope.session import checkpoint_root, scratch_path, sized_conf


def test_sized_conf_bounds():
    small = sized_conf(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    huge = sized_conf(100 << 40, 8000)
    assert huge["spark.sql.shuffle.partitions"] == "50000"
    mid = sized_conf(1 << 40, 800)
    assert mid["spark.sql.shuffle.partitions"] == str((1 << 40) // (256 << 20))


def test_scratch_paths_live_under_checkpoint_root(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_checkpoint_root_is_stable(spark):
    assert checkpoint_root(spark) == checkpoint_root(spark)
