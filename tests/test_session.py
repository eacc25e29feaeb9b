from asterism.session import checkpoint_dir, scratch_path


def test_scratch_under_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(base.rstrip("/") + "/x-") and p1 != p2


def test_release_scratch(spark):
    import os

    from asterism.session import release_scratch, scratch_path

    release_scratch(spark)
    path = scratch_path(spark, "released")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local) and release_scratch(spark) == 1 and not os.path.exists(local)
    assert release_scratch(spark) == 0


def test_sessions_release_their_own_scratch(spark):
    from asterism.session import release_scratch, scratch_path

    other = spark.newSession()
    kept = scratch_path(spark, "kept")
    spark.range(3).write.parquet(kept)
    frame = other.range(2)
    frame.write.parquet(scratch_path(frame.sparkSession, "gone"))
    assert release_scratch(other) == 1 and release_scratch(other) == 0
    assert spark.read.parquet(kept).count() == 3 and release_scratch(spark) >= 1
