import os

import pytest

from cohortloom.session import drop_scratch, materialize, scratch_dir, scratch_scope, ship_package, spread


def test_scratch_tables_are_shared_and_can_be_dropped(spark):
    df = materialize(spark.range(5).toDF("id"), "t")
    assert df.count() == 5 and scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert materialize(spark.range(0).toDF("id")).count() == 0
    root = scratch_dir(spark).removeprefix("file://")
    assert os.listdir(os.path.join(root, "cohortloom"))
    assert drop_scratch(spark) and not drop_scratch(spark)


def test_package_reaches_workers_once(spark):
    ship_package(spark)
    ship_package(spark)

    def where(batches):
        import cohortloom

        for b in batches:
            yield b
            assert cohortloom.__name__

    assert spark.range(3).mapInPandas(where, "id long").count() == 3


def test_scratch_of_a_scope_is_removed_at_its_end(spark):
    root = os.path.join(scratch_dir(spark).removeprefix("file://"), "cohortloom", spark.sparkContext.applicationId)
    kept = materialize(spark.range(2).toDF("id"), "kept")
    with pytest.raises(ValueError), scratch_scope(spark):
        with scratch_scope(spark):
            assert materialize(spark.range(3).toDF("id"), "inner").count() == 3
        assert materialize(spark.range(4).toDF("id"), "outer").count() == 4
        raise ValueError
    assert kept.count() == 2 and all(f.startswith("kept") for f in os.listdir(root))


def test_rows_are_spread_over_all_cores(spark):
    assert spread(spark.range(5).toDF("id")).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
