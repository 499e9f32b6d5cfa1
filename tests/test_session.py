"""Work tables belong to scopes."""

import os

import pytest

from kindred.session import WorkScope, materialize, new_work_path, new_work_table


def test_a_scope_removes_only_what_it_wrote(spark):
    before = materialize(spark.range(3), "before")
    with WorkScope() as outer:
        own = materialize(spark.range(5), "own")
        with WorkScope() as inner:
            other = materialize(spark.range(7), "other")
        late = materialize(spark.range(9), "late")
    after = materialize(spark.range(11), "after")
    outer.drop(spark)
    assert (before.count(), other.count(), after.count()) == (3, 7, 11)
    assert not any(os.path.exists(p) for p in [f.removeprefix("file:") for f in (*own.inputFiles(), *late.inputFiles())])
    inner.drop(spark)
    inner.drop(spark)  # once more changes nothing
    assert before.count() == 3


def test_catalog_entries_go_with_the_folder(spark):
    with WorkScope() as scope:
        name, path = new_work_table(spark, "bucketed")
        spark.range(10).write.option("path", path).bucketBy(2, "id").saveAsTable(name)
    assert spark.table(name).count() == 10
    scope.drop(spark)
    assert not spark.catalog.tableExists(name) and not os.path.exists(path)


def test_a_failed_job_closes_its_scope(spark):
    with pytest.raises(RuntimeError), WorkScope() as scope:
        raise RuntimeError
    new_work_path(spark, "free")
    assert scope.paths == []
