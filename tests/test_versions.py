"""Replacing stored models: whole versions, failing writes, readers of old ones."""

import glob

import pytest
from pyspark.sql import functions as F

from tatemono.sources import readers, sinks, versions


def folders(path):
    return sorted(glob.glob(f"{path}/version-*"))


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "model")
    sinks.write_model(spark.range(5), path)
    broken = spark.range(100, 200, 1, 4).withColumn("id", F.when(F.col("id") < 190, F.col("id")).otherwise(F.raise_error(F.lit("bad row")).cast("long")))
    with pytest.raises(Exception, match="bad row"):
        sinks.write_model(broken, path)
    assert sorted(r["id"] for r in readers.read_model(spark, path).collect()) == [0, 1, 2, 3, 4]
    assert len(folders(path)) == 1


def test_a_version_without_its_marker_does_not_count(spark, tmp_path):
    """As a driver leaves it that dies on the way."""
    path = str(tmp_path / "model")
    sinks.write_model(spark.range(5), path)
    spark.range(9).write.parquet(f"{path}/version-000000000002-{'0' * 32}")
    (tmp_path / "model" / f"version-000000000002-{'0' * 32}" / versions.DONE).unlink()
    assert readers.read_model(spark, path).count() == 5
    for rows in (6, 7, 8):
        assert sinks.write_model(spark.range(rows), path).count() == rows
    assert readers.read_model(spark, path).count() == 8
    assert len(folders(path)) == 2  # the rest went with the versions of its age


def test_a_model_reads_its_own_last_version_and_old_readers_go_on(spark, tmp_path):
    path = str(tmp_path / "model")
    old = sinks.write_model(spark.range(4), path)
    sinks.write_model(readers.read_model(spark, path).withColumn("id", F.col("id") + 10).union(spark.range(1)), path)
    assert sorted(r["id"] for r in readers.read_model(spark, path).collect()) == [0, 10, 11, 12, 13]
    assert old.count() == 4
    with pytest.raises(ValueError, match="at least one"):
        sinks.write_model(spark.range(1), path, keep=0)
    assert readers.read_model(spark, path).count() == 5


def test_a_writer_that_comes_last_with_an_equal_number_keeps_both(spark, tmp_path):
    path = str(tmp_path / "model")

    def write_while_another_does(folder):
        sinks.write_model(spark.range(3), path)
        spark.range(2).write.parquet(folder)

    added = versions.add(spark, path, write_while_another_does)
    assert len(folders(path)) == 2 and spark.read.parquet(added).count() == 2
    assert readers.read_model(spark, path).count() in (2, 3)


def test_plain_folders_and_changed_columns(spark, tmp_path):
    path = str(tmp_path / "plain")
    spark.range(3).write.parquet(path)
    assert readers.read_model(spark, path).count() == 3
    sinks.write_model(spark.range(2).withColumn("x", F.lit("a")), path)
    assert readers.read_model(spark, path).columns == ["id", "x"]
    empty = sinks.write_model(spark.createDataFrame([], "k string"), path)
    assert empty.count() == 0 and readers.read_model(spark, path).columns == ["k"]


def test_a_catalog_table_is_switched(spark):
    spark.sql("drop table if exists switched_model")
    try:
        first = sinks.save_model_table(spark.range(3), "switched_model")
        assert first.count() == 3
        # built from itself, then with other columns
        assert sinks.save_model_table(spark.table("switched_model").union(spark.range(4)), "switched_model").count() == 7
        with pytest.raises(Exception, match="bad row"):
            sinks.save_model_table(spark.range(1).select(F.raise_error(F.lit("bad row")).cast("long").alias("id")), "switched_model")
        assert spark.sql("select count(*) from switched_model").first()[0] == 7
        named = sinks.save_model_table(spark.range(2).withColumn("name", F.lit("n")), "switched_model")
        assert named.columns == ["id", "name"] and spark.table("switched_model").count() == 2
    finally:
        spark.sql("drop table if exists switched_model")
