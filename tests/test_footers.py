"""Parquet footers that cannot be read."""

import pytest

from changeloom.operators import schema_drift
from changeloom.queries import problems


def footers(spark, tmp_path):
    spark.sql("SELECT 1 AS a, 'x' AS b").coalesce(1).write.parquet(str(tmp_path / "good"))
    (tmp_path / "text.parquet").write_text("no parquet file at all")
    (tmp_path / "empty.parquet").write_text("")
    good = spark.read.parquet(str(tmp_path / "good")).inputFiles()[0]
    bad = [(1, f"file://{tmp_path}/nowhere.parquet", "no file"), (2, f"{tmp_path}/text.parquet", "no parquet"), (3, f"{tmp_path}/empty.parquet", "no parquet"), (4, None, "no path")]
    return spark.createDataFrame([("t", 0, good), *(("t", n, p) for n, p, _ in bad)], "topic string, file_seq int, path string"), bad


def test_unread_footers_are_listed(spark, tmp_path):
    files, bad = footers(spark, tmp_path)
    assert {tuple(r) for r in schema_drift.unread_footers(files).collect()} == {("t", n, p, why) for n, p, why in bad}
    assert [tuple(r) for r in schema_drift.footer_fields(files).orderBy("pos").collect()] == [("t", 0, 0, "a", "int32"), ("t", 0, 1, "b", "string")]


def test_p2_footers_fail_on_unread_files(spark, tmp_path):
    files, _ = footers(spark, tmp_path)
    assert problems._all_footers(files.where("file_seq = 0")).count() == 2
    with pytest.raises(ValueError, match="4 footers"):
        problems._all_footers(files)


def test_other_errors_fail(spark):
    # not a missing file: a file system that is not known
    files = spark.createDataFrame([("t", 0, "nosuch://x/y.parquet")], "topic string, file_seq int, path string")
    with pytest.raises(Exception):
        schema_drift.footer_fields(files).collect()
