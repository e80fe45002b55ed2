"""Tables that are replaced as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from formmart.plans.mart import write_table
from formmart.sources.tables import VersionedTable


def test_a_failed_replacement_leaves_the_table(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    first = table.replace(spark.range(100))
    broken = spark.range(1000).withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert table.read().count() == 100 and first.count() == 100


def test_readers_stay_on_their_version_and_old_ones_go(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    first = table.replace(spark.range(3))
    second = table.replace(first.unionByName(spark.range(10, 12)))  # reads the table it replaces
    assert first.count() == 3 and second.count() == 5 and table.read().count() == 5
    table.replace(spark.range(7))
    assert second.count() == 5 and table.read().count() == 7
    assert len(table.versions()) == 2


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "w")
    write_table(spark.range(10), path)
    out = write_table(spark.range(4), path)
    assert out.count() == 4 and out.inputFiles()[0].startswith(f"file://{path}/v") and not (tmp_path / "w_spread").exists()
