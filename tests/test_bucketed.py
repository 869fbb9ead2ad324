"""Column groups in one bucketed layout."""

import pytest
from pyspark.sql import functions as F

from quern.sources.bucketed import BucketedTable


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, first, last):
    return spark.range(first, last).select("id", F.concat(F.lit("t"), "id").alias("text"))


def test_reads_join_groups_without_a_shuffle(spark, tmp_path, no_broadcast):
    table = BucketedTable(spark, str(tmp_path / "t"))
    table.create(rows(spark, 0, 500), "id", 4)
    table.add_columns(table.read().select("id", F.length("text").alias("size"), (F.col("id") % 3).alias("rest")))
    table.append(rows(spark, 500, 800))
    table.add_columns(rows(spark, 0, 800).select("id", F.upper("text").alias("loud")))
    table.add_columns(rows(spark, 500, 700).select("id", F.lit(9).alias("size"), F.lit(None).cast("long").alias("rest")))
    full = table.read()
    assert "Exchange" not in plan(full) and "SortMergeJoin" in plan(full)
    got = {r["id"]: r for r in full.collect()}
    assert len(got) == 800 and set(full.columns) == {"id", "text", "size", "rest", "loud"}
    assert (got[42]["size"], got[42]["rest"], got[42]["loud"]) == (3, 0, "T42")
    assert (got[600]["size"], got[600]["rest"]) == (9, None) and got[750]["size"] is None
    assert table.read(["size"]).columns == ["id", "size"] and "loud" not in plan(table.read(["size"]))
    assert table.read(version=1).count() == 500 and table.read(version=1).columns == ["id", "text"]
    assert table.read(version=3).where("size = 9").count() == 0


def test_later_values_count_null_included_and_a_new_handle_finds_all(spark, tmp_path, no_broadcast):
    root = str(tmp_path / "t")
    table = BucketedTable(spark, root)
    table.create(rows(spark, 0, 20), "id", 3)
    table.add_columns(rows(spark, 0, 20).select("id", F.lit(1).alias("n")))
    table.add_columns(rows(spark, 5, 10).select("id", F.lit(None).cast("int").alias("n")))
    again = BucketedTable(spark, root)
    assert again.version == 3 and [e.rows for e in again.log] == [20, 20, 5]
    assert again.read(["n"]).where("n IS NULL").count() == 5
    assert again.read(["n"], version=2).where("n = 1").count() == 20
    assert "Exchange" not in plan(again.read(["n"]))
    with pytest.raises(ValueError):
        again.add_columns(rows(spark, 0, 5))
    with pytest.raises(ValueError):
        again.create(rows(spark, 0, 5), "id", 3)
    empty = BucketedTable(spark, str(tmp_path / "e"))
    empty.create(rows(spark, 0, 0), "id", 2)
    assert empty.read().count() == 0
