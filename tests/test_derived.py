"""Webhook-shaped sets over driver tables."""

from helpers import final_plan
from pyspark.sql import functions as F

from devmetrics.sources.derived import DerivedEvents


def lines(spark, path, files):
    table = spark.range(0, 400, 1, files).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 3).alias("l_partkey"), (F.col("id") * 5).alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"), F.lit("A").alias("l_returnflag"),
        F.lit("1996-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    table.write.parquet(f"{path}/lineitem.parquet")
    return DerivedEvents(spark, str(path)).reviews


def test_rows_are_dealt_out_only_where_the_scan_has_too_few_tasks(spark, tmp_path):
    few = lines(spark, tmp_path / "few", 1)
    many = lines(spark, tmp_path / "many", 4 * spark.sparkContext.defaultParallelism)
    assert "Exchange" in final_plan(few) and "Exchange" not in final_plan(many)
    assert few.exceptAll(many).count() == many.exceptAll(few).count() == 0 < few.count()
