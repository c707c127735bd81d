"""Queries that ask for every row of their input."""

from pyspark.sql import functions as F

from ledgerline.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_order_is_asked_and_every_row_comes_in(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet").select(F.col("o_orderkey").alias("supply_id"))
    asked = QUERIES["is_entitled_all"](spark, SF)
    assert asked.count() == orders.count() and orders.join(asked, "supply_id", "left_anti").isEmpty()
    entitled = asked.where("entitled").select("supply_id")
    found = QUERIES["entitlement_asof_all"](spark, SF).select("supply_id").distinct()
    assert entitled.exceptAll(found).isEmpty() and found.exceptAll(entitled).isEmpty()
    assert not found.where("supply_id % 10 <> 0").isEmpty()
    assert QUERIES["content_upsert_all"](spark, SF).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
