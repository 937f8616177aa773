"""The derived inputs hold every row of the tables they come from."""

from pyspark.sql import functions as F

from grainfield.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


def test_every_order_is_a_document(spark):
    orders = {f"inv_{r[0]}" for r in spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").distinct().collect()}
    blocks = QUERIES["prepare_blocks"](spark, SF)
    per = {r["document_id"]: r["n"] for r in blocks.groupBy("document_id").agg(F.count("*").alias("n")).collect()}
    assert set(per) == orders and set(per.values()) == {9}
    assert QUERIES["flagship_invoice_extraction"](spark, SF).count() == len(orders)
    assert any(int(d.removeprefix("inv_")) % 10 for d in per)
