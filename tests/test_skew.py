"""Hot keys: one order holds a third of all lines."""

from decimal import Decimal

from pyspark.sql import functions as F

from strata.operators import gold


def test_hot_order_is_pre_aggregated_and_joins_once(spark):
    n = 30000
    items = spark.range(0, n, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("O-hot")).otherwise(F.concat(F.lit("O"), F.col("id").cast("string")))
        .alias("order_id"),
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_id"),
        F.lit(1).alias("quantity"),
        F.lit(Decimal("2.50")).cast("decimal(10,2)").alias("unit_price"),
        F.lit(Decimal("0.50")).cast("decimal(10,2)").alias("discount_amount"),
    )
    orders = items.select("order_id").distinct().select(
        "order_id", F.lit("C1").alias("customer_id"),
        F.lit("2025-12-01 10:00:00").cast("timestamp").alias("order_ts"), F.lit("PIX").alias("payment_method"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = gold.fact_orders(orders, items)
        hot = facts.filter("order_id = 'O-hot'").first()
        plan = facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert facts.count() == orders.count()
    assert hot.gross_amount == Decimal("25000.00")      # 10,000 lines x 2.50
    assert hot.discount_total == Decimal("5000.00")
    assert hot.net_amount == Decimal("20000.00")
    # partial sums run before the shuffle, so the hot order sends one row per map task
    assert "partial_sum" in plan
