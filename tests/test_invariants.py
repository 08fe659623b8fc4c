"""Invariants of the layers on the feeds derived from the benchmark tables."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import gold, silver
from strata.plans.feeds import feed

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")

KEYS = {"customers": ["customer_id"], "products": ["product_id"], "orders": ["order_id"],
        "order_items": ["order_id", "product_id"], "shipments": ["order_id"]}
STAGES = {"customers": silver.silver_customers, "products": silver.silver_products, "orders": silver.silver_orders,
          "order_items": silver.silver_order_items, "shipments": silver.silver_shipments}


@pytest.fixture(scope="module")
def layers(spark):
    out = {name: STAGES[name](feed(spark, SF, name)).cache() for name in STAGES}
    out["fact_order_items"] = gold.fact_order_items(out["order_items"]).cache()
    out["fact_orders"] = gold.fact_orders(out["orders"], out["fact_order_items"], out["shipments"]).cache()
    yield out
    for df in out.values():
        df.unpersist()


@pytest.mark.parametrize("entity", sorted(KEYS))
def test_one_row_per_key_and_every_key_kept(spark, layers, entity):
    df = layers[entity]
    keys = KEYS[entity]
    assert df.groupBy(*keys).count().filter("count > 1").count() == 0
    raw = feed(spark, SF, entity)
    for k in keys:
        raw = raw.filter(F.col(k).isNotNull())
    assert df.count() == raw.select(*keys).distinct().count()


def test_fact_orders_has_one_row_per_silver_order(layers):
    assert layers["fact_orders"].count() == layers["orders"].count()
    assert layers["fact_orders"].select("order_id").distinct().count() == layers["orders"].count()


def test_fact_items_are_sellable_silver_lines(layers):
    fi, si = layers["fact_order_items"], layers["order_items"]
    assert fi.join(si, ["order_id", "product_id"], "left_anti").count() == 0
    assert fi.filter("quantity <= 0 OR unit_price < 0 OR discount_amount < 0").count() == 0
    assert fi.filter("item_net_amount <> round(quantity * unit_price - discount_amount, 2)").count() == 0


def test_order_money_and_status(layers):
    fo = layers["fact_orders"]
    bad = fo.filter(
        "net_amount <> round(coalesce(gross_amount, 0) - coalesce(discount_total, 0) + coalesce(shipping_cost, 0), 2)")
    assert bad.count() == 0
    assert fo.filter("delivered_ts IS NOT NULL AND status_final <> 'DELIVERED'").count() == 0
    assert fo.filter("(delivery_time_hours > 72) <> is_late").count() == 0
    assert fo.filter("delivery_time_hours IS NULL AND is_late IS NOT NULL").count() == 0
