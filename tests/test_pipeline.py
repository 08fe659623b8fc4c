"""End to end on a fresh two-day landing zone: bronze -> silver -> gold."""

import datetime as dt
from decimal import Decimal

import pytest

from landing_fixture import DAY1, DAY2, write_landing
from strata.operators import gold, silver
from strata.operators.audit import orphan_audit, quality_summary
from strata.plans.pipeline import Lake, run_bronze, run_gold, run_pipeline, run_silver
from strata.sources.landing import ingest_audit, read_landing
from strata.sources.tables import read_if_exists, read_table

D1 = dt.date(2025, 12, 1)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    write_landing(root / "landing")
    return run_pipeline(spark, str(root / "landing"), str(root / "lake"), exports=str(root / "exports"))


def by_key(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_bronze_keeps_every_row_with_lineage(spark, lake):
    bronze = read_table(spark, lake.path("bronze", "orders"))
    assert bronze.count() == 6
    assert {"ingestion_ts", "ingest_date", "source_file", "sales_channel"} <= set(bronze.columns)
    audit = [(r.ingest_date, r.rows) for r in ingest_audit(bronze).collect()]
    assert audit == [(D1, 5), (dt.date(2025, 12, 2), 1)]
    assert bronze.filter("source_file NOT LIKE '%orders.csv'").count() == 0


def test_bronze_load_is_idempotent(spark, lake):
    before = read_table(spark, lake.path("bronze", "customers")).count()
    run_bronze(spark, lake.root.replace("/lake", "/landing"), lake, entities=["customers"])
    run_bronze(spark, lake.root.replace("/lake", "/landing"), lake, entities=["customers"], days=[DAY2])
    assert read_table(spark, lake.path("bronze", "customers")).count() == before == 6


def test_silver_customers(spark, lake):
    got = by_key(read_table(spark, lake.path("silver", "customers")), "customer_id")
    assert set(got) == {"C1", "C2", "C3", "C4"}
    assert (got["C1"]["state"], got["C1"]["city"]) == ("SP", "Sao Paulo")
    assert (got["C2"]["state"], got["C2"]["city"], got["C2"]["has_null_required_fields"]) == ("NA", "Unknown", True)
    assert got["C2"]["created_ts"] is None
    assert (got["C3"]["state"], got["C3"]["city"], got["C3"]["has_null_required_fields"]) == ("RJ", "Belem", False)
    assert (got["C4"]["city"], got["C4"]["created_ts"]) == ("Unknown", dt.datetime(2024, 2, 1, 8, 0))
    assert got["C1"]["ingest_date"] == dt.date(2025, 12, 2)


def test_silver_orders(spark, lake):
    got = by_key(read_table(spark, lake.path("silver", "orders")), "order_id")
    assert set(got) == {"O1", "O2", "O3", "O4"}
    o1, o2, o3, o4 = (got[k] for k in ("O1", "O2", "O3", "O4"))
    assert (o1["status"], o1["payment_method"], o1["total_amount"], o1["is_valid_record"]) == \
        ("shipped", "PIX", Decimal("199.90"), True)
    assert o2["order_ts"] == dt.datetime(2025, 12, 1)  # dd/MM text is not parsed by default -> load day
    assert (o2["status"], o2["payment_method"], o2["total_amount"]) == ("UNKNOWN", "UNKNOWN", None)
    assert (o2["is_total_amount_defaulted"], o2["has_foreign_currency"], o2["has_null_required_fields"],
            o2["has_invalid_values"], o2["is_valid_record"]) == (True, True, True, True, False)
    assert (o3["total_amount"], o3["has_foreign_currency"], o3["payment_method"]) == (Decimal("10.50"), True, "CREDIT_CARD")
    assert (o4["is_currency_defaulted"], o4["has_foreign_currency"], o4["has_invalid_values"]) == (True, None, True)
    assert o4["has_null_required_fields"] is False and o4["is_valid_record"] is False


def test_silver_order_items(spark, lake):
    rows = {(r.order_id, r.product_id): r for r in read_table(spark, lake.path("silver", "order_items")).collect()}
    assert set(rows) == {("O1", "P1"), ("O1", "P2"), ("O3", "P1"), ("O2", "P3"), ("O9", "P1")}
    a = rows[("O1", "P1")]
    assert (a.quantity, a.unit_price, a.discount_amount, a.is_valid_item) == (3, Decimal("100.00"), Decimal("5.00"), True)
    b = rows[("O1", "P2")]
    assert (b.quantity, b.discount_amount, b.has_invalid_quantity, b.is_valid_item) == (None, Decimal("0.00"), True, False)
    c = rows[("O3", "P1")]
    assert (c.quantity, c.unit_price, c.discount_amount) == (1, Decimal("99.90"), Decimal("0.00"))
    d = rows[("O2", "P3")]
    assert (d.quantity, d.unit_price, d.discount_amount) == (None, None, Decimal("0.00"))


def test_silver_shipments(spark, lake):
    got = by_key(read_table(spark, lake.path("silver", "shipments")), "order_id")
    assert set(got) == {"O1", "O3", "O4"}
    assert (got["O1"]["carrier"], got["O1"]["delivery_status"], got["O1"]["shipping_cost"]) == \
        ("Correios", "delivered", Decimal("0.00"))
    assert (got["O3"]["carrier"], got["O3"]["delivered_ts"], got["O3"]["has_invalid_values"],
            got["O3"]["is_valid_record"]) == ("Unknown", None, True, False)
    assert (got["O4"]["carrier"], got["O4"]["is_shipping_cost_defaulted"], got["O4"]["shipping_cost"],
            got["O4"]["shipped_ts"]) == ("", True, Decimal("0.00"), None)


def test_silver_products_and_dim(spark, lake):
    got = by_key(read_table(spark, lake.path("silver", "products")), "product_id")
    assert (got["P1"]["category"], got["P1"]["brand"]) == ("Eletronicos", "ACME")
    assert (got["P2"]["category"], got["P2"]["brand"], got["P2"]["has_null_required_fields"]) == \
        ("Unknown", "UNKNOWN", True)
    assert got["P2"]["created_ts"] is None
    # a defaulted category alone does not raise the flag unless strict
    assert got["P4"]["has_null_required_fields"] is False
    bronze = read_table(spark, lake.path("bronze", "products"))
    strict = by_key(silver.silver_products(bronze, strict=True), "product_id")
    assert strict["P4"]["has_null_required_fields"] is True
    dim = by_key(read_table(spark, lake.path("gold", "dim_products")), "product_id")
    assert (dim["P1"]["category"], dim["P1"]["brand"]) == ("ELETRONICOS", "Acme")
    assert (dim["P2"]["category"], dim["P2"]["brand"]) == ("UNKNOWN", "Unknown")
    assert all(v["created_ts"] is not None for v in dim.values())


def test_fact_order_items(spark, lake):
    rows = {(r.order_id, r.product_id): r for r in read_table(spark, lake.path("gold", "fact_order_items")).collect()}
    assert set(rows) == {("O1", "P1"), ("O3", "P1"), ("O9", "P1")}
    assert rows[("O1", "P1")].item_net_amount == Decimal("295.00")
    assert rows[("O3", "P1")].item_net_amount == Decimal("99.90")


def test_fact_orders(spark, lake):
    got = by_key(read_table(spark, lake.path("gold", "fact_orders")), "order_id")
    assert set(got) == {"O1", "O2", "O3", "O4"}  # one row per silver order; O9 has no order
    o1, o2, o3, o4 = (got[k] for k in ("O1", "O2", "O3", "O4"))
    assert (o1["gross_amount"], o1["discount_total"], o1["net_amount"]) == (Decimal("300.00"), Decimal("5.00"),
                                                                             Decimal("295.00"))
    assert (o1["status_final"], o1["delivery_time_hours"], o1["is_late"], o1["payment_method"]) == \
        ("DELIVERED", 97.0, True, "UNKNOWN")
    assert (o2["gross_amount"], o2["net_amount"], o2["status_final"], o2["carrier"], o2["is_late"]) == \
        (None, Decimal("0.00"), "CREATED", None, None)
    assert (o3["net_amount"], o3["status_final"], o3["delivery_time_hours"]) == (Decimal("94.90"), "SHIPPED", None)
    assert (o4["status_final"], o4["delivery_time_hours"], o4["net_amount"]) == ("DELIVERED", None, Decimal("0.00"))


def test_fact_orders_without_shipments_and_with_payments(spark, lake):
    orders = read_table(spark, lake.path("silver", "orders"))
    items = read_table(spark, lake.path("gold", "fact_order_items"))
    bare = gold.fact_orders(orders, items)
    assert dict(bare.dtypes)["shipped_ts"] == "timestamp" and dict(bare.dtypes)["carrier"] == "string"
    assert {r.status_final for r in bare.collect()} == {"CREATED"}
    payments = spark.createDataFrame([("O1", "PIX"), ("O3", "BOLETO")], "order_id string, payment_method string")
    paid = by_key(gold.fact_orders(orders, items, payments=payments), "order_id")
    assert (paid["O1"]["payment_method"], paid["O2"]["payment_method"]) == ("PIX", None)
    own = by_key(gold.fact_orders(orders, items, payment_source="orders"), "order_id")
    assert own["O3"]["payment_method"] == "CREDIT_CARD"


def test_audits(spark, lake):
    orders = read_table(spark, lake.path("silver", "orders"))
    items = read_table(spark, lake.path("silver", "order_items"))
    row = orphan_audit(orders, items).first()
    assert (row.orphan_rows, row.orphan_keys, row.parents_without_children) == (1, 1, 1)  # O9; O4
    summary = {(r.table_name, r.measure): r.value for r in quality_summary({"orders": orders}).collect()}
    assert summary[("orders", "rows")] == 4
    assert summary[("orders", "is_valid_record")] == 2
    assert summary[("orders", "has_foreign_currency")] == 2


def test_exports_are_read_from_written_tables(spark, lake, tmp_path):
    exported = spark.read.option("header", True).option("delimiter", ";").csv(
        lake.exports + "/gold/fact_orders")
    assert exported.count() == 4


def test_optional_table(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing_here")) is None


def test_schema_drift_in_the_middle_binds_by_header(spark, tmp_path):
    (tmp_path / f"ingest_date={DAY1}").mkdir()
    (tmp_path / f"ingest_date={DAY2}").mkdir()
    (tmp_path / f"ingest_date={DAY1}" / "customers.csv").write_text("customer_id,state,city\nC1,SP,Santos\n")
    (tmp_path / f"ingest_date={DAY2}" / "customers.csv").write_text("customer_id,phone,state,city\nC2,555,RJ,Niteroi\n")
    df = read_landing(spark, str(tmp_path), "customers", by_header=True)
    got = {r.customer_id: (r.state, r.city, r.phone) for r in df.collect()}
    assert got == {"C1": ("SP", "Santos", None), "C2": ("RJ", "Niteroi", "555")}


def test_rerun_of_silver_and_gold_is_stable(spark, lake):
    before = sorted(map(tuple, read_table(spark, lake.path("gold", "fact_orders")).collect()))
    run_silver(spark, Lake(lake.root))
    run_gold(spark, Lake(lake.root))
    after = sorted(map(tuple, read_table(spark, lake.path("gold", "fact_orders")).collect()))
    assert before == after


def test_single_file_exports(spark, tmp_path):
    import glob as _glob

    root = tmp_path / "single"
    write_landing(root / "landing")
    lake = run_pipeline(spark, str(root / "landing"), str(root / "lake"), exports=str(root / "exports"),
                        single_file_exports=True)
    for table in ("silver/orders", "gold/fact_orders", "gold/dim_products"):
        assert len(_glob.glob(f"{lake.exports}/{table}/**/part-*.csv", recursive=True)) == 1, table
