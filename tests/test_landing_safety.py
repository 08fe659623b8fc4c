"""Loads must never shift, lose or keep rows silently."""

import glob
import gzip
import time

import pytest
from landing_fixture import write_text
from pyspark.sql import functions as F

from strata.operators import gold
from strata.plans.pipeline import Lake, run_bronze, run_pipeline
from strata.sinks.writers import write_days, write_table
from strata.sources.landing import CORRUPT, header_names, ingest_audit, ingest_entity, lineage_audit, read_landing
from strata.sources.tables import read_table
from strata.streaming.incremental import drain, start_incremental_ingest


def drop(root, day, text, entity="orders", name=None):
    write_text(root / f"ingest_date={day}" / (name or f"{entity}.csv"), text)


def test_columns_bind_by_name_by_default(spark, tmp_path):
    drop(tmp_path, "2025-12-01", "order_id,status\nO1,paid\n")
    drop(tmp_path, "2025-12-02", "order_id,channel,status\nO2,app,sent\n")
    drop(tmp_path, "2025-12-03", "status,order_id\nnew,O3\n")
    rows = {r["order_id"]: (r["status"], r["channel"]) for r in read_landing(spark, str(tmp_path), "orders").collect()}
    assert rows == {"O1": ("paid", None), "O2": ("sent", "app"), "O3": ("new", None)}


def test_positional_read_fails_on_another_header(spark, tmp_path):
    drop(tmp_path, "2025-12-01", "order_id,status\nO1,paid\n")
    drop(tmp_path, "2025-12-02", "order_id,channel\nO2,app\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_landing(spark, str(tmp_path), "orders", ["order_id", "status"], by_header=False).collect()


def test_compressed_nested_and_odd_headers(spark, tmp_path):
    day = tmp_path / "ingest_date=2025-12-01"
    day.mkdir()
    with gzip.open(day / "orders.csv.gz", "wt") as f:
        f.write("order_id,status\nO1,paid\n")
    pattern = "ingest_date=*/{entity}.csv*"
    assert [r["status"] for r in read_landing(spark, str(tmp_path), "orders", pattern=pattern).collect()] == ["paid"]
    write_text(day / "orders.csv" / "part-0.csv", "status,order_id\nsent,O2\n")
    write_text(day / "orders.csv" / "part-1.csv", "order_id,status\nO3,new\n")
    got = {r["order_id"]: r["status"] for r in read_landing(spark, str(tmp_path), "orders", pattern=pattern).collect()}
    assert got == {"O1": "paid", "O2": "sent", "O3": "new"}
    for k, text in enumerate(("\norder_id\nO1\n", "order_id,ingest_date\nO1,x\n", "order_id,order_id\nO1,O2\n", "order_id,,status\nO1,a,b\n")):
        root = tmp_path / f"bad{k}"
        drop(root, "2025-12-01", text)
        with pytest.raises(ValueError):
            read_landing(spark, str(root), "orders")
    with pytest.raises(ValueError):
        header_names("")


def test_load_returns_the_written_rows_and_replaces_emptied_days(spark, tmp_path):
    drop(tmp_path / "in", "2025-12-01", "order_id,status\nO1,a\nO2,b\n")
    drop(tmp_path / "in", "2025-12-02", "order_id,status\nO3,c\n")
    bronze = str(tmp_path / "bronze")
    table = ingest_entity(spark, str(tmp_path / "in"), bronze, "orders")
    first = {r["ingestion_ts"] for r in table.collect()}
    time.sleep(0.05)
    assert {r["ingestion_ts"] for r in table.collect()} == first and len(first) == 1
    audit = {str(r["ingest_date"]): (r["rows"], r["stamps"], r["unstamped"], r["misplaced"]) for r in lineage_audit(table).collect()}
    assert audit == {"2025-12-01": (2, 1, 0, 0), "2025-12-02": (1, 1, 0, 0)}
    drop(tmp_path / "in", "2025-12-01", "order_id,status\n")
    again = ingest_entity(spark, str(tmp_path / "in"), bronze, "orders", days=["2025-12-01"])
    assert [r["order_id"] for r in again.collect()] == ["O3"]


def test_rows_that_do_not_fit_are_counted(spark, tmp_path):
    drop(tmp_path / "in", "2025-12-01", "order_id,status\nO1,a\nO2,b,extra\n")
    table = ingest_entity(spark, str(tmp_path / "in"), str(tmp_path / "bronze"), "orders", keep_corrupt=True)
    assert CORRUPT in table.columns
    assert [(r["rows"], r["corrupt_rows"]) for r in ingest_audit(table).collect()] == [(2, 1)]


def test_stream_managed_paths_and_unfinished_runs(spark, tmp_path):
    drop(tmp_path / "in", "2025-12-01", "order_id,status\nO1,a\n")
    bronze = str(tmp_path / "bronze")
    drain(start_incremental_ingest(spark, str(tmp_path / "in"), bronze, str(tmp_path / "ckpt"), ["order_id", "status"]), 120)
    with pytest.raises(ValueError, match="streaming"):
        ingest_entity(spark, str(tmp_path / "in"), bronze, "orders")

    class Slow:
        def awaitTermination(self, timeout):  # noqa: N802 - Spark's name
            return False

    with pytest.raises(TimeoutError):
        drain(Slow(), 1)


def test_full_overwrite_leaves_no_old_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "2025-12-01"), (2, "2025-12-02")], "v int, ingest_date string")
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        write_table(rows, path, ["ingest_date"])
        write_table(rows.filter("v = 2"), path, ["ingest_date"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert [r["v"] for r in read_table(spark, path).collect()] == [2]
    write_days(rows.filter("v = 1"), path)
    assert sorted(r["v"] for r in read_table(spark, path).collect()) == [1, 2]


def test_one_payment_per_order(spark):
    orders = spark.createDataFrame([("O1", "c", None, None, True), ("O2", "c", None, None, False)],
                                   "order_id string, customer_id string, order_ts timestamp, payment_method string, is_valid_record boolean")
    items = spark.createDataFrame([("O1", "P", 1, 10.0, 0.0, 10.0)], "order_id string, product_id string, quantity int, unit_price double, discount_amount double, item_net_amount double")
    pays = spark.createDataFrame([("O1", "PIX", "2025-12-01"), ("O1", "BOLETO", "2025-12-02"), ("O1", None, "2025-12-02"), ("O2", "B", None), ("O2", "A", None), (None, "X", None)],
                                 "order_id string, payment_method string, ingest_date string")
    got = {r["order_id"]: (r["payment_method"], r["net_amount"]) for r in gold.fact_orders(orders, items, payments=pays).collect()}
    assert got == {"O1": ("BOLETO", 10.0), "O2": ("A", 0.0)}
    assert [r["order_id"] for r in gold.fact_orders(orders, items, valid_only=True).collect()] == ["O1"]
    with pytest.raises(ValueError, match="payment_source"):
        gold.fact_orders(orders, items, payment_source="order")


def test_bronze_extracts_and_options_through_the_pipeline(spark, tmp_path):
    land = tmp_path / "in"
    for day, status in (("2025-12-01", "new"), ("2025-12-02", " Paid ")):
        drop(land, day, f"order_id,customer_id,order_ts,status,payment_method,total_amount,currency\nO-{day},C1,{day} 10:00:00,{status},pix,10.00,brl\n")
        drop(land, day, f"order_id,product_id,quantity,unit_price,discount_amount\nO-{day},P1,2,5.00,0\n", "order_items")
    lake = run_pipeline(spark, str(land), str(tmp_path / "lake"), exports=str(tmp_path / "out"), entities=("orders", "order_items"), gold_tables=("fact_orders",),
                        silver_options={"orders": {"strict": True}}, fact_options={"payment_source": "orders"})
    files = sorted(glob.glob(f"{tmp_path}/out/bronze/orders/ingest_date=*/*.csv"))
    assert len(files) == 2
    with open(files[0], encoding="utf-8") as f:
        assert f.readline().strip() == "order_id;customer_id;order_ts;status;payment_method;total_amount;currency;ingestion_ts;ingest_date;source_file"
        assert ";2025-12-01;" in f.readline()
    fact = spark.read.parquet(lake.path("gold", "fact_orders"))
    assert {r["payment_method"] for r in fact.collect()} == {"PIX"}
    silver = spark.read.parquet(lake.path("silver", "orders"))
    assert {r["status"] for r in silver.collect()} == {"new", "paid"} and not silver.filter("has_foreign_currency").count()
    # a day loaded again replaces its own extract only
    drop(land, "2025-12-02", "order_id,status\nO9,x\n")
    run_bronze(spark, str(land), Lake(str(tmp_path / "lake"), str(tmp_path / "out")), ["orders"], days=["2025-12-02"])
    back = spark.read.option("header", True).option("delimiter", ";").csv(f"{tmp_path}/out/bronze/orders")
    assert {(r["order_id"], str(r["ingest_date"])) for r in back.collect()} == {("O-2025-12-01", "2025-12-01"), ("O9", "2025-12-02")}


def test_text_dates_that_are_no_dates(spark):
    from strata.functions import clean as C

    df = spark.createDataFrame([(None, "nope"), (None, "2025-12-01")], "ts timestamp, d string")
    assert [str(r[0]) for r in df.select(C.ts_or_date("ts", "d").cast("string")).collect()] == ["None", "2025-12-01 00:00:00"]
    assert df.select(F.col("d").try_cast("date")).collect()[0][0] is None
