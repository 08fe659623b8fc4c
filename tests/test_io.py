"""Contracts, writers, readers, the incremental stream and plan shapes."""

import datetime as dt
import glob
import os
from decimal import Decimal

from pyspark.sql import functions as F

from strata.operators.inspect import preview
from strata.sinks.writers import export_csv, spread_days, write_days
from strata.sources.contracts import CONTRACTS, all_text, conform
from strata.sources.tables import read_if_exists, read_table
from strata.streaming.incremental import drain, start_incremental_ingest


def test_session_smoke(spark):
    assert [r.id for r in spark.range(1, 10).collect()] == list(range(1, 10))


def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("O1", "12.5", "2025-12-01 10:00:00", "x"), ("O2", "abc", "bad", "y")],
                               "order_id string, total_amount string, order_ts string, extra string")
    out = conform(df, CONTRACTS["orders"])
    assert out.columns == [f.name for f in CONTRACTS["orders"].fields]
    assert out.schema == CONTRACTS["orders"]
    rows = {r.order_id: r for r in out.collect()}
    assert rows["O1"].total_amount == Decimal("12.50")
    assert rows["O1"].order_ts == dt.datetime(2025, 12, 1, 10, 0)
    assert rows["O2"].total_amount is None and rows["O2"].order_ts is None
    assert rows["O1"].currency is None


def test_single_file_export_keeps_upstream_parallel(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=4).select(F.col("id"), (F.col("id") * 2).alias("twice"))
    path = str(tmp_path / "extract")
    export_csv(df, path, single_file=True)
    parts = glob.glob(os.path.join(path, "part-*.csv"))
    assert len(parts) == 1
    back = spark.read.option("header", True).option("delimiter", ";").schema(all_text(df.columns)).csv(path)
    assert back.count() == 1000
    assert back.filter("CAST(twice AS INT) <> 2 * CAST(id AS INT)").count() == 0
    plan = df.repartition(1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" in plan or "Exchange RoundRobinPartitioning(1)" in plan


def test_export_trims_edges_by_default(spark, tmp_path):
    df = spark.createDataFrame([("CORREIOS ", " x")], "a string, b string")
    export_csv(df, str(tmp_path / "trim"))
    export_csv(df, str(tmp_path / "keep"), trim_edges=False)
    read = lambda p: spark.read.option("header", True).option("delimiter", ";").csv(p).first()
    assert tuple(read(str(tmp_path / "trim"))) == ("CORREIOS", "x")
    assert tuple(read(str(tmp_path / "keep"))) == ("CORREIOS ", " x")


def test_write_days_replaces_only_the_days_written(spark, tmp_path):
    path = str(tmp_path / "bronze")
    day1, day2 = dt.date(2025, 12, 1), dt.date(2025, 12, 2)
    first = spark.createDataFrame([(1, day1), (2, day1), (3, day2)], "v int, ingest_date date")
    write_days(first, path)
    write_days(spark.createDataFrame([(9, day2)], "v int, ingest_date date"), path)
    got = sorted((r.v, r.ingest_date) for r in read_table(spark, path).collect())
    assert got == [(1, day1), (2, day1), (9, day2)]


def test_read_if_exists(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert read_if_exists(spark, str(tmp_path / "t")).count() == 3


def test_preview_is_a_top_n_not_a_sort(spark):
    df = spark.range(0, 10000, numPartitions=4).select((F.col("id") * 7 % 10000).alias("k"))
    out = preview(df, ["k"], 5)
    assert [r.k for r in out.collect()] == [0, 1, 2, 3, 4]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_incremental_ingest_loads_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing" / "customers"
    for day, rows in (("2025-12-01", "C1,SP\nC2,RJ\n"), ("2025-12-02", "C3,MG\n")):
        (landing / f"ingest_date={day}").mkdir(parents=True)
        (landing / f"ingest_date={day}" / "customers.csv").write_text("customer_id,state\n" + rows)
    bronze, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    for _ in range(2):
        drain(start_incremental_ingest(spark, str(landing), bronze, ckpt, ["customer_id", "state"]), 120)
    df = read_table(spark, bronze)
    assert df.count() == 3
    # a new day arrives: only it is loaded
    (landing / "ingest_date=2025-12-03").mkdir()
    (landing / "ingest_date=2025-12-03" / "customers.csv").write_text("customer_id,state\nC4,BA\n")
    drain(start_incremental_ingest(spark, str(landing), bronze, ckpt, ["customer_id", "state"]), 120)
    df = read_table(spark, bronze)
    assert sorted(r.customer_id for r in df.collect()) == ["C1", "C2", "C3", "C4"]
    assert {"ingestion_ts", "source_file", "ingest_date"} <= set(df.columns)


def test_clustered_day_write_splits_a_hot_day(spark, tmp_path):
    # one day holds a third of all rows; the rest spread over 20 days
    df = spark.range(0, 60000, numPartitions=8).select(
        F.col("id"), F.repeat(F.lit("x"), 40).alias("pad"),
        F.when(F.col("id") % 3 == 0, F.lit("2025-12-01")).otherwise(
            F.date_format(F.date_add(F.lit("2025-11-01").cast("date"), (F.col("id") % 20).cast("int")), "yyyy-MM-dd"))
        .cast("date").alias("ingest_date"))
    path = str(tmp_path / "days")
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_days(df, path, cluster=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = glob.glob(os.path.join(path, "ingest_date=2025-12-01", "part-*"))
    cold = glob.glob(os.path.join(path, "ingest_date=2025-11-02", "part-*"))
    assert len(hot) > 1          # the hot day was split over several tasks
    assert len(cold) <= 2        # a small day is not scattered over every task
    assert read_table(spark, path).count() == 60000


def test_header_names():
    from strata.sources.landing import header_names

    assert header_names("customer_id,state, city\n") == ("customer_id", "state", "city")
    assert header_names('﻿"customer_id";"state"', ";") == ("customer_id", "state")


def test_day_limited_load_lists_only_those_days(spark, tmp_path):
    from strata.sources.landing import ingest_entity, read_landing

    landing = tmp_path / "landing"
    for day in ("2025-12-01", "2025-12-02", "2025-12-03"):
        (landing / f"ingest_date={day}").mkdir(parents=True)
        (landing / f"ingest_date={day}" / "orders.csv").write_text(f"order_id,total_amount\nO-{day},1.00\n")
    df = read_landing(spark, str(landing), "orders", ["order_id", "total_amount"], days=["2025-12-02"])
    assert [r.order_id for r in df.collect()] == ["O-2025-12-02"]
    assert df.inputFiles() == [f for f in df.inputFiles() if "2025-12-02" in f]
    bronze = str(tmp_path / "bronze")
    ingest_entity(spark, str(landing), bronze, "orders", by_header=True)
    ingest_entity(spark, str(landing), bronze, "orders", by_header=True, days=["2025-12-01", "2025-12-03"])
    assert sorted(r.order_id for r in read_table(spark, bronze).collect()) == \
        ["O-2025-12-01", "O-2025-12-02", "O-2025-12-03"]


def test_small_days_are_dealt_over_tasks_and_a_large_day_is_split(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id", "CAST(date_add(DATE '2025-01-01', CAST(IF(id % 3 = 0, 0, id % 50) AS INT)) AS DATE) AS ingest_date")
    sizes = {str(r["ingest_date"]): r["n"] * 10 for r in rows.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    out = spread_days(rows, sizes, tasks=6)
    parts = out.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ingest_date").alias("days")).collect()
    assert len(parts) == 6 and max(r["n"] for r in parts) < 1100 and min(r["days"] for r in parts) > 1
    write_days(rows, str(tmp_path / "b"), cluster=True, sizes=sizes)
    assert sorted(map(tuple, read_table(spark, str(tmp_path / "b")).select("id", "ingest_date").collect())) == sorted(map(tuple, rows.collect()))


def test_whole_day_files_load_without_an_exchange(spark, tmp_path, monkeypatch):
    from strata.sources import landing

    seen = []
    write = landing.write_days
    monkeypatch.setattr(landing, "write_days", lambda df, path, cluster=False, **kw: (seen.append(cluster), write(df, path, cluster=cluster, **kw)))
    for n, name in ((1, "whole"), (9, "scattered")):
        for day in ("2025-12-01", "2025-12-02"):
            folder = tmp_path / name / f"ingest_date={day}" / "orders.csv"
            folder.mkdir(parents=True)
            for i in range(n):
                (folder / f"part-{i}.csv").write_text(f"order_id,status\nO{day}-{i},new\n")
        table = landing.ingest_entity(spark, str(tmp_path / name), str(tmp_path / f"bronze-{name}"), "orders", pattern="ingest_date=*/{entity}.csv/part-*", cluster=True)
        assert table.count() == 2 * n
    assert seen == [False, True]
    assert landing.gathered({"a": 5 * landing.FILE_BYTES}, 7) and not landing.gathered({"a": 5 * landing.FILE_BYTES}, 8) and not landing.gathered({}, 0)


def test_a_large_backfill_is_dealt_over_more_tasks_than_slots(spark):
    from strata.sinks.writers import TASK_BYTES

    rows = spark.range(10).selectExpr("id", "DATE '2025-01-01' AS ingest_date")
    slots = spark.sparkContext.defaultParallelism
    assert spread_days(rows, {"2025-01-01": 10 * slots * TASK_BYTES}).rdd.getNumPartitions() == 10 * slots
    assert spread_days(rows, {"2025-01-01": 100}).rdd.getNumPartitions() == 1


def test_landing_rows_are_dealt_before_their_texts_are_made(spark, tmp_path):
    from strata.plans.feeds import feed
    from strata.plans.queries import land_drops

    (spark.range(300).selectExpr("id AS l_orderkey", "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "CAST(id % 4 AS INT) AS l_linenumber", "CAST(id AS DOUBLE) AS l_quantity", "id / 4 AS l_extendedprice",
                                 "0.05D AS l_discount", "0.01D AS l_tax", "IF(id % 50 = 0, NULL, timestamp_ntz '1995-01-01' + make_dt_interval(CAST(id % 9 AS INT))) AS l_shipdate")
     .write.parquet(str(tmp_path / "lineitem.parquet")))
    dealt = feed(spark, str(tmp_path), "shipments", dealt=5)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(dealt) == rows(feed(spark, str(tmp_path), "shipments"))
    exchange = [line for line in dealt._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]
    assert exchange and all("l_shipdate" in line for line in exchange)
    land_drops(spark, str(tmp_path), str(tmp_path / "in"), "shipments")
    files = glob.glob(str(tmp_path / "in" / "shipments" / "ingest_date=1995*" / "part-*"))
    assert len(files) == 9 and all(f.endswith(".csv.gz") for f in files)
