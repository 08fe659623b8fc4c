"""Merges of a load, bucketed tables, the error channel, header drift, and counts from writes and footers."""

import pytest
from landing_fixture import write_text
from pyspark.sql import functions as F

from strata.operators import audit, gold
from strata.operators.dedup import latest_by, latest_with_count, recency
from strata.plans import incremental
from strata.plans.pipeline import ENTITIES, GOLD_TABLES, Lake, run_bronze, run_pipeline, run_silver_observed
from strata.sinks.writers import replace_bucketed, replace_table, write_bucketed, write_days
from strata.sources.contracts import CONTRACTS, conform, parse_errors, write_conformed
from strata.sources.landing import header_drift
from strata.sources.tables import footer_counts, read_bucketed, read_table

ORDERS = "order_id,customer_id,order_ts,status,payment_method,total_amount,currency\n"
ITEMS = "order_id,product_id,quantity,unit_price,discount_amount\n"
SHIPMENTS = "order_id,carrier,shipping_cost,shipped_ts,delivered_ts,delivery_status\n"


def drop(root, day, entity, text):
    write_text(root / f"ingest_date={day}" / f"{entity}.csv", text)


def land(root, day, orders=(), items=(), shipments=(), customers=(), products=()):
    drop(root, day, "orders", ORDERS + "".join(f"{o},C1,{day} 10:00:00,{s},pix,{a},BRL\n" for o, s, a in orders))
    drop(root, day, "order_items", ITEMS + "".join(f"{o},{p},{q},{x},0\n" for o, p, q, x in items))
    drop(root, day, "shipments", SHIPMENTS + "".join(f"{o},Loggi,{c},{day} 11:00:00,,sent\n" for o, c in shipments))
    drop(root, day, "customers", "customer_id,state,city,created_ts\n" + "".join(f"{c},{s},Rio,2024-01-01 00:00:00\n" for c, s in customers))
    drop(root, day, "products", "product_id,category,brand,created_ts\n" + "".join(f"{p},{c},Acme,2024-01-01 00:00:00\n" for p, c in products))


def rows_of(df, without=()):
    cols = sorted(c for c in df.columns if c not in without)
    return sorted(map(str, (tuple(r[c] for c in cols) for r in df.collect())))


def same_as_full_run(spark, lake, landing, tmp_path, name):
    full = run_pipeline(spark, str(landing), str(tmp_path / name))
    for layer, tables in (("silver", ENTITIES), ("gold", GOLD_TABLES)):
        for t in tables:
            got, want = (rows_of(read_table(spark, x.path(layer, t)), ["ingestion_ts"]) for x in (lake, full))
            assert got == want, (layer, t)


def test_days_one_by_one_equal_a_full_run(spark, tmp_path):
    landing, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    days = ["2025-12-01", "2025-12-02", "2025-12-03"]
    land(landing, days[0], [("O1", "new", "10.00"), ("O2", "new", "5,50")], [("O1", "P1", 2, "5.00"), ("O2", "P1", 1, "5.50")], [("O2", "1.00")], [("C1", "sp"), ("C2", "rj")], [("P1", "casa")])
    incremental.run_days(spark, str(landing), lake, [days[0]])
    same_as_full_run(spark, lake, landing, tmp_path, "full1")
    # a late line and a late shipment of an old order, a newer version of another, and new keys
    land(landing, days[1], [("O2", "paid", "6.00"), ("O3", "new", "1.00")], [("O1", "P2", 1, "3.00"), ("O9", "P2", 1, "1.00")], [("O1", "2.50")], [("C2", "mg"), ("C3", "ba")], [("P1", "moda"), ("P2", "casa")])
    incremental.run_days(spark, str(landing), lake, [days[1]])
    same_as_full_run(spark, lake, landing, tmp_path, "full2")
    # the second day again, without most of its rows: the first day's versions win again
    land(landing, days[1], [("O3", "new", "2.00")], [], [], [("C3", "ba")], [("P2", "livros")])
    land(landing, days[2], [("O4", "new", "9.00")], [("O4", "P1", 1, "9.00"), ("O3", "P1", 2, "1.00")], [("O3", "0.10")], [], [])
    incremental.run_days(spark, str(landing), lake, days[1:])
    same_as_full_run(spark, lake, landing, tmp_path, "full3")
    facts = {r["order_id"]: r["net_amount"] for r in read_table(spark, lake.path("gold", "fact_orders")).collect()}
    assert {k: float(v) for k, v in facts.items()} == {"O1": 10.0, "O2": 6.5, "O3": 2.1, "O4": 9.0}


def test_only_changed_keys_are_worked_out_again(spark):
    old = spark.createDataFrame([("O1", "kept as it is"), ("O2", "old")], "order_id string, note string")
    again = spark.createDataFrame([("O2", "new")], "order_id string, note string")
    changed = spark.createDataFrame([("O2",), ("O5",)], "order_id string")
    assert rows_of(incremental.put_in(old, changed, again, ["order_id"])) == ["('kept as it is', 'O1')", "('new', 'O2')"]
    assert incremental.put_in(None, changed, again, ["order_id"]) is again
    with pytest.raises(ValueError):
        incremental.of_days(old.withColumn("ingest_date", F.lit("x")), ["2025-12-01' OR '1'='1"])


def test_replace_table_may_read_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    replace_table(read_table(spark, path).filter("id > 0"), path)
    assert sorted(r["id"] for r in read_table(spark, path).collect()) == [1, 2]


def test_bucketed_tables_join_without_an_exchange(spark, tmp_path):
    orders = spark.range(500).selectExpr("concat('O', id) AS order_id", "'C' AS customer_id", "timestamp '2025-01-01' AS order_ts", "'x' AS payment_method", "true AS is_valid_record")
    items = spark.range(2000).selectExpr("concat('O', id % 600) AS order_id", "concat('P', id) AS product_id", "1 AS quantity", "CAST(2 AS DECIMAL(10, 2)) AS unit_price", "CAST(0 AS DECIMAL(10, 2)) AS discount_amount")
    ships = spark.range(300).selectExpr("concat('O', id) AS order_id", "'c' AS carrier", "CAST(1 AS DECIMAL(10, 2)) AS shipping_cost", "timestamp '2025-01-01' AS shipped_ts", "timestamp '2025-01-05' AS delivered_ts")
    t = [write_bucketed(df, f"test_bucketed_{n}", str(tmp_path / n), ["order_id"], 4) for n, df in (("orders", orders), ("items", items), ("ships", ships))]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.fact_orders(*t)
        rows, plan = rows_of(fact), fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows == rows_of(gold.fact_orders(orders, items, ships))
    for n in ("orders", "items", "ships"):
        spark.sql(f"DROP TABLE test_bucketed_{n}")


def test_every_row_is_accepted_or_rejected(spark, tmp_path):
    cols = [f.name for f in CONTRACTS["orders"].fields]
    raw = [("O1", "2025-12-01 10:00:00", "5.00"), ("O2", "nope", "5.00"), ("O3", "nope", "abc"), ("O4", None, " "), ("O5", "2025-12-01", "99999999999"), (None, "", None)]
    df = spark.createDataFrame(raw, "order_id string, order_ts string, total_amount string").withColumns({c: F.lit(None).cast("string") for c in cols if c not in ("order_id", "order_ts", "total_amount")})
    accepted, rejected = write_conformed(df, CONTRACTS["orders"], str(tmp_path / "c"))
    assert accepted.columns == cols and sorted(str(r["order_id"]) for r in accepted.collect()) == ["None", "O1", "O4"]
    assert {r["order_id"]: r["errors"] for r in rejected.collect()} == {"O2": {"order_ts": "nope"}, "O3": {"order_ts": "nope", "total_amount": "abc"}, "O5": {"total_amount": "99999999999"}}
    assert rows_of(accepted.unionByName(rejected.drop("errors"))) == rows_of(conform(df, CONTRACTS["orders"]))
    typed = conform(df, CONTRACTS["orders"])
    assert {len(r["e"]) for r in typed.select(parse_errors(typed, CONTRACTS["orders"]).alias("e")).collect()} == {0}
    none, bad = write_conformed(df.limit(0), CONTRACTS["orders"], str(tmp_path / "e"))
    assert none.count() == 0 and bad.count() == 0


def test_header_drift_by_day(spark, tmp_path):
    for day, header in (("2025-12-01", "a,b,c"), ("2025-12-02", "a,x,b,c"), ("2025-12-03", "c,a,b"), ("2025-12-04", '"A", b'), ("2025-12-05", "﻿a,b,c")):
        drop(tmp_path, day, "t", header + "\n1,2,3\n")
    got = sorted((str(r["ingest_date"])[-2:], r["change"], r["column"]) for r in header_drift(spark, str(tmp_path), "t", ["a", "b", "c"]).collect())
    assert got == [("02", "added", "x"), ("03", "moved", "a"), ("03", "moved", "b"), ("03", "moved", "c"), ("04", "missing", "c"), ("04", "renamed", "A")]


def test_counts_of_the_write_are_those_of_a_scan(spark, tmp_path):
    landing, lake = tmp_path / "in", Lake(str(tmp_path / "lake"))
    land(landing, "2025-12-01", [("O1", "new", "10.00"), ("O2", "new", "abc"), ("O2", "x", "-1")], [("O1", "P1", 2, "5.00"), ("O2", "P1", "two", "5.50")], [("O2", "free")], [("C1", "sp"), (" ", "")], [("P1", "")])
    run_bronze(spark, str(landing), lake)
    counts = run_silver_observed(spark, lake, {e: read_table(spark, lake.path("bronze", e)) for e in ENTITIES})
    written = {e: read_table(spark, lake.path("silver", e)) for e in ENTITIES}
    assert rows_of(audit.written_summary(spark, counts)) == rows_of(audit.quality_summary(written))


def test_rows_per_day_come_from_footers(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "CAST(date_add(DATE '2025-01-01', CAST(id % 7 AS INT)) AS DATE) AS ingest_date")
    write_days(rows, str(tmp_path / "b"))
    counts = footer_counts(spark, str(tmp_path / "b"), "ingest_date")
    assert rows_of(counts) == rows_of(rows.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("rows")))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "ReadSchema: struct<ingest_date:date,count(*):bigint>" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_superseded_rows_are_counted_in_the_same_exchange(spark):
    rows = spark.range(3000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 40)) AS k", "CAST(date_add(DATE '2025-01-01', CAST(id % 11 AS INT)) AS DATE) AS day",
                                        "IF(id % 5 = 0, NULL, timestamp_seconds(id % 17)) AS ts", "concat('v', id % 13) AS v", "concat('f', id) AS file")
    got = latest_with_count(rows, ["k"], ["day", "ts"], ["v"], "n")
    best = latest_by(rows, ["k"], recency("day", "ts"), ["v", "file"])
    pick = ("k", "day", "ts", "v")
    assert rows_of(got.select(*pick)) == rows_of(best.select(*pick))
    assert rows_of(got.select("k", "n")) == rows_of(rows.groupBy("k").agg((F.count(F.lit(1)) - 1).alias("n")))
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_loads_in_any_order_equal_a_full_run(spark, tmp_path):
    from strata.operators import silver
    from strata.sinks.writers import write_table

    lake = Lake(str(tmp_path / "lake"))
    schema = "order_id string, customer_id string, order_ts string, status string, payment_method string, total_amount string, currency string, ingestion_ts timestamp, ingest_date date, source_file string"
    row = lambda o, s, day: (o, "C", None, s, None, "1", "BRL", None, None if day is None else F"2025-12-{day:02}", "f")
    loads = [({3: [("A", "a3"), ("B", "b3")], 1: [("A", "a1"), ("Z", "z1")]}, [3, 1]), ({2: [("A", "a2"), ("C", "c2"), ("Z", "z2"), (None, "x")]}, [2]),
             ({3: [("B", "b3 again"), ("D", "d3")]}, [3]), ({2: []}, [2]), ({1: [("C", "c1")], 4: [("Z", "z4"), ("Z", "a tie")]}, [1, 4])]
    held = {None: [("A", "of no day"), ("E", "of no day")]}
    text = schema.replace("ingest_date date", "ingest_date string")
    for parts, days in loads:
        held |= parts
        rows = spark.createDataFrame([row(o, s, d) for d, some in held.items() for o, s in some], text).withColumn("ingest_date", F.col("ingest_date").cast("date"))
        write_table(rows, lake.path("bronze", "orders"))
        incremental.refresh(spark, lake, [f"2025-12-{d:02}" for d in days], ["orders"])
        got = {r["order_id"]: r["status"] for r in read_table(spark, lake.path("silver", "orders")).collect()}
        want = {r["order_id"]: r["status"] for r in silver.silver_orders(rows).collect()}
        if got.keys() != want.keys():  # a key that no load has named yet is not worked out
            want = {k: v for k, v in want.items() if k != "E"}
        assert got == want, days


def test_a_load_of_new_days_leaves_other_days_rows_alone(spark):
    cols = "order_id string, product_id string, quantity string, unit_price string, discount_amount string, ingestion_ts timestamp, ingest_date date"
    bronze = spark.createDataFrame([], cols)
    plan = incremental.silver_again("order_items", bronze, ["2025-12-02"], None)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") <= 1
    items = incremental.merge_gold_items(spark.createDataFrame([], cols.replace("quantity string", "quantity int").replace("price string", "price decimal(10,2)").replace("amount string", "amount decimal(10,2)")))
    assert "Exchange" not in items._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_a_load_sends_none_of_the_stored_rows(spark, tmp_path):
    landing, lake, days = tmp_path / "in", Lake(str(tmp_path / "lake")), ["2025-12-01", "2025-12-02"]
    for n, day in enumerate(days):
        land(landing, day, [(f"O{i}", "new", "1.00") for i in range(n, 40)], [(f"O{i}", f"P{i % 7}", 1 + n, "2.00") for i in range(n, 60)], [(f"O{i}", "1.00") for i in range(n, 30)])
        incremental.run_days(spark, str(landing), lake, [day], ["orders", "order_items", "shipments"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = {e: read_bucketed(spark, lake.path("silver", e), incremental.KEYS[e]) for e in ("orders", "order_items", "shipments")}
        for entity, silver in stored.items():  # one exchange: the load's rows, for their newest
            again = incremental.silver_again(entity, read_table(spark, lake.path("bronze", entity)), days[1:], None)
            assert exchanges(incremental.settle(incremental.other_days(silver, days[1:]), again, incremental.KEYS[entity])) == 1
        fact, reached = read_bucketed(spark, lake.path("gold", "fact_orders"), ["order_id"]), stored["shipments"].select("order_id")
        items = read_table(spark, lake.path("gold", "fact_order_items"))
        assert exchanges(incremental.merge_fact_orders(stored["orders"], items, stored["shipments"], fact, reached)) == 1  # the lines
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    run_pipeline(spark, str(landing), str(tmp_path / "full"), entities=["orders", "order_items", "shipments"], gold_tables=["fact_order_items", "fact_orders"])
    for layer, name in (*(("silver", e) for e in stored), ("gold", "fact_order_items"), ("gold", "fact_orders")):
        got, want = (rows_of(read_table(spark, f"{root}/{layer}/{name}"), ["ingestion_ts"]) for root in (lake.root, str(tmp_path / "full")))
        assert got == want and got, (layer, name)


def test_settling_side_by_side_is_by_load_day(spark):
    frame = lambda *rows: spark.createDataFrame(rows, "k string, v string, d string").selectExpr("k", "v", "CAST(d AS date) AS ingest_date")
    settled = frame(("A", "old", "2025-12-01"), ("B", "old", "2025-12-03"), ("C", "old", None), ("D", "old", "2025-12-01"), ("E", None, "2025-12-03"))
    again = frame(("A", "new", "2025-12-02"), ("B", "new", "2025-12-02"), ("C", None, "2025-12-02"), ("E", "new", "2025-12-02"), ("F", "new", "2025-12-02"))
    for a, b in ((settled, again), (settled, again.limit(0)), (settled.limit(0), again)):
        got = incremental.settle(a, b, ["k"])
        assert got.columns == again.columns
        if a is settled and b is again:
            assert {r["k"]: r["v"] for r in got.collect()} == {"A": "new", "B": "old", "C": None, "D": "old", "E": None, "F": "new"}
            assert rows_of(got) == rows_of(incremental.put_newer(settled, again, ["k"], ["2025-12-02"]))
        else:
            assert rows_of(got) == rows_of(a.unionByName(b))


def test_buckets_are_known_by_the_folder_alone(spark, tmp_path):
    path = str(tmp_path / "it's here" / "t")
    rows = spark.range(100).selectExpr("concat('k', id) AS k", "id % 5 AS v")
    tables = len(spark.catalog.listTables())
    (tmp_path / "it's here" / "t__next").mkdir(parents=True)
    (tmp_path / "it's here" / "t__next" / "part-of-a-broken-run").write_text("x")
    replace_bucketed(rows, path, ["k"], 3)
    got = read_bucketed(spark, path, ["k"])
    assert "Exchange" not in got.groupBy("k").agg(F.sum("v"))._jdf.queryExecution().executedPlan().toString()
    assert rows_of(got) == rows_of(rows) == rows_of(read_table(spark, path))
    replace_bucketed(got.filter("v = 1"), path, ["k"], 3)  # may read what it replaces
    assert rows_of(read_bucketed(spark, path, ["k"])) == rows_of(rows.filter("v = 1"))
    assert rows_of(read_bucketed(spark, path, ["v"])) == rows_of(rows.filter("v = 1"))  # by other columns: a plain table
    replace_bucketed(rows.limit(0), path, ["k"], 3)
    assert read_bucketed(spark, path, ["k"]).schema == read_table(spark, path).schema and read_table(spark, path).count() == 0
    replace_table(rows, path)  # written plainly over it
    assert "Exchange" in read_bucketed(spark, path, ["k"]).groupBy("k").agg(F.sum("v"))._jdf.queryExecution().executedPlan().toString()
    assert read_bucketed(spark, str(tmp_path / "none"), ["k"]) is None
    assert len(spark.catalog.listTables()) == tables
