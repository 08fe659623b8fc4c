"""Column builders on hand-made dirty values."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from strata.functions import clean as C


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


def test_parse_decimal(spark):
    cases = {" 99,90": Decimal("99.90"), " 199.90 ": Decimal("199.90"), "free": None, "R$10": None, "": None,
             None: None, "-5": Decimal("-5.00"), "12.345": Decimal("12.35"), "1,5": Decimal("1.50")}
    for raw, want in cases.items():
        assert one(spark, C.parse_decimal("x"), raw) == want, raw


def test_parse_ts_iso_only_by_default(spark):
    assert one(spark, C.parse_ts("x"), "2025-12-01 10:00:00") == dt.datetime(2025, 12, 1, 10, 0)
    assert one(spark, C.parse_ts("x"), "2025-12-01T10:00:05") == dt.datetime(2025, 12, 1, 10, 0, 5)
    assert one(spark, C.parse_ts("x"), "01/12/2025 05:57") is None
    assert one(spark, C.parse_ts("x"), "2024-13-40") is None
    both = C.parse_ts("x", (None, C.DMY_MINUTES))
    assert one(spark, both, "01/12/2025 05:57") == dt.datetime(2025, 12, 1, 5, 57)
    assert one(spark, both, "2025-12-01 10:00:00") == dt.datetime(2025, 12, 1, 10, 0)


def test_null_if_sentinel(spark):
    assert one(spark, C.null_if("x", "N/A"), "N/A") is None
    assert one(spark, C.null_if("x", "N/A"), "n/a") == "n/a"


def test_text_cleaning(spark):
    assert one(spark, C.strip_accents("x"), "São Belém Ação ÇÃO") == "Sao Belem Acao CAO"
    assert one(spark, C.title_clean("x"), "  RIO de janeiro ") == "Rio De Janeiro"
    assert one(spark, C.title_clean("x"), "são paulo") == "Sao Paulo"
    assert one(spark, C.title_clean("x", accents=False), "CORREIOS ") == "Correios"
    assert one(spark, C.upper_trim("x"), "sp ") == "SP"


def test_defaults(spark):
    assert one(spark, C.default_if_null("x", "UNKNOWN", then=F.lower), None) == "UNKNOWN"
    assert one(spark, C.default_if_null("x", "UNKNOWN", then=F.lower), "PAID") == "paid"
    assert one(spark, C.default_if_null("x", "UNKNOWN"), "  ") == "  "  # blank stays
    assert one(spark, C.default_if_blank("x", "NA"), "  ") == "NA"
    assert one(spark, C.default_if_blank("x", "NA"), None) == "NA"
    assert one(spark, C.default_if_blank("x", "NA", then=C.upper_trim), " rj") == "RJ"


def test_numeric_rules(spark):
    ddl = "x decimal(10,2)"
    zero = C.money_zero()
    assert one(spark, C.null_if_negative("x"), Decimal("-1"), ddl) is None
    assert one(spark, C.null_if_negative("x"), Decimal("0"), ddl) == Decimal("0.00")
    assert one(spark, C.zero_if_negative("x", zero), Decimal("-3"), ddl) == Decimal("0.00")
    assert one(spark, C.zero_if_negative("x", zero), None, ddl) is None
    assert one(spark, C.zero_if_null("x", zero), None, ddl) == Decimal("0.00")
    assert one(spark, C.whole_units("x"), Decimal("2.70"), ddl) == 2
    assert one(spark, C.whole_units("x"), Decimal("-0.50"), ddl) == -1
    # the typed zero keeps money decimal(10,2), never double
    df = spark.createDataFrame([(None,)], ddl).select(C.zero_if_null("x", zero).alias("r"))
    assert df.schema["r"].dataType.simpleString() == "decimal(10,2)"


def test_timestamp_fallbacks(spark):
    df = spark.createDataFrame([(None, dt.date(2025, 12, 1), dt.datetime(2025, 12, 2, 6, 0))],
                               "ts timestamp, d date, ing timestamp")
    row = df.select(C.ts_or_date("ts", "d").alias("a"), C.ts_or_ts("ts", "ing").alias("b")).first()
    assert row.a == dt.datetime(2025, 12, 1, 0, 0)
    assert row.b == dt.datetime(2025, 12, 2, 6, 0)


def test_hours_between(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 12, 1, 12), dt.datetime(2025, 12, 5, 13)),
                                (dt.datetime(2025, 12, 2, 12), dt.datetime(2025, 12, 1, 12)),
                                (None, dt.datetime(2025, 12, 1))], "s timestamp, e timestamp")
    got = [r.h for r in df.select(C.hours_between("s", "e").alias("h")).collect()]
    assert got == [97.0, -24.0, None]
