"""Property tests: column builders against plain-Python statements of their rules.

Each generated example is a whole batch of values checked in one Spark job.
"""

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.fixed import ACCENTED, UNACCENTED
from strata.functions import clean as C

NUMBERISH = st.text(alphabet="0123456789,.- a", max_size=14)
WORDISH = st.text(alphabet="abcXYZ çãéÓü", max_size=20)
SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def expected_decimal(raw):
    """trim spaces -> ',' to '.' -> decimal(10, 2) rounded half-up; anything else, or overflow -> None."""
    if raw is None:
        return None
    text = raw.strip(" ").replace(",", ".")
    if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)", text):
        return None
    value = Decimal(text).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return None if abs(value) >= Decimal(10) ** 8 else value


def expected_title(raw):
    """trim -> strip accents -> lower -> upper-case the first letter of each space-separated word."""
    if raw is None:
        return None
    text = raw.strip(" ").translate(str.maketrans(ACCENTED, UNACCENTED)).lower()
    return " ".join(w[:1].upper() + w[1:] for w in text.split(" "))


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.r for r in df.select("i", expr.alias("r")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(st.one_of(st.none(), NUMBERISH), min_size=1, max_size=60))
def test_parse_decimal_matches_rule(spark, values):
    got = run(spark, values, C.parse_decimal("x"))
    assert got == [expected_decimal(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), WORDISH), min_size=1, max_size=60))
def test_title_clean_matches_rule(spark, values):
    got = run(spark, values, C.title_clean("x"))
    assert got == [expected_title(v) for v in values]


ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                          st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.sampled_from(["x", "y", "z"]))), min_size=1, max_size=40)


@SETTINGS
@given(ROWS)
def test_latest_by_matches_brute_force(spark, rows):
    from strata.operators.dedup import latest_by, recency

    df = spark.createDataFrame(rows, "k string, d int, v string")
    got = sorted(((r.k, r.d, r.v) for r in latest_by(df, ["k"], recency("d")).collect()),
                 key=lambda r: (r[0] is not None, r[0] or ""))
    best = {}
    for k, d, v in rows:
        # newest first (d descending, nulls last), then v ascending with nulls first
        rank = (d is None, -(d or 0), v is not None, v or "")
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, d, v))
    want = sorted((row for _, row in best.values()), key=lambda r: (r[0] is not None, r[0] or ""))
    assert got == want


STAMPS = st.lists(st.one_of(st.none(), st.tuples(
    st.integers(2000, 2030), st.integers(0, 13), st.integers(0, 32), st.integers(0, 24), st.integers(0, 60),
    st.sampled_from([" ", "T"]))), min_size=1, max_size=60)


@SETTINGS
@given(STAMPS)
def test_parse_ts_iso_matches_calendar(spark, parts):
    import datetime as dt

    values, want = [], []
    for p in parts:
        if p is None:
            values.append(None)
            want.append(None)
            continue
        y, mo, d, h, mi, sep = p
        values.append(f"{y:04d}-{mo:02d}-{d:02d}{sep}{h:02d}:{mi:02d}:00")
        try:
            want.append(dt.datetime(y, mo, d, h, mi))
        except ValueError:
            want.append(None)
    got = run(spark, values, C.parse_ts("x").cast("timestamp_ntz"))
    assert got == want
