"""Property tests with fixed seeds: exact ratios and date parsing agree with
Python's own arithmetic and parsing."""

import datetime as dt
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from hypothesis import given, seed, settings
from hypothesis import strategies as st

from adlens.functions import dates, ratios

PAIRS = st.lists(st.tuples(st.integers(0, 10**12), st.integers(0, 10**12)), min_size=1, max_size=60)


@seed(1)
@settings(max_examples=15, deadline=None)
@given(PAIRS)
def test_pct_half_up_matches_decimal(spark, pairs):
    df = spark.createDataFrame(pairs, "c long, i long")
    got = [r[0] for r in df.select(ratios.pct_half_up("c", "i")).collect()]
    want = [None if i == 0 else float((Decimal(c) * 100 / Decimal(i)).quantize(Decimal("0.01"), ROUND_HALF_UP))
            for c, i in pairs]
    assert got == want


@seed(2)
@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-10**6, 10**6), min_size=1, max_size=60))
def test_half_even_matches_python_round_on_halves(spark, ints):
    vals = [Decimal(n) / 2 for n in ints]
    df = spark.createDataFrame([(str(v),) for v in vals], "x string")
    got = [r[0] for r in df.select(ratios.round_half_even(df.x.cast("decimal(20,2)"))).collect()]
    assert got == [float(v.quantize(Decimal(1), ROUND_HALF_EVEN)) for v in vals]


@seed(3)
@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)), min_size=1, max_size=40))
def test_both_date_forms_parse_to_the_same_day(spark, days):
    texts = [(d.strftime("%Y%m%d"), d.isoformat(), f"{d.year}-{d.month}-{d.day}") for d in days]
    df = spark.createDataFrame(texts, "a string, b string, c string")
    got = df.select(*[dates.parse_report_date(c) for c in "abc"]).collect()
    assert [tuple(r) for r in got] == [(d, d, d) for d in days]
