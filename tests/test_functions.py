import datetime as dt
from decimal import Decimal, localcontext

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from turnstile.functions import clock, money, text
from turnstile.functions.median import median_few, median_many


def apply(spark, values, make):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, s string")
    return [r.o for r in rows.select("i", make(F.col("s")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "make, cases",
    [
        (
            text.normalize_currency,
            {
                "USD": "USD", "$": "USD", "US$": "USD", "usd ": "USD", "U.S.D.": "USD",
                "$CAD": "USD", "CA$": None, "AUSTRALIAN DOLLAR": "AUS", "": None, None: None,
                " eur ": "EUR", "x1 gbp": "GBP",
            },
        ),
        (text.clean_email, {" A@B.C ": "a@b.c", "No Email": None, "": "", None: None}),
        (text.clean_phone, {"(555) 1-0100 x9": "55510100x9", "--": None, None: None}),
        (
            text.mask_email,
            {"ann@b.c": "XXXXX@b.c", "@b.c": "XXXXX", "": "XXXXX", "ann": "XXXXX", None: None},
        ),
        (
            text.mask_phone,
            {"5551234": "XXX1234", "1234": "1234", "12": "XX", "": "", None: None},
        ),
        (text.status_tight, {"Return Pending": "RETURNPENDING", None: None}),
        (text.status_plain, {"Return Pending": "RETURN PENDING"}),
        (text.status_spaced, {" wait/hold  x ": "WAIT/HOLD X"}),
        (text.trim_ws, {"\t a \n": "a", " 　": "", None: None}),
    ],
)
def test_text_vectors(spark, make, cases):
    assert apply(spark, list(cases), make) == list(cases.values())


def test_currency_function_in_sql(spark):
    text.register_functions(spark)
    cases = ["US$ 5", "usd ", "CA$", "AUSTRALIAN DOLLAR", "", None, "U.S.D."]
    spark.createDataFrame([(c,) for c in cases], "c string").createOrReplaceTempView("currencies")
    rows = spark.sql("SELECT c, normalize_currency(c) AS n FROM currencies")
    same = rows.filter(F.col("n").eqNullSafe(text.normalize_currency(F.col("c"))))
    assert same.count() == len(cases)


def test_local_date_edges(spark):
    moments = {
        "2026-01-01T07:59:59Z": "2025-12-31",
        "2026-01-01T08:00:00Z": "2026-01-01",
        "2026-07-01T06:59:59Z": "2026-06-30",
        "2026-07-01T07:00:00Z": "2026-07-01",
    }
    got = apply(spark, list(moments), lambda c: clock.local_date(c.cast("timestamp")).cast("string"))
    assert got == list(moments.values())


def test_range_on_instants_equals_range_on_local_days(spark):
    hours = spark.range(24 * 800).select(
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2025-01-01").cast("timestamp")).alias("t")
    )
    for start, end in (("2025-03-09", "2025-03-10"), ("2025-11-02", "2025-11-03"), ("2026-01-01", "2027-01-01")):
        fast = hours.filter(clock.on_local_days(F.col("t"), start, end))
        day = clock.local_date(F.col("t"))
        plain = hours.filter((day >= F.lit(clock.as_date(start))) & (day < F.lit(clock.as_date(end))))
        assert fast.count() == plain.count() > 0
        assert fast.exceptAll(plain).isEmpty()


def test_json_text_keeps_nulls(spark):
    row = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, CAST(NULL AS ARRAY<STRUCT<x: INT>>) AS q")
    got = row.select(text.json_text(F.struct("a", "b")).alias("s"), text.json_text(F.col("q")).alias("q")).first()
    assert (got.s, got.q) == ('{"a":1,"b":null}', "null")


def test_quarter_bounds():
    assert clock.quarter_bounds(2026, 4) == (dt.date(2026, 10, 1), dt.date(2027, 1, 1))
    assert clock.quarter_bounds(2026, 1) == (dt.date(2026, 1, 1), dt.date(2026, 4, 1))


def expected_median(values):
    known = sorted(v for v in values if v is not None)
    if not known:
        return []
    n = len(known)
    with localcontext() as exact:
        exact.prec = 80
        mean = (known[(n - 1) // 2] + known[n // 2]) / 2
        return [mean.quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")]


def medians(spark, values):
    rows = spark.createDataFrame([(None if v is None else str(v),) for v in values], "x string")
    df = rows.select(F.col("x").cast("decimal(38,9)").alias("x"))
    return [[r.m for r in f(df, "x", "m").collect()] for f in (median_few, median_many)]


@pytest.mark.parametrize(
    "values",
    [[], [None], ["1.5", "2", None, "10", "4"], ["-3.01"], ["1.01", "1.02"], ["5"] * 7 + ["9"], ["999999999.5", "-999999999.5"],
     ["1234567890123456789.01", "1234567890123456789.04", "2", "9" * 19 + ".99"], ["-" + "8" * 26 + ".123456789", "3"]],
)
def test_median_vectors(spark, values):
    values = [None if v is None else Decimal(v) for v in values]
    few, many = medians(spark, values)
    assert few == many == expected_median(values)


def test_median_over_many_ranges(spark):
    """Ranges of both steps with more values than one, hot values, and both middle ranks at a cut."""
    rows = spark.range(40_001).select((F.col("id") * F.lit("123456789.01").cast("decimal(20,2)")).alias("x"))
    assert median_many(rows, "x", "m").first().m == 20_000 * Decimal("123456789.01")
    even = rows.filter("x > 0")
    assert median_many(even, "x", "m").first().m == 20_000 * Decimal("123456789.01") + Decimal("61728394.51")
    hot = even.unionByName(spark.range(30_000).select(F.lit("7.25").cast("decimal(20,2)").alias("x")))
    assert median_many(hot, "x", "m").first().m == 5_000 * Decimal("123456789.01") + Decimal("61728394.51")


def nearest(x):
    """Nine decimals, half away from zero."""
    return x.quantize(Decimal("1e-9"), rounding="ROUND_HALF_UP")


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.decimals(-(10**19), 10**19, places=9), st.decimals(-(10**9), 10**9, places=9)), min_size=1, max_size=40))
def test_products_are_exact(spark, pairs):
    pairs += [(Decimal(10**28), Decimal("9.5")), (Decimal("-0.5"), Decimal("0.000000001")), (Decimal("-0.25"), Decimal("0.000000001"))]
    pairs += [(None, Decimal(1)), (Decimal("1e-9"), Decimal("1e-9"))]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a decimal(38,9), b decimal(38,9)")
    got = [r.p for r in df.select("i", money.times(F.col("a"), F.col("b")).alias("p")).orderBy("i").collect()]
    with localcontext() as exact:
        exact.prec = 80
        assert got == [None if a is None else nearest(a * b) for a, b in pairs]


def test_a_product_that_does_not_fit_stops_the_job(spark):
    df = spark.sql("SELECT CAST('1e28' AS DECIMAL(38,9)) AS a")
    with pytest.raises(ArithmeticException):
        df.select(money.times(F.col("a"), F.col("a"))).collect()


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.decimals("-5000", "5000", places=2), min_size=1, max_size=60))
def test_median_property(spark, values):
    few, many = medians(spark, values)
    assert few == many == expected_median(values)
