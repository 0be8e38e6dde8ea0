import datetime as dt
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions import keys, money, scalars
from conftest import rows


def test_week_key_matches_strftime_every_day(spark):
    start = dt.date(2016, 12, 25)
    days = [start + dt.timedelta(days=i) for i in range(365 * 9)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = dict((r[0], r[1]) for r in df.select("d", keys.week_key(F.col("d"))).collect())
    assert all(got[d] == d.strftime("%Y%U") for d in days)


@settings(max_examples=25, deadline=None)
@given(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2199, 12, 31)))
def test_week_key_property(spark, d):
    got = spark.range(1).select(keys.week_key(F.lit(d))).first()[0]
    assert got == d.strftime("%Y%U")


def test_week_key_examples_and_null(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2021, 1, 2),), (dt.date(2021, 1, 3),),
                                (dt.date(2020, 12, 31),), (None,)], "d date")
    assert [r[0] for r in df.select(keys.week_key(F.col("d"))).collect()] == \
        ["202100", "202100", "202101", "202052", None]


def test_wave_key_null_strict(spark):
    df = spark.createDataFrame([(1, 2), (1, None)], "p long, w long")
    assert [r[0] for r in df.select(keys.wave_key(F.col("p"), F.col("w"))).collect()] == ["1/2", None]


def test_to_eur_rounds_half_up_on_decimals(spark):
    df = spark.createDataFrame([(12345, 12), (333, 12), (335, 12), (100, 99), (None, 12), (250, 3)],
                               "cents long, cur long")
    out = df.select(money.to_eur(money.to_units(F.col("cents")), F.col("cur"), money.RATES_BY_ID).alias("e"))
    assert [r[0] for r in out.collect()] == [Decimal("104.93"), Decimal("2.83"), Decimal("2.85"), None, None,
                                             Decimal("2.50")]


def test_convert_before_and_after_sum_differ(spark):
    # D3 (round each row, then add) against D4 (add, then round): 5 cents at
    # 0.85 is 4.25 cents per row -> 4 + 4 = 8, while 10 cents -> 8.5 -> 9
    df = spark.createDataFrame([(5, 12), (5, 12)], "cents long, cur long")
    d3 = df.agg(money.to_units(F.sum(money.to_eur_cents(F.col("cents"), F.col("cur"), money.RATES_BY_ID)))).first()[0]
    d4 = df.agg(money.to_eur(money.to_units(F.sum("cents")), F.lit(12), money.RATES_BY_ID)).first()[0]
    assert (d3, d4) == (Decimal("0.08"), Decimal("0.09"))


def test_passthrough_keeps_unknown_currency(spark):
    df = spark.createDataFrame([(1000, 12), (1000, 77), (1000, None)], "cents long, cur long")
    out = df.select(money.to_eur(money.to_units(F.col("cents")), F.col("cur"), money.RATES_BY_ID,
                                 on_unknown="passthrough"))
    assert [r[0] for r in out.collect()] == [Decimal("8.50"), Decimal("10.00"), Decimal("10.00")]


def test_code_table_unrounded(spark):
    df = spark.createDataFrame([(10001, "CLP"), (100, "XXX")], "cents long, code string")
    out = df.select(money.to_eur(money.to_units(F.col("cents")), F.col("code"), money.RATES_BY_CODE_SALES,
                                 digits=None))
    assert [r[0] for r in out.collect()] == [Decimal("0.0230023"), None]


def test_quarter_hours_keeps_other_minutes_as_hours(spark):
    df = spark.createDataFrame([(0,), (15,), (30,), (45,), (20,), (None,)], "m long")
    assert [r[0] for r in df.select(scalars.quarter_hours(F.col("m"))).collect()] == [0.0, 0.25, 0.5, 0.75,
                                                                                        20.0, None]


def test_time_text(spark):
    df = spark.createDataFrame([(2, 15), (None, 30), (3, None)], "h long, m long")
    assert [r[0] for r in df.select(scalars.time_text(F.col("h"), F.col("m"))).collect()] == ["2:15", "0:30", None]


def test_categories(spark):
    df = spark.createDataFrame([("SMALL-Brand#1 - red bolt",), ("plain",), (None,)], "n string")
    out = df.select(scalars.product_category(F.col("n")), scalars.product_sub_category(F.col("n")))
    assert [tuple(r) for r in out.collect()] == [("SMALL", "red bolt"), ("plain", "plain"), (None, None)]


def test_account_manager_default(spark):
    df = spark.createDataFrame([("A", "B"), ("A", None), (None, None)], "f string, l string")
    assert [r[0] for r in df.select(scalars.account_manager(F.col("f"), F.col("l"))).collect()] == \
        ["A B", "No Account Manager", "No Account Manager"]


def test_fill_numeric_nulls_keeps_text_and_dates(spark):
    df = spark.createDataFrame([(None, None, None)], "h long, s string, d date")
    assert rows(scalars.fill_numeric_nulls(df)) == [(0, None, None)]


def test_parse_timestamp_bad_text_is_null(spark):
    df = spark.createDataFrame([("2021-01-02 03:04:05",), ("nope",)], "t string")
    out = [r[0] for r in df.select(scalars.parse_timestamp(F.col("t"))).collect()]
    assert out[0] is not None and out[1] is None


def test_fan_out_sums_are_exact_beyond_a_long(spark):
    df = spark.createDataFrame([(2_000_000, 100_000, 100_000, 100_000, 12)], "c long, a long, b long, d long, k long")
    counts = [F.col("a"), F.col("b"), F.col("d")]
    r = df.select(money.product(F.col("c"), counts).alias("p"),
                  money.product_eur(F.col("c"), counts, F.col("k"), money.RATES_BY_ID).alias("e")).first()
    assert int(r.p) == 2_000_000 * 10 ** 15 and r.e == Decimal("0.85") * 2_000_000 * 10 ** 13


# Hand-written amounts: 1,000,000 units of each currency in EUR.
MILLION = {
    "RATES_BY_CODE_SALES": {"TRY": 120000, "CLP": 230, "USD": 850000, "GBP": 1100000, "PLN": 230000, "KRW": 710,
                            "SEK": 97000, "NZD": 570000, "ARS": 12000, "EUR": 1000000},
    "RATES_BY_CODE_COST": {"ARS": 12000, "DOP": 15000, "TRY": 120000, "USD": 850000, "EUR": 1000000},
    "RATES_BY_ID": {12: 850000, 34: 700, 21: 1120000, 20: 110000, 8: 230000, 4: 7900, 28: 560000, 24: 11000,
                    9: 95000, 23: 1100, 3: 1000000},
    "RATES_BY_ID_COST": {12: 850000, 34: 700, 21: 1120000, 20: 110000, 8: 230000, 4: 7900, 28: 560000, 24: 11000,
                         9: 95000, 23: 1100, 3: 1000000, 26: 15000},
}


def test_every_rate_by_hand(spark):
    for name, amounts in MILLION.items():
        rates = getattr(money, name)
        assert set(rates) == set(amounts)
        df = spark.createDataFrame([(k, v) for k, v in amounts.items()], ["k", "expected"])
        got = df.select("expected", money.to_eur(F.lit(Decimal("1000000.00")), F.col("k"), rates).alias("eur"))
        assert all(r.eur == r.expected for r in got.collect())
