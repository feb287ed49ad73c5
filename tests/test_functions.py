"""Column helpers: rounding, money ratios, text and date rules."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallybook.functions.dates import localise, uk_date
from tallybook.functions.money import money_ratio, percent_round2, round2
from tallybook.functions.text import (blank_fallback, labelled_percent, no_if_false, text_to_int,
                                      yes_if_true)
from tallybook.functions.valuation import (ledger_net, qty_times_price, settlement_net, settlement_vat,
                                           subcontractor_line, supplier_line)


def one(spark, col, ddl="x int", row=(1,)):
    return spark.createDataFrame([row], ddl).select(col.alias("v")).first()["v"]


def dec(v, t="decimal(12,4)"):
    return F.lit(Decimal(str(v))).cast(t)


def test_round_half_away_from_zero_on_decimals(spark):
    assert one(spark, round2(dec("1.005"))) == Decimal("1.01")
    assert one(spark, round2(dec("-1.005"))) == Decimal("-1.01")
    assert one(spark, round2(dec("2.3449"))) == Decimal("2.34")


def test_money_ratio_truncates_at_four_places(spark):
    # money / money keeps 4 dp by cutting: 100/339 = 0.29498... -> 0.2949
    assert one(spark, money_ratio(dec(100), dec(339))) == Decimal("0.2949")
    assert one(spark, money_ratio(dec(-100), dec(339))) == Decimal("-0.2949")
    assert one(spark, money_ratio(dec("85.50"), dec(100))) == Decimal("0.8550")


def test_quotients_of_large_and_of_fine_amounts(spark):
    assert one(spark, money_ratio(dec("99999999999.99", "decimal(19,4)"), dec("99999999999.99", "decimal(19,4)"))) == Decimal("1.0000")
    assert one(spark, percent_round2(dec("0.000149", "decimal(18,6)"), dec("0.000199", "decimal(18,6)"))) == Decimal("74.87")


def test_percentages_and_rates_keep_their_decimals(spark):
    # 33.3333 % off 30,000.00; a rate of 17.555 on 30,000.00
    one_, price, pct, none = dec(1), dec(30000), dec("33.3333", "decimal(9,4)"), F.lit(None).cast("decimal(12,2)")
    assert one(spark, settlement_net(one_, price, none, pct)) == Decimal("20000.01")
    assert one(spark, ledger_net(qty_times_price(one_, price), none, pct)) == Decimal("20000.01")
    assert one(spark, supplier_line(F.lit(0), one_, price, pct, none, none, none)["net"]) == Decimal("20000.01")
    rate = dec("17.555", "decimal(6,3)")
    assert one(spark, settlement_vat(one_, price, none, none, rate)) == Decimal("5266.50")
    assert one(spark, subcontractor_line(F.lit(0), one_, price, rate)["vat"]) == Decimal("5266.50")


def test_percent_round2_is_exact_half_away(spark):
    assert one(spark, percent_round2(dec(1), dec(8))) == Decimal("12.50")
    assert one(spark, percent_round2(dec(1), dec(800))) == Decimal("0.13")
    assert one(spark, percent_round2(dec(2), dec(3))) == Decimal("66.67")
    assert one(spark, percent_round2(dec(-2), dec(3))) == Decimal("-66.67")
    assert one(spark, percent_round2(dec(2), dec(-3))) == Decimal("-66.67")


def test_undiscounted_settlement_line_is_rounded_twice(spark):
    # Q21: qty x price = 0.004995 -> money 0.0050 -> 0.01; a discounted line
    # (fixed discount 0) is rounded once -> 0.00
    q, p = dec("0.0999"), dec("0.0500")
    none = F.lit(None).cast("decimal(12,2)")
    assert one(spark, settlement_net(q, p, none, none)) == Decimal("0.0100")
    assert one(spark, settlement_net(q, p, dec(0, "decimal(12,2)"), none)) == Decimal("0.0000")


def test_settlement_vat_uses_unrounded_net(spark):
    # 3 x 3.33 = 9.99, 10 % off -> 8.991; VAT 20 % on 8.991 = 1.7982 -> 1.80
    v = settlement_vat(dec(3, "decimal(9,2)"), dec("3.33", "decimal(12,2)"), F.lit(None).cast("decimal(12,2)"),
                       dec(10, "decimal(5,2)"), dec(20, "decimal(5,2)"))
    assert one(spark, v) == Decimal("1.8000")


def test_text_to_int_reads_blank_as_zero(spark):
    df = spark.createDataFrame([("",), (" 3 ",), ("x",), ("  ",), (None,)], "v string")
    got = [r[0] for r in df.select(text_to_int(F.col("v"))).collect()]
    assert got == [0, 3, None, 0, None]


def test_blank_fallback_ignores_trailing_blanks(spark):
    df = spark.createDataFrame([(" ", "B"), ("A", "B"), (None, "B"), ("", "B")], "a string, b string")
    got = [r[0] for r in df.select(blank_fallback(F.col("a"), F.col("b"))).collect()]
    assert got == ["B", "A", "B", "B"]


def test_yes_no_null_sides_differ(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    rows = df.select(yes_if_true(F.col("f")), no_if_false(F.col("f"))).collect()
    assert [tuple(r) for r in rows] == [("Yes", "Yes"), ("No", "No"), ("No", "Yes")]


def test_labelled_percent_prints_decimal_scale(spark):
    assert one(spark, labelled_percent("Uplift", dec("12.5", "decimal(9,2)"))) == "Uplift-12.50%"


def test_localised_uk_date_across_daylight_saving(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 1, 23, 30),), (dt.datetime(2024, 1, 1, 23, 30),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(uk_date(localise(F.col("ts"), F.lit("Europe/London")))).collect()]
    assert got == ["02/07/2024", "01/01/2024"]
    win = [r[0] for r in df.select(uk_date(localise(F.col("ts"), F.lit("GMT Standard Time")))).collect()]
    assert win == got


def test_every_windows_zone_is_known_and_other_names_are_counted(spark):
    from tallybook.functions.dates import UNKNOWN_ZONE, WINDOWS_TO_IANA, iana_zone, localise, unknown_zones
    ids = set(spark._jvm.java.time.ZoneId.getAvailableZoneIds().toArray())
    assert len(WINDOWS_TO_IANA) > 130 and not set(WINDOWS_TO_IANA.values()) - ids
    names = [*WINDOWS_TO_IANA, "gmt standard time ", "Europe/London", "+05:30", "Nowhere Standard Time", "Nowhere Standard Time", None]
    df = spark.createDataFrame([(n,) for n in names], "timezone string").withColumn("ts", F.lit("2024-07-01 12:00:00").cast("timestamp_ntz"))
    got = {r[0]: (r[1], r[2]) for r in df.select("timezone", iana_zone(F.col("timezone")), localise(F.col("ts"), F.col("timezone")).cast("string")).collect()}
    assert all(got[n][0] == z for n, z in WINDOWS_TO_IANA.items()) and all(got[n][1] for n in WINDOWS_TO_IANA)
    assert got["gmt standard time "] == ("Europe/London", "2024-07-01 13:00:00") and got["+05:30"][1] == "2024-07-01 17:30:00"
    assert got["Nowhere Standard Time"] == (UNKNOWN_ZONE, "2024-07-01 12:00:00") and got[None] == (None, None)
    assert [tuple(r) for r in unknown_zones(df).collect()] == [("Nowhere Standard Time", 2)]
