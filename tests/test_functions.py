from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierlake.functions import json as J
from tierlake.functions import numeric as N
from tierlake.functions import text as S


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("x")).first()["x"]


def of_json(spark, rule, *values):
    """Results of a rule for a field given as JSON texts; None stands for no such key."""
    texts = ["{}" if v is None else f'{{"f": {v}}}' for v in values]
    schema = J.record_schema(variant_fields=["f"])
    records = spark.createDataFrame(list(enumerate(texts)), "i int, j string").select(
        "i", F.from_json("j", schema).alias("r")
    )
    return [r["x"] for r in records.select("i", rule(F.col("r.f")).alias("x")).sort("i").collect()]


def check(spark, rule, cases):
    assert dict(zip(cases, of_json(spark, rule, *cases))) == cases


def test_trim_strips_blanks_only(spark):
    assert one(spark, S.trim_spaces(F.col("c")), c="  \tAnn  ") == "\tAnn "


def test_ascii_case_leaves_other_letters(spark):
    assert one(spark, S.ascii_lower(F.col("c")), c="ÉA@X.COM") == "Éa@x.com"
    assert one(spark, S.ascii_upper(F.col("c")), c="éa ß") == "éA ß"


def test_unicode_upper(spark):
    assert one(spark, S.unicode_upper(F.col("c")), c="straße é") == "STRASSE É"


@pytest.mark.parametrize("given, expected", [(None, "N"), ("", "N"), ("  ", "  "), ("x", "x")])
def test_or_default(spark, given, expected):
    assert one(spark, S.or_default(F.col("c").cast("string"), "N"), c=given) == expected


def test_day_is_the_written_one(spark):
    assert one(spark, S.iso_day(F.col("c")), c="2024-02-01T23:30:00-05:00") == "2024-02-01"


def test_flag(spark):
    ones = ["true", "1", "1.0", "1e0"]
    zeros = ["false", "2", "0", '"true"', '"1"', "null", None, "[1]"]
    check(spark, J.flag, {v: 1 for v in ones} | {v: 0 for v in zeros})


def test_falsy(spark):
    falsy = [None, "null", '""', "0", "0.0", "-0.0", "0e3", "false", "[]", "{}"]
    others = ['"0"', '" "', "7", "true", "[0]"]
    check(spark, J.is_falsy, {v: True for v in falsy} | {v: False for v in others})


def test_strict_money(spark):
    numbers = {
        "482.0": "482.0000", "440": "440.0000", '"12.5"': "12.5000", "1e2": "100.0000",
        "true": "1.0000", "12.34565": "12.3457",
    }
    refused = ['"x"', "null", None, '""', "[1]", "123456789012345"]
    check(spark, J.strict_money,
          {v: Decimal(d) for v, d in numbers.items()} | {v: None for v in refused})


def test_strict_int(spark):
    check(spark, J.strict_int, {
        "2.7": 2, "-2.7": -2, '"3"': 3, '" 3 "': 3, '"2.5"': None, "null": None, "true": 1,
        "1e2": 100,
    })


def test_real_prefix(spark):
    check(spark, lambda v: N.real_prefix(J.real_text(v)), {
        "4.5": 4.5, '"4.5abc"': 4.5, '"abc"': 0.0, '""': 0.0, '" \\t+4. x"': 4.0, '".5"': 0.5,
        '"-2e1x"': -20.0, "true": 1.0, "[5]": 0.0, "null": None, None: None,
    })


def test_money_prefix_never_turns_a_large_number_into_zero(spark):
    assert one(spark, N.real_prefix(F.col("c"), N.MONEY), c="1e30 EUR") is None
    assert one(spark, N.real_prefix(F.col("c"), N.MONEY), c="none") == 0


def test_missing_differs_from_null(spark):
    def status(v):
        return J.when_missing(v, F.lit("UNKNOWN"), J.string_only(v))

    check(spark, status, {None: "UNKNOWN", "null": None, "5": None, '"a"': "a"})


@pytest.mark.parametrize("value, expected", [
    ("2.675", "2.68"), ("1.005", "1.01"), ("0.125", "0.13"), ("-0.125", "-0.13"),
])
def test_cents_round_half_up(spark, value, expected):
    assert one(spark, N.cents(F.col("c").cast(N.MONEY)), c=value) == Decimal(expected)


def test_line_total(spark):
    total = N.line_total(F.col("q"), F.col("p").cast(N.MONEY))
    assert one(spark, total, q=3, p="1.115") == Decimal("3.3500")
    assert one(spark, total, q=2**62, p="99999999") is None


def test_ratio_is_zero_without_a_divisor(spark):
    ratio = N.ratio(F.col("a").cast("decimal(28,2)"), F.col("b"))
    assert one(spark, ratio, a="10", b=3) == Decimal("3.33")
    assert one(spark, ratio, a="10", b=0) == 0
    assert one(spark, N.percentage(F.col("a"), F.col("b")), a=1, b=3) == Decimal("33.33")
