"""Edge tables for the column expressions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import DateTimeException, NumberFormatException
from pyspark.sql import functions as F

from ordstrata.functions import dates, numbers, text
from ordstrata.plans.gold import tier


def mapped(spark, values, expression, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_trim_strips_every_whitespace(spark):
    given = ["  a b ", "\ta\n", " a ", " \t ", "", None, "a", " 　a \u0085", "\r\nç "]
    assert mapped(spark, given, text.trim_ws) == ["a b", "a", "a", "", "", None, "a", "a", "ç"]


def test_trim_equals_python_strip(spark):
    edges = ["", *text.WHITESPACE, "x", "é"]
    given = [a + b + "mid dle" + b + a for a in edges for b in edges] + edges
    assert mapped(spark, given, text.trim_ws) == [g.strip(text.WHITESPACE) for g in given]


def test_initcap_starts_words_after_punctuation(spark):
    given = ["maria-jose DA silva", "o'neil", "joão d.avila", "a  b", "x/y(z)", "", None, "ÉLAN\tvital"]
    want = ["Maria-Jose Da Silva", "O'neil", "João D.Avila", "A  B", "X/Y(Z)", "", None, "Élan\tVital"]
    assert mapped(spark, given, text.initcap_words) == want


def test_blank_and_digits(spark):
    assert mapped(spark, ["", " \t", "a", None], text.is_blank) == [True, True, False, None]
    assert mapped(spark, ["123", "12a", "", None], text.all_digits) == [True, False, False, None]


def test_padded_keeps_long_numbers(spark):
    assert mapped(spark, [7, 123, 12345, None], lambda x: text.padded(x, 4), "int") == [
        "0007",
        "0123",
        "12345",
        None,
    ]


def test_labels_are_null_when_a_part_is(spark):
    assert mapped(spark, [1, None], lambda x: text.year_month(F.lit(2020), x), "int") == ["2020-01", None]
    assert mapped(spark, [1, None], lambda x: text.year_half(F.lit(2020), x), "int") == ["2020 - S1", None]


def test_safe_dates(spark):
    given = ["29/02/2020", "29/02/2019", "31/04/2020", "1/2/2020", " 05/06/2021\t", "", None, "2020-01-01", "1/2/20"]
    want = [dt.date(2020, 2, 29), None, None, dt.date(2020, 2, 1), dt.date(2021, 6, 5)]
    assert mapped(spark, given, dates.try_parse_dmy) == want + [None] * 4


def test_strict_date_fails(spark):
    assert mapped(spark, ["01/02/2020", None], dates.parse_dmy) == [dt.date(2020, 2, 1), None]
    with pytest.raises(DateTimeException):
        mapped(spark, ["31/04/2020"], dates.parse_dmy)


def test_years_crossed_counts_new_years(spark):
    born = [dt.date(2000, 12, 31), dt.date(2001, 1, 1), None]
    later = F.lit(dt.date(2001, 1, 1))
    assert mapped(spark, born, lambda x: dates.years_crossed(later, x), "date") == [1, 0, None]


def test_weekday_and_half(spark):
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 13), None]
    assert mapped(spark, days, dates.weekday_number, "date") == [1, 7, None]
    assert mapped(spark, days, dates.weekday_name, "date") == ["Sunday", "Saturday", None]
    assert mapped(spark, [1, 6, 7, 12, None], dates.half_of_month, "int") == [1, 1, 2, 2, 2]


def test_strict_casts_fail(spark):
    assert mapped(spark, [" 12 ", "-3", None], numbers.whole) == [12, -3, None]
    for cast in (numbers.whole, numbers.money):
        with pytest.raises(NumberFormatException):
            mapped(spark, ["1,5"], cast)


def test_money_keeps_its_digits(spark):
    values = mapped(spark, ["1.005", "-1.50", "0", "99999999999999.9999"], numbers.money)
    assert values == [Decimal(x) for x in ("1.005", "-1.50", "0", "99999999999999.9999")]


def test_ratio_rounds_halves_away_from_zero(spark):
    def halved(places):
        return lambda x: numbers.ratio(x, F.lit(2), places)

    assert mapped(spark, ["2.01", "-2.01", "0.05"], lambda x: halved(2)(numbers.money(x))) == [1.01, -1.01, 0.03]
    assert mapped(spark, [1, 3], lambda x: numbers.percent(x, F.lit(8), 1), "bigint") == [12.5, 37.5]


def test_safe_divide(spark):
    assert mapped(spark, [4, 0, None], lambda x: numbers.safe_divide(F.lit(8), x), "int") == [2.0, None, None]


def test_percent_change_is_rounded_once(spark):
    """18674.27 / 417302.15 is 4.4749997 %, which six decimals would round up to 4.475."""

    def change(after):
        before = F.lit("417302.15").cast("decimal(37,2)")
        return numbers.percent_change(before, after.cast("decimal(37,2)"), 2)

    assert mapped(spark, ["398627.88", "417302.15", None], change) == [-4.47, 0.0, None]
    zero = F.lit(0).cast("decimal(37,2)")
    assert mapped(spark, ["1.00"], lambda x: numbers.percent_change(zero, numbers.money(x), 2)) == [None]


def test_range_bucket(spark):
    bounds = [2019, 2020, 2021, 2022, 2023, 2024, 2025]
    given = [2018, 2019, 2024, 2025, 2030, None]
    assert mapped(spark, given, lambda x: numbers.range_bucket(x, bounds), "int") == [0, 1, 6, 7, 7, None]
    assert mapped(spark, [5, 10, 99], lambda x: numbers.range_bucket(x, [10, 50, 60]), "int") == [0, 1, 3]


def test_generate_array_includes_both_ends(spark):
    assert spark.range(1).select(numbers.generate_array(2019, 2025, 2)).first()[0] == [2019, 2021, 2023, 2025]


def test_tier_limits_belong_to_the_upper_tier(spark):
    given = ["0", "999.99", "1000", "1999.99", "2000", "4999.99", "5000"]
    names = mapped(spark, given, lambda x: tier(numbers.money(x), (1000, 2000, 5000)))
    assert names == ["Básico", "Básico", "Prata", "Prata", "Ouro", "Ouro", "Super"]


def test_money_keeps_every_digit(spark):
    given = ["0.00004", "0.123456789", "12.5000000000000", "7", None]
    found = mapped(spark, given, lambda x: numbers.money(x).cast("string"))
    assert found == ["0.000040000", "0.123456789", "12.500000000", "7.000000000", None]
    with pytest.raises(Exception, match="more than nine decimals"):
        mapped(spark, ["0.1234567891"], numbers.money)
