from decimal import Decimal

from pyspark.sql import functions as F

from dwspark.functions import rules as R
from dwspark.functions.calendar import calendar_dim
from dwspark.functions.keys import surrogate_key


def _col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_income_band_limits(spark):
    vals = [None, Decimal("0"), Decimal("1999.99"), Decimal("2000"), Decimal("4999.99"), Decimal("5000"),
            Decimal("9999.99"), Decimal("10000"), Decimal("19999.99"), Decimal("20000")]
    got = _col(spark, vals, "decimal(15,2)", R.income_band)
    assert got == [None, "Até 2 mil", "Até 2 mil", "2 a 5 mil", "2 a 5 mil", "5 a 10 mil", "5 a 10 mil",
                   "10 a 20 mil", "10 a 20 mil", "Acima de 20 mil"]


def test_age_band_limits(spark):
    years = [None, 2001 - 25, 2001 - 26, 2001 - 35, 2001 - 36, 2001 - 45, 2001 - 46, 2001 - 60, 2001 - 61]
    got = _col(spark, years, "int", lambda c: R.age_band_from_year(c, F.to_date(F.lit("2001-06-30"))))
    assert got == [None, "18-25", "26-35", "26-35", "36-45", "36-45", "46-60", "46-60", "60+"]


def test_age_band_from_date(spark):
    df = spark.createDataFrame([("1990-01-01",), (None,)], "d string")
    got = [r[0] for r in df.select(R.age_band_from_date(F.to_date("d"), F.to_date(F.lit("2020-01-01")))).collect()]
    assert got == ["26-35", None]


def test_decodes_and_unmapped(spark):
    assert _col(spark, [0, 1, 2, 3, 4, None], "int", R.sale_type) == [None, "À vista", "Prazo", "Cartão", None, None]
    assert _col(spark, [1, 2, 3, 0], "int", R.phone_type) == ["Residencial", "Comercial", "Celular", None]
    assert _col(spark, [1, 2, None], "int", R.address_type) == ["Residencial", "Comercial", "Comercial"]
    assert _col(spark, list(range(1, 13)), "int", R.month_label)[0] == "Janeiro"


def test_or_default_treats_empty_as_missing(spark):
    assert _col(spark, [None, "", "SP"], "string", lambda c: R.or_default(c, "Não informado")) == \
        ["Não informado", "Não informado", "SP"]


def test_money_rounds_half_away_from_zero(spark):
    got = _col(spark, [Decimal("2.345"), Decimal("-2.345"), Decimal("2.344")], "decimal(10,3)", R.money)
    assert got == [Decimal("2.35"), Decimal("-2.35"), Decimal("2.34")]


def test_days_between_propagates_null(spark):
    df = spark.createDataFrame([("2020-01-10", "2020-01-01"), (None, "2020-01-01")], "a string, b string")
    got = [r[0] for r in df.select(R.days_between(F.to_date("a"), F.to_date("b"))).collect()]
    assert got == [9, None]


def test_calendar_span_and_parts(spark):
    cal = calendar_dim(spark, "1996-01-01", "2035-12-31")
    assert cal.count() == 14610
    row = cal.filter(F.col("date") == F.to_date(F.lit("1996-01-06"))).first()
    assert (row.time_key, row.quarter, row.weekday, row.is_weekend, row.month_name) == \
        (19960106, 1, "Saturday", True, "January")


def test_surrogate_key_is_deterministic_and_null_safe(spark):
    df = spark.createDataFrame([("A", "1"), ("A", None), ("A", "")], "s string, i string")
    keys = [r[0] for r in df.select(surrogate_key("s", "i")).collect()]
    assert len(set(keys)) == 3 and all(k > 0 for k in keys)                 # null is told from empty
    assert keys == [r[0] for r in df.select(surrogate_key("s", "i")).collect()]
