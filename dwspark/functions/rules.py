"""Business rules as Column expressions (no Python UDFs).

Every function returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES -- labels and limits that must equal the reference's output.
# ---------------------------------------------------------------------------
SALE_TYPE_LABELS = {1: "À vista", 2: "Prazo", 3: "Cartão"}
PHONE_TYPE_LABELS = {1: "Residencial", 2: "Comercial", 3: "Celular"}
INCOME_BANDS = [  # (upper limit, exclusive), label; last one has no limit
    (2000, "Até 2 mil"),
    (5000, "2 a 5 mil"),
    (10000, "5 a 10 mil"),
    (20000, "10 a 20 mil"),
    (None, "Acima de 20 mil"),
]
AGE_BANDS = [  # (upper limit, inclusive), label; last one has no limit
    (25, "18-25"),
    (35, "26-35"),
    (45, "36-45"),
    (60, "46-60"),
    (None, "60+"),
]
MONTH_LABELS = ["Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
                "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]
PERSON_TYPE_COMPANY = "Jurídica"
PERSON_TYPE_PERSON = "Física"
CURRENCY_WHOLESALE = "USD"
CURRENCY_RETAIL = "BRL"
NOT_INFORMED = "Não informado"
STATE_CODE_DEFAULT = "NA"
RETAIL_COUNTRY = "Brasil"
ADDRESS_TYPE_HOME = "Residencial"
ADDRESS_TYPE_BUSINESS = "Comercial"
UNKNOWN_KEY = -1
UNKNOWN_NAME = "Não aplicável"
UNKNOWN_SOURCE = "N/A"
# ---------------------------------------------------------------------------

MONEY = "decimal(15,2)"
RATE = "decimal(6,4)"


def money(c: Column) -> Column:
    """Round half away from zero to 2 dp and store as NUMERIC(15,2)."""
    return F.round(c, 2).cast(MONEY)


def decode(code: Column, labels: dict[int, str]) -> Column:
    """Code -> label; unmapped codes and NULL give NULL."""
    out = None
    for k, v in labels.items():
        out = (F.when(code == k, F.lit(v)) if out is None
               else out.when(code == k, F.lit(v)))
    return out


def sale_type(code: Column) -> Column:
    return decode(code, SALE_TYPE_LABELS)


def phone_type(code: Column) -> Column:
    return decode(code, PHONE_TYPE_LABELS)


def address_type(code: Column) -> Column:
    return F.when(code == 1, F.lit(ADDRESS_TYPE_HOME)).otherwise(F.lit(ADDRESS_TYPE_BUSINESS))


def income_band(income: Column) -> Column:
    """Half-open bands on income; NULL stays NULL."""
    out = None
    for limit, label in INCOME_BANDS:
        cond = F.lit(True) if limit is None else (income < limit)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(income.isNull(), F.lit(None).cast("string")).otherwise(out)


def _age_band(age: Column) -> Column:
    out = None
    for limit, label in AGE_BANDS:
        cond = F.lit(True) if limit is None else (age <= limit)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(age.isNull(), F.lit(None).cast("string")).otherwise(out)


def age_band_from_year(birth_year: Column, as_of: Column) -> Column:
    """Age = year(as_of) - birth year (the corporate layer keeps the year only)."""
    return _age_band(F.year(as_of) - birth_year)


def age_band_from_date(birth_date: Column, as_of: Column) -> Column:
    """Age = whole days between birth and as_of, divided by 365, floored."""
    return _age_band(F.floor(F.datediff(as_of, birth_date) / F.lit(365)))


def month_label(month: Column) -> Column:
    return decode(month, {i + 1: m for i, m in enumerate(MONTH_LABELS)})


def or_default(c: Column, default: str) -> Column:
    """``x or default`` of the reference: NULL and '' both count as missing."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def phone_text(area_code: Column, number: Column) -> Column:
    """'(DDD) number'; NULL when either part is missing."""
    return F.concat(F.lit("("), area_code.cast("string"), F.lit(") "), number.cast("string"))


def currency_of(is_wholesale: Column) -> Column:
    """The one currency that a source's prices are in."""
    return F.when(is_wholesale, F.lit(CURRENCY_WHOLESALE)).otherwise(F.lit(CURRENCY_RETAIL))


def as_it_is(c: Column) -> Column:
    """The source's own value, cast at most."""
    return c


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days later - earlier as int; NULL if either is NULL."""
    return F.datediff(later, earlier)
