"""What counts as a defect in the two staged files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.functions.dates import try_parse_dmy
from ordstrata.functions.numbers import money, whole
from ordstrata.functions.text import all_digits, clean_upper, is_blank, trim_ws
from ordstrata.operators.lookups import keep_listed
from ordstrata.operators.quality import quality_report
from ordstrata.plans.silver import CONFIRMED, STATES

PENDING = "PENDENTE"


def _missing(name: str) -> Column:
    return F.coalesce(is_blank(F.col(name)), F.lit(True))


def _no_date(name: str) -> Column:
    return ~is_blank(F.col(name)) & try_parse_dmy(F.col(name)).isNull()


def customer_quality(stage: DataFrame) -> DataFrame:
    """Defects of the staged customers; a customer's key is the trimmed id."""
    city = trim_ws(F.col("CIDADE"))
    rules = {
        "blank_id": _missing("ID"),
        "impossible_birth_date": _no_date("DT_NASC"),
        "impossible_signup_date": _no_date("CADASTRO"),
        "no_city": city.isNull() | city.isin("", ".") | all_digits(city),
        "unknown_state": keep_listed(trim_ws(F.col("ESTADO")), STATES).isNull(),
        "no_sex": _missing("SEXO"),
    }
    return quality_report(stage, rules, [trim_ws(F.col("ID"))])


def order_quality(stage: DataFrame) -> DataFrame:
    """Defects of the staged order lines; a line's key is order and product."""
    status, price = clean_upper(F.col("STATUS_PAGAMENTO")), money(F.col("VALOR_UNITARIO"))
    blank = _missing("QTD_PARCELAS")
    rules = {
        "blank_customer": _missing("COD_CLIENTE"),
        "pending": status == PENDING,
        "negative_price": price < 0,
        "confirmed_at_zero": (status == CONFIRMED) & (price == 0),
        "zero_instalments": F.when(~blank, whole(F.col("QTD_PARCELAS"))) == 0,
        "no_instalments": blank,
    }
    return quality_report(stage, rules, [F.col("COD_PEDIDO"), F.col("CODIGO_PRODUTO")])
