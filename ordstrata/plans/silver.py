"""One load of the history to typed, cleaned rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.functions.dates import (
    half_of_month,
    month_of,
    parse_dmy,
    try_parse_dmy,
    year_of,
    years_crossed,
)
from ordstrata.functions.numbers import MONEY, money, try_money, try_whole, whole
from ordstrata.functions.text import (
    all_digits,
    clean_lower,
    clean_upper,
    initcap_words,
    is_blank,
    trim_ws,
)
from ordstrata.operators.lookups import keep_listed
from ordstrata.schemas import PROVENANCE_COLUMNS

# The codes of the 26 Brazilian states and the federal district, by state name.
STATES = [
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA",
    "PB", "PR", "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
]

LOAD_COLUMN = PROVENANCE_COLUMNS[0].name
CONFIRMED = "CONFIRMADO"
CANCELLED = "CANCELADO"


REASONS, SOURCE_ROW = "MOTIVOS", "BRUTO"


@dataclass(frozen=True)
class Casts:
    """How text becomes typed: strictly, so that the job fails at text that is no such value, or
    leniently, as NULL, with the names of the columns where that happened."""

    whole: Callable[[Column], Column]
    money: Callable[[Column], Column]
    date: Callable[[Column], Column]
    product: Callable[[Column, Column], Column]


STRICT = Casts(
    whole, money, parse_dmy, lambda n, price: (n.cast("decimal(18,0)") * price).cast(MONEY)
)
LENIENT = Casts(
    try_whole,
    try_money,
    try_parse_dmy,
    lambda n, price: F.try_multiply(n.try_cast("decimal(18,0)"), price).try_cast(MONEY),
)


def _failures(casts: dict[str, Callable[[Column], Column]]) -> Column:
    """The names, in order, of the columns whose text is given and no value of their type."""
    named = [
        F.when(F.col(name).isNotNull() & cast(F.col(name)).isNull(), F.lit(name))
        for name, cast in casts.items()
    ]
    return F.array_compact(F.array(*named))


def _checked(load: DataFrame, reasons: Column) -> DataFrame:
    """``load`` with its failures and the row as it came."""
    row = F.struct(*(c for c in load.columns if c != LOAD_COLUMN))
    return load.withColumns({REASONS: reasons, SOURCE_ROW: row})


def _only_failed(rows: DataFrame) -> DataFrame:
    """The row as it came only where something failed."""
    return rows.withColumn(SOURCE_ROW, F.when(F.size(REASONS) > 0, F.col(SOURCE_ROW)))


def silver_customers(load: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Typed customers of one load.

    Impossible dates, cities that are blank, ``.`` or digits, and unknown state codes become NULL.
    The age counts the New Years since birth up to ``as_of`` (default: today).
    """
    return _customers(load, as_of, STRICT)


def checked_customers(load: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """:func:`silver_customers` that never fails: ``MOTIVOS`` names the columns whose text is no
    value of their type, which are NULL, and ``BRUTO`` holds the row as it came where there are any.
    """
    reasons = _failures({"ID": try_whole, "RECEBE_EMAIL": try_whole})
    return _only_failed(
        _customers(_checked(load, reasons), as_of, LENIENT, (REASONS, SOURCE_ROW))
    )


def _customers(
    load: DataFrame, as_of: dt.date | None, casts: Casts, more: Sequence[str] = ()
) -> DataFrame:
    today = F.current_date() if as_of is None else F.lit(as_of)
    city = trim_ws(F.col("CIDADE"))
    no_city = city.isin("", ".") | all_digits(city)
    typed = load.filter(~is_blank(F.col("ID"))).select(
        casts.whole(F.col("ID")).alias("ID_CLIENTE"),
        clean_lower(F.col("EMAIL")).alias("EMAIL"),
        initcap_words(trim_ws(F.col("NOME"))).alias("NOME"),
        try_parse_dmy(F.col("DT_NASC")).alias("DATA_NASCIMENTO"),
        trim_ws(F.col("SEXO")).alias("SEXO"),
        try_parse_dmy(F.col("CADASTRO")).alias("DATA_CADASTRO"),
        F.when(~no_city, F.upper(city)).alias("CIDADE"),
        keep_listed(trim_ws(F.col("ESTADO")), STATES).alias("UF"),
        (casts.whole(F.col("RECEBE_EMAIL")) == 1).alias("PERMISSAO_RECEBE_EMAIL"),
        "DT_CARGA",
        *more,
    )
    age = years_crossed(today, F.col("DATA_NASCIMENTO"))
    return typed.withColumn("IDADE", age).select(
        "ID_CLIENTE",
        "EMAIL",
        "NOME",
        "DATA_NASCIMENTO",
        "IDADE",
        "SEXO",
        "DATA_CADASTRO",
        "CIDADE",
        "UF",
        "PERMISSAO_RECEBE_EMAIL",
        "DT_CARGA",
        *more,
    )


def silver_orders(load: DataFrame) -> DataFrame:
    """Typed order lines of one load: decided payments with a price above zero.

    The grain stays the order line. Missing, blank or zero instalments count as one payment.
    """
    return _orders(load, STRICT)


def _instalments(cast: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Blank text is no instalments, not a failure."""
    return lambda text: F.when(is_blank(text), F.lit(0).cast("bigint")).otherwise(cast(text))


def checked_orders(load: DataFrame) -> DataFrame:
    """:func:`silver_orders` that never fails: ``MOTIVOS`` names the columns whose text is no value of
    their type, which are NULL, and ``BRUTO`` holds the line as it came where there are any. Lines
    of undecided payments are left out unseen, as there; a line whose price is no number is not."""
    wholes = ("COD_CLIENTE", "COD_PEDIDO", "CODIGO_PRODUTO", "QUANTIDADE")
    reasons = _failures(
        {
            **dict.fromkeys(wholes, try_whole),
            "VALOR_UNITARIO": try_money,
            "QTD_PARCELAS": _instalments(try_whole),
            "DT_PEDIDO": try_parse_dmy,
        }
    )
    typed = _orders(_checked(load, reasons), LENIENT, (REASONS, SOURCE_ROW))
    too_large = F.col("VALOR_TOTAL").isNull() & F.col("QUANTIDADE").isNotNull()
    too_large = too_large & F.col("VALOR_UNITARIO").isNotNull()
    more = F.when(too_large, F.array(F.lit("VALOR_TOTAL"))).otherwise(F.array().cast("array<string>"))
    return _only_failed(typed.withColumn(REASONS, F.concat(REASONS, more)))


def _orders(load: DataFrame, casts: Casts, more: Sequence[str] = ()) -> DataFrame:
    status = clean_upper(F.col("STATUS_PAGAMENTO"))
    price = casts.money(F.col("VALOR_UNITARIO"))
    sold = price > 0
    if more:
        sold = sold | F.array_contains(REASONS, "VALOR_UNITARIO")
    instalments = F.when(is_blank(F.col("QTD_PARCELAS")), None).otherwise(
        casts.whole(F.col("QTD_PARCELAS"))
    )
    typed = load.filter(status.isin(CONFIRMED, CANCELLED) & sold).select(
        casts.whole(F.col("COD_CLIENTE")).alias("ID_CLIENTE"),
        casts.whole(F.col("COD_PEDIDO")).alias("ID_PEDIDO"),
        casts.whole(F.col("CODIGO_PRODUTO")).alias("ID_PRODUTO"),
        clean_upper(F.col("DEPTO")).alias("DEPARTAMENTO"),
        casts.whole(F.col("QUANTIDADE")).alias("QUANTIDADE"),
        price.alias("VALOR_UNITARIO"),
        F.coalesce(instalments, F.lit(0)).alias("INFORMADAS"),
        casts.date(F.col("DT_PEDIDO")).alias("DATA_PEDIDO"),
        clean_upper(F.col("MEIO_PAGTO")).alias("MEIO_PAGAMENTO"),
        status.alias("STATUS_PAGAMENTO"),
        "DT_CARGA",
        *more,
    )
    total = casts.product(F.col("QUANTIDADE"), F.col("VALOR_UNITARIO"))
    month = month_of(F.col("DATA_PEDIDO"))
    given = F.col("INFORMADAS")
    return typed.select(
        "ID_CLIENTE",
        "ID_PEDIDO",
        "ID_PRODUTO",
        "DEPARTAMENTO",
        "QUANTIDADE",
        "VALOR_UNITARIO",
        F.when(given == 0, F.lit(1)).otherwise(given).cast("bigint").alias("PARCELAS"),
        "DATA_PEDIDO",
        "MEIO_PAGAMENTO",
        "STATUS_PAGAMENTO",
        total.alias("VALOR_TOTAL"),
        (given > 1).alias("PARCELADO"),
        year_of(F.col("DATA_PEDIDO")).alias("ANO"),
        month.alias("MES"),
        half_of_month(month).alias("SEMESTRE"),
        "DT_CARGA",
        *more,
    )
