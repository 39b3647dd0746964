"""Silver tables to result tables.

Every plan groups the order lines first, with map-side partial aggregates, and joins customers to
the totals. A distinct count of orders first shuffles by group *and* order, so a customer or
department that holds a large share of all lines is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.functions.dates import (
    days_between,
    month_of,
    weekday_name,
    weekday_number,
    year_of,
)
from ordstrata.functions.numbers import percent, percent_change, ratio, rounded
from ordstrata.functions.text import year_half, year_month
from ordstrata.operators.aggregates import (
    any_where,
    count_where,
    pivot_sums,
    rows_counted,
    sum_where,
)
from ordstrata.operators.lookups import with_dimension
from ordstrata.operators.windows import any_in_key, grand_total, previous, running_total
from ordstrata.plans.silver import CANCELLED, CONFIRMED


@dataclass(frozen=True)
class Rules:
    """Fixed values of the result tables; the defaults are those of the original job."""

    years: tuple[int, int] = (2019, 2020)
    categories: tuple[str, ...] = ("SOM", "PAPELARIA")
    tier_limits: tuple[int, int, int] = (1000, 2000, 5000)
    year_boundaries: tuple[int, ...] = (2019, 2020, 2021, 2022, 2023, 2024, 2025)


# The labels in the result tables.
TIERS = ("Básico", "Prata", "Ouro", "Super")
OPTED_IN = "Aceita e-mail"
NOT_OPTED_IN = "Não aceita e-mail"
BOTH_YEARS = "Recorrente ({} e {})"
ONE_YEAR = "Apenas {}"


def confirmed(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("STATUS_PAGAMENTO") == CONFIRMED)


def orders_by_semester(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Confirmed orders per half-year of the customers with at least one instalment order.

    All confirmed orders of these customers count, not only those in instalments. Whether a
    customer belongs is read off the grouped rows, which saves a second scan of the order lines.
    """
    halves = (
        confirmed(orders)
        .groupBy("ID_CLIENTE", "ANO", "SEMESTRE")
        .agg(
            F.countDistinct("ID_PEDIDO").alias("QTD_PEDIDOS"),
            F.sum("VALOR_TOTAL").alias("VALOR"),
            F.max("PARCELADO").alias("PARCELOU"),
        )
        .withColumn("PARCELOU", any_in_key("PARCELOU", "ID_CLIENTE"))
        .filter("PARCELOU")
    )
    return with_dimension(halves, customers, "ID_CLIENTE", ["NOME"], ["VALOR"]).select(
        "ID_CLIENTE",
        "NOME",
        "ANO",
        "SEMESTRE",
        year_half(F.col("ANO"), F.col("SEMESTRE")).alias("ANO_SEMESTRE"),
        "QTD_PEDIDOS",
        rounded(F.col("VALOR"), 2).alias("VALOR_TOTAL_PERIODO"),
    )


def avg_ticket_month(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, total and total per order of each customer and month."""
    months = (
        confirmed(orders)
        .groupBy("ID_CLIENTE", "ANO", "MES")
        .agg(F.countDistinct("ID_PEDIDO").alias("QTD_PEDIDOS"), F.sum("VALOR_TOTAL").alias("VALOR"))
    )
    return with_dimension(months, customers, "ID_CLIENTE", ["NOME"], ["VALOR"]).select(
        "ID_CLIENTE",
        "NOME",
        "ANO",
        "MES",
        year_month(F.col("ANO"), F.col("MES")).alias("ANO_MES"),
        "QTD_PEDIDOS",
        rounded(F.col("VALOR"), 2).alias("VALOR_TOTAL"),
        ratio(F.col("VALOR"), F.col("QTD_PEDIDOS"), 2).alias("TICKET_MEDIO"),
    )


def purchase_interval(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Days between the purchase dates of a customer, by the year of the later date.

    The window sees the distinct dates of a customer, which are few whatever the number of lines.
    """
    dates = confirmed(orders).select("ID_CLIENTE", "ANO", "DATA_PEDIDO").distinct()
    gaps = dates.withColumn("ANTERIOR", previous("DATA_PEDIDO", "ID_CLIENTE")).filter(
        F.col("ANTERIOR").isNotNull()
    )
    days = days_between(F.col("DATA_PEDIDO"), F.col("ANTERIOR"))
    years = (
        gaps.withColumn("DIAS", days)
        .groupBy("ID_CLIENTE", "ANO")
        .agg(
            rows_counted().alias("QTD_INTERVALOS"),
            ratio(F.sum("DIAS"), rows_counted(), 1).alias("INTERVALO_MEDIO_DIAS"),
            F.min("DIAS").alias("MENOR_INTERVALO_DIAS"),
            F.max("DIAS").alias("MAIOR_INTERVALO_DIAS"),
        )
    )
    return with_dimension(years, customers, "ID_CLIENTE", ["NOME"], ["QTD_INTERVALOS"]).select(
        "ID_CLIENTE",
        "NOME",
        "ANO",
        "QTD_INTERVALOS",
        "INTERVALO_MEDIO_DIAS",
        "MENOR_INTERVALO_DIAS",
        "MAIOR_INTERVALO_DIAS",
    )


def tier(value: Column, limits: Sequence[int]) -> Column:
    """Name of the tier; a value at a limit belongs to the tier above it."""
    low, middle, high = limits
    return (
        F.when(value < low, TIERS[0])
        .when(value < middle, TIERS[1])
        .when(value < high, TIERS[2])
        .otherwise(TIERS[3])
    )


def monthly_tiers(
    orders: DataFrame, customers: DataFrame, limits: Sequence[int] = Rules.tier_limits
) -> DataFrame:
    """Tier of each customer and month by the rounded value of the confirmed orders."""
    months = (
        confirmed(orders)
        .groupBy("ID_CLIENTE", "ANO", "MES")
        .agg(F.round(F.sum("VALOR_TOTAL"), 2).alias("VALOR_MES"))
    )
    return months.join(customers.select("ID_CLIENTE", "NOME"), "ID_CLIENTE", "left").select(
        "ID_CLIENTE",
        "NOME",
        "ANO",
        "MES",
        year_month(F.col("ANO"), F.col("MES")).alias("ANO_MES"),
        F.col("VALOR_MES").cast("double").alias("VALOR_MES"),
        tier(F.col("VALOR_MES"), limits).alias("TIER"),
    )


def category_yoy(
    orders: DataFrame,
    categories: Sequence[str] = Rules.categories,
    years: Sequence[int] = Rules.years,
) -> DataFrame:
    """Confirmed totals of the categories in two years side by side, and their change.

    A year without sales is 0, and a change from 0 has no percentage.
    """
    first, second = (f"TOTAL_{year}" for year in years)
    yearly = (
        confirmed(orders)
        .filter(F.col("DEPARTAMENTO").isin(*categories) & F.col("ANO").isin(*years))
        .groupBy("DEPARTAMENTO", "ANO")
        .agg(F.round(F.sum("VALOR_TOTAL"), 2).alias("TOTAL_VENDAS"))
    )
    totals = pivot_sums(
        yearly, ["DEPARTAMENTO"], "ANO", "TOTAL_VENDAS", dict(zip(years, (first, second)))
    )
    change = F.col(second) - F.col(first)
    return totals.select(
        "DEPARTAMENTO",
        F.col(first).cast("double").alias(first),
        F.col(second).cast("double").alias(second),
        rounded(change, 2).alias("VARIACAO_ABSOLUTA"),
        percent_change(F.col(first), F.col(second), 2).alias("VARIACAO_PERCENTUAL"),
    )


def cancellation_rate(orders: DataFrame) -> DataFrame:
    """Order lines, share cancelled, revenue kept and lost per department."""
    status, value = F.col("STATUS_PAGAMENTO"), F.col("VALOR_TOTAL")
    return (
        orders.groupBy("DEPARTAMENTO")
        .agg(
            rows_counted().alias("TOTAL_PEDIDOS"),
            count_where(status == CONFIRMED).alias("CONFIRMADOS"),
            count_where(status == CANCELLED).alias("CANCELADOS"),
            rounded(sum_where(status == CONFIRMED, value), 2).alias("RECEITA_CONFIRMADA"),
            rounded(sum_where(status == CANCELLED, value), 2).alias("RECEITA_PERDIDA"),
        )
        .select(
            "DEPARTAMENTO",
            "TOTAL_PEDIDOS",
            "CONFIRMADOS",
            "CANCELADOS",
            percent(F.col("CANCELADOS"), F.col("TOTAL_PEDIDOS"), 1).alias("PCT_CANCELAMENTO"),
            "RECEITA_CONFIRMADA",
            "RECEITA_PERDIDA",
        )
    )


def weekday_volume(orders: DataFrame) -> DataFrame:
    """Confirmed orders, revenue, value per line and share of all orders per weekday."""
    days = (
        confirmed(orders)
        .groupBy(weekday_number(F.col("DATA_PEDIDO")).alias("NUM_DIA"))
        .agg(
            weekday_name(F.min("DATA_PEDIDO")).alias("DIA_SEMANA"),
            F.countDistinct("ID_PEDIDO").alias("QTD_PEDIDOS"),
            F.sum("VALOR_TOTAL").alias("RECEITA"),
            rows_counted().alias("LINHAS"),
        )
    )
    return days.select(
        "DIA_SEMANA",
        "NUM_DIA",
        "QTD_PEDIDOS",
        rounded(F.col("RECEITA"), 2).alias("RECEITA_TOTAL"),
        ratio(F.col("RECEITA"), F.col("LINHAS"), 2).alias("TICKET_MEDIO"),
        percent(F.col("QTD_PEDIDOS"), grand_total("QTD_PEDIDOS"), 1).alias("PCT_DO_TOTAL"),
    )


def optin_impact(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, orders, revenue and value per line by consent to e-mail.

    Lines of unknown customers are left out; unknown consent counts as none. Lines are first
    summed per customer and order. A customer with very many orders makes one partition of the
    join large, which adaptive execution splits.
    """
    per_order = (
        confirmed(orders)
        .groupBy("ID_CLIENTE", "ID_PEDIDO")
        .agg(F.sum("VALOR_TOTAL").alias("VALOR"), rows_counted().alias("LINHAS"))
    )
    consent = F.when(F.col("PERMISSAO_RECEBE_EMAIL"), OPTED_IN).otherwise(NOT_OPTED_IN)
    consents = customers.select("ID_CLIENTE", consent.alias("PERMISSAO_EMAIL"))
    groups = (
        with_dimension(
            per_order, consents, "ID_CLIENTE", ["PERMISSAO_EMAIL"], ["VALOR", "LINHAS"], "inner"
        )
        .groupBy("PERMISSAO_EMAIL")
        .agg(
            F.countDistinct("ID_CLIENTE").alias("QTD_CLIENTES"),
            F.countDistinct("ID_PEDIDO").alias("QTD_PEDIDOS"),
            F.sum("VALOR").alias("RECEITA"),
            F.sum("LINHAS").alias("LINHAS"),
        )
        .withColumn("MEDIA", F.col("RECEITA").cast("double") / F.col("LINHAS"))
    )
    share = F.lit(100) * F.col("MEDIA") / grand_total("MEDIA")
    return groups.select(
        "PERMISSAO_EMAIL",
        "QTD_CLIENTES",
        "QTD_PEDIDOS",
        rounded(F.col("RECEITA"), 2).alias("RECEITA_TOTAL"),
        ratio(F.col("RECEITA"), F.col("LINHAS"), 2).alias("TICKET_MEDIO"),
        rounded(share, 1).alias("PCT_TICKET_RELATIVO"),
    )


def retention(
    orders: DataFrame, customers: DataFrame, years: Sequence[int] = Rules.years
) -> DataFrame:
    """Customers with a confirmed order in either of two years, and in which of them."""
    first, second = years
    in_first, in_second = f"COMPROU_{first}", f"COMPROU_{second}"
    bought = (
        confirmed(orders)
        .filter(F.col("ANO").isin(*years))
        .groupBy("ID_CLIENTE")
        .agg(
            any_where(F.col("ANO") == first).alias(in_first),
            any_where(F.col("ANO") == second).alias(in_second),
        )
    )
    profile = (
        F.when(F.col(in_first) & F.col(in_second), BOTH_YEARS.format(first, second))
        .when(F.col(in_first), ONE_YEAR.format(first))
        .when(F.col(in_second), ONE_YEAR.format(second))
    )
    return bought.join(customers.select("ID_CLIENTE", "NOME"), "ID_CLIENTE", "left").select(
        "NOME", "ID_CLIENTE", profile.alias("PERFIL_RETENCAO"), in_first, in_second
    )


def base_growth(customers: DataFrame) -> DataFrame:
    """New customers per month with their running total."""
    signed_up = F.col("DATA_CADASTRO")
    months = (
        customers.filter(signed_up.isNotNull())
        .groupBy(year_of(signed_up).alias("ANO"), month_of(signed_up).alias("MES"))
        .agg(rows_counted().alias("NOVOS_CLIENTES"))
    )
    return months.select(
        "ANO",
        "MES",
        year_month(F.col("ANO"), F.col("MES")).alias("ANO_MES"),
        "NOVOS_CLIENTES",
        running_total(["ANO", "MES"], "NOVOS_CLIENTES").alias("TOTAL_ACUMULADO"),
    )


@dataclass(frozen=True)
class GoldTable:
    """A result table: how to build it from silver orders and customers, and how to store it."""

    build: Callable[[DataFrame, DataFrame, Rules], DataFrame]
    comment: str
    cluster_by: tuple[str, ...] = ()
    by_year: bool = False
    order_by: str | None = None
    ascending: bool = True

    def ordered(self, rows: DataFrame) -> DataFrame:
        """Rows in the order of the report; the stored table has no order."""
        if self.order_by is None:
            return rows
        return rows.orderBy(self.order_by, ascending=self.ascending)


GOLD_TABLES = {
    "pedidos_por_cliente_semestre": GoldTable(
        lambda o, c, rules: orders_by_semester(o, c),
        "Orders per half-year of customers who pay in instalments",
        ("ID_CLIENTE",),
        True,
    ),
    "ticket_medio_cliente_ano_mes": GoldTable(
        lambda o, c, rules: avg_ticket_month(o, c),
        "Average order value per customer and month",
        ("ID_CLIENTE",),
        True,
    ),
    "intervalo_medio_compras": GoldTable(
        lambda o, c, rules: purchase_interval(o, c),
        "Days between the purchases of a customer, per year",
        ("ID_CLIENTE",),
        True,
    ),
    "tiers_clientes": GoldTable(
        lambda o, c, rules: monthly_tiers(o, c, rules.tier_limits),
        "Tier of each customer and month",
        ("ID_CLIENTE", "TIER"),
        True,
    ),
    "comparativo_som_papelaria": GoldTable(
        lambda o, c, rules: category_yoy(o, rules.categories, rules.years),
        "Change of category sales between two years",
    ),
    "cancelamento_por_departamento": GoldTable(
        lambda o, c, rules: cancellation_rate(o),
        "Cancellations per department",
        order_by="PCT_CANCELAMENTO",
        ascending=False,
    ),
    "pedidos_por_dia_semana": GoldTable(
        lambda o, c, rules: weekday_volume(o), "Confirmed orders per weekday", order_by="NUM_DIA"
    ),
    "impacto_permissao_email": GoldTable(
        lambda o, c, rules: optin_impact(o, c),
        "Purchases by consent to e-mail",
        order_by="TICKET_MEDIO",
        ascending=False,
    ),
    "retencao_clientes": GoldTable(
        lambda o, c, rules: retention(o, c, rules.years), "Customers kept between two years"
    ),
    "crescimento_base_clientes": GoldTable(
        lambda o, c, rules: base_growth(c), "New customers per month"
    ),
}
