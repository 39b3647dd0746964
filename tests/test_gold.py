"""Result tables against plain SQL on rows that the test tables do not hold: customers held twice
or not at all, orders shared by customers, one frequent customer, months without sales."""

import datetime as dt
import random
from collections import Counter

import duckdb
import pandas as pd
import pytest

from checks.mapping import RULES
from checks.oracles import GOLD
from ordstrata.plans import gold

LINES = (
    "ID_CLIENTE bigint, ID_PEDIDO bigint, DEPARTAMENTO string, PARCELADO boolean, DATA_PEDIDO date,"
    " STATUS_PAGAMENTO string, VALOR_TOTAL decimal(18,4), ANO bigint, MES bigint, SEMESTRE bigint"
)
CUSTOMERS = "ID_CLIENTE bigint, NOME string, PERMISSAO_RECEBE_EMAIL boolean, DATA_CADASTRO date"

BUILDS = {
    "gold_orders_by_semester": gold.orders_by_semester,
    "gold_avg_ticket_month": gold.avg_ticket_month,
    "gold_purchase_interval": gold.purchase_interval,
    "gold_monthly_tiers": lambda o, c: gold.monthly_tiers(o, c, (300, 750, 1500)),
    "gold_category_yoy": lambda o, c: gold.category_yoy(o, RULES.categories, RULES.years),
    "gold_cancellation_rate": lambda o, c: gold.cancellation_rate(o),
    "gold_weekday_volume": lambda o, c: gold.weekday_volume(o),
    "gold_optin_impact": gold.optin_impact,
    "gold_retention": lambda o, c: gold.retention(o, c, RULES.years),
    "gold_base_growth": lambda o, c: gold.base_growth(c),
}


def line(customer, order, day, value, status="CONFIRMADO", department="PROMO", instalments=False):
    day = dt.date.fromisoformat(day) if isinstance(day, str) else day
    period = (day.year, day.month, 1 if day.month <= 6 else 2)
    return (customer, order, department, instalments, day, status, round(value, 2), *period)


def made_up(seed):
    chance = random.Random(seed)
    lines = []
    for _ in range(600):
        customer = 1 if chance.random() < 0.4 else chance.randrange(30)
        order = chance.randrange(3) if chance.random() < 0.2 else chance.randrange(200)
        day = dt.date(1995, 12, 20) + dt.timedelta(days=chance.randrange(900))
        status = chance.choice(["CONFIRMADO", "CONFIRMADO", "CANCELADO"])
        department = chance.choice(["PROMO", "SMALL", "LARGE"])
        value = chance.randrange(1, 100000) / 100
        lines.append(line(customer, order, day, value, status, department, chance.random() < 0.05))
    people = []
    for _ in range(40):
        key = chance.randrange(25)
        joined = None if chance.random() < 0.1 else dt.date(1995, 1 + chance.randrange(12), 3)
        people.append((key, chance.choice(["Ana", "Rui", None]), chance.choice([True, False, None]), joined))
    return lines, people


def frames(spark, lines, people):
    text = LINES.replace("decimal(18,4)", "double")
    orders = spark.createDataFrame([(*r[:6], float(r[6]), *r[7:]) for r in lines], text)
    orders = orders.withColumn("VALOR_TOTAL", orders.VALOR_TOTAL.cast("decimal(18,4)"))
    return orders, spark.createDataFrame(people, CUSTOMERS)


def expected(key, lines, people):
    connection = duckdb.connect()
    columns = [c.strip().split(" ")[0] for c in LINES.replace("decimal(18,4)", "decimal").split(",")]
    orders = pd.DataFrame(lines, columns=columns)  # noqa: F841
    known = pd.DataFrame(people, columns=[c.strip().split(" ")[0] for c in CUSTOMERS.split(",")])  # noqa: F841
    connection.execute("""CREATE TABLE lines AS SELECT * REPLACE (CAST(VALOR_TOTAL AS DECIMAL(14,2))
      AS VALOR_TOTAL, CAST(DATA_PEDIDO AS DATE) AS DATA_PEDIDO) FROM orders""")
    connection.execute("CREATE VIEW conf AS SELECT * FROM lines WHERE STATUS_PAGAMENTO = 'CONFIRMADO'")
    connection.execute("""CREATE TABLE customers AS SELECT * REPLACE (CAST(DATA_CADASTRO AS DATE)
      AS DATA_CADASTRO, CAST(PERMISSAO_RECEBE_EMAIL AS BOOLEAN) AS PERMISSAO_RECEBE_EMAIL) FROM known""")
    sql = GOLD[key]
    for fixture, small in zip(RULES.tier_limits, (300, 750, 1500)):
        sql = sql.replace(f"VALOR < {fixture} ", f"VALOR < {small} ")
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return names, Counter(result.fetchall())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("key", BUILDS)
def test_same_as_plain_sql(spark, key, seed):
    lines, people = made_up(seed)
    names, want = expected(key, lines, people)
    rows = BUILDS[key](*frames(spark, lines, people)).select(*names)
    assert Counter(map(tuple, rows.collect())) == want


def build(spark, key, lines, people=((1, "Ana", None, dt.date(2020, 1, 1)),)):
    return BUILDS[key](*frames(spark, list(lines), list(people)))


def test_one_purchase_has_no_interval(spark):
    lines = [line(1, 1, "1996-05-01", 10), line(1, 2, "1996-05-01", 10)]
    assert build(spark, "gold_purchase_interval", lines).count() == 0


def test_interval_across_new_year_belongs_to_the_later_year(spark):
    lines = [line(1, 1, "1996-12-31", 10), line(1, 2, "1997-01-01", 10), line(1, 3, "1997-01-04", 10)]
    [row] = build(spark, "gold_purchase_interval", lines).collect()
    assert tuple(row) == (1, "Ana", 1997, 2, 2.0, 1, 3)


def test_zero_base_year_has_no_percentage(spark):
    [row] = build(spark, "gold_category_yoy", [line(1, 1, "1997-02-01", 10)]).collect()
    assert tuple(row) == ("PROMO", 0.0, 10.0, 10.0, None)


def test_unknown_consent_counts_as_none_and_unknown_customers_are_left_out(spark):
    lines = [line(1, 1, "1996-02-01", 10), line(2, 2, "1996-02-01", 99)]
    [row] = build(spark, "gold_optin_impact", lines).collect()
    assert tuple(row) == ("Não aceita e-mail", 1, 1, 10.0, 10.0, 100.0)


def test_unknown_customers_keep_their_orders_without_a_name(spark):
    [row] = build(spark, "gold_avg_ticket_month", [line(2, 1, "1996-02-01", 10.01), line(2, 2, "1996-02-01", 10)]).collect()
    assert tuple(row) == (2, None, 1996, 2, "1996-02", 2, 20.01, 10.01)


def test_semester_counts_all_orders_of_instalment_customers(spark):
    lines = [line(1, 1, "1996-02-01", 10, instalments=True), line(1, 2, "1997-08-01", 5), line(2, 3, "1996-02-01", 7)]
    rows = build(spark, "gold_orders_by_semester", lines).orderBy("ANO").collect()
    assert [tuple(r) for r in rows] == [
        (1, "Ana", 1996, 1, "1996 - S1", 1, 10.0),
        (1, "Ana", 1997, 2, "1997 - S2", 1, 5.0),
    ]


def test_default_rules_and_column_names(spark):
    rules = gold.Rules()
    assert (rules.years, rules.categories, rules.tier_limits) == ((2019, 2020), ("SOM", "PAPELARIA"), (1000, 2000, 5000))
    orders, people = frames(spark, [line(1, 1, "2019-05-01", 10, department="SOM")], [(1, "Ana", True, None)])
    assert gold.category_yoy(orders).columns[1:3] == ["TOTAL_2019", "TOTAL_2020"]
    [row] = gold.retention(orders, people).collect()
    assert row.asDict() == dict(NOME="Ana", ID_CLIENTE=1, PERFIL_RETENCAO="Apenas 2019", COMPROU_2019=True, COMPROU_2020=False)


def test_invariants(spark):
    lines, people = made_up(3)
    shares = build(spark, "gold_weekday_volume", lines, people).collect()
    assert abs(sum(r.PCT_DO_TOTAL for r in shares) - 100) < 0.5
    rates = build(spark, "gold_cancellation_rate", lines, people).collect()
    assert all(r.CONFIRMADOS + r.CANCELADOS == r.TOTAL_PEDIDOS for r in rates)
    growth = build(spark, "gold_base_growth", lines, people).orderBy("ANO", "MES").collect()
    assert growth[-1].TOTAL_ACUMULADO == sum(r.NOVOS_CLIENTES for r in growth)
