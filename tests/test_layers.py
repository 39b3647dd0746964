"""Raw and silver rules on inline rows."""

import datetime as dt

import pytest
from pyspark.errors import DateTimeException, NumberFormatException

from ordstrata.plans.raw import raw_customers, raw_orders
from ordstrata.plans.silver import silver_customers, silver_orders
from ordstrata.schemas import RAW_CUSTOMERS, RAW_ORDERS, STAGE_CUSTOMERS, STAGE_ORDERS, names

LOAD = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def customer(**fields):
    row = dict(ID="1", EMAIL="a@b.c", NOME="ana", DT_NASC="01/02/1990", SEXO="F", CADASTRO="03/04/2019")
    row |= dict(CIDADE="natal", ESTADO="RN", RECEBE_EMAIL="1") | fields
    return tuple(row.get(name) for name in names(STAGE_CUSTOMERS))


def order(**fields):
    row = dict(COD_CLIENTE="1", COD_PEDIDO="10", CODIGO_PRODUTO="100", DEPTO="som", QUANTIDADE="2")
    row |= dict(VALOR_UNITARIO="3.50", QTD_PARCELAS="1", DT_PEDIDO="05/07/2019", MEIO_PAGTO="pix")
    row |= dict(STATUS_PAGAMENTO="confirmado") | fields
    return tuple(row.get(name) for name in names(STAGE_ORDERS))


def customers(spark, *rows, as_of=dt.date(2024, 1, 1)):
    stage = spark.createDataFrame([customer(**r) for r in rows], STAGE_CUSTOMERS)
    return silver_customers(raw_customers(stage, LOAD, "file"), as_of)


def orders(spark, *rows):
    return silver_orders(raw_orders(spark.createDataFrame([order(**r) for r in rows], STAGE_ORDERS), LOAD, "file"))


def test_raw_columns(spark):
    assert raw_customers(spark.createDataFrame([], STAGE_CUSTOMERS), LOAD, "file").columns == names(RAW_CUSTOMERS)
    assert raw_orders(spark.createDataFrame([], STAGE_ORDERS), LOAD, "file").columns == names(RAW_ORDERS)


def test_customer_rules(spark):
    [row] = customers(spark, dict(ID=" 7\t", EMAIL=" A@B.C ", NOME=" maria-jose DA silva ", SEXO="F ")).collect()
    assert row.asDict() == dict(
        ID_CLIENTE=7,
        EMAIL="a@b.c",
        NOME="Maria-Jose Da Silva",
        DATA_NASCIMENTO=dt.date(1990, 2, 1),
        IDADE=34,
        SEXO="F",
        DATA_CADASTRO=dt.date(2019, 4, 3),
        CIDADE="NATAL",
        UF="RN",
        PERMISSAO_RECEBE_EMAIL=True,
        DT_CARGA=dt.datetime(2024, 1, 1),
    )


@pytest.mark.parametrize(
    "field, given, column, want",
    [
        ("CIDADE", ["", " ", ".", " . ", "123", " 45 ", "1a", None, "são luís"], "CIDADE", [None] * 6 + ["1A", None, "SÃO LUÍS"]),
        ("ESTADO", ["SP", " SP ", "sp", "MIN", "", None], "UF", ["SP", "SP", None, None, None, None]),
        ("RECEBE_EMAIL", ["1", "0", "2", " 1 ", None], "PERMISSAO_RECEBE_EMAIL", [True, False, False, True, None]),
        ("DT_NASC", ["31/12/2023", "29/02/1991", "", None], "IDADE", [1, None, None, None]),
        ("CADASTRO", ["31/04/2020", "1/2/2020"], "DATA_CADASTRO", [None, dt.date(2020, 2, 1)]),
    ],
)
def test_customer_values(spark, field, given, column, want):
    rows = customers(spark, *[{"ID": str(i), field: g} for i, g in enumerate(given)])
    assert [r[column] for r in rows.orderBy("ID_CLIENTE").collect()] == want


def test_customers_without_id_are_dropped(spark):
    assert customers(spark, *[dict(ID=i) for i in ("", " ", None, "ID", " ", "5")]).count() == 1


def test_age_defaults_to_today(spark):
    year = dt.datetime.now(dt.timezone.utc).year
    assert customers(spark, dict(DT_NASC=f"01/01/{year - 3}"), as_of=None).first().IDADE == 3


def test_order_rules(spark):
    [row] = orders(spark, dict(DEPTO=" papelaria ", QTD_PARCELAS="3", MEIO_PAGTO="Pix ")).collect()
    found = row.asDict() | dict(VALOR_UNITARIO=float(row.VALOR_UNITARIO), VALOR_TOTAL=float(row.VALOR_TOTAL))
    assert found == dict(
        ID_CLIENTE=1,
        ID_PEDIDO=10,
        ID_PRODUTO=100,
        DEPARTAMENTO="PAPELARIA",
        QUANTIDADE=2,
        VALOR_UNITARIO=3.5,
        PARCELAS=3,
        DATA_PEDIDO=dt.date(2019, 7, 5),
        MEIO_PAGAMENTO="PIX",
        STATUS_PAGAMENTO="CONFIRMADO",
        VALOR_TOTAL=7.0,
        PARCELADO=True,
        ANO=2019,
        MES=7,
        SEMESTRE=2,
        DT_CARGA=dt.datetime(2024, 1, 1),
    )


def test_instalments(spark):
    given = [None, "", " ", "0", "1", "2", " 2 ", "-1"]
    rows = orders(spark, *[dict(COD_PEDIDO=str(i), QTD_PARCELAS=g) for i, g in enumerate(given)])
    found = [(r.PARCELAS, r.PARCELADO) for r in rows.orderBy("ID_PEDIDO").collect()]
    assert found == [(1, False)] * 5 + [(2, True)] * 2 + [(-1, False)]


def test_kept_orders(spark):
    states = ["Confirmado", " CANCELADO ", "pendente", "", None]
    prices = ["1", "0", "-1.50", None]
    rows = orders(spark, *[dict(STATUS_PAGAMENTO=s, VALOR_UNITARIO=p) for s in states for p in prices])
    assert sorted(r.STATUS_PAGAMENTO for r in rows.collect()) == ["CANCELADO", "CONFIRMADO"]


def test_half_year_boundary(spark):
    rows = orders(spark, dict(DT_PEDIDO="30/06/2020"), dict(DT_PEDIDO="01/07/2020"))
    assert sorted(r.SEMESTRE for r in rows.collect()) == [1, 2]


def test_bad_values_fail_the_job(spark):
    with pytest.raises(DateTimeException):
        orders(spark, dict(DT_PEDIDO="31/04/2020")).collect()
    for field in ("COD_PEDIDO", "QUANTIDADE", "QTD_PARCELAS"):
        with pytest.raises(NumberFormatException):
            orders(spark, {field: "x"}).collect()
    with pytest.raises(NumberFormatException):
        customers(spark, dict(RECEBE_EMAIL="sim")).collect()
