"""Fixed schemas of the file, history and log tables, with column descriptions."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, data_type: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, data_type, True, {"comment": comment})


def _text(**columns: str) -> list[T.StructField]:
    return [_field(name, T.StringType(), comment) for name, comment in columns.items()]


CUSTOMER_COLUMNS = _text(
    ID="customer id",
    EMAIL="e-mail address",
    NOME="customer name",
    DT_NASC="birth date, dd/mm/yyyy",
    SEXO="sex",
    CADASTRO="sign-up date, dd/mm/yyyy",
    CIDADE="city",
    ESTADO="state code",
    RECEBE_EMAIL="1 when the customer accepts e-mail",
)

ORDER_COLUMNS = _text(
    COD_CLIENTE="customer id",
    COD_PEDIDO="order id",
    CODIGO_PRODUTO="product id",
    DEPTO="department",
    QUANTIDADE="quantity",
    VALOR_UNITARIO="unit price",
    QTD_PARCELAS="number of instalments",
    DT_PEDIDO="order date, dd/mm/yyyy",
    MEIO_PAGTO="means of payment",
    STATUS_PAGAMENTO="payment status",
)

# The customer file carries four trailing fields without a name; they end at the stage table.
UNNAMED_COLUMNS = _text(
    string_field_9="unnamed file column",
    string_field_10="unnamed file column",
    string_field_11="unnamed file column",
    string_field_12="unnamed file column",
)

PROVENANCE_COLUMNS = [
    _field("DT_CARGA", T.TimestampType(), "time of the load"),
    _field("ORIGEM", T.StringType(), "source of the load"),
    _field("UUID_LINHA", T.StringType(), "row id"),
]

STAGE_CUSTOMERS = T.StructType(CUSTOMER_COLUMNS + UNNAMED_COLUMNS)
STAGE_ORDERS = T.StructType(ORDER_COLUMNS)
RAW_CUSTOMERS = T.StructType(CUSTOMER_COLUMNS + PROVENANCE_COLUMNS)
RAW_ORDERS = T.StructType(ORDER_COLUMNS + PROVENANCE_COLUMNS)

RUN_LOG = T.StructType(
    [
        _field("ID_RODADA", T.LongType(), "running number of the log row"),
        _field("DATA_RODADA", T.TimestampType(), "time of the run"),
        _field("TABELA", T.StringType(), "table written"),
        _field("QTD_INCLUIDO", T.LongType(), "rows written"),
        _field("ORIGEM", T.StringType(), "source of the rows"),
        _field("STATUS", T.StringType(), "SUCESSO or ERRO"),
        _field("OBSERVACAO", T.StringType(), "further details"),
    ]
)

DELIVERIES = T.StructType(
    [
        _field("TABELA", T.StringType(), "history table"),
        _field("ARQUIVO", T.StringType(), "file"),
        _field("TAMANHO", T.LongType(), "length of the file in bytes"),
        _field("DT_MODIFICACAO", T.TimestampType(), "modification time of the file"),
        _field("DT_CARGA", T.TimestampType(), "time of the load"),
        _field("ESTADO", T.StringType(), "INICIO, FIM or IGUAL"),
        _field("QTD_LINHAS", T.LongType(), "rows of the file in the load"),
        _field("SOMA_HASH", T.DecimalType(38, 0), "sum of the hashes of these rows"),
    ]
)


def names(schema: T.StructType | list[T.StructField]) -> list[str]:
    return [field.name for field in schema]
