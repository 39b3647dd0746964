"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from checks.mapping import AS_OF, CUSTOMER_FIELDS, ORDER_FIELDS, RULES, select_list
from ordstrata.plans.silver import STATES

Y1, Y2 = RULES.years
C1, C2 = RULES.categories
T1, T2, T3 = RULES.tier_limits
FIRST, SECOND = "2024-01-01 00:00:00", "2024-01-02 03:04:05"

_STAGE = {
    "stg_customers": f"SELECT {', '.join(select_list(CUSTOMER_FIELDS))}"
    " FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "stg_orders": f"SELECT {', '.join(select_list(ORDER_FIELDS))}"
    " FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey",
}
_RAW = {
    "raw_customers": "SELECT * FROM stg_customers"
    " WHERE ID IS NOT NULL AND trim(ID) <> '' AND trim(ID) <> 'ID'",
    "raw_orders": "SELECT * FROM stg_orders WHERE COD_CLIENTE IS NOT NULL"
    " AND trim(COD_CLIENTE) <> '' AND trim(COD_CLIENTE) <> 'COD_CLIENTE'",
}
_STATE_LIST = ", ".join(f"'{s}'" for s in STATES)
_SILVER = {
    "customers": f"""
        SELECT *, {AS_OF.year} - year(DATA_NASCIMENTO) AS IDADE FROM (
          SELECT CAST(trim(ID) AS BIGINT) AS ID_CLIENTE, lower(trim(EMAIL)) AS EMAIL,
            array_to_string(list_transform(string_split(trim(NOME), ' '),
              lambda w: upper(w[1]) || lower(w[2:])), ' ') AS NOME,
            CAST(try_strptime(trim(DT_NASC), '%d/%m/%Y') AS DATE) AS DATA_NASCIMENTO,
            trim(SEXO) AS SEXO,
            CAST(try_strptime(trim(CADASTRO), '%d/%m/%Y') AS DATE) AS DATA_CADASTRO,
            CASE WHEN trim(CIDADE) IN ('', '.') THEN NULL
              WHEN regexp_full_match(trim(CIDADE), '[0-9]+') THEN NULL
              ELSE upper(trim(CIDADE)) END AS CIDADE,
            CASE WHEN trim(ESTADO) IN ({_STATE_LIST}) THEN trim(ESTADO) END AS UF,
            CAST(RECEBE_EMAIL AS BIGINT) = 1 AS PERMISSAO_RECEBE_EMAIL
          FROM raw_customers)""",
    "lines": """
        SELECT *, QUANTIDADE * VALOR_UNITARIO AS VALOR_TOTAL, year(DATA_PEDIDO) AS ANO,
          month(DATA_PEDIDO) AS MES, CAST(CASE WHEN month(DATA_PEDIDO) <= 6 THEN 1 ELSE 2 END AS BIGINT) AS SEMESTRE
        FROM (
          SELECT CAST(COD_CLIENTE AS BIGINT) AS ID_CLIENTE, CAST(COD_PEDIDO AS BIGINT) AS ID_PEDIDO,
            CAST(CODIGO_PRODUTO AS BIGINT) AS ID_PRODUTO, upper(trim(DEPTO)) AS DEPARTAMENTO,
            CAST(QUANTIDADE AS BIGINT) AS QUANTIDADE,
            CAST(VALOR_UNITARIO AS DECIMAL(14,2)) AS VALOR_UNITARIO,
            CASE WHEN QTD_PARCELAS IS NULL OR trim(QTD_PARCELAS) IN ('', '0') THEN 1
              ELSE CAST(QTD_PARCELAS AS BIGINT) END AS PARCELAS,
            CASE WHEN QTD_PARCELAS IS NULL OR trim(QTD_PARCELAS) = '' THEN FALSE
              ELSE CAST(QTD_PARCELAS AS BIGINT) > 1 END AS PARCELADO,
            CAST(strptime(trim(DT_PEDIDO), '%d/%m/%Y') AS DATE) AS DATA_PEDIDO,
            upper(trim(MEIO_PAGTO)) AS MEIO_PAGAMENTO,
            upper(trim(STATUS_PAGAMENTO)) AS STATUS_PAGAMENTO
          FROM raw_orders)
        WHERE STATUS_PAGAMENTO IN ('CONFIRMADO', 'CANCELADO') AND VALOR_UNITARIO > 0""",
    "conf": "SELECT * FROM lines WHERE STATUS_PAGAMENTO = 'CONFIRMADO'",
}


def _with(select: str, *layers: dict[str, str]) -> str:
    ctes = {name: sql for layer in layers for name, sql in layer.items()}
    body = ", ".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {body} {select}"


def stage_sql(select: str) -> str:
    return _with(select, _STAGE)


def raw_sql(select: str) -> str:
    return _with(select, _STAGE, _RAW)


def silver_sql(select: str) -> str:
    return _with(select, _STAGE, _RAW, _SILVER)


def _half_up(numerator: str, denominator: str, places: int) -> str:
    """Exact quotient of decimals with two places, halves rounded up, for positive values."""
    digits = 10**places
    return (
        f"CAST((2 * {digits} * CAST(100 * ({numerator}) AS HUGEINT) + 100 * ({denominator}))"
        f" // (200 * ({denominator})) AS DOUBLE) / {digits}"
    )


def _dbl(sql: str) -> str:
    return f"CAST({sql} AS DOUBLE)"


def _text(sql: str) -> str:
    return f"CAST({sql} AS VARCHAR)"


_YM = "printf('%04d-%02d', ANO, MES)"

GOLD = {
    "gold_orders_by_semester": f"""
        SELECT p.ID_CLIENTE, c.NOME, p.ANO, p.SEMESTRE, p.ANO || ' - S' || p.SEMESTRE AS ANO_SEMESTRE,
          count(DISTINCT p.ID_PEDIDO) AS QTD_PEDIDOS, {_dbl('sum(p.VALOR_TOTAL)')} AS VALOR_TOTAL_PERIODO
        FROM conf p JOIN (SELECT DISTINCT ID_CLIENTE FROM conf WHERE PARCELADO) k USING (ID_CLIENTE)
          LEFT JOIN customers c ON c.ID_CLIENTE = p.ID_CLIENTE
        GROUP BY p.ID_CLIENTE, c.NOME, p.ANO, p.SEMESTRE""",
    "gold_avg_ticket_month": f"""
        SELECT p.ID_CLIENTE, c.NOME, p.ANO, p.MES, {_YM} AS ANO_MES,
          count(DISTINCT p.ID_PEDIDO) AS QTD_PEDIDOS, {_dbl('sum(p.VALOR_TOTAL)')} AS VALOR_TOTAL,
          {_half_up('sum(p.VALOR_TOTAL)', 'count(DISTINCT p.ID_PEDIDO)', 2)} AS TICKET_MEDIO
        FROM conf p LEFT JOIN customers c ON c.ID_CLIENTE = p.ID_CLIENTE
        GROUP BY p.ID_CLIENTE, c.NOME, p.ANO, p.MES""",
    "gold_purchase_interval": f"""
        SELECT i.ID_CLIENTE, c.NOME, i.ANO, count(*) AS QTD_INTERVALOS,
          {_half_up('sum(DIAS)', 'count(*)', 1)} AS INTERVALO_MEDIO_DIAS,
          min(DIAS) AS MENOR_INTERVALO_DIAS, max(DIAS) AS MAIOR_INTERVALO_DIAS
        FROM (SELECT ID_CLIENTE, ANO, DATA_PEDIDO
                - lag(DATA_PEDIDO) OVER (PARTITION BY ID_CLIENTE ORDER BY DATA_PEDIDO) AS DIAS
              FROM (SELECT DISTINCT ID_CLIENTE, ANO, DATA_PEDIDO FROM conf)) i
          LEFT JOIN customers c ON c.ID_CLIENTE = i.ID_CLIENTE
        WHERE DIAS IS NOT NULL GROUP BY i.ID_CLIENTE, c.NOME, i.ANO""",
    "gold_monthly_tiers": f"""
        SELECT v.ID_CLIENTE, c.NOME, v.ANO, v.MES, {_YM} AS ANO_MES, {_dbl('VALOR')} AS VALOR_MES,
          CASE WHEN VALOR < {T1} THEN 'Básico' WHEN VALOR < {T2} THEN 'Prata'
            WHEN VALOR < {T3} THEN 'Ouro' ELSE 'Super' END AS TIER
        FROM (SELECT ID_CLIENTE, ANO, MES, sum(VALOR_TOTAL) AS VALOR FROM conf GROUP BY ALL) v
          LEFT JOIN customers c ON c.ID_CLIENTE = v.ID_CLIENTE""",
    "gold_category_yoy": f"""
        SELECT DEPARTAMENTO, {_dbl('A')} AS TOTAL_{Y1}, {_dbl('B')} AS TOTAL_{Y2},
          {_dbl('B - A')} AS VARIACAO_ABSOLUTA,
          round({_dbl('B - A')} / nullif({_dbl('A')}, 0) * 100, 2) AS VARIACAO_PERCENTUAL
        FROM (SELECT DEPARTAMENTO,
            sum(CASE WHEN ANO = {Y1} THEN VALOR_TOTAL ELSE 0 END) AS A,
            sum(CASE WHEN ANO = {Y2} THEN VALOR_TOTAL ELSE 0 END) AS B
          FROM conf WHERE DEPARTAMENTO IN ('{C1}', '{C2}') AND ANO IN ({Y1}, {Y2})
          GROUP BY DEPARTAMENTO)""",
    "gold_cancellation_rate": f"""
        SELECT DEPARTAMENTO, count(*) AS TOTAL_PEDIDOS,
          count(*) FILTER (STATUS_PAGAMENTO = 'CONFIRMADO') AS CONFIRMADOS,
          count(*) FILTER (STATUS_PAGAMENTO = 'CANCELADO') AS CANCELADOS,
          {_half_up("100 * count(*) FILTER (STATUS_PAGAMENTO = 'CANCELADO')", 'count(*)', 1)}
            AS PCT_CANCELAMENTO,
          {_dbl("sum(CASE WHEN STATUS_PAGAMENTO = 'CONFIRMADO' THEN VALOR_TOTAL ELSE 0 END)")}
            AS RECEITA_CONFIRMADA,
          {_dbl("sum(CASE WHEN STATUS_PAGAMENTO = 'CANCELADO' THEN VALOR_TOTAL ELSE 0 END)")}
            AS RECEITA_PERDIDA
        FROM lines GROUP BY DEPARTAMENTO""",
    "gold_weekday_volume": f"""
        SELECT DIA_SEMANA, NUM_DIA, QTD_PEDIDOS, {_dbl('RECEITA')} AS RECEITA_TOTAL,
          {_half_up('RECEITA', 'LINHAS', 2)} AS TICKET_MEDIO,
          {_half_up('100 * QTD_PEDIDOS', 'CAST(sum(QTD_PEDIDOS) OVER () AS BIGINT)', 1)} AS PCT_DO_TOTAL
        FROM (SELECT dayname(DATA_PEDIDO) AS DIA_SEMANA, dayofweek(DATA_PEDIDO) + 1 AS NUM_DIA,
            count(DISTINCT ID_PEDIDO) AS QTD_PEDIDOS, sum(VALOR_TOTAL) AS RECEITA, count(*) AS LINHAS
          FROM conf GROUP BY ALL)""",
    "gold_optin_impact": f"""
        SELECT PERMISSAO_EMAIL, QTD_CLIENTES, QTD_PEDIDOS, {_dbl('RECEITA')} AS RECEITA_TOTAL,
          {_half_up('RECEITA', 'LINHAS', 2)} AS TICKET_MEDIO,
          round(100 * {_dbl('RECEITA')} / LINHAS
            / sum({_dbl('RECEITA')} / LINHAS) OVER (), 1) AS PCT_TICKET_RELATIVO
        FROM (SELECT CASE WHEN c.PERMISSAO_RECEBE_EMAIL THEN 'Aceita e-mail'
              ELSE 'Não aceita e-mail' END AS PERMISSAO_EMAIL,
            count(DISTINCT p.ID_CLIENTE) AS QTD_CLIENTES, count(DISTINCT p.ID_PEDIDO) AS QTD_PEDIDOS,
            sum(p.VALOR_TOTAL) AS RECEITA, count(*) AS LINHAS
          FROM conf p JOIN customers c ON c.ID_CLIENTE = p.ID_CLIENTE GROUP BY ALL)""",
    "gold_retention": f"""
        SELECT c.NOME, a.ID_CLIENTE,
          CASE WHEN A AND B THEN 'Recorrente ({Y1} e {Y2})' WHEN A THEN 'Apenas {Y1}'
            WHEN B THEN 'Apenas {Y2}' END AS PERFIL_RETENCAO,
          A AS COMPROU_{Y1}, B AS COMPROU_{Y2}
        FROM (SELECT ID_CLIENTE, count(*) FILTER (ANO = {Y1}) > 0 AS A,
            count(*) FILTER (ANO = {Y2}) > 0 AS B
          FROM conf WHERE ANO IN ({Y1}, {Y2}) GROUP BY ID_CLIENTE) a
          LEFT JOIN customers c ON c.ID_CLIENTE = a.ID_CLIENTE""",
    "gold_base_growth": f"""
        SELECT ANO, MES, {_YM} AS ANO_MES, NOVOS_CLIENTES,
          CAST(sum(NOVOS_CLIENTES) OVER (ORDER BY ANO, MES) AS BIGINT) AS TOTAL_ACUMULADO
        FROM (SELECT year(DATA_CADASTRO) AS ANO, month(DATA_CADASTRO) AS MES,
            count(*) AS NOVOS_CLIENTES
          FROM customers WHERE DATA_CADASTRO IS NOT NULL GROUP BY ALL)""",
}

_CUSTOMER_NAMES = list(CUSTOMER_FIELDS)
_ORDER_NAMES = list(ORDER_FIELDS)


def _row_hash(names: list[str]) -> str:
    parts = ", ".join(f"coalesce('=' || {c}, '-')" for c in names)
    return f"sha256(concat_ws(chr(31), {parts}))"


def _counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS TABELA, (SELECT count(*) FROM ({sql})) AS QTD_INCLUIDO"
        for name, sql in tables.items()
    )


_SILVER_CUSTOMERS = f"""
    SELECT ID_CLIENTE, EMAIL, NOME, {_text('DATA_NASCIMENTO')} AS DATA_NASCIMENTO, IDADE, SEXO,
      {_text('DATA_CADASTRO')} AS DATA_CADASTRO, CIDADE, UF, PERMISSAO_RECEBE_EMAIL,
      '{FIRST}' AS DT_CARGA FROM customers"""
_SILVER_ORDERS = f"""
    SELECT ID_CLIENTE, ID_PEDIDO, ID_PRODUTO, DEPARTAMENTO, QUANTIDADE,
      {_dbl('VALOR_UNITARIO')} AS VALOR_UNITARIO, PARCELAS, {_text('DATA_PEDIDO')} AS DATA_PEDIDO,
      MEIO_PAGAMENTO, STATUS_PAGAMENTO, {_dbl('VALOR_TOTAL')} AS VALOR_TOTAL, PARCELADO,
      ANO, MES, SEMESTRE, '{FIRST}' AS DT_CARGA FROM lines"""

_GOLD_NAMES = {
    "pedidos_por_cliente_semestre": "gold_orders_by_semester",
    "ticket_medio_cliente_ano_mes": "gold_avg_ticket_month",
    "intervalo_medio_compras": "gold_purchase_interval",
    "tiers_clientes": "gold_monthly_tiers",
    "comparativo_som_papelaria": "gold_category_yoy",
    "cancelamento_por_departamento": "gold_cancellation_rate",
    "pedidos_por_dia_semana": "gold_weekday_volume",
    "impacto_permissao_email": "gold_optin_impact",
    "retencao_clientes": "gold_retention",
    "crescimento_base_clientes": "gold_base_growth",
}
_LOGGED = {
    "raw_cadastro": "SELECT * FROM raw_customers",
    "raw_pedido": "SELECT * FROM raw_orders",
    "silver.cadastro": "SELECT * FROM customers",
    "silver.pedido": "SELECT * FROM lines",
    **{f"gold.{table}": GOLD[key] for table, key in _GOLD_NAMES.items()},
}
_TWO_RESULTS = ("gold.cancelamento_por_departamento", "gold.crescimento_base_clientes")
_ORIGINS = (
    "CASE TABELA WHEN 'raw_cadastro' THEN 'customers'"
    " WHEN 'raw_pedido' THEN 'orders'"
    " ELSE CASE WHEN TABELA LIKE 'silver%' THEN 'raw' ELSE 'silver' END END"
)


def _raw(names: list[str], table: str, origin: str, load: str) -> str:
    return (
        f"SELECT {', '.join(names)}, '{load}' AS DT_CARGA, '{origin}' AS ORIGEM,"
        f" {_row_hash(names)} AS UUID_LINHA FROM {table}"
    )


def _log_of_two_loads(tables: list[str]) -> str:
    counts = {t: _LOGGED[t] for t in tables}
    loads = " UNION ALL ".join(
        f"SELECT {load} * {len(tables)} + row_number() OVER (ORDER BY TABELA) AS ID_RODADA,"
        f" '{at}' AS DATA_RODADA, TABELA, QTD_INCLUIDO, {_ORIGINS} AS ORIGEM,"
        f" 'SUCESSO' AS STATUS, CAST(NULL AS VARCHAR) AS OBSERVACAO FROM ({_counts(counts)})"
        for load, at in enumerate((FIRST, SECOND))
    )
    return _with(loads, _STAGE, _RAW)


def oracle_sql() -> dict[str, str]:
    unnamed = ", ".join(f"CAST(NULL AS VARCHAR) AS string_field_{n}" for n in range(9, 13))
    return {
        "stage_customers": stage_sql(f"SELECT *, {unnamed} FROM stg_customers"),
        "stage_orders": stage_sql("SELECT * FROM stg_orders"),
        "raw_customers": _with(
            _raw(_CUSTOMER_NAMES, "raw_customers", "customers", FIRST), _STAGE, _RAW
        ),
        "raw_orders": _with(
            _raw(_ORDER_NAMES, "raw_orders", "orders", FIRST), _STAGE, _RAW
        ),
        "latest_load": _with(
            _raw(_CUSTOMER_NAMES, "raw_customers", "customers", SECOND), _STAGE, _RAW
        ),
        "job_latest_load": _with(
            _raw(_CUSTOMER_NAMES, "raw_customers", "customers", SECOND), _STAGE, _RAW
        ),
        "repeated_deliveries": _with(
            f"SELECT 'raw_cadastro' AS TABELA, '{FIRST}' AS DT_CARGA, count(*) AS count FROM raw_customers"
            " UNION ALL SELECT 'raw_cadastro', '2024-01-03 00:00:00', 2 * count(*) FROM raw_customers"
            f" UNION ALL SELECT 'raw_pedido', '{FIRST}', count(*) FROM raw_orders",
            _STAGE,
            _RAW,
        ),
        "results_of_two_runs": silver_sql(
            f"SELECT r.*, DT_CARGA FROM ({GOLD['gold_cancellation_rate']}) r,"
            f" (VALUES ('{FIRST}'), ('{SECOND}')) AS v(DT_CARGA)"
        ),
        "drifted_headers": "SELECT * FROM (VALUES (2, 'EMAIL', 'NOME'), (3, 'NOME', 'EMAIL'),"
        " (14, NULL, 'TELEFONE')) AS v(position, expected, found)",
        "job_silver_orders": silver_sql(_SILVER_ORDERS.replace(FIRST, SECOND)),
        "job_gold_monthly_tiers": silver_sql(GOLD["gold_monthly_tiers"]),
        "silver_customers": silver_sql(_SILVER_CUSTOMERS),
        "silver_orders": silver_sql(_SILVER_ORDERS),
        **{key: silver_sql(sql) for key, sql in GOLD.items()},
        "run_log": _log_of_two_loads(["raw_cadastro", "raw_pedido"]),
        "log_newest_first": silver_sql(
            "SELECT CAST(n AS BIGINT) AS ID_RODADA, DATA_RODADA, TABELA, QTD_INCLUIDO,"
            " 'silver' AS ORIGEM, 'SUCESSO' AS STATUS"
            f" FROM ({_counts({t: s for t, s in _LOGGED.items() if t in _TWO_RESULTS})})"
            f" JOIN (VALUES (1, '{FIRST}', '{_TWO_RESULTS[0]}'), (2, '{SECOND}', '{_TWO_RESULTS[1]}'))"
            " AS v(n, DATA_RODADA, TABELA) USING (TABELA)"
        ),
        "run_medallion": silver_sql(
            f"SELECT TABELA, QTD_INCLUIDO, {_ORIGINS} AS ORIGEM, 'SUCESSO' AS STATUS"
            f" FROM ({_counts(_LOGGED)})"
        ),
    }
