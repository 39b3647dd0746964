"""One registered query per single operator, each with its SQL next to it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.mapping import AS_OF, RULES, read_table, stage_customers, stage_orders
from checks.oracles import raw_sql, stage_sql
from checks.setup import new_lake
from ordstrata.functions import dates, numbers, text
from ordstrata.operators import aggregates, history, lookups, windows
from ordstrata.plans.silver import STATES

Query = Callable[[SparkSession, str], DataFrame]

OPERATORS: dict[str, tuple[Query, str]] = {}


def operator(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that gives the same rows."""

    def register(query: Query) -> Query:
        OPERATORS[query.__name__] = (query, sql)
        return query

    return register


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their year and an exact price."""
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
        dates.year_of(F.col("o_orderdate")).alias("year"),
        dates.month_of(F.col("o_orderdate")).alias("month"),
    )


_ORDERS = """WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus,
  CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(o_orderdate AS DATE) AS day,
  year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders) """

_STATE_LIST = ", ".join(f"'{s}'" for s in STATES)
_Y1, _Y2 = RULES.years
_BOUNDS = RULES.year_boundaries


# Scans and sinks


@operator("SELECT p_partkey, p_type FROM part WHERE p_retailprice > 950 AND p_retailprice <= 990")
def range_filtered_scan(spark, sf_dir):
    price = F.col("p_retailprice")
    rows = read_table(spark, sf_dir, "part").filter((price > 950) & (price <= 990))
    return rows.select("p_partkey", "p_type")


@operator("""SELECT (SELECT max(o_orderkey) + 1 FROM orders) AS next_id,
  (SELECT count(*) FROM lineitem) AS n_lines, 'SUCESSO' AS status""")
def one_row_of_subqueries(spark, sf_dir):
    orders, lines = (read_table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    highest = orders.agg(F.coalesce(F.max("o_orderkey"), F.lit(0))).scalar()
    return spark.range(1).select(
        (highest + 1).alias("next_id"),
        lines.agg(aggregates.rows_counted()).scalar().alias("n_lines"),
        F.lit("SUCESSO").alias("status"),
    )


_PARTY = T.StructType(
    [
        T.StructField("id", T.LongType(), True, {"comment": "key of the party"}),
        T.StructField("name", T.StringType(), True),
        T.StructField("nation", T.IntegerType(), True),
    ]
)


@operator("""SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
  UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def append_by_position(spark, sf_dir):
    lake = new_lake(spark)
    lake.create("raw", "parties", _PARTY)
    for table in ("customer", "supplier"):
        key, name = ("c_custkey", "c_name") if table == "customer" else ("s_suppkey", "s_name")
        nation = f"{table[0]}_nationkey"
        lake.append("raw", "parties", read_table(spark, sf_dir, table).select(key, name, nation))
    return lake.table("raw", "parties")


@operator("SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_nationkey < 10")
def replace_reading_itself(spark, sf_dir):
    lake = new_lake(spark)
    lake.replace("silver", "parties", read_table(spark, sf_dir, "customer"))
    lake.replace("silver", "parties", read_table(spark, sf_dir, "supplier"))
    own = lake.table("silver", "parties")
    lake.replace("silver", "parties", own.filter("s_nationkey < 10"))
    return lake.table("silver", "parties")


@operator(_ORDERS + f"""SELECT year, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total
  FROM o WHERE year IN ({_Y1}, {_Y2}) GROUP BY year""")
def partitioned_roundtrip(spark, sf_dir):
    lake = new_lake(spark)
    layout = ("year", _BOUNDS)
    orders = _orders(spark, sf_dir)
    lake.replace("gold", "orders", orders, cluster_by=["o_custkey"], bucket_by=layout)
    picked = lake.bucketed("gold", "orders", layout, RULES.years).groupBy("year")
    return picked.agg(
        aggregates.rows_counted().alias("n"), F.sum("price").cast("double").alias("total")
    )


@operator("SELECT count(*) AS n_before, CAST(0 AS BIGINT) AS n_after, 'id,name,nation' AS names FROM supplier")
def emptied_table(spark, sf_dir):
    """A table of the suppliers, then replaced by an empty one of a given schema."""
    lake = new_lake(spark)
    written = lake.replace("stage", "parties", read_table(spark, sf_dir, "supplier"))
    lake.create_empty("stage", "parties", _PARTY)
    empty = lake.table("stage", "parties")
    left = empty.agg(aggregates.rows_counted().alias("n_after"))
    return left.select(
        F.lit(written).alias("n_before"), "n_after", F.lit(",".join(empty.columns)).alias("names")
    )


@operator("""SELECT 'id' AS col_name, 'key of the party' AS comment, count(*) AS n FROM customer
  UNION ALL SELECT 'name', NULL, count(*) FROM customer
  UNION ALL SELECT 'nation', NULL, count(*) FROM customer""")
def described_columns(spark, sf_dir):
    """Descriptions of the columns of a written table, with its rows."""
    lake = new_lake(spark)
    rows = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    written = lake.replace("silver", "parties", rows.toDF(*_PARTY.names).to(_PARTY))
    described = spark.sql(f"DESCRIBE {lake.name('silver', 'parties')}")
    return described.select("col_name", "comment", F.lit(written).alias("n"))


@operator(_ORDERS + "SELECT count(*) AS n, count(DISTINCT o_custkey) AS n_customers, CAST(0 AS BIGINT) AS n_unsorted FROM o")
def clustered_by_two_keys(spark, sf_dir):
    """A table arranged by customer and year, and how many rows are out of order in their file."""
    lake = new_lake(spark)
    lake.replace("gold", "orders", _orders(spark, sf_dir), cluster_by=["o_custkey", "year"])
    keys = F.struct("o_custkey", "year")
    stored = lake.table("gold", "orders").select(
        keys.alias("keys"),
        F.input_file_name().alias("file"),
        F.monotonically_increasing_id().alias("nth"),
    )
    before = F.lag("keys").over(Window.partitionBy("file").orderBy("nth"))
    return stored.withColumn("before", before).agg(
        aggregates.rows_counted().alias("n"),
        F.countDistinct("keys.o_custkey").alias("n_customers"),
        aggregates.count_where(F.col("before") > F.col("keys")).alias("n_unsorted"),
    )


@operator(_ORDERS + "SELECT year, count(*) AS n FROM o GROUP BY year")
def overflow_partitions_kept(spark, sf_dir):
    lake = new_lake(spark)
    lake.replace("gold", "orders", _orders(spark, sf_dir), bucket_by=("year", _BOUNDS))
    counted = lake.table("gold", "orders").groupBy("year")
    return counted.agg(aggregates.rows_counted().alias("n"))


# Filters


@operator(stage_sql(r"""SELECT
  count(*) FILTER (ID IS NOT NULL AND trim(ID) <> '' AND trim(ID) <> 'ID') AS keyed,
  count(*) FILTER (ID IS NULL) AS no_id, count(*) FILTER (ID IS NOT NULL) AS some_id,
  count(*) FILTER (trim(SEXO) IN ('F', 'M')) AS listed,
  count(*) FILTER (trim(ESTADO) = 'SP') AS equal,
  count(*) FILTER (NOT (trim(ESTADO) = 'SP' AND RECEBE_EMAIL = '0')) AS not_both,
  count(*) FILTER (regexp_full_match(trim(CIDADE), '[0-9]+')) AS digits,
  count(*) FILTER (CASE WHEN RECEBE_EMAIL = '1' THEN TRUE ELSE FALSE END) AS opted_in
  FROM stg_customers"""))
def predicates(spark, sf_dir):
    stage = stage_customers(spark, sf_dir)
    key, state, mail = F.col("ID"), text.trim_ws(F.col("ESTADO")), F.col("RECEBE_EMAIL")
    tests = {
        "keyed": key.isNotNull() & (text.trim_ws(key) != "") & (text.trim_ws(key) != "ID"),
        "no_id": key.isNull(),
        "some_id": key.isNotNull(),
        "listed": text.trim_ws(F.col("SEXO")).isin("F", "M"),
        "equal": state == "SP",
        "not_both": ~((state == "SP") & (mail == "0")),
        "digits": text.all_digits(text.trim_ws(F.col("CIDADE"))),
        "opted_in": F.when(mail == "1", True).otherwise(False),
    }
    return stage.agg(*[aggregates.count_where(t).alias(n) for n, t in tests.items()])


@operator(stage_sql("""SELECT COD_PEDIDO, CODIGO_PRODUTO FROM stg_orders WHERE COD_CLIENTE IS NOT NULL
  AND trim(COD_CLIENTE) <> '' AND trim(COD_CLIENTE) <> 'COD_CLIENTE'"""))
def keyed_rows(spark, sf_dir):
    kept = history.keyed_rows(stage_orders(spark, sf_dir), "COD_CLIENTE")
    return kept.select("COD_PEDIDO", "CODIGO_PRODUTO")


# Joins


@operator(raw_sql(f"""SELECT CAST(ID AS BIGINT) AS ID_CLIENTE,
  CASE WHEN trim(ESTADO) IN ({_STATE_LIST}) THEN trim(ESTADO) END AS UF FROM raw_customers"""))
def literal_lookup_join(spark, sf_dir):
    rows = history.keyed_rows(stage_customers(spark, sf_dir), "ID")
    listed = lookups.literal_relation(spark, STATES, "uf")
    state = text.trim_ws(F.col("ESTADO"))
    # 27 constants: the size is fixed.
    joined = rows.join(F.broadcast(listed), state == F.col("uf"), "left")
    known = F.when(F.col("uf").isNotNull(), state)
    return joined.select(numbers.whole(F.col("ID")).alias("ID_CLIENTE"), known.alias("UF"))


@operator(_ORDERS + """SELECT o_orderkey, o_custkey FROM o
  WHERE o_custkey IN (SELECT o_custkey FROM o WHERE o_orderstatus = 'P')""")
def membership_join(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    members = orders.filter(F.col("o_orderstatus") == "P")
    return lookups.members_only(orders, members, "o_custkey").select("o_orderkey", "o_custkey")


@operator(_ORDERS + "SELECT DISTINCT o_custkey, year, day::VARCHAR AS day FROM o")
def distinct_rows(spark, sf_dir):
    rows = _orders(spark, sf_dir).select("o_custkey", "year", "day").distinct()
    return rows.withColumn("day", F.col("day").cast("string"))


@operator(_ORDERS + """SELECT o_custkey, c_name, count(*) AS n, CAST(sum(price) AS DOUBLE) AS total
  FROM o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c
  ON c_custkey = o_custkey GROUP BY o_custkey, c_name""")
def left_join_dimension(spark, sf_dir):
    totals = (
        _orders(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(aggregates.rows_counted().alias("n"), F.sum("price").alias("total"))
    )
    known = read_table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    known = known.withColumnRenamed("c_custkey", "o_custkey")
    joined = lookups.with_dimension(totals, known, "o_custkey", ["c_name"], ["n", "total"])
    return joined.withColumn("total", F.col("total").cast("double"))


@operator("""SELECT p_type, count(*) AS n_lines, count(DISTINCT p_partkey) AS n_parts
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type""")
def inner_join_dimension(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey")
    per_part = lines.agg(aggregates.rows_counted().alias("n"))
    parts = read_table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    return (
        lookups.with_dimension(per_part, parts, "l_partkey", ["p_type"], ["n"], "inner")
        .groupBy("p_type")
        .agg(F.sum("n").alias("n_lines"), F.countDistinct("l_partkey").alias("n_parts"))
    )


@operator(_ORDERS + """SELECT o.o_custkey, c_name, count(*) AS n FROM o
  JOIN (SELECT DISTINCT o_custkey FROM o WHERE o_orderstatus = 'P') k ON k.o_custkey = o.o_custkey
  LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING') c ON c_custkey = o.o_custkey
  GROUP BY o.o_custkey, c_name""")
def three_way_join(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    status = F.col("o_orderstatus")
    counted = orders.groupBy("o_custkey").agg(
        aggregates.rows_counted().alias("n"), aggregates.any_where(status == "P").alias("member")
    )
    counted = counted.filter("member").drop("member")
    known = read_table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    known = known.withColumnRenamed("c_custkey", "o_custkey")
    return lookups.with_dimension(counted, known, "o_custkey", ["c_name"], ["n"])


# Aggregates


@operator(_ORDERS + """SELECT o_custkey, count(*) AS n,
  count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'P') AS n_p,
  CAST(sum(CASE WHEN o_orderstatus = 'F' THEN price ELSE 0 END) AS DOUBLE) AS total_f
  FROM o GROUP BY o_custkey""")
def conditional_count_and_sum(spark, sf_dir):
    status = F.col("o_orderstatus")
    return (
        _orders(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(
            aggregates.rows_counted().alias("n"),
            aggregates.count_where(status == "F").alias("n_f"),
            aggregates.count_where(status == "P").alias("n_p"),
            aggregates.sum_where(status == "F", F.col("price")).cast("double").alias("total_f"),
        )
    )


@operator(_ORDERS + f"""SELECT o_custkey, a, b,
  CASE WHEN a AND b THEN 'both' WHEN a THEN 'first' WHEN b THEN 'second' END AS label
  FROM (SELECT o_custkey, count(*) FILTER (year = {_Y1}) > 0 AS a,
    count(*) FILTER (year = {_Y2}) > 0 AS b FROM o GROUP BY o_custkey)""")
def exists_flag(spark, sf_dir):
    flags = (
        _orders(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(
            aggregates.any_where(F.col("year") == _Y1).alias("a"),
            aggregates.any_where(F.col("year") == _Y2).alias("b"),
        )
    )
    label = F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "first")
    return flags.withColumn("label", label.when(F.col("b"), "second"))


@operator(_ORDERS + f"""SELECT o_custkey, CAST(a AS DOUBLE) AS total_1, CAST(b AS DOUBLE) AS total_2,
  round(CAST(b - a AS DOUBLE) / nullif(CAST(a AS DOUBLE), 0) * 100, 2) AS pct
  FROM (SELECT o_custkey, sum(CASE WHEN year = {_Y1} THEN v ELSE 0 END) AS a,
    sum(CASE WHEN year = {_Y2} THEN v ELSE 0 END) AS b
    FROM (SELECT o_custkey, year, sum(price) AS v FROM o WHERE year IN ({_Y1}, {_Y2})
      GROUP BY o_custkey, year) GROUP BY o_custkey)""")
def pivot_and_safe_divide(spark, sf_dir):
    yearly = (
        _orders(spark, sf_dir)
        .filter(F.col("year").isin(*RULES.years))
        .groupBy("o_custkey", "year")
        .agg(F.round(F.sum("price"), 2).alias("v"))
    )
    sides = aggregates.pivot_sums(yearly, ["o_custkey"], "year", "v", {_Y1: "a", _Y2: "b"})
    return sides.select(
        "o_custkey",
        F.col("a").cast("double").alias("total_1"),
        F.col("b").cast("double").alias("total_2"),
        numbers.percent_change(F.col("a"), F.col("b"), 2).alias("pct"),
    )


@operator("""SELECT l_partkey, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders,
  CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
  CAST((20 * sum(CAST(l_quantity AS BIGINT)) + count(DISTINCT l_orderkey))
    // (2 * count(DISTINCT l_orderkey)) AS DOUBLE) / 10 AS per_order
  FROM lineitem GROUP BY l_partkey""")
def distinct_ratio(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_partkey")
    sums = lines.agg(
        aggregates.rows_counted().alias("n_lines"),
        F.countDistinct("l_orderkey").alias("n_orders"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
    )
    per_order = numbers.ratio(F.col("quantity"), F.col("n_orders"), 1)
    return sums.withColumn("per_order", per_order)


@operator("""SELECT l_partkey, CAST(min(q) AS BIGINT) AS low, CAST(max(q) AS BIGINT) AS high,
  CAST((20 * sum(q) + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS mean
  FROM (SELECT l_partkey, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY l_partkey""")
def min_max_avg(spark, sf_dir):
    quantity = F.col("l_quantity").cast("bigint")
    rows = read_table(spark, sf_dir, "lineitem").select("l_partkey", quantity.alias("q"))
    return rows.groupBy("l_partkey").agg(
        F.min("q").alias("low"),
        F.max("q").alias("high"),
        numbers.rounded(F.avg(F.col("q").cast("decimal(18,4)")), 1).alias("mean"),
    )


# Windows


@operator(_ORDERS + """SELECT o_custkey, day::VARCHAR AS day, gap FROM (SELECT o_custkey, day,
  day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS gap
  FROM (SELECT DISTINCT o_custkey, day FROM o)) WHERE gap IS NOT NULL""")
def lag_gap(spark, sf_dir):
    days = _orders(spark, sf_dir).select("o_custkey", "day").distinct()
    with_previous = days.withColumn("before", windows.previous("day", "o_custkey"))
    return with_previous.filter(F.col("before").isNotNull()).select(
        "o_custkey",
        F.col("day").cast("string").alias("day"),
        dates.days_between(F.col("day"), F.col("before")).alias("gap"),
    )


@operator(_ORDERS + """SELECT year, month, n, CAST(sum(n) OVER (ORDER BY year, month) AS BIGINT) AS upto
  FROM (SELECT year, month, count(*) AS n FROM o GROUP BY year, month)""")
def running_total(spark, sf_dir):
    months = _orders(spark, sf_dir).groupBy("year", "month")
    counted = months.agg(aggregates.rows_counted().alias("n"))
    return counted.withColumn("upto", windows.running_total(["year", "month"], "n"))


@operator(_ORDERS + """SELECT o_orderstatus, n,
  CAST((2000 * n + t) // (2 * t) AS DOUBLE) / 10 AS pct FROM (SELECT o_orderstatus, n,
    CAST(sum(n) OVER () AS BIGINT) AS t FROM (SELECT o_orderstatus, count(DISTINCT o_custkey) AS n
    FROM o GROUP BY o_orderstatus))""")
def share_of_total(spark, sf_dir):
    groups = _orders(spark, sf_dir).groupBy("o_orderstatus")
    counted = groups.agg(F.countDistinct("o_custkey").alias("n"))
    share = numbers.percent(F.col("n"), windows.grand_total("n"), 1)
    return counted.withColumn("pct", share)


@operator(_ORDERS + """SELECT o_orderstatus, round(100 * m / sum(m) OVER (), 1) AS pct FROM
  (SELECT o_orderstatus, CAST(sum(price) AS DOUBLE) / count(*) AS m FROM o GROUP BY o_orderstatus)""")
def share_of_averages(spark, sf_dir):
    mean = F.sum("price").cast("double") / aggregates.rows_counted()
    means = _orders(spark, sf_dir).groupBy("o_orderstatus").agg(mean.alias("m"))
    share = F.lit(100) * F.col("m") / windows.grand_total("m")
    return means.select("o_orderstatus", numbers.rounded(share, 1).alias("pct"))


# Sorting


@operator(_ORDERS + """SELECT o_orderkey, CAST(price AS DOUBLE) AS price FROM o
  ORDER BY price DESC, o_orderkey""")
def order_descending(spark, sf_dir):
    rows = _orders(spark, sf_dir).orderBy(F.desc("price"), "o_orderkey")
    return rows.select("o_orderkey", F.col("price").cast("double").alias("price"))


# Scalar functions


@operator(stage_sql("""SELECT COD_PEDIDO, upper(trim(DEPTO)) AS upper_text,
  lower(trim(MEIO_PAGTO)) AS lower_text, trim(STATUS_PAGAMENTO) AS text,
  COD_PEDIDO || ' - ' || trim(DEPTO) AS joined FROM stg_orders"""))
def text_clean(spark, sf_dir):
    return stage_orders(spark, sf_dir).select(
        "COD_PEDIDO",
        text.clean_upper(F.col("DEPTO")).alias("upper_text"),
        text.clean_lower(F.col("MEIO_PAGTO")).alias("lower_text"),
        text.trim_ws(F.col("STATUS_PAGAMENTO")).alias("text"),
        F.concat("COD_PEDIDO", F.lit(" - "), text.trim_ws(F.col("DEPTO"))).alias("joined"),
    )


@operator("""SELECT c_custkey, 'Customer-' || c_custkey || '/' || upper(c_mktsegment[1])
  || lower(c_mktsegment[2:]) || ' O''neil' AS title FROM customer""")
def initcap_words(spark, sf_dir):
    name = F.concat(
        F.lit("cUSTOMER-"), F.col("c_custkey"), F.lit("/"), "c_mktsegment", F.lit(" o'NEIL")
    )
    rows = read_table(spark, sf_dir, "customer")
    return rows.select("c_custkey", text.initcap_words(name).alias("title"))


@operator(_ORDERS + """SELECT o_orderkey, printf('%04d-%02d', year, month) AS year_month,
  year || ' - S' || CASE WHEN month <= 6 THEN 1 ELSE 2 END AS year_half,
  CAST(CASE WHEN month <= 6 THEN 1 ELSE 2 END AS BIGINT) AS half FROM o""")
def period_labels(spark, sf_dir):
    year, month = F.col("year"), F.col("month")
    half = dates.half_of_month(month)
    return _orders(spark, sf_dir).select(
        "o_orderkey",
        text.year_month(year, month).alias("year_month"),
        text.year_half(year, half).alias("year_half"),
        half.alias("half"),
    )


@operator(stage_sql("""SELECT EMAIL,
  try_strptime(DT_NASC, '%d/%m/%Y')::DATE::VARCHAR AS born,
  try_strptime(CADASTRO, '%d/%m/%Y')::DATE::VARCHAR AS joined FROM stg_customers"""))
def safe_date(spark, sf_dir):
    return stage_customers(spark, sf_dir).select(
        "EMAIL",
        dates.try_parse_dmy(F.col("DT_NASC")).cast("string").alias("born"),
        dates.try_parse_dmy(F.col("CADASTRO")).cast("string").alias("joined"),
    )


@operator(stage_sql(f"""SELECT EMAIL,
  {AS_OF.year} - year(try_strptime(DT_NASC, '%d/%m/%Y')) AS age FROM stg_customers"""))
def age_years(spark, sf_dir):
    age = dates.years_crossed(F.lit(AS_OF), dates.try_parse_dmy(F.col("DT_NASC")))
    return stage_customers(spark, sf_dir).select("EMAIL", age.alias("age"))


@operator(stage_sql("""SELECT COD_PEDIDO, strptime(DT_PEDIDO, '%d/%m/%Y')::DATE::VARCHAR AS day
  FROM stg_orders"""))
def strict_date(spark, sf_dir):
    day = dates.parse_dmy(F.col("DT_PEDIDO")).cast("string")
    return stage_orders(spark, sf_dir).select("COD_PEDIDO", day.alias("day"))


@operator(_ORDERS + """SELECT o_orderkey, year, month, dayofweek(day) + 1 AS number,
  dayname(day) AS name FROM o""")
def date_parts(spark, sf_dir):
    day = F.col("day")
    return _orders(spark, sf_dir).select(
        "o_orderkey",
        "year",
        "month",
        dates.weekday_number(day).alias("number"),
        dates.weekday_name(day).alias("name"),
    )


@operator(_ORDERS + f"""SELECT year,
  CAST(CASE {' '.join(f'WHEN year < {b} THEN {n}' for n, b in enumerate(_BOUNDS))}
    ELSE {len(_BOUNDS)} END AS BIGINT) AS bucket, count(*) AS n FROM o GROUP BY year""")
def range_bucket(spark, sf_dir):
    years = _orders(spark, sf_dir).groupBy("year")
    counted = years.agg(aggregates.rows_counted().alias("n"))
    bucket = numbers.range_bucket(F.col("year"), _BOUNDS).cast("bigint")
    return counted.withColumn("bucket", bucket)


@operator(_ORDERS + f"""SELECT y.year, count(o_orderkey) AS n
  FROM (SELECT unnest(generate_series({_BOUNDS[0]}, {_BOUNDS[-1]}, 2)) AS year) y
  LEFT JOIN o ON o.year = y.year GROUP BY y.year""")
def generated_array_as_relation(spark, sf_dir):
    array = numbers.generate_array(_BOUNDS[0], _BOUNDS[-1], 2)
    years = spark.range(1).select(F.explode(array).alias("year"))
    counted = _orders(spark, sf_dir).groupBy("year").agg(aggregates.rows_counted().alias("n"))
    return years.join(counted, "year", "left").na.fill(0, ["n"])


@operator(stage_sql("""SELECT COD_PEDIDO, CAST(CODIGO_PRODUTO AS BIGINT) AS product,
  CAST(CAST(VALOR_UNITARIO AS DECIMAL(14,2)) AS DOUBLE) AS price,
  CAST(QUANTIDADE AS BIGINT) * 2 - 1 AS computed, CAST(2 * CAST(QUANTIDADE AS BIGINT) AS VARCHAR) AS text,
  coalesce(try_cast(QTD_PARCELAS AS BIGINT), 0) AS instalments FROM stg_orders"""))
def casts_and_arithmetic(spark, sf_dir):
    quantity = numbers.whole(F.col("QUANTIDADE"))
    given = F.when(~text.is_blank(F.col("QTD_PARCELAS")), F.col("QTD_PARCELAS"))
    return stage_orders(spark, sf_dir).select(
        "COD_PEDIDO",
        numbers.whole(F.col("CODIGO_PRODUTO")).alias("product"),
        numbers.money(F.col("VALOR_UNITARIO")).cast("double").alias("price"),
        (quantity * 2 - 1).alias("computed"),
        (quantity * 2).cast("string").alias("text"),
        F.coalesce(numbers.whole(given), F.lit(0)).alias("instalments"),
    )


@operator("""SELECT p_partkey, CAST((2 * c + 10) // 20 AS DOUBLE) / 10 AS one_place,
  CAST(c AS DOUBLE) / 100 AS two_places FROM
  (SELECT p_partkey, CAST(100 * CAST(p_retailprice AS DECIMAL(18,2)) AS BIGINT) AS c FROM part)""")
def half_up_rounding(spark, sf_dir):
    price = F.col("p_retailprice").cast("decimal(18,2)")
    return read_table(spark, sf_dir, "part").select(
        "p_partkey",
        numbers.rounded(price, 1).alias("one_place"),
        numbers.rounded(price, 2).alias("two_places"),
    )


@operator("SELECT count(*) AS n_rows, count(*) AS n_ids FROM lineitem")
def random_row_ids(spark, sf_dir):
    rows = read_table(spark, sf_dir, "lineitem").select(history.random_id().alias("id"))
    return rows.agg(
        aggregates.rows_counted().alias("n_rows"), F.countDistinct("id").alias("n_ids")
    )
