"""Made-up silver tables for plan tests."""

from pyspark.sql import functions as F


def hot_customer(spark, folder, n_orders=200_000, n_customers=1000):
    """Orders of which customer 1 holds three quarters; customer 0 has none."""
    key = F.when(F.col("id") % 4 != 0, F.lit(1)).otherwise(1 + F.col("id") / 4 % (n_customers - 1))
    orders = spark.range(n_orders).select(
        key.cast("bigint").alias("ID_CLIENTE"),
        F.col("id").alias("ID_PEDIDO"),
        F.lit("CONFIRMADO").alias("STATUS_PAGAMENTO"),
        F.lit(1).cast("decimal(18,4)").alias("VALOR_TOTAL"),
    )
    customers = spark.range(n_customers).select(
        F.col("id").alias("ID_CLIENTE"), F.lit(True).alias("PERMISSAO_RECEBE_EMAIL")
    )
    orders.write.parquet(f"{folder}/o")
    customers.write.parquet(f"{folder}/c")
    return spark.read.parquet(f"{folder}/o"), spark.read.parquet(f"{folder}/c"), n_orders
