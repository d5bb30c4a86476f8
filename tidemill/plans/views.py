"""Views over the test tables that give them the shapes the operators work on.

Each view exists twice: as a DataFrame and as the SQL text the check queries start from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day(column: str):
    return F.col(column).cast("date")


def cents(column):
    """Sum in whole cents: exact, so it does not depend on the order of the rows."""
    c = F.col(column) if isinstance(column, str) else column
    return F.sum(F.round(c * 100).cast("bigint"))


DELIVERIES_SQL = """
deliveries AS (
  SELECT CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month,
         r_name AS region, p_type AS model,
         CAST(sum(l_quantity) AS BIGINT) AS deliveries,
         CAST(count(*) AS BIGINT) AS production,
         sum(CAST(round(p_retailprice * 100) AS BIGINT)) / (100.0 * count(*)) AS price,
         CAST(max(p_size) AS BIGINT) AS battery_kwh,
         CAST(sum(p_size) AS BIGINT) AS range_km,
         sum(CAST(round(l_tax * 100 * l_quantity) AS BIGINT)) / 100.0 AS co2,
         CAST(count(DISTINCT l_suppkey) AS BIGINT) AS stations,
         CAST(make_date(CAST(year(l_shipdate) AS INT), CAST(month(l_shipdate) AS INT), 1) AS DATE) AS date
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL
)"""


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly deliveries by region and model."""
    geo = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("region"))
    )
    part = table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("model"), "p_size", "p_retailprice")
    lines = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_tax", "l_shipdate")
    joined = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        geo, F.col("l_suppkey") == F.col("s_suppkey")
    )
    return (
        joined.groupBy(
            F.year("l_shipdate").cast("bigint").alias("year"),
            F.month("l_shipdate").cast("bigint").alias("month"),
            "region",
            "model",
        )
        .agg(
            F.sum("l_quantity").cast("bigint").alias("deliveries"),
            F.count(F.lit(1)).alias("production"),
            (cents("p_retailprice") / (F.count(F.lit(1)) * 100.0)).alias("price"),
            F.max("p_size").cast("bigint").alias("battery_kwh"),
            F.sum("p_size").cast("bigint").alias("range_km"),
            (cents(F.col("l_tax") * F.col("l_quantity")) / 100.0).alias("co2"),
            F.count_distinct("l_suppkey").alias("stations"),
        )
        .withColumn("date", F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1)))
    )


ADMISSIONS_SQL = """
stays AS (
  SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS discharged FROM lineitem GROUP BY l_orderkey
),
admissions AS (
  SELECT o_orderkey AS admission_id, 'patient ' || CAST(o_custkey AS VARCHAR) AS patient_name,
         CAST(18 + c_custkey % 70 AS BIGINT) AS age,
         CASE WHEN c_nationkey < 12 THEN 'female' ELSE 'male' END AS gender,
         c_mktsegment AS condition, CAST(o_orderdate AS DATE) AS admitted, c_name AS doctor,
         n_name AS hospital, r_name AS insurer, o_totalprice AS billing,
         o_orderpriority AS admission_type, discharged, o_orderstatus AS result
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN stays ON o_orderkey = l_orderkey
)"""


def admissions(spark: SparkSession, sf: str) -> DataFrame:
    """Flat admission rows, one per hospital stay."""
    stays = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.max(day("l_shipdate")).alias("discharged"))
    )
    people = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return (
        table(spark, sf, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .join(stays, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("admission_id"),
            F.concat(F.lit("patient "), F.col("o_custkey").cast("string")).alias("patient_name"),
            (F.lit(18) + F.col("c_custkey") % 70).cast("bigint").alias("age"),
            F.when(F.col("c_nationkey") < 12, "female").otherwise("male").alias("gender"),
            F.col("c_mktsegment").alias("condition"),
            day("o_orderdate").alias("admitted"),
            F.col("c_name").alias("doctor"),
            F.col("n_name").alias("hospital"),
            F.col("r_name").alias("insurer"),
            F.col("o_totalprice").alias("billing"),
            F.col("o_orderpriority").alias("admission_type"),
            "discharged",
            F.col("o_orderstatus").alias("result"),
        )
    )


# Negative balances stand for unknown salaries; ages come from the nation key and are unknown for key 0.
EMPLOYEES_SQL = """
employees AS (
  SELECT c_custkey AS employee_id, c_name AS name, c_mktsegment AS department,
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS salary,
         CAST(CASE WHEN c_nationkey = 0 THEN NULL ELSE 20 + c_nationkey END AS BIGINT) AS age,
         CASE WHEN c_acctbal > 9900 THEN NULL ELSE c_acctbal / 2500.0 END AS performance
  FROM customer
)"""


def employees(spark: SparkSession, sf: str) -> DataFrame:
    """Staff rows with gaps in salary, age and performance."""
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("employee_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("department"),
        F.when(balance < 0, None).otherwise(balance).alias("salary"),
        F.when(nation == 0, None).otherwise(nation + 20).cast("bigint").alias("age"),
        F.when(balance > 9900, None).otherwise(balance / 2500.0).alias("performance"),
    )


CLIENTS_SQL = """
clients AS (
  SELECT c_custkey AS id, c_acctbal AS balance, CAST(count(o_orderkey) AS DOUBLE) AS orders_made,
         coalesce(avg(o_totalprice), 0.0) AS mean_price
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey
  GROUP BY c_custkey, c_acctbal
)"""


def clients(spark: SparkSession, sf: str) -> DataFrame:
    """One row per customer with a few numeric features, for clustering."""
    made = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).cast("double").alias("orders_made"), F.avg("o_totalprice").alias("mean_price"))
    )
    return (
        table(spark, sf, "customer")
        .join(made, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("id"),
            F.col("c_acctbal").alias("balance"),
            F.coalesce("orders_made", F.lit(0.0)).alias("orders_made"),
            F.coalesce("mean_price", F.lit(0.0)).alias("mean_price"),
        )
    )


MONTHLY_SQL = """
monthly AS (
  SELECT region, model, date, CAST(sum(deliveries) AS DOUBLE) AS y FROM deliveries GROUP BY ALL
)"""


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    """Series rows `(region, model, date, y)`."""
    return (
        deliveries(spark, sf)
        .groupBy("region", "model", "date")
        .agg(F.sum("deliveries").cast("double").alias("y"))
    )
