"""The driver's tables in the grain of the domain: territory x period x category facts. Each as a frame and as SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _code(c: str, width: int):
    return F.lpad(F.col(c).cast("string"), width, "0")


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """commune = nation, region, year of shipping, category = part type, value = quantity shipped. Complete grid."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", F.year("l_shipdate").alias("year"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    # Lines go once to their order and once to their part; the order's nation is found without them.
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    sold = line.join(placed, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    counted = sold.groupBy("c_nationkey", "year", "p_type").agg(F.sum("l_quantity").cast("long").alias("value"))
    # nation has a fixed 25 rows
    named = counted.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select(_code("n_nationkey", 5).alias("commune_code"), F.col("n_name").alias("commune_name"), _code("n_regionkey", 2).alias("region_code"), "year", F.col("p_type").alias("crime_category"), "value")


DENSE_SQL = """
    SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS commune_code, n_name AS commune_name, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS region_code,
           CAST(year(l_shipdate) AS INTEGER) AS year, p_type AS crime_category, CAST(sum(l_quantity) AS BIGINT) AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
         JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
    GROUP BY ALL"""


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """commune = supplier, category = brand, value = lines. Cells without a line have no row, and none is made up."""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("year"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    sold = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    counted = sold.groupBy("l_suppkey", "year", "p_brand").agg(F.count("*").alias("value"))
    return counted.select(_code("l_suppkey", 5).alias("commune_code"), "year", F.col("p_brand").alias("crime_category"), "value")


SPARSE_SQL = """
    SELECT lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS commune_code, CAST(year(l_shipdate) AS INTEGER) AS year, p_brand AS crime_category, count(*) AS value
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""


def regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """region = nation, category = order priority, value = orders; one region lacks one year. Classes by category."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    counted = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("year", "c_nationkey", F.col("o_orderpriority").alias("crime_category")).agg(F.count("*").alias("value"))
    kept = counted.where(~((F.col("c_nationkey") == 3) & (F.col("year") == 1998)))
    of = F.col("crime_category").substr(1, 1)
    kind = F.when(of == "1", "base_19913").when(of.isin("2", "3"), "proxy_19913").when(of == "4", "crimen_organizado_proxy").otherwise("contexto_general")
    weight = F.when(of == "1", 1.0).when(of == "2", 0.9).when(of == "3", 0.6).when(of == "4", 0.5).otherwise(0.0)
    return kept.select("year", _code("c_nationkey", 2).alias("region_code"), "crime_category", "value", kind.alias("aml_class"), weight.alias("weight"))


REGIONAL_SQL = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS region_code, o_orderpriority AS crime_category, count(*) AS value,
           CASE left(o_orderpriority, 1) WHEN '1' THEN 'base_19913' WHEN '2' THEN 'proxy_19913' WHEN '3' THEN 'proxy_19913' WHEN '4' THEN 'crimen_organizado_proxy' ELSE 'contexto_general' END AS aml_class,
           CASE left(o_orderpriority, 1) WHEN '1' THEN 1.0 WHEN '2' THEN 0.9 WHEN '3' THEN 0.6 WHEN '4' THEN 0.5 ELSE 0.0 END::DOUBLE AS weight
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE NOT (c_nationkey = 3 AND year(o_orderdate) = 1998) GROUP BY ALL"""


def tiered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sparse() told apart by line status: open lines are the direct source, finished ones its mirror; some rows lack a tier, a code or a metric."""
    line = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus", "l_linenumber", F.year("l_shipdate").alias("year"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    sold = line.join(part, F.col("l_partkey") == F.col("p_partkey"))
    counted = sold.groupBy("l_suppkey", "year", "p_brand", "l_linestatus").agg(F.count("*").alias("value"), F.max("l_linenumber").alias("line"))
    tier = F.when(F.col("l_linestatus") == "O", "primary_direct").when(F.col("l_suppkey") % 7 == 0, F.lit(None)).when(F.col("l_suppkey") % 5 == 0, "elsewhere").otherwise("mirror_of_primary")
    code = F.when(F.col("l_suppkey") % 11 != 0, F.col("l_suppkey").cast("string"))
    metric = F.when(F.col("l_suppkey") % 13 == 0, "denuncias").otherwise("casos_policiales")
    return counted.select("year", code.alias("commune_code"), F.upper("p_brand").alias("crime_category"), metric.alias("metric"), "value", tier.alias("source_tier"), F.col("line").cast("long").alias("ordinal"))


TIERED_SQL = """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS commune_code, upper(p_brand) AS crime_category,
           CASE WHEN l_suppkey % 13 = 0 THEN 'denuncias' ELSE 'casos_policiales' END AS metric, count(*) AS value,
           CASE WHEN l_linestatus = 'O' THEN 'primary_direct' WHEN l_suppkey % 7 = 0 THEN NULL WHEN l_suppkey % 5 = 0 THEN 'elsewhere' ELSE 'mirror_of_primary' END AS source_tier,
           CAST(max(l_linenumber) AS BIGINT) AS ordinal
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, year(l_shipdate), p_brand, l_linestatus"""
