"""Queries on single aggregates, orders of nulls, and projections; plain functions of Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.plans.queries import query, read


@query("SELECT l_orderkey, any_value(l_returnflag) AS returnflag, count(*) AS n_lines FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1")
def single_valued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the value of groups that have only one; least and greatest say so without a distinct count."""
    flag = F.col("l_returnflag")
    groups = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min(flag).alias("returnflag"), F.max(flag).alias("most"), F.count("*").alias("n_lines"))
    return groups.where("returnflag = most").drop("most")


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def value_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct values of each group in order, as one text."""
    read(spark, sf_dir, "orders").createOrReplaceTempView("value_lists_orders")
    return spark.sql("SELECT o_custkey, listagg(DISTINCT o_orderpriority, ', ') WITHIN GROUP (ORDER BY o_orderpriority) AS priorities FROM value_lists_orders GROUP BY o_custkey")


@query("SELECT event_type AS item, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC LIMIT 3")
def frequent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent values from a sketch of bounded size, exact while it holds all distinct values."""
    top = read(spark, sf_dir, "events").agg(F.expr("approx_top_k(event_type, 3, 1000)").alias("top"))
    return top.select(F.inline("top")).select("item", F.col("count").alias("n"))


@query("SELECT l_suppkey, count(*) AS n, round(stddev_samp(l_quantity), 4) AS deviation, round(stddev_samp(l_quantity) / nullif(avg(l_quantity), 0), 4) AS variation FROM lineitem GROUP BY 1")
def variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: sample deviation and its ratio to the mean; null where the mean is zero or there is one row."""
    deviation, mean = F.stddev_samp("l_quantity"), F.avg("l_quantity")
    lines = read(spark, sf_dir, "lineitem")
    return lines.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.round(deviation, 4).alias("deviation"), F.round(F.try_divide(deviation, mean), 4).alias("variation"))


@query("""WITH t AS (SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS balance FROM customer)
SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY balance NULLS FIRST, c_custkey) AS from_missing, row_number() OVER (PARTITION BY c_nationkey ORDER BY balance DESC NULLS LAST, c_custkey) AS from_most FROM t""")
def null_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: places with missing values first, and with missing values last."""
    c = read(spark, sf_dir, "customer").withColumn("balance", F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")))
    nation, balance = Window.partitionBy("c_nationkey"), F.col("balance")
    place = lambda order: F.row_number().over(nation.orderBy(order, "c_custkey"))
    return c.select("c_custkey", place(balance.asc_nulls_first()).alias("from_missing"), place(balance.desc_nulls_last()).alias("from_most"))


@query("""SELECT p.key AS name, count(*) AS n, sum(TRY_CAST(json_extract_string(props, p.key) AS BIGINT))::BIGINT AS total FROM events, unnest(json_keys(props)) AS p(key) GROUP BY 1""")
def prop_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: a row per entry of a JSON object, then sums by its name."""
    entries = read(spark, sf_dir, "events").select(F.explode(F.from_json("props", "map<string,string>")).alias("name", "v"))
    return entries.groupBy("name").agg(F.count("*").alias("n"), F.sum(F.expr("try_cast(v AS BIGINT)")).alias("total"))


@query("SELECT * EXCLUDE (s_name, s_acctbal) FROM supplier")
def all_but(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns but some."""
    return read(spark, sf_dir, "supplier").drop("s_name", "s_acctbal")


@query("""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey END AS o_custkey, CASE WHEN o_orderkey % 8 = 0 THEN ' ' ELSE o_orderstatus END AS o_orderstatus FROM orders)
SELECT * FROM t WHERE o_custkey IS NOT NULL AND trim(o_orderstatus) <> ''""")
def complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that have all required fields; blank texts count as missing."""
    k = F.col("o_orderkey")
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 6 != 0, F.col("o_custkey")).alias("o_custkey"), F.when(k % 8 == 0, " ").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    return o.dropna(subset=["o_custkey", "o_orderstatus"]).where(F.trim("o_orderstatus") != "")
