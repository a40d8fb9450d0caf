"""Queries on control of loads, rules, samples and overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.operators import freshness, graph, joins, quality, rules, runs, series
from sluicework.plans.queries import _SERIES, _series, query, read


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(c_custkey::VARCHAR), c_custkey LIMIT 100")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: a sample that is the same in every run."""
    return read(spark, sf_dir, "customer").orderBy(F.md5(F.col("c_custkey").cast("string")), "c_custkey").limit(100).select("c_custkey", "c_name")


@query("""WITH a AS (SELECT o_custkey, c_name || CASE WHEN o_custkey % 50 = 0 THEN 'x' ELSE '' END AS v FROM (SELECT DISTINCT o_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey)), b AS (SELECT DISTINCT o_custkey, c_name AS v FROM orders JOIN customer ON o_custkey = c_custkey),
k AS (SELECT o_custkey FROM b ORDER BY md5(o_custkey::VARCHAR), o_custkey LIMIT 200)
SELECT o_custkey, v, 'a' AS side FROM (SELECT * FROM a WHERE o_custkey IN (SELECT * FROM k) EXCEPT ALL SELECT * FROM b) UNION ALL SELECT o_custkey, v, 'b' FROM (SELECT * FROM b WHERE o_custkey IN (SELECT * FROM k) EXCEPT ALL SELECT * FROM a)""")
def parity_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental result against a full one, on a sample of keys."""
    b = read(spark, sf_dir, "orders").select("o_custkey").distinct().join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_custkey", F.col("c_name").alias("v"))
    a = b.withColumn("v", F.concat("v", F.when(F.col("o_custkey") % 50 == 0, "x").otherwise("")))
    return rules.parity_sample(a, b, "o_custkey", 200)


@query("""WITH p AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), o AS (SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(*) AS shared FROM p a JOIN p b ON a.l_partkey = b.l_partkey AND a.l_suppkey <> b.l_suppkey GROUP BY ALL)
SELECT a, b, shared, place FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) AS place FROM o) WHERE place <= 3""")
def supplier_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three suppliers with most parts in common, per supplier; a top-3 report."""
    return joins.most_overlap(read(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey", 3)


_RULES = [rules.Rule("metal", "%ring%", 2), rules.Rule("tool", "%widget%", 1, unless="red%"), rules.Rule("small", "small%", 3), rules.Rule("red", "red%", 4), rules.Rule("other", "%", 9)]


@query("""SELECT p_partkey, CASE WHEN p_name LIKE '%widget%' AND p_name NOT LIKE 'red%' THEN 'tool' WHEN p_name LIKE '%ring%' THEN 'metal' WHEN p_name LIKE 'small%' THEN 'small' WHEN p_name LIKE 'red%' THEN 'red' ELSE 'other' END AS label FROM part""")
def rule_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C17: labels by rules with priorities and exceptions."""
    return read(spark, sf_dir, "part").select("p_partkey", rules.classify(F.col("p_name"), _RULES).alias("label"))


@query("""WITH r AS (SELECT * FROM (VALUES ('metal', '%ring%', 2), ('tool', '%widget%', 1), ('any', '%', 9)) t(label, pattern, priority)) SELECT p_partkey, arg_min(label, priority) AS label FROM part JOIN r ON p_name LIKE pattern GROUP BY 1""")
def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table of rules."""
    table = spark.createDataFrame([("metal", "%ring%", 2), ("tool", "%widget%", 1), ("any", "%", 9)], "label string, pattern string, priority int")
    return rules.classify_by_table(read(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", table, "label").select("p_partkey", "label")


@query("""WITH t AS (SELECT 'p_partkey' AS column_name, p_partkey::VARCHAR AS v FROM part UNION ALL SELECT 'p_name', p_name FROM part UNION ALL SELECT 'p_size', nullif(p_size, 7)::VARCHAR FROM part)
SELECT column_name, count(v) AS n_values, count(*) - count(v) AS n_null, count(*) FILTER (regexp_matches(v, '^[-+]?[0-9]+([.][0-9]+)?$')) AS n_numeric, count(*) FILTER (regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}')) AS n_dates, min(length(v))::INT AS min_length, max(length(v))::INT AS max_length FROM t GROUP BY 1""")
def type_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds and lengths of values per column."""
    p = read(spark, sf_dir, "part")
    return rules.type_profile(p.select("p_partkey", "p_name", F.nullif("p_size", F.lit(7)).alias("p_size")))


@query(r"""WITH t AS (SELECT 'a' AS column_name, o_orderkey::VARCHAR AS v FROM orders UNION ALL SELECT 'b', o_totalprice::VARCHAR FROM orders UNION ALL SELECT 'c', o_orderstatus FROM orders UNION ALL SELECT 'd', o_orderdate::VARCHAR FROM orders UNION ALL SELECT 'e', NULL FROM orders
  UNION ALL SELECT 'f', (o_orderkey % 2 = 0)::VARCHAR FROM orders UNION ALL SELECT 'g', CASE WHEN o_orderkey % 100 = 7 THEN 'n/a' ELSE o_custkey::VARCHAR END FROM orders UNION ALL SELECT 'h', CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice::VARCHAR ELSE o_custkey::VARCHAR END FROM orders)
SELECT column_name, CASE WHEN count(v) = 0 THEN 'string' WHEN count(v) = count(*) FILTER (regexp_matches(v, '^\d{4}-\d{2}-\d{2}') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'timestamp' WHEN count(v) = count(*) FILTER (regexp_matches(v, '^\s*[-+]?\d+\s*$') AND TRY_CAST(v AS BIGINT) IS NOT NULL) THEN 'integer'
  WHEN count(v) = count(TRY_CAST(v AS DOUBLE)) THEN 'float' WHEN count(v) = count(TRY_CAST(v AS BOOLEAN)) THEN 'boolean' ELSE 'string' END AS inferred FROM t GROUP BY 1""")
def inferred_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: the narrowest type that fits every value of a text column; one stray value, or a few decimals, widen it."""
    o = read(spark, sf_dir, "orders")
    text = lambda c: F.col(c).cast("string")
    mixed = {"f": (F.col("o_orderkey") % 2 == 0).cast("string"), "g": F.when(F.col("o_orderkey") % 100 == 7, "n/a").otherwise(text("o_custkey")), "h": F.when(F.col("o_orderkey") % 3 == 0, text("o_totalprice")).otherwise(text("o_custkey"))}
    plain = {"a": text("o_orderkey"), "b": text("o_totalprice"), "c": F.col("o_orderstatus"), "d": text("o_orderdate"), "e": F.lit(None).cast("string")}
    return quality.infer_types(o.select([v.alias(k) for k, v in (plain | mixed).items()]))


@query(f"""WITH {_SERIES}, m AS (SELECT table_name, median(n) AS body FROM series GROUP BY 1), p AS (SELECT table_name, n < 0.8 * body AS low, row_number() OVER (PARTITION BY table_name ORDER BY d DESC) AS place FROM series JOIN m USING (table_name))
SELECT table_name, greatest(5, coalesce(min(place) FILTER (NOT low) - 1, count(*)))::INT AS settle_days FROM p GROUP BY 1""")
def settle_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the last days may still be filling."""
    return series.settle_lag(_series(spark, sf_dir))


@query(f"""WITH {_SERIES}, days AS (SELECT table_name, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM series GROUP BY 1), f AS (SELECT table_name, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY table_name ORDER BY d DESC) AS place FROM days LEFT JOIN series USING (table_name, d))
SELECT table_name, coalesce(median(n) FILTER (place > 7) > 0 AND max(n) FILTER (place <= 7) = 0, false) AS flagged FROM f GROUP BY 1""")
def gone_to_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series that ended in zeros."""
    return series.gone_to_zero(_series(spark, sf_dir))


@query("""WITH a AS (SELECT count(*) AS n, 100.0 * count(*) FILTER (value > 40) / count(*) AS p FROM events WHERE ts >= TIMESTAMP '2024-01-20'), b AS (SELECT count(*) AS n, 100.0 * count(*) FILTER (value > 90) / count(*) AS p FROM events WHERE ts < TIMESTAMP '2024-01-20')
SELECT a.n AS recent_rows, round(a.p, 6) AS recent_pct, b.n AS before_rows, round(b.p, 6) AS before_pct, a.n >= 100 AND b.n >= 100 AND a.p - b.p > 20 AS flagged FROM a, b""")
def null_jump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is null much more often than before."""
    e = read(spark, sf_dir, "events")
    recent, before = e.where("ts >= TIMESTAMP '2024-01-20'"), e.where("ts < TIMESTAMP '2024-01-20'")
    out = quality.null_jump(recent.withColumn("v", F.when(F.col("value") <= 40, 1)), before.withColumn("v", F.when(F.col("value") <= 90, 1)), "v")
    return out.withColumns({c: F.round(c, 6) for c in ("recent_pct", "before_pct")})


@query("""SELECT l_returnflag AS source, l_linestatus AS table_name, count(*) AS n, arg_max(l_linenumber::VARCHAR, (l_shipdate, l_linenumber::VARCHAR)) AS last_error FROM lineitem WHERE l_tax < 0.04 AND l_linenumber < 5 GROUP BY 1, 2""")
def retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open failures with retries left, and the latest error."""
    f = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("table_name"), (F.col("l_tax") >= 0.04).alias("resolved"), (F.col("l_linenumber") - 2).alias("retry_count"), F.col("l_shipdate").alias("failed_at"), F.col("l_linenumber").cast("string").alias("error_type"))
    return freshness.retryable(f)


@query("""SELECT o_custkey, o_orderkey AS job, o_orderdate::VARCHAR AS at FROM orders WHERE o_orderstatus <> 'F' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def resumable_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest job that isn't complete, per source."""
    o = read(spark, sf_dir, "orders").where("o_orderstatus <> 'F'")
    return runs.latest(o, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", F.col("o_orderkey").alias("job"), F.col("o_orderdate").cast("string").alias("at"))


@query("""SELECT event_type AS source, date_diff('hour', max(ts), TIMESTAMP '2024-01-31 12:00:00') AS age_hours, 6 AS limit_hours, event_type <> 'error' AS critical, date_diff('hour', max(ts), TIMESTAMP '2024-01-31 12:00:00') > 6 AS stale,
 bool_or(date_diff('hour', max(ts), TIMESTAMP '2024-01-31 12:00:00') > 6 AND event_type <> 'error') OVER () AS blocked FROM (SELECT event_type, date_trunc('hour', ts) AS ts FROM events) GROUP BY 1""")
def upstream_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: stale sources, and whether a critical one blocks the run."""
    e = read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.timestamp_diff("HOUR", F.date_trunc("hour", F.max("ts")), F.lit("2024-01-31 12:00:00").cast("timestamp")).alias("age_hours"))
    return freshness.upstream_gate(e.select("source", "age_hours", F.lit(6).alias("limit_hours"), (F.col("source") != "error").alias("critical")))


@query("""WITH n AS (SELECT o_orderkey::VARCHAR AS v, 'N' || (o_custkey // 3) AS new_id, 'O' || (o_custkey // 2) AS old_id FROM orders), o AS (SELECT old_id, new_id, count(*) AS members FROM n GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY old_id ORDER BY members DESC, new_id) AS place, count(*) OVER (PARTITION BY old_id) AS parts FROM o), f AS (SELECT * FROM b WHERE place = 1)
SELECT old_id, new_id AS current_id, members, CASE WHEN parts > 1 THEN 'split' WHEN count(*) OVER (PARTITION BY new_id) > 1 THEN 'merge' ELSE 'stable' END AS event_type FROM f""")
def graph_persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each entity id between two runs."""
    o = read(spark, sf_dir, "orders").select(F.lit("order").alias("node_type"), F.col("o_orderkey").cast("string").alias("node_value"), "o_custkey")
    ids = lambda p, k: o.select("node_type", "node_value", F.concat(F.lit(p), F.floor(F.col("o_custkey") / k).cast("string")).alias("entity_id"))
    return graph.persist_ids(ids("N", 3), ids("O", 2))
