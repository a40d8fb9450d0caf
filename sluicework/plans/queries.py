"""The library's operators applied to the driver tables: name, function of (spark, sf_dir), and the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluicework.functions import normalise
from sluicework.operators import freshness, graph, joins, merge, quality, series

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A re-pull of the customers: some gone, some with another balance or a null segment, some new."""
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    kept = c.where(k % 10 != 3).withColumns({"c_acctbal": F.when(k % 7 == 0, F.col("c_acctbal") + 100).otherwise(F.col("c_acctbal")), "c_mktsegment": F.when(k % 11 != 0, F.col("c_mktsegment"))})
    return kept.unionByName(c.where(k % 5 == 0).withColumn("c_custkey", k + 10_000_000))


_STAGING = """staging AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_custkey % 10 <> 3 UNION ALL SELECT c_custkey + 10000000, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_custkey % 5 = 0)"""
_CHANGED = "(s.c_name IS DISTINCT FROM m.c_name OR s.c_nationkey IS DISTINCT FROM m.c_nationkey OR s.c_acctbal IS DISTINCT FROM m.c_acctbal OR s.c_mktsegment IS DISTINCT FROM m.c_mktsegment)"


@query(f"""WITH {_STAGING}
SELECT coalesce(m.c_custkey, s.c_custkey) AS c_custkey, CASE WHEN m.c_custkey IS NULL THEN 'INSERT' WHEN s.c_custkey IS NULL THEN 'KEEP' WHEN {_CHANGED} THEN 'UPDATE' ELSE 'KEEP' END AS action,
  coalesce(s.c_name, m.c_name) AS c_name, coalesce(s.c_nationkey, m.c_nationkey) AS c_nationkey, coalesce(s.c_acctbal, m.c_acctbal) AS c_acctbal, coalesce(s.c_mktsegment, m.c_mktsegment) AS c_mktsegment
FROM staging s FULL JOIN customer m ON s.c_custkey = m.c_custkey""")
def hash_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The upsert; null values of the re-pull don't overwrite."""
    return merge.hash_merge(_staging(spark, sf_dir), read(spark, sf_dir, "customer"), ["c_custkey"])


@query(f"""WITH {_STAGING}
SELECT count(*) FILTER (m.c_custkey IS NULL) AS rows_inserted, count(*) FILTER (m.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL AND {_CHANGED}) AS rows_updated,
  count(*) FILTER (s.c_custkey IS NULL) AS rows_removed, count(s.c_custkey) AS rows_total FROM staging s FULL JOIN customer m ON s.c_custkey = m.c_custkey""")
def merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3d, M9: what a rebuild that deletes missing rows changes."""
    return merge.change_stats(merge.hash_merge(_staging(spark, sf_dir), read(spark, sf_dir, "customer"), ["c_custkey"], merge.MergeRules(delete_missing=True)))


@query(f"""WITH {_STAGING}
SELECT 'ADDED' AS change_type, s.* FROM staging s ANTI JOIN customer m USING (c_custkey) UNION ALL SELECT 'REMOVED', m.* FROM customer m ANTI JOIN staging s USING (c_custkey)
UNION ALL SELECT 'UPDATED', s.* FROM staging s JOIN customer m USING (c_custkey) WHERE {_CHANGED}""")
def snapshot_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog of a snapshot that replaces the table."""
    return merge.snapshot_replace(_staging(spark, sf_dir), read(spark, sf_dir, "customer"), ["c_custkey"])[1]


@query(f"WITH {_STAGING} SELECT m.*, 'not in source' AS removal_reason FROM customer m ANTI JOIN staging s USING (c_custkey)")
def removed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: rows that a snapshot no longer has."""
    return merge.removed_records(_staging(spark, sf_dir), read(spark, sf_dir, "customer"), ["c_custkey"])


@query("SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY ALL")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key, the latest."""
    return merge.dedup_latest(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], F.col("l_shipdate")).select("l_orderkey", "l_linenumber", "l_shipdate")


@query("""WITH s AS (SELECT l_orderkey AS k, sum(l_quantity)::BIGINT AS impressions, l_returnflag AS flag FROM lineitem GROUP BY ALL)
SELECT k, max(impressions) AS impressions FROM s GROUP BY k""")
def metric_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: of rows with one key, the one with the largest sum of metrics."""
    s = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("flag")).agg(F.sum("l_quantity").cast("long").alias("impressions"))
    full = s.withColumns({c: F.lit(0) for c in merge.METRICS[1:]})
    return merge.dedup_staging(full, ["k"]).select("k", "impressions")


@query("""SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN p_brand WHEN 'Brand#' || (p_partkey % 25) IS DISTINCT FROM p_brand THEN 'Brand#' || (p_partkey % 25) ELSE p_brand END AS p_brand,
  p_size % 5 <> 0 AND 'Brand#' || (p_partkey % 25) IS DISTINCT FROM p_brand AS changed FROM part""")
def lookup_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values from a lookup where they differ; guarded rows keep theirs."""
    p = read(spark, sf_dir, "part")
    lookup = p.select("p_partkey", F.concat(F.lit("Brand#"), F.col("p_partkey") % 25).alias("p_brand"))
    return merge.update_from_lookup(p.withColumn("manual", F.col("p_size") % 5 == 0), lookup, "p_partkey", "p_brand", "manual").select("p_partkey", "p_brand", "changed")


@query("""WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg, c_acctbal FROM customer)
SELECT x.column_name, round(100.0 * x.nulls / n, 2) AS null_pct, round(100.0 * x.nulls / n, 2) <= 5 AS passed FROM
 (SELECT count(*) AS n, unnest([{'column_name': 'c_custkey', 'nulls': count(*) - count(c_custkey)}, {'column_name': 'seg', 'nulls': count(*) - count(seg)}, {'column_name': 'c_acctbal', 'nulls': count(*) - count(c_acctbal)}]) AS x FROM c)""")
def null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, A2: the share of nulls in each column."""
    return quality.null_rates(read(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"), "c_acctbal"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur more than once."""
    return quality.duplicate_groups(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT sum(n)::BIGINT AS n_rows, sum(n - 1)::BIGINT AS extra_rows, sum(n - 1) / sum(n) AS ratio, sum(n - 1) / sum(n) > 0.001 AS flagged FROM g""")
def duplicate_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of rows beyond one per key."""
    return quality.duplicate_ratio(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_END = "(SELECT max(ts) FROM events)"


@query(f"""SELECT count(*) AS n_rows, count(*) FILTER (epoch_us({_END}) - epoch_us(ts) < 241 * 3600000000) AS n_fresh, round(100.0 * count(*) FILTER (epoch_us({_END}) - epoch_us(ts) < 241 * 3600000000) / count(*), 2) AS fresh_pct,
  round(100.0 * count(*) FILTER (epoch_us({_END}) - epoch_us(ts) < 241 * 3600000000) / count(*), 2) >= 80 AS passed FROM events""")
def fresh_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: the share of events at most 240 whole hours older than the last."""
    e = read(spark, sf_dir, "events")
    return quality.fresh_share(e, "ts", F.lit(e.agg(F.max("ts")).first()[0]), 240)


@query("SELECT c_custkey AS value FROM customer EXCEPT SELECT o_custkey FROM orders")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without an order."""
    return quality.orphans(read(spark, sf_dir, "customer"), "c_custkey", read(spark, sf_dir, "orders"), "o_custkey")


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by day and priority, fewer rows in every 41st day."""
    return series.daily_counts(read(spark, sf_dir, "orders"), "o_orderdate", F.col("o_orderpriority"))


_SERIES = "series AS (SELECT o_orderpriority AS table_name, o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY ALL)"


@query(f"WITH {_SERIES} SELECT table_name, d::VARCHAR AS d, n FROM series")
def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day."""
    return _series(spark, sf_dir).withColumn("d", F.col("d").cast("string"))


@query(f"""WITH {_SERIES}, days AS (SELECT table_name, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM series GROUP BY table_name)
SELECT table_name, count(*) AS n_missing, min(d)::VARCHAR AS first_missing, max(d)::VARCHAR AS last_missing FROM days ANTI JOIN series USING (table_name, d) GROUP BY table_name""")
def missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of the calendar without a row."""
    return series.missing_days(_series(spark, sf_dir)).withColumns({c: F.col(c).cast("string") for c in ("first_missing", "last_missing")})


@query(f"""WITH {_SERIES}, gaps AS (SELECT table_name, d - lag(d) OVER (PARTITION BY table_name ORDER BY d) AS gap FROM series),
mode AS (SELECT table_name, gap FROM (SELECT table_name, gap, count(*) AS k FROM gaps WHERE gap IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY k DESC, gap) = 1),
span AS (SELECT table_name, max(d) AS last_date, max(d) - min(d) AS span FROM series GROUP BY table_name)
SELECT table_name, last_date::VARCHAR AS last_date, (DATE '2001-08-10' - last_date)::INT AS lag_days, (CASE WHEN span >= 30 THEN gap ELSE 1 END)::INT AS cadence, CASE WHEN DATE '2001-08-10' - last_date > CASE WHEN span >= 30 THEN gap ELSE 1 END + 2 THEN 'HIGH' ELSE 'NONE' END AS severity
FROM span LEFT JOIN mode USING (table_name)""")
def recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lag of each series against its cadence."""
    return series.recency(_series(spark, sf_dir), F.lit("2001-08-10").cast("date")).withColumn("last_date", F.col("last_date").cast("string"))


_LINES = "SELECT 'lineitem' AS table_name, l_shipdate::DATE AS d, count(*) AS n FROM lineitem WHERE epoch_us(l_shipdate) // 86400000000 % 37 <> 0 OR l_linenumber = 1 GROUP BY ALL"


@query(f"""WITH s AS ({_LINES}), settled AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY table_name ORDER BY d DESC) > 5),
m AS (SELECT table_name, median(n) AS median_n, count(*) AS days, max(d) AS last FROM settled GROUP BY 1),
f AS (SELECT *, abs(n - median_n) AS off FROM settled JOIN m USING (table_name)), mad AS (SELECT table_name, median(off) AS mad FROM f GROUP BY 1)
SELECT table_name, d::VARCHAR AS d, n, median_n, median_n - 4 * 1.4826 * mad AS expected_low, CASE WHEN last - d < 14 THEN 'ACTIVE' ELSE 'HISTORICAL' END AS status, CASE WHEN last - d < 14 THEN 'MEDIUM' ELSE 'LOW' END AS severity
FROM f JOIN mad USING (table_name) WHERE days >= 30 AND median_n >= 1 AND n < median_n - 4 * 1.4826 * mad AND n < 0.5 * median_n""")
def volume_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days far below the median by the median deviation."""
    low = F.floor(F.unix_micros(F.col("l_shipdate").cast("timestamp")) / 86_400_000_000) % 37 == 0
    lines = read(spark, sf_dir, "lineitem").where(~low | (F.col("l_linenumber") == 1))
    found = series.volume_outliers(series.daily_counts(lines, "l_shipdate", F.lit("lineitem")), least_median=1.0)
    return found.withColumn("d", F.col("d").cast("string"))


@query(f"""WITH {_SERIES}, days AS (SELECT table_name, unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS d FROM series GROUP BY table_name),
filled AS (SELECT table_name, d, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY table_name ORDER BY d DESC) AS place FROM days LEFT JOIN series USING (table_name, d))
SELECT table_name, sum(n) FILTER (place <= 7)::BIGINT AS recent_n, sum(n) FILTER (place BETWEEN 8 AND 14)::BIGINT AS prior_n, sum(n) FILTER (place <= 7) < 0.05 * sum(n) FILTER (place BETWEEN 8 AND 14) AS collapsed FROM filled GROUP BY 1 HAVING count(*) >= 14""")
def collapses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last week against the week before."""
    return series.collapses(_series(spark, sf_dir))


@query("""WITH t AS (SELECT event_type AS table_name, max(ts)::DATE AS last FROM events WHERE event_type <> 'error' OR ts < TIMESTAMP '2024-01-20' GROUP BY 1),
s AS (SELECT table_name, last, DATE '2024-02-02' - last AS days_behind FROM t)
SELECT table_name, last::VARCHAR AS most_recent_date, days_behind::INT AS days_behind, CASE WHEN days_behind > 7 THEN 'FAIL' WHEN days_behind >= 3 THEN 'WARNING' ELSE 'PASS' END AS audit_status FROM s""")
def freshness_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1, H2: the latest date per kind of event and its status."""
    e = read(spark, sf_dir, "events").where("event_type <> 'error' OR ts < TIMESTAMP '2024-01-20'")
    out = e.groupBy(F.col("event_type").alias("table_name")).agg(freshness.probe(e, ["loaded_at", "ts"]).alias("most_recent_date"))
    behind = F.date_diff(F.lit("2024-02-02").cast("date"), F.col("most_recent_date"))
    return out.select("table_name", F.col("most_recent_date").cast("string").alias("most_recent_date"), behind.alias("days_behind"), freshness.status(behind, F.lit(7), F.lit(3), F.lit(False)).alias("audit_status"))


@query("""WITH r AS (SELECT o_custkey AS table_name, o_orderdate AS run_at, o_orderkey, o_totalprice::BIGINT AS days_behind FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) = 1),
p AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY run_at DESC) AS place, lead(days_behind) OVER (PARTITION BY table_name ORDER BY run_at DESC) AS prior FROM r)
SELECT table_name, 'PASS' AS audit_status FROM p WHERE place <= 3 GROUP BY table_name HAVING count(*) = 3 AND bool_and(place = 3 OR days_behind > prior)""")
def at_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that rose over the last three runs; halves go to the even number, as in the SQL's cast."""
    runs = merge.dedup_latest(read(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], -F.col("o_orderkey"))
    runs = runs.select(F.col("o_custkey").alias("table_name"), F.col("o_orderdate").alias("run_at"), F.rint("o_totalprice").cast("long").alias("days_behind"), F.lit("PASS").alias("audit_status"))
    return freshness.at_risk(runs)


_SCORE = "round(45 * (1 - avg((l_returnflag = 'R')::INT)) + 20 * least(avg(l_quantity) / 50, 1) + 15 * (1 - avg(l_discount)) + 10 * (1 - avg(l_tax)) + 10 * avg((l_linestatus = 'O')::INT), 1)"


@query(f"""WITH s AS (SELECT l_suppkey, {_SCORE} AS score FROM lineitem GROUP BY 1)
SELECT l_suppkey, score, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 60 THEN 'D' ELSE 'F' END AS grade, score < 70 OR 75 - score >= 15 AS degraded FROM s""")
def reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score per source, its grade and whether it has degraded."""
    share = lambda c, v: F.avg((F.col(c) == v).cast("int"))
    score = freshness.reliability({"success": 1 - share("l_returnflag", "R"), "freshness": F.avg("l_quantity") / 50, "quality": 1 - F.avg("l_discount"), "anomaly": 1 - F.avg("l_tax"), "schema": share("l_linestatus", "O")})
    out = read(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(score.alias("score"))
    return out.select("l_suppkey", "score", freshness.grade(F.col("score")).alias("grade"), freshness.degraded(F.col("score"), F.lit(75.0)).alias("degraded"))


@query("""SELECT a.event_id, b.event_id AS b_event_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'click' AND b.event_type = 'purchase' AND abs(epoch_us(a.ts) - epoch_us(b.ts)) < 301 * 1000000""")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and purchases of one user at most five minutes apart, in whole seconds."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return joins.interval_join(e.where("event_type = 'click'"), e.where("event_type = 'purchase'"), ["user_id"], "ts", "ts", 300).select("event_id", "b_event_id")


@query("""WITH h AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'signup' GROUP BY ALL)
SELECT e.event_id, h.value AS value_as_of FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN h ON e.user_id = h.user_id AND e.ts >= h.ts""")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value in effect at each event."""
    e = read(spark, sf_dir, "events")
    history = e.where("event_type = 'signup'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    found = joins.as_of(e.where("event_type = 'error'").select("event_id", "user_id", "ts"), "ts", history, ["user_id"], "ts", ["value"])
    return found.select("event_id", "value_as_of")


@query("""WITH n AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem), z AS (SELECT l_orderkey FROM n GROUP BY 1 HAVING count(*) BETWEEN 2 AND 50)
SELECT a.l_orderkey, a.l_suppkey AS a, b.l_suppkey AS b FROM n a JOIN n b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey SEMI JOIN z ON a.l_orderkey = z.l_orderkey""")
def pairs_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of suppliers within an order, orders of 2 to 50 suppliers."""
    p = joins.pairs_within(read(spark, sf_dir, "lineitem"), "l_orderkey", ["l_suppkey"])
    return p.select("l_orderkey", F.col("a.l_suppkey").alias("a"), F.col("b.l_suppkey").alias("b"))


@query("""WITH u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE)))) AS e FROM embeddings)
SELECT a.vec_id, a.label, round(avg(list_dot_product(a.e, b.e)), 9) AS similarity FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY ALL""")
def group_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean cosine of each vector to the others of its label."""
    return joins.group_similarity(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label").select("vec_id", "label", F.round("similarity", 9).alias("similarity"))


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifier pairs: an order and its customer, an order and all of its suppliers."""
    o, l_ = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    end = lambda t, c: [F.lit(t), F.col(c).cast("string")]
    cols = ["a_type", "a_value", "b_type", "b_value", "match_rule", "source_system", "base_confidence", "cap", "first_seen", "last_seen"]
    a = o.select(*end("order", "o_orderkey"), *end("customer", "o_custkey"), F.lit("placed"), F.lit("s1"), F.lit(0.6), F.lit(0.9), "o_orderdate", F.col("o_orderdate").alias("x")).toDF(*cols)
    b = l_.select(*end("supplier", "l_suppkey"), *end("order", "l_orderkey"), F.lit("shipped"), F.when(F.col("l_quantity") > 25, "s2").otherwise("s1"), F.lit(0.5), F.lit(0.8), "l_shipdate", F.col("l_shipdate").alias("x")).toDF(*cols)
    return a.unionByName(b)


_EDGES = """edges AS (SELECT 'customer' AS a_type, o_custkey::VARCHAR AS a_value, 'order' AS b_type, o_orderkey::VARCHAR AS b_value, 'placed' AS match_rule, 's1' AS source_system, 0.6::DOUBLE AS base, 0.9::DOUBLE AS cap, o_orderdate AS t FROM orders
  UNION ALL SELECT 'order', l_orderkey::VARCHAR, 'supplier', l_suppkey::VARCHAR, 'shipped', CASE WHEN l_quantity > 25 THEN 's2' ELSE 's1' END, 0.5, 0.8, l_shipdate FROM lineitem),
agg AS (SELECT a_type, a_value, b_type, b_value, match_rule, min(source_system) AS source_system, count(*) AS observations, min(t) AS first_seen, max(t) AS last_seen, max(base) AS base_confidence, round(least(max(cap), max(base) * log2(count(*) + 1)), 9) AS confidence FROM edges GROUP BY 1, 2, 3, 4, 5)"""


@query(f"WITH {_EDGES} SELECT * FROM agg")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected edges with observations and confidence."""
    return graph.aggregate_edges(_edges(spark, sf_dir)).withColumn("confidence", F.round("confidence", 9))


@query(f"""WITH {_EDGES}, ends AS (SELECT a_type AS t, a_value AS v, b_type || ':' || b_value AS o FROM agg UNION ALL SELECT b_type, b_value, a_type || ':' || a_value FROM agg),
hubs AS (SELECT t, v FROM ends GROUP BY 1, 2 HAVING count(DISTINCT o) > 12)
SELECT a_type, a_value, b_type, b_value, match_rule FROM agg WHERE (a_type, a_value) NOT IN (SELECT (t, v) FROM hubs) AND (b_type, b_value) NOT IN (SELECT (t, v) FROM hubs) AND NOT (b_type = 'supplier' AND b_value IN ('1', '2'))""")
def graph_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges without listed ends and without ends of too many neighbours."""
    e = graph.aggregate_edges(_edges(spark, sf_dir))
    listed = spark.createDataFrame([("supplier", "1"), ("supplier", "2"), ("supplier", None)], "type string, value string")
    return graph.drop_blacklisted(graph.trim_fanout(e, 12), listed).select("a_type", "a_value", "b_type", "b_value", "match_rule")


@query(f"""WITH {_EDGES}, ends AS (SELECT a_type AS t, a_value AS v, b_type AS ot, b_value AS ov FROM agg UNION ALL SELECT b_type, b_value, a_type, a_value FROM agg),
many AS (SELECT t, v FROM ends WHERE ot = 'supplier' GROUP BY 1, 2 HAVING count(DISTINCT ov) >= 2)
SELECT a_type, a_value, b_type, b_value, match_rule, coalesce(m.v IS NOT NULL OR n.v IS NOT NULL, false) AS conflict, CASE WHEN m.v IS NOT NULL OR n.v IS NOT NULL THEN least(confidence, 0.5) ELSE confidence END AS confidence
FROM agg LEFT JOIN many m ON a_type = m.t AND a_value = m.v LEFT JOIN many n ON b_type = n.t AND b_value = n.v""")
def graph_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges at nodes with several suppliers are capped."""
    e = graph.cap_conflicts(graph.aggregate_edges(_edges(spark, sf_dir)), "supplier").withColumn("confidence", F.round("confidence", 9))
    return e.select("a_type", "a_value", "b_type", "b_value", "match_rule", "conflict", "confidence")


@query(f"""WITH RECURSIVE {_EDGES}, few AS (SELECT * FROM agg WHERE last_seen IS NULL OR date_diff('day', last_seen, TIMESTAMP '2001-09-01') <= CASE WHEN a_type = 'customer' THEN 1000 ELSE 400 END),
links AS (SELECT a_type || ':' || a_value AS u, b_type || ':' || b_value AS v FROM few UNION SELECT b_type || ':' || b_value, a_type || ':' || a_value FROM few),
keyed AS (SELECT DISTINCT u, CASE split_part(u, ':', 1) WHEN 'customer' THEN '1' WHEN 'supplier' THEN '2' ELSE '3' END || u AS k FROM links),
reach(u, k) USING KEY (u) AS (SELECT u, k FROM keyed UNION SELECT l.v, min(r.k) FROM reach r JOIN links l ON r.u = l.u JOIN recurring.reach c ON c.u = l.v WHERE r.k < c.k GROUP BY l.v),
best AS (SELECT u, substr(k, 2) AS root FROM reach)
SELECT split_part(u, ':', 1) AS node_type, split_part(u, ':', 2) AS node_value, split_part(root, ':', 1) AS root_type, split_part(root, ':', 2) AS root_value,
 'ent_' || left(translate(to_base64(unhex(sha256(root))), '+/=', '-_'), 16) AS entity_id, count(*) OVER (PARTITION BY root) AS cluster_size FROM best""")
def graph_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities over all edges that are recent enough for their types, suppliers' too."""
    recent = graph.in_influence(graph.aggregate_edges(_edges(spark, sf_dir)), F.lit("2001-09-01").cast("timestamp"), {"customer": 1000, "order": -1, "supplier": 400})
    return graph.stitch(recent, {"customer": 1, "supplier": 2, "order": 3}, 0.0)


@query("""SELECT event_id, CASE WHEN props IS NULL THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS at, sha256(coalesce(user_id::VARCHAR, '') || '|' || coalesce(event_type, '')) AS device FROM events""")
def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3, P11, F2, F7, G1d: fields of JSON, ISO text and hashes of signals."""
    return read(spark, sf_dir, "events").select("event_id", normalise.coerce(F.get_json_object("props", "$.k"), "INT64").alias("k"), normalise.iso(F.col("ts")).alias("at"), normalise.device_hash(F.col("user_id"), F.col("event_type")).alias("device"))


@query("""SELECT o_custkey, sum(o_totalprice) FILTER (o_orderstatus = 'F') AS f, sum(o_totalprice) FILTER (o_orderstatus = 'O') AS o, sum(o_totalprice) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1""")
def pivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long to wide."""
    return read(spark, sf_dir, "orders").groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.sum("o_totalprice")).withColumnsRenamed({"F": "f", "O": "o", "P": "p"})


@query("""SELECT l_orderkey, l_linenumber, l_partkey, m AS measure, v AS value FROM (SELECT l_orderkey, l_linenumber, l_partkey, unnest([{'m': 'discount', 'v': l_discount}, {'m': 'quantity', 'v': l_quantity}, {'m': 'tax', 'v': l_tax}], recursive := true) FROM lineitem) WHERE v <> 0""")
def unpivot_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide to long, without empty values."""
    wide = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_discount").alias("discount"), F.col("l_quantity").alias("quantity"), F.col("l_tax").alias("tax"))
    return wide.unpivot(["l_orderkey", "l_linenumber", "l_partkey"], ["discount", "quantity", "tax"], "measure", "value").where("value <> 0")


@query("""SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses, median(o_totalprice) AS median_price, bool_or(o_totalprice > 499000) AS any_large, round(stddev_samp(o_totalprice), 4) AS spread
FROM orders GROUP BY 1""")
def priority_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, distinct counts, ordered lists, medians and spreads."""
    o = read(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    return o.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"), F.median(price).alias("median_price"), F.bool_or(price > 499000).alias("any_large"), F.round(F.stddev_samp(price), 4).alias("spread"))


@query("SELECT * FROM (SELECT l_partkey, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue FROM lineitem GROUP BY 1) ORDER BY n DESC, l_partkey LIMIT 25")
def top_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-25 report."""
    return read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue")).orderBy(F.desc("n"), "l_partkey").limit(25)


@query("SELECT n_name, r_name, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM (SELECT l_suppkey, l_extendedprice, l_discount FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01') JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2".replace("sum(l_extendedprice * (1 - l_discount))", "round(sum(l_extendedprice * (1 - l_discount)), 2)"))
def revenue_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered scan joined to small tables; the rows are summed by supplier before any join."""
    by = read(spark, sf_dir, "lineitem").where("l_shipdate >= TIMESTAMP '1997-01-01'").groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    joined = by.join(s, by["l_suppkey"] == s["s_suppkey"]).join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    return joined.groupBy("n_name", "r_name").agg(F.round(F.sum("revenue"), 2).alias("revenue"))
