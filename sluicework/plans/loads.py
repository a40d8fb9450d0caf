"""Queries over what a load reads, guards and reports: ranges, merge guards, cleaning, views and assertions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.functions import normalise
from sluicework.operators import freshness, merge, quality, runs
from sluicework.plans.queries import query, read
from sluicework.sources import tables


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS d FROM orders
WHERE o_orderkey % 9 = 0 OR o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-07-01'""")
def half_open_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from a day to the end of another; rows without a date are kept."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")).alias("d"))
    return tables.scan_range(o, "d", "1996-01-01", "1996-06-30", closed=False, keep_null=True)


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey % 9 <> 0 AND o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'""")
def closed_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range closed at both ends; rows without a date go."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    return tables.scan_range(o, "o_orderdate", "1996-01-01", "1996-06-30", closed=True, keep_null=False)


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-18 12:00:00' AND ts < TIMESTAMP '2024-01-26 00:00:00'")
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows from the watermark less two safety days up to the day of the run."""
    start, end = freshness.incremental_window("date", datetime(2024, 1, 25), watermark=datetime(2024, 1, 20, 12), safety=2)
    return freshness.in_window(read(spark, sf_dir, "events").select("event_id", "ts"), "ts", start, end, keep_null=False)


@query("SELECT min(event_id) AS min_id, max(ts)::DATE::VARCHAR AS max_date FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY")
def lookback_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4: the least id and the last date of the lookback, for loads by id."""
    e = read(spark, sf_dir, "events")
    last = e.agg(F.max("ts").alias("last"))
    return e.join(F.broadcast(last), F.col("ts") >= F.col("last") - F.expr("INTERVAL 7 DAYS")).agg(F.min("event_id").alias("min_id"), F.max("ts").cast("date").cast("string").alias("max_date"))


@query("""WITH m AS (SELECT l_orderkey AS k, sum(l_quantity)::BIGINT AS impressions, sum(l_linenumber)::BIGINT AS clicks FROM lineitem GROUP BY ALL),
s AS (SELECT k, CASE WHEN k % 3 = 0 THEN impressions - 1 WHEN k % 3 = 1 THEN impressions + 5 ELSE impressions END AS impressions, clicks FROM m)
SELECT k, CASE WHEN m.k % 3 = 1 THEN 'UPDATE' ELSE 'KEEP' END AS action, greatest(m.impressions, s.impressions) AS impressions, m.clicks FROM m JOIN s USING (k)""")
def guarded_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics that a re-pull has shrunk are not taken."""
    m = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").cast("long").alias("impressions"), F.sum("l_linenumber").cast("long").alias("clicks"))
    s = m.withColumn("impressions", F.col("impressions") + F.when(F.col("k") % 3 == 0, -1).when(F.col("k") % 3 == 1, 5).otherwise(0))
    return merge.hash_merge(s, m, ["k"], merge.MergeRules(guard_metrics=True)).select("k", "action", "impressions", "clicks")


@query("""SELECT user_id, arg_min(event_id, ts) AS first_event, arg_max(event_id, ts) AS last_event FROM (SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY ALL) GROUP BY user_id""")
def first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each key the first and the last row; ties in time go to the least id."""
    e = read(spark, sf_dir, "events")
    return e.groupBy("user_id").agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("first_event"), F.max_by("event_id", F.struct(F.col("ts"), -F.col("event_id"))).alias("last_event"))


@query("""SELECT conv_id, count(*) AS n_rows, count(*) FILTER (length(coalesce(text, '')) > 0) AS n_answered, count(*) FILTER (role = 'assistant') AS n_submitted FROM conversations GROUP BY conv_id""")
def participation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of each group have an answer, and how many are complete."""
    return read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n_rows"), F.count_if(F.length(F.coalesce("text", F.lit(""))) > 0).alias("n_answered"), F.count_if(F.col("role") == "assistant").alias("n_submitted"))


@query("""SELECT l_returnflag, sum(l_quantity)::BIGINT AS shown, sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END)::BIGINT AS seen,
  round(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) / nullif(sum(l_quantity), 0), 6) AS rate, strftime(min(l_shipdate AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'), '%Y-%m-%d %H:%M:%S') AS first_local FROM lineitem GROUP BY l_returnflag""")
def ratio_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast metrics with zero for what doesn't fit, guarded ratios, a named time zone."""
    q = F.coalesce(F.col("l_quantity").cast("string").try_cast("double"), F.lit(0.0))
    seen = F.sum(F.when(F.col("l_linestatus") == "F", q).otherwise(0.0))
    local = F.date_format(F.min(F.from_utc_timestamp("l_shipdate", "America/New_York")), "yyyy-MM-dd HH:mm:ss")
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.sum(q).cast("long").alias("shown"), seen.cast("long").alias("seen"), F.round(F.try_divide(seen, F.sum(q)), 6).alias("rate"), local.alias("first_local"))


@query("""SELECT o_orderkey, coalesce(c.c_nationkey, s.s_nationkey, -1) AS nation, CASE WHEN c.c_custkey IS NOT NULL THEN 'customer' WHEN s.s_suppkey IS NOT NULL THEN 'supplier' END AS side
FROM orders LEFT JOIN customer c ON c_custkey = o_custkey AND c_custkey % 2 = 0 LEFT JOIN supplier s ON s_suppkey = o_custkey""")
def either_endpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two left joins that resolve a key by one table or else the other; -1 where neither has it."""
    o, c, s = (read(spark, sf_dir, t) for t in ("orders", "customer", "supplier"))
    c = c.where(F.col("c_custkey") % 2 == 0).select("c_custkey", "c_nationkey")
    out = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(s.select("s_suppkey", "s_nationkey"), F.col("o_custkey") == F.col("s_suppkey"), "left")
    return out.select("o_orderkey", F.coalesce("c_nationkey", "s_nationkey", F.lit(-1)).alias("nation"), F.when(F.col("c_custkey").isNotNull(), "customer").when(F.col("s_suppkey").isNotNull(), "supplier").alias("side"))


@query("""SELECT 'customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders""")
def scalar_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One frame of scalar counts."""
    out = None
    for t in ("customer", "supplier", "part", "orders"):
        one = read(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("""SELECT o_orderkey, count(*) OVER w AS n, min(o_orderdate) OVER w AS first_date, max(o_orderdate) OVER w AS last_date FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def partition_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-partition counts and bounds beside each row."""
    w = Window.partitionBy("o_custkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", F.count("*").over(w).alias("n"), F.min("o_orderdate").over(w).alias("first_date"), F.max("o_orderdate").over(w).alias("last_date"))


@query(r"""WITH raw AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '1 (' || lpad((200 + c_custkey % 700)::VARCHAR, 3, '0') || ') 234-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0')
  WHEN 1 THEN '555.555.5555' WHEN 2 THEN '21255501' || lpad((c_custkey % 100)::VARCHAR, 2, '0') ELSE '12345' END AS phone,
  ' A.' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '+tag@Gmail.com' ELSE '+tag@Example.com ' END AS mail FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN regexp_replace(substr(regexp_replace(phone, '\D', '', 'g'), 2), '\D', '') END AS phone,
  CASE WHEN c_custkey % 2 = 0 THEN 'a' || c_custkey || '@gmail.com' ELSE 'a.' || c_custkey || '+tag@example.com' END AS mail FROM raw""")
def clean_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """phones without test patterns; mail addresses without tags and dots on listed domains."""
    k = F.col("c_custkey")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    phone = F.when(k % 4 == 0, F.concat(F.lit("1 ("), pad(200 + k % 700, 3), F.lit(") 234-"), pad(k % 10000, 4))).when(k % 4 == 1, "555.555.5555").when(k % 4 == 2, F.concat(F.lit("21255501"), pad(k % 100, 2))).otherwise("12345")
    mail = F.concat(F.lit(" A."), k.cast("string"), F.when(k % 2 == 0, "+tag@Gmail.com").otherwise("+tag@Example.com "))
    return read(spark, sf_dir, "customer").select("c_custkey", normalise.phone(phone).alias("phone"), normalise.email(mail).alias("mail"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN strftime(CASE WHEN o_orderkey % 4 = 2 THEN date_trunc('day', o_orderdate) ELSE date_trunc('second', o_orderdate) END, '%Y-%m-%dT%H:%M:%SZ') END AS at FROM orders""")
def parsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """times given as ISO text, seconds since the epoch, dates or zero dates."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 4 == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).when(k % 4 == 1, F.unix_timestamp(d).cast("string")).when(k % 4 == 2, F.date_format(d, "yyyy-MM-dd")).otherwise("0000-00-00 00:00:00")
    return read(spark, sf_dir, "orders").select("o_orderkey", normalise.iso(normalise.parse_timestamp(text)).alias("at"))


@query("""WITH c AS (SELECT (SELECT count(*) FROM customer) AS n_new, (SELECT count(*) FROM orders) AS n_old) SELECT n_new, n_old, n_new < 0.5 * n_old AS blocked FROM c""")
def shrink_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9: a write that would leave less than half of the rows is blocked."""
    return quality.shrink_guard(read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders"))


@query("SELECT count(*) AS n_rows, count(*) BETWEEN 100 AND 1000000000 AS passed FROM orders")
def row_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4: whether a table's rows are within bounds."""
    return quality.row_bounds(read(spark, sf_dir, "orders"), 100, 1_000_000_000)


@query("""WITH now AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate >= DATE '1998-01-01'), before AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderdate < DATE '1998-01-01')
SELECT 'new' AS change, k FROM now WHERE k NOT IN (SELECT k FROM before) UNION ALL SELECT 'resolved', k FROM before WHERE k NOT IN (SELECT k FROM now)""")
def run_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are active in this run and weren't in the last, and the reverse."""
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")).alias("late"))
    per = o.groupBy("k").agg(F.bool_or("late").alias("now"), F.bool_or(~F.col("late")).alias("before")).where(F.col("now") != F.col("before"))
    return per.select(F.when(F.col("now"), "new").otherwise("resolved").alias("change"), "k")


@query("""SELECT count(*) FILTER (event_type = 'error') AS n_errors, count(*) FILTER (event_type LIKE 'p%' AND value BETWEEN 10 AND 60) AS n_paid, count(*) FILTER (user_id IN (1, 2, 3)) AS n_listed,
  count(*) FILTER (regexp_matches(props, '"k"') OR props IS NULL) AS n_keyed, count(*) FILTER (starts_with(event_type, 'si')) AS n_started FROM events""")
def predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms of conditions, counted in one pass."""
    t, v = F.col("event_type"), F.col("value")
    conds = {"n_errors": t == "error", "n_paid": t.like("p%") & v.between(10, 60), "n_listed": F.col("user_id").isin(1, 2, 3), "n_keyed": F.col("props").rlike('"k"') | F.col("props").isNull(), "n_started": t.startswith("si")}
    return read(spark, sf_dir, "events").agg(*(F.count_if(c).alias(k) for k, c in conds.items()))


@query("""WITH a AS (SELECT count(*) AS n, count(DISTINCT o_orderkey) AS d, count(o_custkey) AS filled FROM orders), x AS (SELECT count(*) AS gone FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
SELECT 'unique_key' AS name, 'hard' AS severity, n = d AS passed, (n - d)::DOUBLE AS detail FROM a UNION ALL
SELECT 'orphans_pct', 'soft', round(100.0 * gone / n, 4) <= 1, round(100.0 * gone / n, 4)::DOUBLE FROM a, x UNION ALL SELECT 'fill_rate', 'hard', round(100.0 * filled / n, 4) >= 95, round(100.0 * filled / n, 4)::DOUBLE FROM a""")
def build_assertions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: unique keys, orphans and fill rate of a table that was built, a row each."""
    o = read(spark, sf_dir, "orders")
    known = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("known")).distinct()
    per_key = o.join(known, F.col("o_custkey") == F.col("known"), "left").groupBy("o_orderkey").agg(F.count("*").alias("n"), F.count("o_custkey").alias("filled"), F.count_if(F.col("o_custkey").isNotNull() & F.col("known").isNull()).alias("gone"))
    one = per_key.agg(F.sum("n").alias("n"), F.count("*").alias("d"), F.sum("filled").alias("filled"), F.sum("gone").alias("gone"))
    pct = lambda c: F.round(100.0 * F.col(c) / F.col("n"), 4)
    row = lambda name, severity, ok, detail: F.struct(F.lit(name).alias("name"), F.lit(severity).alias("severity"), ok.alias("passed"), detail.cast("double").alias("detail"))
    return one.select(F.inline(F.array(row("unique_key", "hard", F.col("n") == F.col("d"), F.col("n") - F.col("d")), row("orphans_pct", "soft", pct("gone") <= 1, pct("gone")), row("fill_rate", "hard", pct("filled") >= 95, pct("filled")))))


@query("""SELECT o_orderkey, o_custkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) <= 2""")
def latest_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last rows of each key, as the views of latest results have them."""
    return runs.latest(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()], 2)
