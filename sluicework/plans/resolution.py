"""Queries on entities over several runs, and on matching of texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluicework.operators import graph, matching, redirects
from sluicework.plans.queries import _EDGES, _edges, query, read

_PRIORITY = {"customer": 1, "order": 2}


def _alias_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer and its orders; and of every ten customers the first four in a chain."""
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    placed = o.select(F.lit("customer").alias("a_type"), F.col("o_custkey").cast("string").alias("a_value"), F.lit("order").alias("b_type"), F.col("o_orderkey").cast("string").alias("b_value"))
    after = c.select((F.col("c_custkey") - 1).alias("k"))
    chain = c.join(after, F.col("c_custkey") == F.col("k")).where("c_custkey % 10 < 3")
    alias = chain.select(F.lit("customer").alias("a_type"), F.col("c_custkey").cast("string").alias("a_value"), F.lit("customer").alias("b_type"), (F.col("c_custkey") + 1).cast("string").alias("b_value"))
    return placed.unionByName(alias).withColumn("confidence", F.lit(1.0))


@query("""WITH chain AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 10 <= 3 THEN c_custkey - c_custkey % 10 ELSE c_custkey END AS g FROM customer WHERE c_custkey % 10 <= 3 OR c_custkey IN (SELECT o_custkey FROM orders)),
nodes AS (SELECT g, 'customer' AS node_type, k::VARCHAR AS node_value FROM chain UNION ALL SELECT g, 'order', o_orderkey::VARCHAR FROM orders JOIN chain ON o_custkey = k),
roots AS (SELECT g, min(node_value) AS root_value FROM nodes WHERE node_type = 'customer' GROUP BY g)
SELECT node_type, node_value, 'customer' AS root_type, root_value, 'ent_' || left(translate(to_base64(unhex(sha256('customer:' || root_value))), '+/=', '-_'), 16) AS entity_id, count(*) OVER (PARTITION BY g) AS cluster_size FROM nodes JOIN roots USING (g)""")
def graph_restitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities after new links of customers, from those before; of each new link only the lesser end is listed as changed."""
    edges = _alias_edges(spark, sf_dir)
    before = graph.stitch(edges.where("b_type = 'order'"), _PRIORITY, 0.5)
    changed = edges.where("b_type = 'customer'").select(F.col("a_type").alias("node_type"), F.col("a_value").alias("node_value"))
    return graph.restitch(edges, before, changed, _PRIORITY, 0.5)


@query("""WITH chain AS (SELECT o_orderkey, o_custkey % 25 AS g, row_number() OVER (PARTITION BY o_custkey % 25 ORDER BY o_orderdate, o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey % 25) AS n, min(o_orderkey) OVER (PARTITION BY o_custkey % 25) AS low,
 last_value(o_orderkey) OVER (PARTITION BY o_custkey % 25 ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS top FROM orders)
SELECT o_orderkey AS old_id, CASE WHEN g % 5 = 0 THEN low ELSE top END AS current_id, CASE WHEN g % 5 = 0 THEN -1 ELSE n - i END AS hops, g % 5 = 0 AS in_cycle FROM chain WHERE i < n OR g % 5 = 0 AND n > 1""")
def graph_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where chains of some hundred redirects end; every fifth chain is a cycle. Runs that said otherwise before are outdated."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", (F.col("o_custkey") % 25).alias("g"))
    order = Window.partitionBy("g").orderBy("o_orderdate", "o_orderkey")
    after = F.coalesce(F.lead("o_orderkey").over(order), F.when(F.col("g") % 5 == 0, F.first("o_orderkey").over(order)))
    now = o.select(F.col("o_orderkey").alias("old_id"), after.alias("new_id"), F.lit(2).alias("run"))
    outdated = o.select(F.col("o_orderkey").alias("old_id"), F.lit(0).cast("long").alias("new_id"), F.lit(1).alias("run")).join(now.where("new_id IS NOT NULL").select("old_id"), "old_id", "left_semi")
    return redirects.resolve(redirects.latest_redirects(now.unionByName(outdated)))


@query(f"""WITH {_EDGES}, ends AS (SELECT a_type || ':' || a_value AS node, b_type || ':' || b_value AS neighbour, observations AS w FROM agg UNION ALL SELECT b_type || ':' || b_value, a_type || ':' || a_value, observations FROM agg),
pairs AS (SELECT node, neighbour, CAST(sum(w) AS BIGINT) AS weight FROM ends GROUP BY 1, 2), ranked AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY weight DESC, neighbour) AS place, count(*) OVER (PARTITION BY node) AS degree FROM pairs)
SELECT node, neighbour, weight, place, degree FROM ranked WHERE place <= 5""")
def graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five neighbours of each node that it was seen with most, and how many there are; suppliers have hundreds."""
    e = graph.aggregate_edges(_edges(spark, sf_dir))
    name = lambda x: F.concat_ws(":", f"{x}_type", f"{x}_value").alias(x)
    return redirects.neighbours(e.select(name("a"), name("b"), F.col("observations").alias("weight")), 5)


@query("""WITH n AS (SELECT 'O' || (o_custkey // 2) AS old_id, 'N' || (o_custkey // 3) AS new_id, count(*) FILTER (o_orderpriority LIKE '1%') AS anchors, count(*) AS nodes FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY old_id ORDER BY anchors DESC, nodes DESC, new_id) AS of_old, row_number() OVER (PARTITION BY new_id ORDER BY anchors DESC, nodes DESC, old_id) AS of_new FROM n)
SELECT old_id, new_id, anchors, nodes, CASE WHEN of_old = 1 AND of_new = 1 THEN 'kept' WHEN of_old = 1 THEN 'merged' WHEN of_new = 1 THEN 'split' ELSE 'moved' END AS event,
 coalesce(max(CASE WHEN of_old = 1 AND of_new = 1 THEN old_id END) OVER (PARTITION BY new_id), new_id) AS kept_id FROM r""")
def graph_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of two customers become groups of three, so that they merge and split at once; urgent orders are the anchors."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").startswith("1").alias("urgent"))
    group = lambda p, k: o.withColumn("id", F.concat(F.lit(p), F.floor(F.col("o_custkey") / k).cast("string")))
    return redirects.lineage(group("N", 3), group("O", 2), ["o_orderkey"], "urgent")


@query(r"""WITH known AS (SELECT 'P' || p_partkey AS id, trim(regexp_replace(lower(p_name || ' ' || p_brand || ' ' || p_type || ' size ' || p_size || ' lot ' || (p_partkey // 8)), '[^\p{L}\p{N}]+', ' ', 'g')) AS t FROM part),
noisy AS (SELECT p_partkey, trim(regexp_replace(lower(CASE p_partkey % 5 WHEN 0 THEN upper(p_name) || ', ' || p_brand || ' ' || p_type || '; size ' || p_size || ' lot ' || (p_partkey // 8)
  WHEN 1 THEN p_type || ' ' || p_brand || ' lot ' || (p_partkey // 8) || ' size ' || p_size || ' ' || p_name WHEN 2 THEN p_name || ' ' || p_brand || ' ' || p_type || ' size ' || p_size || ' lot ' || (p_partkey // 8) || ' new'
  WHEN 3 THEN p_name || ' ' || p_brand || ' size ' || p_size || ' lot ' || (p_partkey // 8) ELSE p_name || ' of no brand' END), '[^\p{L}\p{N}]+', ' ', 'g')) AS t FROM part),
k AS (SELECT t, min(id) AS id, list_sort(list_distinct(string_split(t, ' '))) AS ws FROM known GROUP BY t), a AS (SELECT DISTINCT t, list_sort(list_distinct(string_split(t, ' '))) AS ws FROM noisy),
pairs AS (SELECT a.t, a.n AS an, k.t AS kt, k.id, k.n AS kn, count(*) AS shared FROM (SELECT t, len(ws) AS n, unnest(ws) AS w FROM a) a JOIN (SELECT t, id, len(ws) AS n, unnest(ws) AS w FROM k) k USING (w) GROUP BY ALL),
scored AS (SELECT t, id, round(shared / (an + kn - shared), 6) AS score, CASE WHEN t = kt THEN 1 WHEN shared = an AND shared = kn THEN 2 ELSE 3 END AS layer FROM pairs WHERE 1000 * shared >= 700 * (an + kn - shared)),
best AS (SELECT t, arg_min(id, (layer, -score, id)) AS id, min((layer, -score, id)) AS b FROM (SELECT t, id, score, CASE layer WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 3 END AS layer FROM scored) GROUP BY t)
SELECT p_partkey, best.id AS match_id, CASE b[1] WHEN 1 THEN 'exact' WHEN 2 THEN 'words' WHEN 3 THEN 'similar' END AS match_layer, -b[2] AS match_score FROM noisy LEFT JOIN best USING (t)""")
def part_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """noisy descriptions of parts matched to the catalogue, in three layers."""
    p = read(spark, sf_dir, "part")
    lot, size = F.floor(F.col("p_partkey") / 8).cast("string"), F.col("p_size").cast("string")
    label = F.concat_ws(" ", "p_name", "p_brand", "p_type", F.lit("size"), size, F.lit("lot"), lot)
    kind = F.col("p_partkey") % 5
    noisy = (
        F.when(kind == 0, F.concat(F.upper("p_name"), F.lit(", "), F.concat_ws(" ", "p_brand", "p_type"), F.lit("; size "), size, F.lit(" lot "), lot))
        .when(kind == 1, F.concat_ws(" ", "p_type", "p_brand", F.lit("lot"), lot, F.lit("size"), size, "p_name"))
        .when(kind == 2, F.concat(label, F.lit(" new")))
        .when(kind == 3, F.concat_ws(" ", "p_name", "p_brand", F.lit("size"), size, F.lit("lot"), lot))
        .otherwise(F.concat(F.col("p_name"), F.lit(" of no brand")))
    )
    known = p.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("id"), label.alias("label"))
    out = matching.match(p.select("p_partkey", noisy.alias("said")), "said", known, "id", "label")
    return out.select("p_partkey", "match_id", "match_layer", "match_score")
