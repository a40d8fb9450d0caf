"""Entity resolution: typed identifier pairs are aggregated, filtered, weighted and stitched into entities.

An edge has a_type, a_value, b_type, b_value, match_rule, source_system, base_confidence, cap, first_seen and last_seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.operators.components import components
from sluicework.storage import materialize, small_tasks

ENDS = ("a_type", "a_value", "b_type", "b_value")


def aggregate_edges(edges: DataFrame) -> DataFrame:
    """One undirected edge per pair and rule: observations, first and last seen, confidence = min(cap, base x log2(n + 1)).

    The lesser end comes first. Of several bases of one rule the highest counts, then the lesser source. Nearly every pair is a
    row of its own, so tasks hold about all that they read, and are kept small.
    """
    small_tasks(edges.sparkSession)
    a, b = F.struct(F.col("a_type").alias("type"), F.col("a_value").alias("value")), F.struct(F.col("b_type").alias("type"), F.col("b_value").alias("value"))
    directed = edges.where(a != b).withColumn("lo", F.least(a, b)).withColumn("hi", F.greatest(a, b))
    keys = [F.col("lo.type").alias("a_type"), F.col("lo.value").alias("a_value"), F.col("hi.type").alias("b_type"), F.col("hi.value").alias("b_value"), "match_rule"]
    best = F.min(F.struct((-F.col("base_confidence")).alias("minus"), "source_system", "cap"))
    out = directed.groupBy(*keys).agg(F.count("*").alias("observations"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), best.alias("best"))
    base = -F.col("best.minus")
    return out.select(*ENDS, "match_rule", F.col("best.source_system").alias("source_system"), "observations", "first_seen", "last_seen", base.alias("base_confidence"), F.least(F.col("best.cap"), base * F.log(2.0, F.col("observations") + 1)).alias("confidence"))


def drop_blacklisted(edges: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Edges none of whose ends is listed (type, value); null entries list nothing."""
    listed = blacklist.where("type is not null and value is not null").select("type", "value").distinct()
    for end in "ab":
        edges = edges.join(listed, (F.col(f"{end}_type") == listed["type"]) & (F.col(f"{end}_value") == listed["value"]), "left_anti")
    return edges


def _ends(edges: DataFrame, *more: str) -> DataFrame:
    end = lambda e: F.struct(F.col(f"{e}_type").alias("type"), F.col(f"{e}_value").alias("value"))
    return edges.select(*more, F.explode(F.array(F.struct(end("a").alias("node"), end("b").alias("other")), F.struct(end("b").alias("node"), end("a").alias("other")))).alias("x")).select(*more, "x.node", "x.other")


def trim_fanout(edges: DataFrame, most: int, by_rule: bool = False) -> DataFrame:
    """Edges none of whose ends has more than ``most`` distinct neighbours (by rule, if wanted)."""
    keys = ["match_rule"] if by_rule else []
    degree = _ends(edges, *keys).groupBy("node", *keys).agg(F.count_distinct("other").alias("degree")).where(F.col("degree") > most)
    hubs = degree.select(F.col("node.type").alias("h_type"), F.col("node.value").alias("h_value"), *(F.col(k).alias(f"h_{k}") for k in keys))
    for e in "ab":
        edges = edges.join(hubs, [F.col(f"{e}_type") == F.col("h_type"), F.col(f"{e}_value") == F.col("h_value"), *(F.col(k) == F.col(f"h_{k}") for k in keys)], "left_anti")
    return edges


def cap_conflicts(edges: DataFrame, anchor: str, least: int = 2, cap: float = 0.5) -> DataFrame:
    """Edges at a node with ``least`` or more distinct neighbours of the anchor type have at most ``cap`` confidence."""
    many = _ends(edges).where(F.col("other.type") == anchor).groupBy("node").agg(F.count_distinct("other").alias("k")).where(F.col("k") >= least).select("node")
    for e in "ab":
        hit = many.select(F.col("node.type").alias(f"{e}t"), F.col("node.value").alias(f"{e}v"), F.lit(True).alias(f"{e}_hit"))
        edges = edges.join(hit, (F.col(f"{e}_type") == F.col(f"{e}t")) & (F.col(f"{e}_value") == F.col(f"{e}v")), "left").drop(f"{e}t", f"{e}v")
    conflict = F.coalesce("a_hit", "b_hit", F.lit(False))
    return edges.withColumn("conflict", conflict).withColumn("confidence", F.when(conflict, F.least("confidence", F.lit(cap))).otherwise(F.col("confidence"))).drop("a_hit", "b_hit")


def in_influence(edges: DataFrame, now: Column, days: dict[str, int], default: int = 365) -> DataFrame:
    """Edges no older than the shorter window of their ends' types; -1 is for ever, and edges never seen stay."""
    window = lambda c: _lookup(F.col(c), days, default)
    far = F.lit(1 << 30)
    forever = lambda c: F.when(window(c) < 0, far).otherwise(window(c))
    age = F.timestamp_diff("DAY", F.col("last_seen"), now)
    return edges.where(F.col("last_seen").isNull() | (age <= F.least(forever("a_type"), forever("b_type"))))


def _lookup(key: Column, values: dict[str, int], default: int) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out.otherwise(default) if out is not None else F.lit(default)


def decay(age_days: Column, permanent: Column, steps: list[tuple[int, float]]) -> Column:
    """The weight of the first step whose age isn't exceeded; 1 if either end is permanent, 0 beyond all."""
    out = F.when(permanent, 1.0)
    for days, weight in sorted(steps):
        out = out.when(age_days <= days, weight)
    return out.otherwise(0.0)


def stitch(edges: DataFrame, priority: dict[str, int], least: float) -> DataFrame:
    """node_type, node_value, root_type, root_value, entity_id, cluster_size, from the edges with at least that confidence.

    The root of a component is its node of the lowest type priority, then of the lesser ``type:value``; the
    entity's id is a digest of the root's key. Nodes are numbered once in that order, so the rounds move pairs of
    longs and not names; names are joined back at the end.
    """
    def node(e: str) -> Column:
        return F.struct(F.col(f"{e}_type").alias("type"), F.col(f"{e}_value").alias("value"))

    links = materialize(edges.where(F.col("confidence") >= least).select(node("a").alias("u"), node("b").alias("v")).distinct(), "links")
    nodes = _numbered(links.select(F.explode(F.array("u", "v")).alias("node")).distinct(), priority)
    of = lambda end: nodes.select(F.col("node").alias(end), F.col("number").alias(f"{end}_number"))
    pairs = links.join(of("u"), "u").join(of("v"), "v")
    found = components(pairs.select(F.col("u_number").alias("u"), F.col("v_number").alias("v")))
    roots = found.groupBy("component").agg(F.count("*").alias("cluster_size")).join(nodes.select(F.col("number").alias("component"), F.col("node").alias("root"), "key"), "component")
    out = found.join(roots, "component").join(nodes.select(F.col("number").alias("node"), F.col("node").alias("name")), "node")
    return out.select(F.col("name.type").alias("node_type"), F.col("name.value").alias("node_value"), F.col("root.type").alias("root_type"), F.col("root.value").alias("root_value"), entity_id(F.col("key")).alias("entity_id"), "cluster_size")


def _numbered(nodes: DataFrame, priority: dict[str, int]) -> DataFrame:
    """node, key, number, written: numbers rise with the type's priority, then the key, then the node itself; they have gaps.

    A range sort in parallel, whose partitions are in order, and so are the numbers given within them.
    """
    keyed = nodes.select("node", F.concat_ws(":", "node.type", "node.value").alias("key"), _lookup(F.col("node.type"), priority, 99).alias("priority"))
    return materialize(keyed.orderBy("priority", "key", "node").select("node", "key", F.monotonically_increasing_id().alias("number")), "nodes")


def entity_id(key: Column, prefix: str = "ent_") -> Column:
    """The prefix and 16 characters of the URL-safe base64 of the key's SHA-256."""
    return F.concat(F.lit(prefix), F.substring(F.translate(F.base64(F.unhex(F.sha2(key, 256))), "+/=", "-_"), 1, 16))


def persist_ids(now: DataFrame, before: DataFrame) -> DataFrame:
    """Entity ids over two runs: per old id the current one that has most of its members, and what happened.

    ``now`` and ``before`` have node_type, node_value, entity_id. An id is stable if it goes to one
    that takes it from no other, merge if several go to one, split if its members went to several.
    """
    keys = ["node_type", "node_value"]
    shared = now.select(*keys, F.col("entity_id").alias("new_id")).join(before.select(*keys, F.col("entity_id").alias("old_id")), keys)
    overlap = shared.groupBy("old_id", "new_id").agg(F.count("*").alias("members"))
    best = Window.partitionBy("old_id").orderBy(F.col("members").desc(), "new_id")
    one = overlap.withColumn("place", F.row_number().over(best)).withColumn("parts", F.count("*").over(Window.partitionBy("old_id"))).where("place = 1")
    into = F.count("*").over(Window.partitionBy("new_id"))
    return one.select("old_id", F.col("new_id").alias("current_id"), "members", F.when(F.col("parts") > 1, "split").when(into > 1, "merge").otherwise("stable").alias("event_type"))


def health(clusters: DataFrame) -> DataFrame:
    """Adds health_score (100 less penalties for size and for several values of one anchor type) and is_suspicious (below 60)."""
    score = F.lit(100) - F.when(F.col("cluster_size") > 20, 30).when(F.col("cluster_size") > 10, 15).otherwise(0) - F.when(F.col("anchors") > 2, 40).when(F.col("anchors") > 1, 20).otherwise(0)
    return clusters.withColumn("health_score", F.greatest(score, F.lit(0))).withColumn("is_suspicious", F.col("health_score") < 60)


def gate_shared(edges: DataFrame, rule: str, anchor: str, least: int = 3) -> DataFrame:
    """Without the rule's edges at nodes that it joins to ``least`` or more distinct values of the anchor type."""
    of_rule = _ends(edges.where(F.col("match_rule") == rule))
    shared = of_rule.where(F.col("other.type") == anchor).groupBy("node").agg(F.count_distinct("other").alias("k")).where(F.col("k") >= least)
    shared = shared.select(F.col("node.type").alias("h_type"), F.col("node.value").alias("h_value"))
    for e in "ab":
        edges = edges.join(shared, (F.col("match_rule") == rule) & (F.col(f"{e}_type") == F.col("h_type")) & (F.col(f"{e}_value") == F.col("h_value")), "left_anti")
    return edges


def effective_confidence(confidence: Column, cap: Column, ratio: Column, weight: Column) -> Column:
    """The confidence times the rule's ratio and the decay weight, at most the cap."""
    return F.least(cap, confidence * ratio * weight)


def merge_edges(new: DataFrame, old: DataFrame) -> DataFrame:
    """The union of two edge sets by ends and rule: the earlier first and later last sighting, other columns from the new one."""
    keys = [*ENDS, "match_rule"]
    rest = [c for c in old.columns if c not in (*keys, "first_seen", "last_seen")]
    o = old.select([F.col(c).alias(f"o_{c}") for c in old.columns])
    both = new.join(o, [F.col(k) == F.col(f"o_{k}") for k in keys], "full_outer")
    cols = [F.coalesce(k, f"o_{k}").alias(k) for k in keys] + [F.coalesce(c, f"o_{c}").alias(c) for c in rest]
    return both.select(*cols, F.least("first_seen", "o_first_seen").alias("first_seen"), F.greatest("last_seen", "o_last_seen").alias("last_seen"))


def tiers(nodes: DataFrame, tier1: list[str], tier2: list[str], most: int) -> DataFrame:
    """entity_id, cluster_size, anchors (distinct nodes of tier-1 types), tier; clusters above ``most`` and those without either kind go."""
    one, two = F.col("node_type").isin(tier1), F.col("node_type").isin(tier2)
    per = nodes.groupBy("entity_id").agg(F.count("*").alias("cluster_size"), F.count_if(one).alias("anchors"), F.bool_or(one).alias("one"), F.bool_or(two).alias("two"))
    per = per.where((F.col("cluster_size") <= most) & (F.col("one") | F.col("two")))
    return per.select("entity_id", "cluster_size", "anchors", F.when(F.col("one"), "tier1").otherwise("tier2").alias("tier"))


def coverage(nodes: DataFrame) -> DataFrame:
    """Per node type: nodes, entities, and nodes per entity."""
    return nodes.groupBy("node_type").agg(F.count("*").alias("nodes"), F.count_distinct("entity_id").alias("entities"), F.round(F.count("*") / F.count_distinct("entity_id"), 4).alias("fragmentation"))


def restitch(edges: DataFrame, before: DataFrame, changed: DataFrame, priority: dict[str, int], least: float) -> DataFrame:
    """Entities again for those with a changed key (node_type, node_value), and the others as before.

    ``changed`` has at least one end of each edge that is new, gone or of another confidence. Edges between nodes of unlike old entities
    are the only ones that can join these; they are contracted to pairs of entities (a node without one is its own), whose components are
    all that a change can reach, however far. The edges of those entities are stitched. So the rounds are over new links, not over the graph.
    ``before`` is read four times and so is written first.
    """
    before = materialize(before, "before")
    strong = edges.where(F.col("confidence") >= least)
    own = lambda t, v: F.concat_ws(":", F.lit("new"), t, v)
    for e in "ab":
        home = before.select(F.col("node_type").alias(f"{e}t"), F.col("node_value").alias(f"{e}v"), F.col("entity_id").alias(f"{e}_entity"))
        strong = strong.join(home, (F.col(f"{e}_type") == F.col(f"{e}t")) & (F.col(f"{e}_value") == F.col(f"{e}v")), "left").drop(f"{e}t", f"{e}v")
        strong = strong.withColumn(f"{e}_entity", F.coalesce(f"{e}_entity", own(f"{e}_type", f"{e}_value")))
    placed = materialize(strong, "placed")
    groups = components(placed.where("a_entity != b_entity").select(F.col("a_entity").alias("u"), F.col("b_entity").alias("v")))
    groups = materialize(groups, "groups")
    hit = changed.join(before.select("node_type", "node_value", "entity_id"), ["node_type", "node_value"], "left")
    hit = hit.select(F.coalesce("entity_id", own("node_type", "node_value")).alias("node")).distinct()
    hit = materialize(hit.join(groups, "node", "left"), "hit")
    reached = groups.join(hit.select("component").where("component IS NOT NULL").distinct(), "component", "left_semi").select("node")
    affected = materialize(reached.unionByName(hit.select("node")).distinct().withColumnRenamed("node", "entity_id"), "affected")
    some = placed.join(affected, placed["a_entity"] == affected["entity_id"], "left_semi").select(edges.columns)
    again = stitch(some, priority, least)
    return again.unionByName(before.join(affected, "entity_id", "left_anti").select(again.columns))
