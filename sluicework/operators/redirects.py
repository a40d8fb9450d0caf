"""What ids stand for after many runs: chains of redirects closed by pointer doubling, lineage of groups, bounded neighbour lists.

These are standard techniques (pointer jumping, mutual best overlap, top k by group), with rules of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluicework.storage import materialize

#: So many pointers are resolved by doubling alone; of more some are taken out first.
FEW = 1 << 20

def latest_redirects(events: DataFrame, run: str = "run") -> DataFrame:
    """From (old_id, new_id, run) one redirect for each old id: that of its latest run, then the lesser target; redirects to oneself are none."""
    last = events.where("old_id IS NOT NULL AND new_id IS NOT NULL").groupBy("old_id").agg(F.min_by("new_id", F.struct((-F.col(run).cast("long")).alias("late"), "new_id")).alias("new_id"))
    return last.where("old_id != new_id")


def resolve(redirects: DataFrame) -> DataFrame:
    """From (old_id, new_id), one row for each old id: old_id, current_id, hops and in_cycle.

    While there are more than ``FEW`` pointers, each round takes some out that don't point to one another (``_passed``): those to them jump
    on. About a quarter goes each time, so what all rounds send is a multiple of the input, however long the chains are. What is left is
    resolved by doubling, and those taken out get what they point to, the last ones first. An old id may have one redirect only.
    """
    start = redirects.select("old_id", F.col("new_id").alias("at"), F.lit(1).cast("long").alias("hops"), F.col("old_id").alias("least"))
    state, taken = materialize(start, "redirects"), []
    n = state.count()
    while n > FEW:
        passed = _passed(len(taken))
        over = state.where(passed).select(F.col("old_id").alias("head"), F.col("at").alias("to"), F.col("hops").alias("more"), F.col("least").alias("low"))
        rest = state.where(~passed).join(over, F.col("at") == F.col("head"), "left")
        rest = materialize(rest.select("old_id", F.coalesce("to", "at").alias("at"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.least("least", "low").alias("least")), "contracted")
        taken.append(state.where(passed))
        before, n, state = n, rest.count(), rest
        if n > 0.9 * before:  # cycles that have shrunk to one pointer stay, and a star's pointers may all stay in one round
            break
    found = _doubled(state)
    if taken:
        found = materialize(found, "resolved")
    for part in reversed(taken):
        ends = found.select(F.col("old_id").alias("head"), "current_id", F.col("hops").alias("more"), "in_cycle")
        part = part.join(ends, F.col("at") == F.col("head"), "left")
        hops = F.when(F.col("in_cycle"), -1).otherwise(F.col("hops") + F.coalesce("more", F.lit(0)))
        part = part.select("old_id", F.coalesce("current_id", "at").alias("current_id"), hops.alias("hops"), F.coalesce("in_cycle", F.lit(False)).alias("in_cycle"))
        found = found.unionByName(materialize(part, "resolved"))
    return found


def _passed(round_: int) -> Column:
    """Pointers that a round takes out: their own coin shows 1 and their target's 0, so none points to another of them."""
    coin = lambda c: F.xxhash64(F.lit(round_), c).bitwiseAND(1) == 1
    return coin("old_id") & ~coin("at")


def _doubled(state: DataFrame) -> DataFrame:
    """The same for pointers (old_id, at, hops, least): ``hops`` steps lead from the id to ``at``, and ``least`` is the least id before it.

    Each round every pointer jumps to where its target's pointer leads, so a chain of n takes log2(n) joins. While
    a chain is open some of its ids end in each round, so a round in which none does leaves only ids that lead to cycles; when they have jumped
    as often as there are such ids, each points into its cycle and has met all of what it points to: current_id is then the
    least id of that cycle, and hops are -1.
    """
    jumped, before = 1, None
    while True:
        heads = state.select(F.col("old_id").alias("head"), F.col("at").alias("to"), F.col("hops").alias("more"), F.col("least").alias("low"))
        step = state.join(heads, state["at"] == heads["head"], "left")
        step = materialize(step.select("old_id", F.coalesce("to", "at").alias("at"), (F.col("hops") + F.coalesce("more", F.lit(0))).alias("hops"), F.least("least", "low").alias("least"), F.col("to").isNull().alias("ended")), "redirects")
        # an id that has ended stays as a head, as others may still point to it
        n_open = step.where(~F.col("ended")).count()
        state, jumped = step.drop("ended"), 2 * jumped
        if not n_open:
            return state.select("old_id", F.col("at").alias("current_id"), "hops", F.lit(False).alias("in_cycle"))
        if n_open == before and jumped >= n_open:
            break
        before = n_open
    ended = step.where("ended").select("old_id", F.col("at").alias("current_id"), "hops", F.lit(False).alias("in_cycle"))
    turning = step.where(~F.col("ended"))
    on = turning.select(F.col("old_id").alias("head"), F.col("least").alias("cycle"))  # what a cycle's own id has met is the cycle
    round_ = turning.join(on, turning["at"] == on["head"]).select("old_id", F.col("cycle").alias("current_id"), F.lit(-1).cast("long").alias("hops"), F.lit(True).alias("in_cycle"))
    return ended.unionByName(round_)


def neighbours(pairs: DataFrame, most: int, weight: str = "weight") -> DataFrame:
    """From undirected pairs (a, b, weight) each node's ``most`` heaviest neighbours: node, neighbour, weight, place, degree.

    Ties go to the lesser neighbour. The limit by place acts before the shuffle too, so a hub sends few rows from each task;
    degrees are counted, not collected. What both read is written first, so the pairs are computed once.
    """
    both = pairs.select(F.col("a").alias("node"), F.col("b").alias("neighbour"), weight).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("neighbour"), weight)).where("node != neighbour")
    both = materialize(both.groupBy("node", "neighbour").agg(F.sum(weight).alias("weight")), "neighbours")
    best = Window.partitionBy("node").orderBy(F.col("weight").desc(), "neighbour")
    top = both.withColumn("place", F.row_number().over(best)).where(F.col("place") <= most)
    degree = both.groupBy("node").agg(F.count("*").alias("degree"))
    return top.join(degree, "node").select("node", "neighbour", "weight", "place", "degree")


def lineage(now: DataFrame, before: DataFrame, node: list[str], anchor: str) -> DataFrame:
    """What became of each old group: a row for each pair of an old and a new group that share nodes.

    Both have the ``node`` columns and a group ``id``; ``now`` says by the boolean ``anchor`` which nodes count first. Each old group has a best
    new one and each new group a best old one, by shared anchors, shared nodes, then the lesser id. Where both agree the new
    group keeps the old id (``kept``). Otherwise the old group went into another's (``merged``, its best one is taken), the new
    one came off an old group that goes on elsewhere (``split``), or only some nodes moved (``moved``). So each old id has one successor at
    most, each new group keeps one old id at most, and a group may merge and split in one run.

    Columns: old_id, new_id, anchors, nodes, event, kept_id (what the new group is called from now on).
    """
    shared = now.select(*node, F.col("id").alias("new_id"), F.col(anchor).alias("is_anchor")).join(before.select(*node, F.col("id").alias("old_id")), node)
    overlap = materialize(shared.groupBy("old_id", "new_id").agg(F.count_if("is_anchor").alias("anchors"), F.count("*").alias("nodes")), "overlap")
    rank = lambda other: F.struct((-F.col("anchors")).alias("a"), (-F.col("nodes")).alias("n"), other)
    best_new = overlap.groupBy("old_id").agg(F.min_by("new_id", rank("new_id")).alias("best_new"))
    best_old = overlap.groupBy("new_id").agg(F.min_by("old_id", rank("old_id")).alias("best_old"))
    both = overlap.join(best_new, "old_id").join(best_old, "new_id")
    onward, source = F.col("best_new") == F.col("new_id"), F.col("best_old") == F.col("old_id")
    event = F.when(onward & source, "kept").when(onward, "merged").when(source, "split").otherwise("moved")
    both = both.withColumn("event", event)
    kept = both.where("event = 'kept'").select("new_id", F.col("old_id").alias("kept_id"))
    return both.join(kept, "new_id", "left").select("old_id", "new_id", "anchors", "nodes", "event", F.coalesce("kept_id", "new_id").alias("kept_id"))
