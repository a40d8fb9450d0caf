"""Matching of texts to known ones in layers: equal, equal as sets of words, similar. Each layer sees what the ones before left.

The last is a set similarity join. Two sets of a and b words with a Jaccard similarity of t or more share need = ceil(t * (a + b) / (1 + t)) words
or more. Small sets that may lack two words each of these at most meet on what is left of them without so many words: hardly any other pairs meet, however
frequent the words. Larger ones meet by prefix filtering: the first n - ceil(t * n) + 1 words of either, in one order of all words, have one in
common; with rare words first few pairs meet. All are verified on their whole sets. Rows with one text are matched once, and those that have a
match of high similarity aren't compared at the threshold.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicework.storage import materialize

#: Similarities are compared in thousandths.
THRESHOLD = 700
#: Sets of up to so many words meet whole, less two words at most: that is 67 keys of a set for one other size.
MOST_WHOLE = 12


def plain(text: str) -> Column:
    """Lower case, with one space for whatever is neither a letter nor a digit."""
    return F.trim(F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", " "))


def words(text: str) -> Column:
    """The distinct words of a plain text, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.col(text), " "), lambda w: w != "")))


def _prefixes(sets: DataFrame, frequency: DataFrame, threshold: int) -> DataFrame:
    """From (set, ws) a row for each word of a set's prefix: set, ws, n, word. Words are ordered by frequency, those without one first."""
    each = sets.select("set", F.explode("ws").alias("word")).join(frequency, "word", "left")
    ordered = each.groupBy("set").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("frequency", F.lit(0)).alias("f"), "word"))).alias("by_rarity"))
    n = F.size("by_rarity")
    need = F.floor((n * threshold + 999) / 1000).cast("int")
    out = ordered.select("set", n.alias("n"), F.explode(F.slice("by_rarity.word", F.lit(1), n - need + 1)).alias("word"))
    return out.join(sets, "set")


def _need(a: int, b: int, threshold: int) -> int:
    """The least number of words that sets of a and b words share at that similarity."""
    return -(-threshold * (a + b) // (1000 + threshold))


def _whole(a: int, b: int, threshold: int) -> bool:
    """Whether sets of these sizes meet whole, less two words at most."""
    return max(a, b) <= MOST_WHOLE and _need(a, b, threshold) >= max(a, b, 3) - 2


def _sizes(sets: DataFrame) -> list[int]:
    return sorted(r[0] for r in sets.select(F.size("ws")).distinct().collect())


def _without(n_less: int) -> Column:
    """The set without each choice of so many words: none, one or two."""
    ws = F.col("ws")
    if n_less == 0:
        return F.array(ws)
    if n_less == 1:
        return F.transform(ws, lambda w: F.array_remove(ws, w))
    return F.flatten(F.transform(ws, lambda w, i: F.transform(F.slice(ws, i + 2, F.size(ws)), lambda v: F.array_remove(F.array_remove(ws, w), v))))


def _keys(sets: DataFrame, less: dict[int, set[int]], side: str) -> DataFrame:
    """Hashes of what is left of each set without some words; ``less`` has for each size how many."""
    n = F.size("ws")
    choices = lambda k: F.when(n.isin([size for size, of in less.items() if k in of]), _without(k)).otherwise(F.expr("array()").cast("array<array<string>>"))
    return sets.where(n.isin(list(less))).select(F.col("set").alias(f"{side}_set"), F.explode(F.concat(*map(choices, range(3)))).alias("rest")).select(f"{side}_set", F.xxhash64("rest").alias("key"))


def similar(left: DataFrame, right: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Pairs of sets (set, ws: a key and its distinct words) with that similarity or more: l_set, r_set, shared, n_all."""
    close = lambda a, b: (1000 * a >= threshold * b) & (1000 * b >= threshold * a)
    l_sizes, r_sizes = _sizes(left), _sizes(right)
    small = [(a, b) for a in l_sizes if a <= MOST_WHOLE for b in r_sizes if _need(a, b, threshold) <= min(a, b)]
    l_less, r_less, by_prefix = defaultdict(set), defaultdict(set), set()
    for a, b in small:
        if _whole(a, b, threshold):
            l_less[a].add(a - _need(a, b, threshold))
            r_less[b].add(b - _need(a, b, threshold))
        else:
            by_prefix.add(a)
    verified = lambda df: df.withColumn("shared", F.size(F.array_intersect("l_ws", "r_ws"))).withColumn("n_all", F.size("l_ws") + F.size("r_ws") - F.col("shared")).where(1000 * F.col("shared") >= threshold * F.col("n_all")).select("l_set", "r_set", "shared", "n_all")
    met = _keys(left, l_less, "l").join(_keys(right, r_less, "r"), "key").select("l_set", "r_set").distinct()
    whole = verified(met.join(left.select(F.col("set").alias("l_set"), F.col("ws").alias("l_ws")), "l_set").join(right.select(F.col("set").alias("r_set"), F.col("ws").alias("r_ws")), "r_set"))
    if not by_prefix and l_sizes[-1:] <= [MOST_WHOLE]:
        return whole
    frequency = materialize(right.select(F.explode("ws").alias("word")).groupBy("word").agg(F.count("*").alias("frequency")), "frequency")
    rest = left.where((F.size("ws") > MOST_WHOLE) | F.size("ws").isin(list(by_prefix)))
    a, b = (_prefixes(x, frequency, threshold).select(*(F.col(c).alias(f"{p}_{c}") for c in ("set", "ws", "n")), "word") for x, p in ((rest, "l"), (right, "r")))
    # a pair may meet on several words, or have met whole; only those that are similar enough are shuffled once more
    return whole.unionByName(verified(a.join(b, "word").where(close(F.col("l_n"), F.col("r_n"))))).distinct()


def match(rows: DataFrame, text: str, known: DataFrame, known_id: str, known_text: str, threshold: int = THRESHOLD) -> DataFrame:
    """``rows`` with match_id, match_layer (exact, words, similar) and match_score; null where nothing known is similar enough.

    Of several known texts the most similar counts, then the least id. Texts without a word match nothing.
    """
    k = known.select(F.col(known_id).alias("k_id"), plain(known_text).alias("k_plain")).where("k_plain != '' AND k_id IS NOT NULL")
    k = materialize(k.groupBy("k_plain").agg(F.min("k_id").alias("k_id")).withColumn("k_ws", words("k_plain")), "known")
    k_sets = materialize(k.groupBy(F.concat_ws(" ", "k_ws").alias("k_set")).agg(F.min("k_id").alias("k_id"), F.first("k_ws").alias("k_ws")), "known_sets")
    asked = rows.select(plain(text).alias("plain")).where("plain != ''").distinct()
    asked = materialize(asked.withColumn("ws", words("plain")).withColumn("set", F.concat_ws(" ", "ws")), "asked")
    first = asked.join(k.select("k_plain", "k_id"), asked["plain"] == F.col("k_plain"), "left").drop("k_plain")
    exact = first.where("k_id IS NOT NULL").select("plain", "k_id", F.lit("exact").alias("layer"), F.lit(1.0).alias("score"))
    left = first.where("k_id IS NULL").drop("k_id")
    second = materialize(left.join(k_sets.select("k_set", "k_id"), left["set"] == F.col("k_set"), "left").drop("k_set"), "second")
    same = second.where("k_id IS NOT NULL").select("plain", "k_id", F.lit("words").alias("layer"), F.lit(1.0).alias("score"))
    sets = second.where("k_id IS NULL").select("set", "ws").distinct()
    known_sets = k_sets.select(F.col("k_set").alias("set"), F.col("k_ws").alias("ws"))
    best = None
    for level in sorted({(threshold + 1000) // 2, threshold}, reverse=True):
        pairs = similar(sets, known_sets, level)
        scored = pairs.join(k_sets.select("k_set", "k_id"), pairs["r_set"] == F.col("k_set")).withColumn("score", F.round(F.col("shared") / F.col("n_all"), 6))
        found = scored.groupBy("l_set").agg(F.min_by(F.struct("k_id", "score"), F.struct((-F.col("score")).alias("s"), "k_id")).alias("best"))
        if level > threshold:  # all pairs above the level are known by now, and none below it is better; one at the level may tie when rounded
            found = materialize(found.where(F.col("best.score") > level / 1000), "found")
            sets = materialize(sets.join(found, sets["set"] == found["l_set"], "left_anti"), "sets")
        best = found if best is None else best.unionByName(found)
    near = second.where("k_id IS NULL").select("plain", "set").join(best, F.col("set") == F.col("l_set")).select("plain", "best.k_id", F.lit("similar").alias("layer"), "best.score")
    found = exact.unionByName(same).unionByName(near).select(F.col("plain").alias("m_plain"), F.col("k_id").alias("match_id"), F.col("layer").alias("match_layer"), F.col("score").alias("match_score"))
    return rows.join(found, plain(text) == F.col("m_plain"), "left").drop("m_plain")
