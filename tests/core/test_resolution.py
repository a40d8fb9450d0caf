"""Redirects, lineage, incremental entities and matching against brute force on random and odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sluicework.operators import graph, matching, redirects


def brute_end(target, start):
    """Follow pointers one by one; on a cycle, its least id."""
    at, hops, seen = start, 0, set()
    while at in target:
        if at in seen:
            low, on = at, target[at]
            while on != at:
                low, on = min(low, on), target[on]
            return low, -1, True
        seen.add(at)
        at, hops = target[at], hops + 1
    return at, hops, False


@pytest.mark.parametrize("seed", [1, 2])
def test_resolve_random_pointers(spark, seed):
    rng = random.Random(seed)
    target = {i: rng.choice([j for j in (i - 1, i + 1, rng.randrange(80), 900 + i) if j != i]) for i in rng.sample(range(80), 60)}
    got = redirects.resolve(spark.createDataFrame(list(target.items()), "old_id long, new_id long")).collect()
    assert {r.old_id: (r.current_id, r.hops, r.in_cycle) for r in got} == {i: brute_end(target, i) for i in target}


@pytest.mark.parametrize("n, cyclic", [(1, False), (2, True), (3, True), (1000, False), (257, True)])
def test_resolve_long_chains(spark, monkeypatch, n, cyclic):
    """A chain of n takes about log2(n) joins, and a cycle ends."""
    writes, plain = [], redirects.materialize
    monkeypatch.setattr(redirects, "materialize", lambda df, label: (writes.append(label), plain(df, label))[1])
    rows = [(f"{i:05d}", f"{(i + 1) % n if cyclic else i + 1:05d}") for i in range(n)] + [("tail", "00000")]
    got = {r.old_id: r for r in redirects.resolve(spark.createDataFrame(rows, "old_id string, new_id string")).collect()}
    assert len(got) == n + 1 and len(writes) <= n.bit_length() + 4
    if cyclic:
        assert {(r.current_id, r.in_cycle) for r in got.values()} == {("00000", True)}
    else:
        assert {r.current_id for r in got.values()} == {f"{n:05d}"} and got["tail"].hops == n + 1


@pytest.mark.parametrize("seed", [1, 2])
def test_resolve_takes_pointers_out(spark, monkeypatch, seed):
    """Chains, trees and cycles are resolved alike if pointers are taken out first, and what is written is a multiple of their number."""
    rows, plain = [], redirects.materialize
    monkeypatch.setattr(redirects, "FEW", 20)
    monkeypatch.setattr(redirects, "materialize", lambda df, label: (out := plain(df, label), rows.append(out.count()))[0])
    rng = random.Random(seed)
    chain = {i: i + 1 for i in range(300)}
    cycle = {i: 1000 + (i - 999) % 90 for i in range(1000, 1090)} | {2000: 2001, 2001: 2000}
    tree = {i: rng.choice([rng.randrange(300), rng.randrange(1000, 1090), rng.randrange(2000, 2002), 5000]) for i in range(3000, 3100)}
    target = chain | cycle | tree
    got = redirects.resolve(spark.createDataFrame(list(target.items()), "old_id long, new_id long")).collect()
    assert len(got) == len(target) and {r.old_id: (r.current_id, r.hops, r.in_cycle) for r in got} == {i: brute_end(target, i) for i in target}
    assert len(rows) > 15 and sum(rows) < 8 * len(target)


def test_latest_redirects(spark):
    rows = [("a", "b", 1), ("a", "c", 2), ("a", "d", 2), ("b", "b", 3), (None, "x", 1), ("e", None, 1), ("f", "a", None)]
    got = redirects.latest_redirects(spark.createDataFrame(rows, "old_id string, new_id string, run int")).collect()
    assert sorted((r.old_id, r.new_id) for r in got) == [("a", "c"), ("f", "a")]
    assert redirects.resolve(spark.createDataFrame([], "old_id string, new_id string")).count() == 0


def test_neighbours_of_hubs(spark):
    rows = [("hub", f"n{i:04d}", i % 7) for i in range(3000)] + [("n0001", "hub", 100), ("x", "x", 5)]
    got = redirects.neighbours(spark.createDataFrame(rows, "a string, b string, weight long"), 3)
    hub = sorted((r.place, r.neighbour, r.weight, r.degree) for r in got.where("node = 'hub'").collect())
    assert hub == [(1, "n0001", 101, 3000), (2, "n0006", 6, 3000), (3, "n0013", 6, 3000)]
    assert got.where("node = 'x'").count() == 0 and got.count() == 3 + 3000


def test_neighbours_compute_pairs_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    pairs = spark.createDataFrame([(f"n{i % 7}", f"m{i}", i) for i in range(50)], "a string, b string, weight long").mapInPandas(watched, "a string, b string, weight long")
    assert redirects.neighbours(pairs.coalesce(1), 3).count() == 7 * 3 + 50
    assert seen.value <= 2 * 50  # both directions


def test_lineage_merges_and_splits_at_once(spark):
    before = spark.createDataFrame([*((i, "A") for i in range(6)), *((i, "B") for i in range(6, 8)), *((i, "C") for i in range(8, 11))], "node int, id string")
    now = [(i, "X") for i in range(4)] + [(i, "Y") for i in (4, 5, 6, 7, 8)] + [(9, "Z"), (10, "Z"), (50, "N")]
    now = spark.createDataFrame([(n, i, n == 6) for n, i in now], "node int, id string, anchor boolean")
    got = {(r.old_id, r.new_id): (r.anchors, r.nodes, r.event, r.kept_id) for r in redirects.lineage(now, before, ["node"], "anchor").collect()}
    assert got == {("A", "X"): (0, 4, "kept", "A"), ("A", "Y"): (0, 2, "moved", "B"), ("B", "Y"): (1, 2, "kept", "B"), ("C", "Y"): (0, 1, "moved", "B"), ("C", "Z"): (0, 2, "kept", "C")}
    both = spark.createDataFrame([(1, "X", False), (2, "X", False), (3, "W", False)], "node int, id string, anchor boolean")
    old = spark.createDataFrame([(1, "P"), (2, "Q"), (3, "Q")], "node int, id string")
    got = {(r.old_id, r.new_id): r.event for r in redirects.lineage(both, old, ["node"], "anchor").collect()}
    assert got == {("P", "X"): "kept", ("Q", "X"): "moved", ("Q", "W"): "kept"}


@pytest.mark.parametrize("seed", range(3))
def test_lineage_gives_each_one_successor(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"o{rng.randrange(12)}", f"n{rng.randrange(12)}", rng.random() < 0.2) for i in range(150)]
    df = spark.createDataFrame(rows, "node int, old string, new string, anchor boolean")
    got = redirects.lineage(df.select("node", F.col("new").alias("id"), "anchor"), df.select("node", F.col("old").alias("id")), ["node"], "anchor").collect()
    onward = [r for r in got if r.event in ("kept", "merged")]
    assert len(onward) == len({r.old_id for r in onward}) == len({r[1] for r in rows})
    names = {(r.new_id, r.kept_id) for r in got}
    assert len(names) == len({n for n, _ in names}) == len({k for _, k in names})  # no two new groups take one name


KEY = "a_type string, a_value string, b_type string, b_value string, confidence double"


@pytest.mark.parametrize("seed", range(3))
def test_restitch_after_random_changes(spark, seed):
    """New edges, of which one end is listed, and lost ones."""
    rng = random.Random(seed)
    edge = lambda: ("a", str(rng.randrange(40)), "b", str(rng.randrange(25)), rng.choice([0.4, 0.9, 0.9]))
    old, new = {edge()[:4]: 0.9 for _ in range(25)}, {edge()[:4]: 0.9 for _ in range(8)}
    gone = rng.sample(sorted(old), 3)
    now = {k: v for k, v in {**old, **new}.items() if k not in gone}
    frame = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], KEY)
    changed = [k[:2] if rng.random() < 0.5 else k[2:] for k in [*(set(new) - set(old)), *gone, *(set(gone) & set(new))]]
    order = {"b": 1, "a": 2}
    before = graph.stitch(frame(old), order, 0.5)
    got = graph.restitch(frame(now), before, spark.createDataFrame(changed, "node_type string, node_value string"), order, 0.5)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(got) == rows(graph.stitch(frame(now), order, 0.5).select(got.columns))


def test_restitch_joins_whole_entities(spark):
    """Only one end of the new link is listed; the other's entity comes along whole, and so does what a further new link adds."""
    e = spark.createDataFrame([("a", "1", "a", "2", 1.0), ("b", "1", "b", "2", 1.0), ("a", "1", "b", "1", 1.0), ("b", "2", "c", "1", 1.0), ("d", "1", "d", "2", 1.0)], KEY)
    before = graph.stitch(e.where("a_type = b_type"), {}, 0.5)
    changed = spark.createDataFrame([("a", "1")], "node_type string, node_value string")
    got = graph.restitch(e, before, changed, {}, 0.5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, graph.stitch(e, {}, 0.5).select(got.columns).collect()))
    assert graph.restitch(e.where("a_type = b_type"), before, changed.where("false"), {}, 0.5).count() == before.count()


def brute_words(text):
    return sorted(set(re.findall(r"[^\W_]+", (text or "").lower())))


def brute_match(said, known, threshold):
    plain = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    if not plain(said):
        return (None, None, None)
    found = []
    for i, t in known:
        a, b = set(brute_words(said)), set(brute_words(t))
        if i is None or not b:
            continue
        layer = 0 if plain(said) == plain(t) else 1 if a == b else 2
        if 1000 * len(a & b) >= threshold * len(a | b):
            found.append((layer, -round(len(a & b) / len(a | b), 6), i))
    best = min(found, default=None)
    return (best[2], ("exact", "words", "similar")[best[0]], -best[1]) if best else (None, None, None)


@pytest.mark.parametrize("threshold", [500, 700, 1000])
def test_match_against_all_pairs(spark, threshold):
    rng = random.Random(threshold)
    vocabulary = [f"w{i}" for i in range(30)] + ["the"] * 12
    phrase = lambda: " ".join(rng.choices(vocabulary, k=rng.randint(1, 8)))
    known = [(i, phrase()) for i in range(120)] + [(None, phrase()), (500, None), (501, " - "), (502, "the W1, w2"), (503, "the w1 w2")]
    said = [phrase() for _ in range(150)] + [None, "", "...", "THE w1/w2", "w2 w1 the the", "zzz", "Ünï çode"] + ["the w1 w2"] * 5
    rows = spark.createDataFrame(list(enumerate(said)), "n int, said string").withColumn("word", F.lit("clash"))
    got = matching.match(rows, "said", spark.createDataFrame(known, "id int, label string"), "id", "label", threshold).collect()
    assert len(got) == len(said)
    assert {r.n: (r.match_id, r.match_layer, r.match_score) for r in got} == {i: brute_match(t, known, threshold) for i, t in enumerate(said)}


def test_match_nothing(spark):
    rows, known = spark.createDataFrame([(1, "a b")], "n int, said string"), spark.createDataFrame([(1, "a b")], "id int, label string")
    assert matching.match(rows, "said", known.where("false"), "id", "label").first().match_id is None
    assert matching.match(rows.where("false"), "said", known, "id", "label").count() == 0
