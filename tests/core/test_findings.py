"""Queries against their SQL on tables made for what a review found."""

import random
from datetime import datetime

import duckdb
import pytest

import sluicework.plans.controls
import sluicework.plans.reports
import sluicework.plans.resolution  # noqa: F401
from sluicework.operators import components, graph, joins, matching
from sluicework.plans import queries
from sluicework.plans.queries import QUERIES, SQL


@pytest.fixture
def check(spark, tmp_path):
    """A function of a query and its tables (DDL and rows): the query's rows, which are its SQL's."""

    def run(name, **tables):
        c = duckdb.connect()
        for t, (ddl, rows) in tables.items():
            spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        want = c.sql(SQL[name]).df()
        got = QUERIES[name](spark, str(tmp_path)).select(*want.columns).toPandas()
        key = lambda df: sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
        assert key(got) == key(want)
        return got

    return run


def test_at_risk_rounds_halves_to_even(check):
    """100.5 is 100, as by the SQL's cast, so it isn't more than 100.2; 102.5 is 102 and less than 102.6."""
    prices = {1: (50.0, 100.2, 100.5), 2: (50.0, 102.5, 102.6), 3: (1.0, 2.0, 3.0)}
    rows = [(10 * c + i, c, p, datetime(2000, 1, 1 + i)) for c, ps in prices.items() for i, p in enumerate(ps)]
    got = check("at_risk", orders=("o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz", rows))
    assert sorted(got["table_name"]) == [2, 3]


def test_scorecard_rounds_sums_and_has_two_grades(check):
    """A score of 62.849999999999994 is 62.9 and one of 80 has a D, as by the SQL."""
    # supplier, lines, of these not returned, open, discount
    cases = [(1, 960, 720, 720, 0.02), (2, 1000, 650, 470, 0.02), (3, 1000, 1000, 1000, 0.0), (4, 10, 0, 0, 0.1)]
    rows = [(s, "N" if i < ok else "R", "O" if i < new else "F", d) for s, n, ok, new, d in cases for i in range(n)]
    got = check("scorecard", lineitem=("l_suppkey long, l_returnflag string, l_linestatus string, l_discount double", rows), supplier=("s_suppkey long", [(k,) for k in range(1, 6)]))
    assert dict(zip(got["k"], got["grade"], strict=True)) == {1: "D", 2: "F", 3: "D", 4: "F", 5: "F"}


@pytest.mark.parametrize("threshold", [300, 700, 850])
def test_similar_sets_of_all_sizes(spark, threshold):
    rng = random.Random(threshold)
    sets = lambda n: sorted({tuple(sorted(rng.sample("abcdefghijklmnopqr", rng.randrange(1, 18)))) for _ in range(n)})
    left, right = sets(120), sets(150)
    frame = lambda rows: spark.createDataFrame([(" ".join(r), list(r)) for r in rows], "set string, ws array<string>")
    got = sorted(tuple(r) for r in matching.similar(frame(left), frame(right), threshold).collect())
    want = [(a, b, len(set(a) & set(b)), len(set(a) | set(b))) for a in left for b in right]
    assert got == sorted((" ".join(a), " ".join(b), s, n) for a, b, s, n in want if 1000 * s >= threshold * n)


def test_frequent_words_make_no_pairs(spark, monkeypatch):
    """Sets of words that are all frequent but for one: by prefixes of words each would meet hundreds of the others."""
    monkeypatch.setattr(matching, "_prefixes", lambda *_: pytest.fail("sets met by single words"))
    known = spark.range(2000).selectExpr("id", "concat_ws(' ', 'c' || id % 4, 'brand', 'b' || id % 5, 't' || id % 3, 'size', 's' || id % 7, 'lot', 'l' || id) AS label")
    asked = known.selectExpr("id AS asked", "replace(label, 'brand ', '') AS said")
    got = matching.match(asked, "said", known, "id", "label").where("asked = match_id AND match_layer = 'similar'")
    assert got.count() == 2000


def test_edges_are_aggregated_by_small_tasks(spark, sf):
    """What a task reads has a bound that doesn't depend on the tables; smaller settings stay."""
    key = "spark.sql.files.maxPartitionBytes"
    try:
        for now, then in (("128m", 8 << 20), ("1m", 1 << 20)):
            spark.conf.set(key, now)
            graph.aggregate_edges(queries._edges(spark, sf))
            assert int(spark.conf.get(key)) == then
    finally:
        spark.conf.unset(key)


def test_overlaps_of_random_sets(spark):
    """A value that all have, values of one item, nulls and repeated rows; parts of a few pairs each, and counts that are summed up on the way."""
    rng = random.Random(5)
    rows = [(rng.randrange(-9, 40), rng.randrange(60)) for _ in range(900)] + [(i, 100) for i in range(-9, 40)] + [(1, 200), (None, 100), (3, None), (77, 300)]
    frame = spark.createDataFrame(rows, "item long, value long")
    has = {i: {v for k, v in rows if k == i and v is not None} for i in {i for i, _ in rows if i is not None}}
    want = set()
    for a in has:
        best = sorted((-len(has[a] & has[b]), b) for b in has if b != a and has[a] & has[b])[:3]
        want |= {(a, b, -n, k) for k, (n, b) in enumerate(best, 1)}
    for part, held in ((1 << 22, 1 << 22), (500, 100)):
        got = joins.most_overlap(frame, "item", "value", 3, part_pairs=part, held=held)
        assert {tuple(r) for r in got.select("a", "b", "shared", "place").collect()} == want


def test_overlaps_send_few_bytes(spark):
    """Lists of 20 items of 5000, sent to some 18 parts each: about 720,000 entries, for which 4.0 MB were shuffled in all, and 1.9 now."""
    rng = random.Random(7)
    rows = [(i, v) for v in range(2000) for i in rng.sample(range(5000), 20)]
    frame = spark.createDataFrame(rows, "item long, value long").repartition(4)
    store, none = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def shuffled():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, none, None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = shuffled()
    assert joins.most_overlap(frame, "item", "value", 3, part_pairs=8000, held=8000).count() == 3 * len({i for i, _ in rows})
    sent = shuffled() - before
    assert sent < 3_000_000, sent


def test_overlaps_in_turns_and_of_far_ids(spark, monkeypatch):
    """Parts that take turns leave nothing but a result each, and ids as far apart as longs can be are told apart."""
    rng = random.Random(11)
    near = [(rng.randrange(300), rng.randrange(90)) for _ in range(1500)] + [(7, v) for v in range(90)]
    far = {i: rng.randrange(-(1 << 63), 1 << 63) for i in range(300)} | {0: -(1 << 63), 1: (1 << 63) - 1}
    writes, plain = [], joins.materialize
    monkeypatch.setattr(joins, "materialize", lambda df, label, **kw: (writes.append(label), plain(df, label, **kw))[1])
    for rows, part_pairs in ((near, 130), ([(far[i], v) for i, v in near], 130), ([(far[i], v) for i, v in near], 1 << 22)):
        has = {i: {v for k, v in rows if k == i} for i in {i for i, _ in rows}}
        want = set()
        for a in has:
            best = sorted((-len(has[a] & has[b]), b) for b in has if b != a and has[a] & has[b])[:3]
            want |= {(a, b, -n, k) for k, (n, b) in enumerate(best, 1)}
        writes.clear()
        got = joins.most_overlap(spark.createDataFrame(rows, "item long, value long"), "item", "value", 3, part_pairs=part_pairs, held=50, sent_at_once=1)
        assert {tuple(r) for r in got.select("a", "b", "shared", "place").collect()} == want
        assert (writes.count("overlaps") > 1) == (part_pairs == 130)
    assert joins.most_overlap(spark.createDataFrame([(1, 1), (2, 2)], "item long, value long"), "item", "value", 3).count() == 0


def test_scorecard_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    """A sum of 50.45, whose mean discount differs in its last bit between orders if it is added up plainly."""
    often = [70, 53, 67, 40, 57, 55, 68, 59, 44, 53, 34]
    discounts = [i / 100 for i, n in enumerate(often) for _ in range(n)]
    spark.createDataFrame([(1,)], "s_suppkey long").write.parquet(f"{tmp_path}/up/supplier.parquet")
    spark.createDataFrame([(1,)], "s_suppkey long").write.parquet(f"{tmp_path}/down/supplier.parquet")
    for name, given in (("up", discounts), ("down", discounts[::-1])):
        rows = [(1, "N" if i < 406 else "R", "O" if i < 285 else "F", d) for i, d in enumerate(given)]
        spark.createDataFrame(rows, "l_suppkey long, l_returnflag string, l_linestatus string, l_discount double").coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
    assert [QUERIES["scorecard"](spark, f"{tmp_path}/{name}").first()["score"] for name in ("up", "down")] == [50.5, 50.5]


def test_components_of_stars_take_no_round(spark, monkeypatch):
    """Stars are seen as such, and a chain's rounds end when it is one, without another round to see that nothing changes."""
    writes, plain = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, label: (writes.append(label), plain(df, label))[1])
    stars = [(k, 10 * k + i) for k in (1, 2) for i in range(1, 9)]
    got = components.components(spark.createDataFrame(stars, "u long, v long")).collect()
    assert {tuple(r) for r in got} == {(v, u) for u, v in stars} | {(1, 1), (2, 2)} and len(got) == 18
    assert writes == ["edges", "least"]
    got = components.components(spark.createDataFrame([(1, 2), (2, 3)], "u long, v long")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1), (2, 1), (3, 1)]
    assert writes[2:] == ["edges", "least", "edges", "least"]


def test_restitch_reads_what_was_before_once(spark):
    """The entities before are an expensive frame, which restitch reads at four places."""
    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    edges = spark.createDataFrame([("customer", str(k), "order", f"{k}{i}", 1.0) for k in (1, 2, 3) for i in range(3)] + [("customer", "1", "customer", "2", 1.0)], "a_type string, a_value string, b_type string, b_value string, confidence double")
    priority = {"customer": 1, "order": 2}
    old = graph.stitch(edges.where("b_type = 'order'"), priority, 0.5)
    before = old.mapInPandas(watched, old.schema)
    got = graph.restitch(edges, before, spark.createDataFrame([("customer", "1")], "node_type string, node_value string"), priority, 0.5)
    assert sorted(r.cluster_size for r in got.collect()) == [4] * 4 + [8] * 8 and seen.value == 12
