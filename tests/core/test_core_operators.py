"""Cases that the driver tables don't have."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicework.functions import normalise
from sluicework.operators import components, freshness, graph, joins, merge, quality, series
from sluicework.sources import paged, tables
from sluicework.streaming import ingest


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_merge_rules(spark):
    main = frame(spark, [(1, "a", 10), (2, "b", 20), (None, "n", 1)], "k int, v string, impressions int")
    staging = frame(spark, [(1, None, 10), (2, "c", 5), (3, "d", 7), (None, "m", 1)], "k int, v string, impressions int")
    got = {r.k: (r.action, r.v, r.impressions) for r in merge.hash_merge(staging, main, ["k"]).collect()}
    assert got == {1: ("UPDATE", "a", 10), 2: ("UPDATE", "c", 5), 3: ("INSERT", "d", 7), None: ("UPDATE", "m", 1)}
    got = {r.k: r.action for r in merge.hash_merge(staging, main, ["k"], merge.MergeRules(guard_metrics=True)).collect()}
    assert got[2] == "KEEP"
    got = {r.k: r.v for r in merge.hash_merge(staging, main, ["k"], merge.MergeRules(preserve_nulls=False)).collect()}
    assert got[1] is None
    gone = merge.hash_merge(staging.where("k = 1"), main, ["k"], merge.MergeRules(delete_missing=True))
    assert {r.k: r.action for r in gone.collect()}[2] == "DELETE"


def test_merge_casts_and_dedups(spark):
    main = frame(spark, [(1, 5)], "k int, n int")
    staging = frame(spark, [("1", "x", datetime(2024, 1, 1)), ("1", "7", datetime(2024, 1, 2)), ("2", "3", None)], "k string, n string, extracted_at timestamp")
    out = merge.hash_merge(staging, main.withColumn("extracted_at", F.lit(None).cast("timestamp")), ["k"])
    assert {r.k: (r.action, r.n) for r in out.collect()} == {1: ("UPDATE", 7), 2: ("INSERT", 3)}


def test_hash_ignores_fractions_of_seconds(spark):
    df = frame(spark, [(datetime(2024, 1, 1, 0, 0, 0, 5),), (datetime(2024, 1, 1, 0, 0, 0, 900),)], "t timestamp")
    assert df.select(merge.row_hash(df).alias("h")).distinct().count() == 1


def test_snapshot(spark):
    main = frame(spark, [(1, "a")], "k int, v string")
    assert merge.snapshot_replace(main.where("false"), main, ["k"]) == (main, None, None)
    assert merge.snapshot_replace(main, None, ["k"])[1] is None
    with pytest.raises(ValueError):
        merge.apply_disposition("append", main, main, ["k"])


def test_types_and_schema(spark):
    df = frame(spark, [("1", "0", "1.5", "x", "2024-01-02", None), ("-2", "1", "2", "1", "2024-01-03 04:05:06", None)], "i string, b string, f string, s string, t string, n string")
    assert {r.column_name: r.inferred for r in quality.infer_types(df).collect()} == {"i": "integer", "b": "integer", "f": "float", "s": "string", "t": "timestamp", "n": "string"}
    staging = frame(spark, [(1, datetime(2024, 1, 1), 2.0)], "k int, t timestamp, new double")
    main = frame(spark, [(1, "2024-01-01 00:00:00", 3)], "k int, t string, old int")
    out, log = quality.evolve(staging, main)
    assert dict(out.dtypes) == {"k": "int", "t": "timestamp", "old": "int", "new": "double"}
    assert [(x[0], x[1], x[4]) for x in log] == [("missing_field", "old", False), ("new_field", "new", True), ("type_change", "t", True)]


def test_quality(spark):
    a, b = spark.range(200).withColumn("v", F.when(F.col("id") % 2 == 0, F.col("id"))), spark.range(200).withColumn("v", F.col("id"))
    assert quality.null_jump(a, b, "v").first().flagged and not quality.null_jump(b, a, "v").first().flagged
    assert quality.shrink_guard(a.limit(50), b).first().blocked
    assert quality.row_bounds(a, 1, 100).first().passed is False
    assert quality.null_rates(a.where("false")).first().passed


def days(spark, counts, start=date(2024, 1, 1)):
    return frame(spark, [("t", start + timedelta(i), n) for i, n in enumerate(counts) if n is not None], "table_name string, d date, n long")


def test_series(spark):
    s = days(spark, [200] * 40 + [20] + [200] * 10 + [50] * 5)
    got = series.volume_outliers(s).collect()
    assert [(r.d, r.status) for r in got] == [(date(2024, 2, 10), "ACTIVE")]
    assert series.settle_lag(days(spark, [100] * 20 + [10] * 8)).first().settle_days == 8
    assert series.missing_days(days(spark, [1, None, None, 1, None, 1])).first().n_missing == 3
    assert series.cadence(days(spark, [1 if i % 7 == 0 else None for i in range(60)])).first().cadence == 7
    assert [r.gap for r in series.abnormal_gaps(days(spark, [1, 1, 1, 1, None, None, None, 1])).collect()] == [4]
    assert series.collapses(days(spark, [100] * 14 + [1] * 7)).first().collapsed
    assert series.gone_to_zero(days(spark, [5] * 20 + [0] * 7)).first().flagged
    delta = series.active_delta(s.limit(2).select("d"), s.orderBy("d").limit(1).select("d"), ["d"])
    assert delta.where("change = 'resolved'").count() == 0


def test_freshness(spark):
    assert freshness.thresholds(None, None, 3) == (3, 3) and freshness.thresholds(5, 9) == (5, 5)
    now = datetime(2024, 3, 10)
    assert freshness.watermark_start(now, datetime(2024, 3, 8), safety=2) == datetime(2024, 3, 6)
    assert freshness.watermark_start(now, datetime(2024, 4, 8)) == now
    assert freshness.incremental_window("full", now) == (None, None)
    assert freshness.incremental_window("date", now) == (datetime(2024, 3, 3), now)
    gate = freshness.upstream_gate(frame(spark, [("a", None, 5, True), ("b", 3, 5, True)], "source string, age_hours int, limit_hours int, critical boolean"))
    assert {r.source: (r.stale, r.blocked) for r in gate.collect()} == {"a": (True, True), "b": (False, True)}
    dlq = frame(spark, [("s", "t", False, 0, 1, "x"), ("s", "t", False, 1, 2, "y"), ("s", "u", True, 0, 1, "z"), ("s", "v", False, 3, 1, "z")], "source string, table_name string, resolved boolean, retry_count int, failed_at int, error_type string")
    assert [tuple(r) for r in freshness.retryable(dlq).collect()] == [("s", "t", 2, "y")]
    rows = frame(spark, [(datetime(2024, 1, 1), 1), (datetime(2024, 1, 3, 23), 2), (None, 3), (datetime(2024, 1, 4), 4)], "t timestamp, i int")
    assert sorted(r.i for r in freshness.in_window(rows, "t", datetime(2024, 1, 2), datetime(2024, 1, 3)).collect()) == [2, 3]


def test_interval_edges(spark):
    t = datetime(2024, 1, 1, 12)
    a = frame(spark, [("k", t), (None, t)], "k string, ts timestamp")
    b = frame(spark, [("k", t + timedelta(minutes=5)), ("k", t + timedelta(minutes=5, seconds=1)), ("k", t - timedelta(minutes=5, microseconds=900)), (None, t)], "k string, ts timestamp")
    got = joins.interval_join(a, b, ["k"], "ts", "ts", 300).collect()
    assert len(got) == 2


def test_as_of_over_slots(spark):
    """Slots of a minute and of a day against a search through all history; a key with most rows, ties, nulls, no history."""
    import random

    rng, t = random.Random(3), datetime(2024, 1, 1)
    at = lambda: None if rng.random() < 0.05 else t + timedelta(seconds=rng.randrange(0, 4000, 40))
    key = lambda: rng.choice(["hot"] * 6 + ["a", "b", None])
    history = [(key(), at(), rng.choice([None, 1, 2, 3]), "x") for _ in range(150)] + [("gone", t, 1, "x")]
    rows = [(i, key(), at()) for i in range(400)] + [(999, "new", t), (0, "hot", t)]
    order = lambda h: (h[1] is not None, h[1] or t, h[2] is not None, h[2] or 0)
    want = []
    for i, k, when in rows:
        seen = [h for h in history if h[0] == k and (h[1] is None or when is not None and h[1] <= when)]
        want.append((i, k, when, max(seen, key=order)[2] if seen else None))
    h = frame(spark, history, "k string, since timestamp, value int, id string")
    df = frame(spark, rows, "id int, k string, ts timestamp")
    for seconds in (60, 86400):
        got = joins.as_of(df, "ts", h, ["k"], "since", ["value"], seconds)
        assert got.columns == ["id", "k", "ts", "value_as_of"]
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert joins.as_of(df.limit(0), "ts", h, ["k"], "since", ["value"]).count() == 0
    assert {r.value_as_of for r in joins.as_of(df, "ts", h.limit(0), ["k"], "since", ["value"]).collect()} == {None}


def test_nearest_in_parts(spark):
    """Items sent whole and in parts, ties, one row repeated most often, and vectors that are null, empty, partly null, of no length or of another size."""
    rng = np.random.default_rng(5)
    items = [(f"i{k}", rng.integers(-3, 4, 4).astype(float).tolist()) for k in range(57)] + [("tie", [2.0, 0.0, 0.0, 0.0]), ("aa", [5.0, 0.0, 0.0, 0.0]), (None, [1.0] * 4), ("no", None), ("zero", [0.0] * 4), ("short", [1.0])]
    rows = [(i, rng.integers(-3, 4, 4).astype(float).tolist()) for i in range(200)] + [(900, [1.0, 0.0, 0.0, 0.0]), (901, None), (902, []), (903, [0.0] * 4), (904, [2.0]), (905, [1.0] * 3), (906, [1.0, None, 0.0, 0.0])] + [(900, [1.0, 0.0, 0.0, 0.0])] * 300
    want = {}
    for i, v in rows:
        scored = []
        for name, k in items:
            if name is not None and k is not None and v is not None and len(k) == len(v) and any(k) and any(v) and None not in v:
                scored.append((-round(float(np.dot(v, k) / np.sqrt(np.dot(v, v)) / np.sqrt(np.dot(k, k))), 9), name))
        want[i] = min(scored) if scored else (None, None)
    df, known = frame(spark, rows, "id int, v array<double>"), frame(spark, items, "item string, v array<double>")
    for part_bytes in (900, 1 << 20):
        got = {r.id: (None if r.score is None else pytest.approx(-r.score, abs=2e-9), r.best) for r in joins.nearest(df, "id", "v", known, "item", "v", part_bytes).collect()}
        assert got == want
    assert {r.best for r in joins.nearest(df, "id", "v", known.limit(0), "item", "v").collect()} == {None}
    assert joins.nearest(df.limit(0), "id", "v", known, "item", "v").count() == 0
    assert joins.nearest(df.limit(0), "id", "v", known, "item", "v", 900).count() == 0


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(frame(spark, edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert components.components(frame(spark, [], "u long, v long")).count() == 0


def test_graph_rules(spark):
    schema = "node_type string, node_value string, entity_id string"
    before = frame(spark, [("t", str(i), "A" if i < 4 else "B" if i < 6 else "C") for i in range(10)], schema)
    now = frame(spark, [("t", str(i), "X" if i < 6 else "Y" if i < 9 else "Z") for i in range(10)], schema)
    assert {r.old_id: (r.current_id, r.event_type) for r in graph.persist_ids(now, before).collect()} == {"A": ("X", "merge"), "B": ("X", "merge"), "C": ("Y", "split")}
    w = frame(spark, [(0, False), (30, False), (31, False), (999, True), (999, False)], "age int, p boolean").select(graph.decay(F.col("age"), F.col("p"), [(30, 1.0), (90, 0.5)]).alias("w"))
    assert [r.w for r in w.collect()] == [1.0, 1.0, 0.5, 1.0, 0.0]
    h = graph.health(frame(spark, [(25, 3), (2, 1)], "cluster_size int, anchors int")).collect()
    assert [(r.health_score, r.is_suspicious) for r in h] == [(30, True), (100, False)]


def test_normalise(spark):
    one = lambda v, f: spark.createDataFrame([(v,)], "v string").select(f(F.col("v")).alias("x")).first().x
    assert [one(v, normalise.phone) for v in ("1 (206) 655-0142", "2222222222", "206-5550142", "12")] == ["2066550142", None, None, None]
    assert [one(v, normalise.email) for v in (" A.b+x@Gmail.com", "a.b+x@corp.org", "no at")] == ["ab@gmail.com", "a.b+x@corp.org", None]
    assert [one(v, lambda c: normalise.coerce(c, "INT64")) for v in ("1.5", "9007199254740993", "x", "")] == [1, 9007199254740993, None, None]
    assert one("0000-00-00 00:00:00", normalise.parse_timestamp) is None and one("1700000000", normalise.parse_timestamp) == datetime(2023, 11, 14, 22, 13, 20)
    assert one("<p>a &lt;b&gt;</p><script>x</script> c", normalise.strip_tags) == "a <b> c"
    assert normalise.snake("Total Clicks (%)") == "total_clicks" and normalise.snake("campaignId") == "campaign_id"
    assert one("x/2024/03/05/f.csv", normalise.day_folder) == date(2024, 3, 5)


def _rows(offset, limit):
    return [{"i": i, "s": str(i)} for i in range(offset, min(offset + limit, 57))]


def test_paging():
    assert len(list(paged.by_offset(_rows, 10))) == 57
    pages = {None: ([{"i": 1}], "a"), "a": ([{"i": 2}], "a")}
    assert [r["i"] for r in paged.by_cursor(lambda c: pages[c])] == [1, 2]


def test_reports(spark, tmp_path):
    root = str(tmp_path / "r")
    spark.createDataFrame([("2024-01-01", "1", "2.0"), ("2024-01-02", "2", "x"), ("2024-01-03", "3", "1"), ("2024-01-02", None, "1")], "day string, `Row Id` string, `Spend USD` string").write.partitionBy("day").option("header", True).csv(root)
    spec = tables.TableSpec("spend", ["row_id"], {"row_id": "INT64", "spend_usd": "FLOAT64", "gone": "STRING"})
    got = tables.read_reports(spark, root, spec, "2024-01-02", "2024-01-03").orderBy("row_id").collect()
    assert [(r.row_id, r.spend_usd, r.gone, str(r.report_day)) for r in got] == [(2, None, None, "2024-01-02"), (3, 1.0, None, "2024-01-03")]
    specs = [tables.TableSpec("a", [], pattern="spend"), tables.TableSpec("b", [], pattern="daily_spend", priority=5)]
    assert spark.createDataFrame([("x/daily_spend.csv",), ("x/spend.csv",), ("y",)], "p string").select(tables.route(F.col("p"), specs).alias("r")).collect() == [("b",), ("a",), (None,)]


def test_promote(spark, tmp_path):
    for name in ("s1", "live1"):
        spark.range(3 if name == "s1" else 1).write.parquet(str(tmp_path / name))
    with pytest.raises(FileNotFoundError):
        tables.promote(spark, {str(tmp_path / "s1"): str(tmp_path / "live1"), str(tmp_path / "none"): str(tmp_path / "live2")})
    assert spark.read.parquet(str(tmp_path / "live1")).count() == 1
    tables.promote(spark, {str(tmp_path / "s1"): str(tmp_path / "live1")})
    assert spark.read.parquet(str(tmp_path / "live1")).count() == 3


def test_stream_merge(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i, rows in enumerate(([(1, "a"), (2, "b")], [(2, None), (3, "c")])):
        frame(spark, rows, "k int, v string").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("k int, v string").parquet(src)
        ingest.merge_stream(stream, out, str(tmp_path / "cp"), ["k"]).awaitTermination()
    newest = ingest.current_version(stream, out)
    assert {r.k: r.v for r in spark.read.parquet(newest).collect()} == {1: "a", 2: "b", 3: "c"}
