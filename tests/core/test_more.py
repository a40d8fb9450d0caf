"""Reshaping, run reports and the rest of the graph."""

from pyspark.sql import functions as F

from sluicework.functions import reshape
from sluicework.operators import graph, runs


def test_reshape(spark):
    df = spark.createDataFrame([(1, ((("x", 2),), [1, 2]), [("a", "1"), ("a", "2"), ("b", None)])], "k int, s struct<Inner:struct<d:struct<p:string,q:int>>,l:array<int>>, pairs array<struct<name:string,value:string>>")
    flat = reshape.flatten(df.drop("pairs"), depth=2)
    assert flat.collect()[0].asDict() == {"k": 1, "s_inner_d": '{"p":"x","q":2}', "s_l": "[1,2]"}
    assert reshape.pairs_to_columns(df.select("k", "pairs"), "pairs", "name", "value", ["a", "b", "c"]).collect() == [(1, "2", None, None)]
    wide = spark.createDataFrame([(7, "i1", "s1", "", "s2", "i3")], "id int, ident_1 string, state_1 string, ident_2 string, state_2 string, ident_3 string")
    got = reshape.repeating_groups(wide, ["id"], 3, {"identifier": "ident_{i}", "state": "state_{i}"}).collect()
    assert [tuple(r) for r in got] == [(7, 1, "i1", "s1"), (7, 3, "i3", None)]
    js = spark.createDataFrame([('{"a":{"b":5},"c":[1]}',)], "j string")
    assert js.select(reshape.path(F.col("j"), "a.b"), reshape.path(F.col("j"), "a"), reshape.path(F.col("j"), "c")).first()[:] == ("5", None, None)
    assert dict(reshape.string_ids(spark.createDataFrame([(1, 2, 3)], "id int, user_id int, paid int")).dtypes) == {"id": "string", "user_id": "string", "paid": "int"}


def test_runs(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 9.0)], "k string, s double")
    assert [tuple(r) for r in runs.slowest(df, "k", "s").collect()] == [("a", 2, 2.0)]
    assert runs.latest(df, ["k"], [F.desc("s")]).where("k = 'a'").first().s == 3.0
    scope = runs.refresh_scope(spark.createDataFrame([("ALL",), ("x",), ("x",), ("b",)], "k string"), "k", "ALL").first()
    assert (scope.full_refreshes, scope["keys"], [tuple(x) for x in scope.scope]) == (1, 2, [("b", 1), ("x", 2)])


def test_restitch_equals_stitch(spark):
    e = spark.createDataFrame([("a", str(i), "b", str(i // 3), 1.0) for i in range(12)] + [("a", "0", "b", "3", 1.0)], "a_type string, a_value string, b_type string, b_value string, confidence double")
    order = {"b": 1, "a": 2}
    before = graph.stitch(e.where("not (a_value = '0' and b_value = '3')"), order, 0.5)
    changed = spark.createDataFrame([("a", "0"), ("b", "3")], "node_type string, node_value string")
    key = lambda df: sorted(map(tuple, df.select("node_type", "node_value", "entity_id").collect()))
    assert key(graph.restitch(e, before, changed, order, 0.5)) == key(graph.stitch(e, order, 0.5))
    cover = {r.node_type: (r.nodes, r.entities) for r in graph.coverage(before).collect()}
    assert cover == {"a": (12, 4), "b": (4, 4)}


def rows_from(offset, limit):
    return [{"i": i, "s": str(i)} for i in range(offset, min(offset + limit, 57))]


def test_paged_reader(spark):
    from pyspark.sql.types import StructType

    from sluicework.sources.paged import PagedReader

    schema = StructType.fromDDL("s string, i long, none string")
    reader = PagedReader(schema, {"fetch": f"{__name__}:rows_from", "total": "57", "size": "10", "parts": "3"})
    parts = reader.partitions()
    assert len(parts) == 3
    assert [t for p in parts for t in reader.read(p)] == [(str(i), i, None) for i in range(57)]


def test_stitch_all_lines(spark, sf):
    from sluicework.plans.queries import QUERIES, _edges, read

    lines = read(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct().count()
    assert QUERIES["graph_edges"](spark, sf).where("b_type = 'supplier'").count() == lines
    recent = graph.in_influence(graph.aggregate_edges(_edges(spark, sf)), F.lit("2001-09-01").cast("timestamp"), {"customer": 1000, "order": -1, "supplier": 400}).collect()
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    rank = lambda x: ({"customer": 1, "supplier": 2, "order": 3}[x[0]], x)
    for r in recent:
        a, b = sorted((find((r.a_type, r.a_value)), find((r.b_type, r.b_value))), key=lambda x: (rank(x)[0], ":".join(x)))
        root[b] = a
    assert any(r.b_type == "supplier" for r in recent)
    got = {(r.node_type, r.node_value): (r.root_type, r.root_value) for r in QUERIES["graph_entities"](spark, sf).collect()}
    assert got == {x: find(x) for x in root}
