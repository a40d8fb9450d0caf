"""The operators against brute force on small tables, and on odd rows."""

import hashlib
import time
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicework.llm import chat_tools, decontamination, host_rules, html_extraction, jaccard_join, line_dedup, mixing, quality_classifier, suffix_dedup, token_output
from sluicework.llm.common import shingles, table, word_hashes


def documents(spark, sf):
    return [(r.doc_id, r.text or "", r.source) for r in table(spark, sf, "documents").orderBy("doc_id").collect()]


# --- 1 -------------------------------------------------------------------------------------


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_classifier.op1_quality(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    assert (got.predicted == got.quality).mean() > 0.93
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id)


def test_quality_odd(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None)], "doc_id long, quality int")
    got = quality_classifier.scores(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r.score <= 1 for r in got)
    assert quality_classifier.scores(no_docs, labels).count() == 0
    kept = quality_classifier.keep_good(odd_docs, labels.where("false"))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_isotonic():
    assert quality_classifier.isotonic(np.array([1.0, 3.0, 2.0, 4.0]), np.ones(4)).tolist() == [1.0, 2.5, 2.5, 4.0]


# --- 2 -------------------------------------------------------------------------------------


def brute_lines(rows):
    seen, out = {}, {}
    for doc, text in rows:
        lines, drop = text.split("\n"), set()
        for first, n, data in line_dedup.chunks(text):
            if data in seen:
                drop.update(range(first, first + n))
            seen.setdefault(data, doc)
        out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in drop)
    return out


def test_line_dedup(spark, sf):
    want = brute_lines((d, t) for d, t, _ in documents(spark, sf))
    got = {r.doc_id: r.text for r in line_dedup.line_dedup(table(spark, sf, "documents")).collect()}
    assert got == want


def test_line_chunks_shift():
    lines = [f"line {i} of the passage" for i in range(60)]
    a, b = ({x[2] for x in line_dedup.chunks("\n".join(head + lines))} for head in ([], ["new", "lines above"]))
    assert len(a & b) >= len(a) - 2


def test_line_dedup_whole_copies(spark):
    rng = np.random.default_rng(6)
    texts = ["\n".join(f"line {x}" for x in rng.integers(0, 1 << 40, n)) for n in [2, 3] * 150 + list(range(4, 24))]
    rows = [(i + 1000 * k, t) for k in range(3) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_lines - r.n_removed, r.text) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: (0, "") if d >= 1000 else (t.count("\n") + 1, t) for d, t in rows}


def test_line_dedup_inner_passages():
    rng = np.random.default_rng(7)
    new = lambda n: [f"line {x}" for x in rng.integers(0, 1 << 40, n)]
    for _ in range(200):
        passage = new(40)
        texts = ["\n".join(new(int(rng.integers(1, 9))) + passage + new(int(rng.integers(1, 9)))) for _ in range(2)]
        (a, b), place = ({x[2] for x in line_dedup.chunks(t)} for t in texts), {x: i for i, x in enumerate(passage)}
        same = sorted(place[x.decode()] for data in a & b for x in data.split(b"\n"))
        assert same == list(range(same[0], same[-1] + 1)) and len(same) >= 12  # no line stays between removed ones


def test_line_dedup_odd(spark, odd_docs, no_docs):
    twice = odd_docs.select("doc_id", F.concat("text", F.lit("\nx y\nz w\nq r\ns t")).alias("text"), "th")
    assert line_dedup.line_dedup(odd_docs).count() == odd_docs.count()
    assert line_dedup.line_dedup(twice).count() == odd_docs.count()
    assert line_dedup.line_dedup(no_docs).count() == 0


# --- 3 -------------------------------------------------------------------------------------


def brute_suffix(rows):
    seen, out = set(), {}
    for doc, text in rows:
        data = text.encode()
        cover, new = bytearray(len(data)), set()
        for k in range(len(data) - 99):
            w = data[k : k + 100]
            if w in seen or w in new:
                cover[k : k + 100] = b"\1" * 100
            new.add(w)
        seen |= new
        spans = sum(1 for k in range(len(data)) if cover[k] and (k == 0 or not cover[k - 1]))
        out[doc] = (len(data), sum(cover), spans, hashlib.sha256(bytes(x for x, c in zip(data, cover) if not c)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup(spark, sf, hot):
    want = brute_suffix((d, t) for d, t, _ in documents(spark, sf))
    got = suffix_dedup.suffix_dedup(table(spark, sf, "documents").repartition(3), hot=hot)
    got = got.select("doc_id", "n_bytes", F.size("runs").alias("n"), F.length("kept").alias("k"), F.sha2("kept", 256).alias("h")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_bytes - r.k, r.n, r.h) for r in got} == want


@pytest.mark.parametrize("spread", [False, True])
@pytest.mark.parametrize("bits", [0, 2, 64])
def test_suffix_dedup_colliding_hashes(sf, monkeypatch, bits, spread):
    """The passes one after another, with hashes cut to a few bits: anchors that agree by chance remove nothing, be they listed as common or not."""
    whole = suffix_dedup._hashes
    monkeypatch.setattr(suffix_dedup, "_hashes", lambda *x: whole(*x) & np.uint64((1 << bits) - 1))
    rng = np.random.default_rng(3)
    base = "".join(chr(97 + c) for c in rng.integers(0, 4, 700))
    texts = dict(enumerate([base, base[300:] + base[:350], "x" * 50 + base[100:260] + "y" * 130, base[:99] + "é" + base[1:140], "short", ""]))
    batch = pa.RecordBatch.from_pydict({"doc": pa.array(texts, pa.int64()), "rank": pa.array([0] * len(texts), pa.int32()), "text": list(texts.values())})
    table_of = lambda batches: pa.Table.from_batches([b for b in batches if b.num_rows])
    one_by_one = [batch.slice(i, 1) for i in range(len(texts))]
    common = np.unique(table_of(suffix_dedup._scan(one_by_one)).column("key").to_numpy()) if spread else None
    found = table_of(suffix_dedup._scan(one_by_one, common)).sort_by([(c, "ascending") for c in ("gone", "key", "digest", "more", "doc", "rank", "span")])
    judged = table_of(suffix_dedup._judge(found.to_batches(max_chunksize=7))).to_pylist()
    spans = defaultdict(list)
    for x in judged:
        if x["gone"]:
            low, high, _ = suffix_dedup.unpack(x["span"])
            spans[x["doc"]].append((low, high))
    parts = [{**x, "part": texts[x["doc"]].encode()[low : high + 100]} for x in judged if not x["gone"] for low, high, _ in [suffix_dedup.unpack(x["span"])]]
    parts = pa.Table.from_pylist(sorted(({k: x[k] for k in ("key", "doc", "rank", "span", "part")} for x in parts), key=lambda x: (x["key"], x["doc"], x["span"])), pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("rank", pa.int32()), ("span", pa.int64()), ("part", pa.binary())]))
    for b in suffix_dedup._sort_windows(parts.to_batches()):
        for x in b.to_pylist():
            spans[x["doc"]].append((x["low"], x["high"]))
    want = brute_suffix(texts.items())
    got = {d: suffix_dedup._remove(t.encode(), spans[d]) for d, t in texts.items()}
    assert {d: (len(runs), hashlib.sha256(kept).hexdigest()) for d, (runs, kept) in got.items()} == {d: w[2:] for d, w in want.items()}


def test_suffix_dedup_pieces(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = "".join(chr(97 + c) for c in rng.integers(0, 20, 3000))
    rows = [(5, base[500:1500] + "é" * 300), (1, base), (9, "x" * 450 + base[2000:2099] + base[100:230])]
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_suffix(sorted(rows))
    assert {d: hashlib.sha256(k).hexdigest() for d, k in got.items()} == {d: w[3] for d, w in want.items()}


def test_suffix_dedup_common_passage(spark):
    """A passage of 130 bytes in most documents and whole copies of one text: no key of the first shuffle has more than a fiftieth of the rows."""
    rng = np.random.default_rng(8)
    passage = "".join(chr(97 + x) for x in rng.integers(0, 26, 130))
    word = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    copied = word(900)
    rows = [(i, copied if i % 9 == 0 else word(60) + passage + word(int(rng.integers(20, 200)))) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ordered = docs.selectExpr("doc_id AS doc", "0 AS rank", "text")
    common = suffix_dedup.common_anchors(ordered)
    assert 0 < len(common) <= suffix_dedup.LISTED
    hottest = lambda keys: [r["count"] for r in suffix_dedup.dealt(ordered, keys).groupBy("key").count().orderBy(F.col("count").desc()).limit(1).collect()][0]
    total = suffix_dedup.dealt(ordered, common).count()
    assert hottest(common) <= total / 50 < hottest(np.empty(0, np.int64))
    want = brute_suffix(rows)
    for hot in (suffix_dedup.HOT, 50):
        got = {r.doc_id: hashlib.sha256(bytes(r.kept)).hexdigest() for r in suffix_dedup.suffix_dedup(docs, hot=hot).collect()}
        assert got == {d: w[3] for d, w in want.items()}


def test_suffix_dedup_odd(spark, odd_docs, no_docs):
    got = suffix_dedup.suffix_dedup(odd_docs).collect()
    assert len(got) == odd_docs.count()
    text = " ".join(f"word{i}" for i in range(40))
    assert [bytes(r.kept).decode() for r in got if r.doc_id == 1] == [text]
    assert all(len(r.kept) == 0 for r in got if r.doc_id == 2 and r.n_bytes == len(text))
    assert [len(r.kept) for r in got if r.doc_id == 8] == [1]
    assert suffix_dedup.suffix_dedup(no_docs).count() == 0


# --- 4 -------------------------------------------------------------------------------------


def test_tools(spark):
    calls = spark.createDataFrame(
        [
            (1, 5, "c", "add", '{"b": 2, "a": 1}', "b"),
            (1, 3, "b", "add", '{"a": "x", "b": 1}', "a"),
            (1, 1, "a", "add", '{"a": 1, "b": 2, "z": 0}', "gone"),
            (1, 7, "a", "add", "{}", None),
            (1, 8, "x", "add", "[1]", "y"),
            (1, 9, "y", "other", "{}", "x"),
            (None, 1, "a", "add", None, None),
            (1, 2, None, "add", '{"a": 1', None),
        ],
        "conv_id long, turn long, call_id string, name string, arguments string, follows string",
    )
    results = spark.createDataFrame([(1, 6, "c", "3"), (1, 9, "c", "4"), (1, 4, "zzz", "lost"), (None, 2, "a", "null's")], "conv_id long, turn long, call_id string, content string")
    got = chat_tools.format_tools(calls, results, {"add": {"a": ("integer", True), "b": ("number", True)}}).collect()
    by = {(r.conv_id, r.call_id): r for r in got}
    assert len(got) == 7
    assert [by[1, x].depth for x in "abcxy"] == [0, 1, 2, None, None]
    assert [by[1, x].position for x in "abc"] == [0, 1, 2] and {by[1, x].position for x in "xy"} == {3, 4}
    assert by[1, "a"].n_calls == 2 and by[1, "c"].n_results == 2
    assert by[1, "c"].json == '{"arguments":{"a":1,"b":2},"call_id":"c","name":"add","result":"3"}'
    assert by[1, "c"].valid and by[1, "a"].errors == ["unknown z"] and by[1, "b"].errors == ["a is no integer"]
    assert by[1, "x"].errors == ["no object"] and by[1, "y"].errors == ["unknown tool"] and by[1, None].errors == ["no JSON"]
    assert by[None, "a"].json.endswith('"result":"null\'s"}')
    assert chat_tools.format_tools(calls.where("false"), results, {}).count() == 0


def test_tools_schemas(spark):
    """Names that look like paths, nested objects, items and enumerations."""
    field = chat_tools.Field
    schemas = {
        "odd": {"a.b": ("integer", True), "it's": ("string", False), 'say "x"?': ("boolean", False), "l[0]": ("number", False), "$": ("string", False)},
        "deep": {
            "at": field("object", True, {"x": field("number"), "unit": field("string", False, values=("m", "k\u00e9", 3))}),
            "tags": field("array", False, items=field("string")),
            "rows": field("array", False, items=field("object", fields={"id": field("integer"), "of": field("array", False, items=field("integer"))})),
            "mode": field("string", False, values=("on", "off")),
        },
    }
    cases = [
        ("odd", '{"a.b": 1}', []),
        ("odd", '{"a": {"b": 1}}', ["missing a.b", "unknown a"]),
        ("odd", """{"a.b": 1, "it's": 2, "say \\"x\\"?": true, "l[0]": 1.5, "$": "s"}""", ["it's is no string"]),
        ("odd", '{"a.b": null}', ["a.b is no integer"]),
        ("odd", '{"a.b": 1, "z": 1, "l": [2], "b": 0}', ["unknown b", "unknown l", "unknown z"]),
        ("deep", '{"at": {"x": 1.5, "unit": "k\u00e9"}, "tags": ["a", "b"], "rows": [{"id": 1, "of": [1, 2]}], "mode": "on"}', []),
        ("deep", '{"at": {"x": "1", "unit": "cm", "y": 2}, "mode": "ON"}', ["at.x is no number", "at.unit is none of its values", "unknown at.y", "mode is none of its values"]),
        ("deep", '{"at": {"x": 1, "unit": 3}}', ["at.unit is no string"]),
        ("deep", '{"at": [], "tags": ["a", 1, 2], "rows": [{"id": 1}, {"id": "x", "of": ["y", "z"]}, {}, 5]}', ["at is no object", "tags[] is no string", "rows[].id is no integer", "rows[].of[] is no integer", "missing rows[].id", "rows[] is no object"]),
        ("deep", '{"at": {"x": 1}, "tags": [], "rows": []}', []),
        ("deep", "{}", ["missing at"]),
        ("deep", '"text"', ["no object"]),
        ("deep", "null", ["no object"]),
    ]
    calls = spark.createDataFrame([(1, i, f"c{i}", tool, text, None) for i, (tool, text, _) in enumerate(cases)], "conv_id long, turn long, call_id string, name string, arguments string, follows string")
    got = chat_tools.format_tools(calls, spark.createDataFrame([], "conv_id long, turn long, call_id string, content string"), schemas).orderBy("turn").collect()
    assert [r.errors for r in got] == [e for _, _, e in cases] and [r.valid for r in got] == [not e for _, _, e in cases]


def test_tools_of_odd_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", None), (1, 1, "assistant", "r"), (1, 1, "assistant", "q"), (1, 2, "user", ""), (None, 0, "user", "n"), (2, None, "user", "x"), (2, 5, None, "y"), (3, 4, "user", "z" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
    calls, results = chat_tools.conversation_calls(turns)
    slips = chat_tools.format_tools(*chat_tools.conversation_calls(spark.createDataFrame([(0, 2 * k, "user", None if k == 7 else "t") for k in range(8)], "conv_id long, turn long, role string, text string")), {"reply": chat_tools.REPLY}).orderBy("turn").collect()
    assert [r.errors for r in slips] == [[], ["missing turn"], ["turn is no integer"], ["unknown lang"], ["no JSON"], [], [], ["missing text"]]
    got = {(r.conv_id, r.turn): r for r in chat_tools.format_tools(calls, results, {"reply": chat_tools.REPLY}).collect()}
    assert set(got) == {(1, 0), (1, 2), (None, 0), (2, None), (3, 4)}
    assert got[1, 0].n_calls == 3 and got[1, 0].n_results == 2 and got[1, 2].depth == 1 and got[2, None].position is None
    assert not got[2, None].valid and got[3, 4].valid and len(got[3, 4].json) > 100_000


def test_tools_graphs(spark):
    """Depths against a longest-path search, on branches that meet, unlike branches, cycles and what follows them."""
    rng = np.random.default_rng(2)
    graphs = {1: {i: [i - 1] + ([i - 3] if i % 4 == 3 else []) for i in range(1, 150)} | {0: []}, 2: {0: [], 1: [0], 2: [0, 1], 3: [2, 1], 4: [3, 0, 77], 5: [5], 6: [7, 0], 7: [6], 8: [5, 0], 9: [10, 1], 10: [11], 11: [9], 12: [9, 9]}}
    graphs[3] = {i: sorted(set(rng.integers(0, i, rng.integers(0, 4)).tolist())) if i else [] for i in range(60)}
    want = {}
    for conv, graph in graphs.items():
        depth = {}
        for _ in graph:  # as often as there are calls: what isn't known then is on a cycle or after one
            for i, before in graph.items():
                if all(b in depth or b not in graph for b in before):
                    depth[i] = max((depth[b] + 1 for b in before if b in graph), default=0)
        want |= {(conv, f"c{i}"): depth.get(i) for i in graph}
    rows = [(conv, -i, f"c{i}", "t", "{}", [f"c{b}" for b in before]) for conv, graph in graphs.items() for i, before in graph.items()]
    calls = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, name string, arguments string, follows array<string>")
    got = chat_tools.format_tools(calls, spark.createDataFrame([], "conv_id long, turn long, call_id string, content string"), {"t": {}}).collect()
    assert {(r.conv_id, r.call_id): r.depth for r in got} == want
    places = {(r.conv_id, r.call_id): r.position for r in got}
    for conv, graph in graphs.items():
        assert sorted(places[conv, f"c{i}"] for i in graph) == list(range(len(graph)))
        assert all(places[conv, f"c{b}"] < places[conv, f"c{i}"] for i, before in graph.items() for b in before if b in graph and want[conv, f"c{i}"] is not None)


def test_tools_long_chain(spark):
    calls = spark.range(700).selectExpr("1L AS conv_id", "id AS turn", "'c' || id AS call_id", "'t' AS name", "'{}' AS arguments", "'c' || (id - 1) AS follows")
    got = chat_tools.format_tools(calls, spark.createDataFrame([], "conv_id long, turn long, call_id string, content string"), {"t": {}})
    assert got.where("depth = turn AND position = turn AND valid").count() == 700


# --- 5 -------------------------------------------------------------------------------------


def test_leaks(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(400)]
    item = list(rng.choice(vocabulary, 40))
    edited = [w if i % 7 else "changed" for i, w in enumerate(item)]
    filler = lambda n: list(rng.choice(vocabulary, n))
    rows = [(1, " ".join(filler(200) + item + filler(50))), (2, " ".join(filler(100) + [w.upper() + "," for w in edited] + filler(9000))), (3, " ".join(filler(3000))), (4, None), (5, ""), (None, " ".join(item)), (1, " ".join(item))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash"))
    items = spark.createDataFrame([(7, " ".join(item)), (8, None), (9, ""), (None, "two words")], "item_id long, text string")
    got = decontamination.leaks(docs, items).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == Counter([(1, 7), (1, 7), (2, 7), (None, 7)])
    two = next(r for r in got if r.doc_id == 2)
    assert 0.5 < two.score < 1 and 95 <= two.start_word <= 102 and 138 <= two.end_word <= 142
    small = decontamination.leaks(docs, items, most_bits=64)  # a filter that lets nearly all pass
    assert Counter((r.doc_id, r.item_id) for r in small.collect()) == Counter((r.doc_id, r.item_id) for r in got)
    kept = decontamination.keep_clean(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert decontamination.leaks(docs, items.where("false")).count() == 0 and decontamination.leaks(docs.where("false"), items).count() == 0


def test_leaks_send_no_text_without_hits(spark, monkeypatch):
    """What the join of texts with windows gets has the documents with windows, also where it is no broadcast, and few others."""
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(k if k else None, text(k % 200)) for k in range(400)]
    kept, plain = {}, decontamination.materialize
    monkeypatch.setattr(decontamination, "materialize", lambda df, label: kept.setdefault(label, plain(df, label)))
    got = decontamination.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, text(0)), (2, text(7))], "item_id long, text string"))
    assert Counter((r.doc_id, r.item_id) for r in got.collect()) == Counter([(None, 1), (200, 1), (7, 2), (207, 2)])
    assert kept["suspects"].count() < 20 and kept["suspects"].join(kept["hits"], "th", "left_semi").count() == 4


def test_leaks_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "HITS", 500)
    rng = np.random.default_rng(11)
    vocabulary = np.array([f"w{i}" for i in range(60)])
    items = [(i, list(rng.choice(vocabulary, n))) for i, n in enumerate([2, 3, 4, 5, 6, 7, 9, 15, 25, 40, 40])]
    edits = {"replace": lambda w: ["edit"], "insert": lambda w: [w, "more"], "delete": lambda w: []}
    rows = []
    for every in (1, 2, 3, 4, 5, 6):
        for edit in edits.values():
            for _, item in items[6:]:  # no copy is verbatim
                copy = [x for k, w in enumerate(item) for x in (edit(w) if k % every == every - 1 else [w])]
                rows.append([*rng.choice(vocabulary, 30), *copy, *rng.choice(vocabulary, 30)])
    rows += [list(rng.choice(vocabulary, n)) for n in (0, 1, 3, 50, 200)] + [items[9][1][:20] + ["x"] * n + items[9][1][20:] for n in (15, 25)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    table_of = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    hashed = lambda w: decontamination.plain_words([" ".join(w)])[0]
    for least in (0.5, 0.7, 0.3):
        want = {(d, i): decontamination.align(hashed(w), hashed(r))[0] for d, r in enumerate(rows) for i, w in items if len(w) > 2}
        got = {(r.doc_id, r.item_id): r.score for r in decontamination.leaks(docs, table_of, least_score=least).collect()}
        assert {k: x for k, x in got.items() if k[1]} == {k: x for k, x in want.items() if x >= least}


def test_leaks_against_all_alignments(spark, sf):
    hashed = lambda t: decontamination.plain_words([t or ""])[0]
    items = [(r.item_id, hashed(r.text)) for r in table(spark, sf, "benchmark").collect()]
    want = {(d, i): decontamination.align(w, words)[0] for d, t, _ in documents(spark, sf) if len(words := hashed(t)) for i, w in items}
    want = {k: x for k, x in want.items() if x >= decontamination.LEAST_SCORE}
    got = {(r.doc_id, r.item_id): r.score for r in decontamination.op5_decontamination(spark, sf).collect()}
    assert want and got == want


def test_leaks_odd(spark, odd_docs):
    item = " ".join(f"word{i}" for i in range(5, 30))
    items = spark.createDataFrame([(1, item), (1, item), (2, "a" * 3000), (3, " ".join(f"long{i}x" for i in range(2000, 2040)))], "item_id long, text string")
    got = Counter((r.doc_id, r.item_id) for r in decontamination.leaks(odd_docs, items).collect())
    assert got == Counter({(1, 1): 2, (2, 1): 4, (7, 3): 1, (8, 2): 1})  # alike documents are one, repeated items are two
    kept = decontamination.keep_clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 6


def test_align_brute():
    rng = np.random.default_rng(5)
    for _ in range(30):
        a, b = (rng.integers(0, 4, rng.integers(1, 15)).astype(np.uint64) for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        score, start, end = decontamination.align(a, b)
        assert score == h.max() / (2 * len(a)) and start <= end


# --- 6 -------------------------------------------------------------------------------------


def brute_tokens(texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(token_output.default_tokenizer())
    return [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for t in texts]


def test_tokens(spark, sf):
    rows = documents(spark, sf)
    want, at = {}, 0
    for (doc, _, _), ids in zip(rows, brute_tokens(t for _, t, _ in rows)):
        want[doc] = (at, len(ids) // 4, zlib.crc32(ids))
        at += len(ids) // 4
    got = token_output.op6_token_output(spark, sf).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want


def test_encoder_text_forms():
    texts = ["", " ", "  ", "a  b", "<|endoftext|> x", "it's  we'll\n\n b", " lead", "trail ", "tab\there \n x", "日本 語 text", "naïve café's x.", "x's_ 12ab a1 b's", " 'tis 'd", "word.'s a", "a\nb c\n d", "ÿ Āx ɐ", "x| | |y", " a b  c"]
    assert [t + b"\0\0" for t in token_output.Encoder(token_output.default_tokenizer()).encode(texts)] == [np.frombuffer(t, "<u4").astype("<u2").tobytes() for t in brute_tokens(texts)]


def test_encoder_keeps_words_in_use(monkeypatch):
    """Words of every text are tokenized once, though far more words than the cache holds come between; ids are the library's."""
    rng, seen = np.random.default_rng(7), []
    word = lambda letters: "".join(rng.choice(list(letters), 8))
    texts = [f"Der {word('abcdef')} und {word('abcdefé')}, oder {word('abc')}.\n{word('abcdé')}! und" for _ in range(500)]
    monkeypatch.setattr(token_output._Cache.__init__, "__defaults__", (100,))
    coder = token_output.Encoder(token_output.default_tokenizer())
    learn = coder.units.learn
    coder.units.learn = lambda unit: (seen.append(unit), learn(unit))[1]
    assert [t + b"\0\0" for t in coder.encode(texts)] == [np.frombuffer(t, "<u4").astype("<u2").tobytes() for t in brute_tokens(texts)]
    assert seen.count("und") == 1 and seen.count("oder") == 1 and len(seen) > 1500


def test_encoder_shares_words():
    """A word is tokenized once, whatever marks or line ends stand around it; ids are the library's."""
    coder, asked = token_output.Encoder(token_output.default_tokenizer()), []
    tokenize = coder.tokenize
    coder.tokenize = lambda piece: (asked.append(piece), tokenize(piece))[1]
    texts = ["a hjkwe, hjkwe. hjkwe! hjkwe hjkwe.\nQwzrt hjkwe;\nQwzrt, \u00f1bq. \u00f1bq, x"]
    assert [t + b"\0\0" for t in coder.encode(texts)] == [np.frombuffer(t, "<u4").astype("<u2").tobytes() for t in brute_tokens(texts)]
    assert [sum(w in piece for piece in asked) for w in ("hjkwe", "Qwzrt", "bq")] == [1, 1, 1]


def test_tokens_odd(spark, odd_docs, no_docs):
    got = token_output.token_output(odd_docs, token_output.default_tokenizer()).orderBy("start").collect()
    assert len(got) == odd_docs.count() and sorted((r.doc_id or 0, r.copy) for r in got)[:2] == [(0, 0), (0, 1)]
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()
    assert sum(r.doc_id == 2 for r in got) == 3
    assert token_output.token_output(no_docs, token_output.default_tokenizer()).count() == 0


def test_perfect_hash():
    keys = np.random.default_rng(2).integers(0, 1 << 63, 5000).astype(np.uint64)
    levels, left = token_output.build_mph(keys)
    assert sorted(token_output.mph_slots(keys, levels, left).tolist()) == list(range(5000))
    entries = np.zeros(5000, token_output._ENTRY)
    entries["offset"] = np.arange(5000)
    entries["fingerprint"] = keys ^ np.uint64(5)
    index = token_output.unpack_index(token_output.pack_index(keys, entries))
    assert index.slots(keys).tolist() == token_output.mph_slots(keys, levels, left).tolist()
    assert index.entries["offset"][index.slots(keys)].tolist() == list(range(5000))


def test_colliding_keys():
    keys, entries = np.array([5, 9, 9, 12, 9], np.uint64), np.zeros(5, token_output._ENTRY)
    entries["fingerprint"], entries["offset"] = [1, 2, 3, 4, 5], np.arange(5)
    known, got = token_output.find_keys(token_output.pack_index(keys, entries), keys, entries["fingerprint"])
    assert known.all() and got["offset"].tolist() == list(range(5))
    known, _ = token_output.find_keys(token_output.pack_index(keys, entries), np.array([9, 77], np.uint64), np.array([6, 1], np.uint64))
    assert not known.any()
    entries["fingerprint"][2] = 2
    with pytest.raises(ValueError):
        token_output.pack_index(keys, entries)


def test_tokens_of_two_attempts(spark, sf, tmp_path):
    path, docs, tokenizer = f"file://{tmp_path}", table(spark, sf, "documents"), token_output.default_tokenizer()
    meta = token_output.write_shards(docs, path, tokenizer, shard_bytes=100_000)
    shards = sorted(p.name for p in tmp_path.glob("shard-*.bin"))
    assert len(shards) >= docs.agg(F.sum(F.octet_length("text"))).first()[0] / 100_000 * 0.9
    (tmp_path / (shards[0].rsplit("-", 1)[0] + "-999999.bin")).write_bytes(b"half of a lost attempt")
    (tmp_path / "index-00000-999999.mph").write_bytes(b"")
    read = token_output.read_payloads(token_output.look_up(meta, path, token_output.write_index(meta, path, 50)), path, "<u2")
    got = {r.doc_id: r.ids_crc32 for r in read.collect()}
    rows = documents(spark, sf)
    assert got == {d: zlib.crc32(ids) for (d, _, _), ids in zip(rows, brute_tokens(t for _, t, _ in rows))}


def test_unknown_key(spark, odd_docs, tmp_path):
    path = f"file://{tmp_path}"
    n = token_output.write_index(token_output.write_shards(odd_docs, path, token_output.default_tokenizer()), path)
    asked = spark.createDataFrame([(1, 0), (1, 1), (77, 0), (None, 1)], "doc_id long, copy long")
    assert sorted((r.doc_id or 0, r.copy) for r in token_output.look_up(asked, path, n).collect()) == [(0, 1), (1, 0)]


def test_tokens_of_one_id_take_several_shards(spark, tmp_path):
    """Rows of one id, null ids among them, and rows that are alike: dealt over shards, with copies numbered through."""
    rows = [(None, f"text {i % 700} of none") for i in range(3000)] + [(7, "the same text")] * 2000 + [(i, f"own {i}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    docs.write.parquet(f"{tmp_path}/docs")
    path = f"file://{tmp_path}/out"
    got = token_output.token_output(spark.read.parquet(f"{tmp_path}/docs"), token_output.default_tokenizer(), path).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r.start):
        by[r.doc_id].append(r)
    assert [r.copy for r in by[None]] == list(range(3000)) and [r.copy for r in by[7]] == list(range(2001))
    assert len({r.shard for r in by[None]}) > 1 and Counter(len(r) for r in by.values())[1] == 499
    reader = token_output.Reader(path)
    for r in (*by[None][::400], *by[7][::400], *by[3]):
        assert zlib.crc32(reader.get(r.doc_id, r.copy).astype("<u4").tobytes()) == r.ids_crc32
    assert reader.get(None, 3000) is None and reader.get(501) is None
    with pytest.raises(FileExistsError):
        token_output.write_output(docs, token_output.default_tokenizer(), path)


def test_reader_reads_little(spark, sf, tmp_path):
    """All keys one by one, from many buckets; a key's reads don't grow with the bucket."""
    path, rows = f"file://{tmp_path}/out", documents(spark, sf)
    token_output.token_output(table(spark, sf, "documents"), token_output.default_tokenizer(), path)
    reader = token_output.Reader(path)
    want = {d: ids for (d, _, _), ids in zip(rows, brute_tokens(t for _, t, _ in rows))}
    assert all(reader.get(d).astype("<u4").tobytes() == ids for d, ids in want.items())
    rng, read = np.random.default_rng(3), []
    for n in (1000, 200_000):
        keys, entries = rng.integers(0, 1 << 63, n).astype(np.uint64), np.zeros(n, token_output._ENTRY)
        entries["offset"], entries["fingerprint"] = np.arange(n), keys ^ np.uint64(9)
        data = token_output.pack_index(keys, entries)

        class File:
            at = total = 0

            def seek(self, at):
                self.at = at

            def read(self, k):
                self.at, self.total = self.at + k, self.total + k
                return data[self.at - k : self.at]

        file = File()
        reader.heads.clear()
        for i in range(0, n, n // 500):
            file.at = 0
            assert int(reader._entry(file, 0, int(keys[i]), int(keys[i]) ^ 9)["offset"]) == i
        read.append(file.total / 500)
    assert max(read) < 250


# --- 7 -------------------------------------------------------------------------------------


def test_html(spark):
    page = (
        "<html><head><title>x</title><script>var a='</p>';</script></head><body><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies</div><div class=wrap><div class='post post-{0}'><h1>Title {0}</h1>"
        "<p>Some &amp; text <b>bold</b>\n here<p>second &lt;one&gt; with a <a href=x>link</a><ul><li>item one<li>item two</ul><form>mail<input></form></div><aside>side text that is rather long</aside></div><section id=comments><p>First! great great great post</p></section><footer>&copy; us</footer>"
    )
    rows = [(i, f"https://Host.example/{i}", page.format(i)) for i in range(5)] + [(9, "https://host.example/x", "<p>bare</p>"), (10, None, None), (11, "no url", "just &eacute; text"), (12, "https://b.example", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("path", F.lit("clash"))
    got = {r.page_id: r for r in html_extraction.extract(pages).collect()}
    assert got[3].text == "Title 3\nSome & text bold here\nsecond <one> with a link\nitem one\nitem two"
    assert got[3].path == "/html/body/div.wrap/div.post" and got[3].n_chars == len(got[3].text)
    assert [got[i].text for i in (9, 10, 11, 12)] == ["bare", "", "just é text", ""]
    assert html_extraction.extract(pages.where("false")).count() == 0


class ArticleText(HTMLParser):
    """The article of a page of the given tables, by the standard parser: blocks end at each tag that isn't inline."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.blocks, self.now, self.depth, self.off = [], "", 0, 0
        self.feed(source)
        self.close()
        self.flush()

    def flush(self):
        if text := " ".join(self.now.split()):
            self.blocks.append(text)
        self.now = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.now += " "
        elif tag not in ("b", "i", "a", "em", "strong", "span"):
            self.flush()
        self.depth += tag == "article"
        self.off += tag in ("script", "style", "nav", "form", "aside")

    def handle_endtag(self, tag):
        if tag not in ("b", "i", "a", "em", "strong", "span"):
            self.flush()
        self.depth -= tag == "article"
        self.off -= tag in ("script", "style", "nav", "form", "aside")

    def handle_data(self, data):
        if self.depth > 0 and not self.off:
            self.now += data


def in_form(source):
    """The page as some servers send it: all of the body in one form."""
    return source.replace("<body>", "<body><form method=post action=x><input type=hidden name=state value=1><div><input name=q><input type=submit></div>").replace("</body>", "</form></body>")


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_html_against_standard_parser(spark, folder):
    rows = table(spark, f"/root/testdata/{folder}", "pages").select("page_id", "html").collect()
    got = {r.page_id: r.text for r in html_extraction.op7_html_extraction(spark, f"/root/testdata/{folder}").collect()}
    with_article = [r for r in rows if r.html and "<article" in r.html]
    assert len(got) == len(rows) and len(with_article) > 0.8 * len(rows)
    assert all(got[r.page_id] == "\n".join(ArticleText(r.html).blocks) for r in with_article)
    # the same pages without article elements, and in a form
    plain = spark.createDataFrame([(r.page_id, f"https://h{r.page_id % 5}.example/", form(r.html.replace("<article", "<div").replace("</article", "</div"))) for r in with_article for form in (str, in_form)], "page_id long, url string, html string")
    texts = {r.page_id: "\n".join(ArticleText(r.html).blocks) for r in with_article}
    assert all(r.text == texts[r.page_id] for r in html_extraction.extract(plain).collect())


def test_html_keeps_articles():
    text = lambda x: html_extraction.main_text(x, None)
    body = "<p>A sentence of the body that is long enough to count.</p>"
    assert text(f"<header>Site</header><article><header><h1>Title</h1></header>{body}</article>").startswith("Title\nA sentence")
    for kept in ("<div class='related-work'>Work of others</div>", "<p class='privacy'>On privacy</p>", "<p>so <math><mi>m</mi><mo>=</mo></math> holds</p>", "<div class='notice'>A notice period</div>"):
        assert len(text(f"<article>{body}{kept}</article>").split("\n")) == 2, kept
    for gone in ("<div class=ad>Buy</div>", "<div class='cookie-notice'>We use</div>", "<section id=comments><p>First!</p></section>", "<div class='social-share'>Tell</div>", "<footer>By us</footer>", "<div class='related'><a href=x>more</a></div>", "<p>a<span class=advert>Buy</span></p>"):
        assert "\n" not in text(f"<article>{body}{gone}</article>").replace("\na", ""), gone
    assert text(f"<div class='ads'>{body * 9}</div>").count("\n") == 8  # what alone holds the text is kept


COMMENTS = [
    ("<section id=comments>{}</section>", "<div class=comment><b>Reader</b><p>I read this {}, and it made me write at some length.</p></div>"),
    ("<h2 class=comments>Replies</h2><ol class=commentlist>{}</ol>", "<li class='comment odd'><article class=comment-body><h3 class=commenter>Reader</h3><p>I read this {}.</p></article>"),
    ("<div class='comments-area'><h1>Thread</h1>{}</div>", "<article><p>I read this {}, all of it.</p></article>"),
    ("<div>{}</div>", "<p class=comment>I read this {}, and it made me write at some length.</p>"),
]


@pytest.mark.parametrize("around, each", COMMENTS)
@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize("story", ["<article>{}{}</article>", "<div class=story>{}{}</div>", "<main>{}{}</main>"])
def test_html_comments_never_count(around, each, inside, story):
    """However many there are, wherever they stand."""
    body = "<p>A story of one paragraph, long enough to be told and short enough for a test.</p>"
    for n in (2, 5, 9, 40, 400):
        thread = around.format("".join(each.format(i) for i in range(n)))
        page = f"<html><body>{story.format(body, thread if inside else '')}{'' if inside else thread}</body></html>"
        assert html_extraction.main_text(page, None) == body[3:-4], (n, page[:300])


def test_html_judges_each_element():
    text = lambda x: html_extraction.main_text(x, None)
    body = "<p>A sentence of the body that is long enough to count.</p>"
    many = lambda kept: text(f"<article>{body}{kept}</article>").count("\n")
    for kept in (
        "<p class=comment>One comment of the author, who wrote the story.</p>",
        "<div class=share><p>We share the results of our work with all who ask.</p></div>",
        "<div class=commentary><p>What this means.</p></div>",
        "<aside class=pull-quote>A sentence of the body</aside>",
        "<pre><code><span class=comment># a comment of the code</span> x = 1</code></pre>",
    ):
        assert many(kept) == 1, kept
    for gone in (
        "<div class=share>Tell your friends <a href=x>here</a></div>",
        "<div class=share><p>Send this story to all of your many friends.</p><input name=to></div>",
        "<aside>At the side</aside>",
        "<form><p>Your mail, and we write to you every week.</p><input name=mail><button>Go</button></form>",
        "<form><label>Name</label><input name=a><fieldset>Street<input name=b></fieldset></form>",
        "<div class='sponsored ad'><p>Buy these. They are the best of all that you can buy.</p></div>",
    ):
        assert many(gone) == 0, gone
    for n in (1, 9, 90):  # an advert is one at any length, and a page's wrapper is none
        assert text(f"<div class=story>{body}</div><div class=ad>{'<p>Buy this, and then buy it again, as often as you can.</p>' * n}</div>") == body[3:-4]
        assert text(f"<div class=modal><article>{body}</article></div><p>{'outside ' * n}</p>").startswith(body[3:-4])
    assert text(f"<form><input type=hidden><input name=q><article>{body}</article></form>") == body[3:-4]
    assert text(f"<form><input name=q><h1>Title</h1>{body}</form>") == f"Title\n{body[3:-4]}"
    assert text("<section id=comments><div class=comment>Only these</div></section>") == ""
    assert text(f"<form>{body}<input name=a><input name=b></form>") == body[3:-4]  # there is nothing else
    assert text("<div class=ads>" * 20_000 + body) == body[3:-4]


def test_html_host_path_and_own(spark):
    story = "<html><body><div class=list><p>teaser of the story</p></div><div class=story>{}</div></body></html>".format("<p>One of the many long sentences of the story itself.</p>" * 8)
    index = "<html><body><div class=list>{}</div></body></html>".format("<p>A teaser of some story {0} that is long.</p>" * 6)
    notes = "<html><body><div class=story><p>{0} text of its own that is long enough.</p><p>More of {0}.</p><div class=disclaimer>No advice, all rights with us</div></div></body></html>"
    rows = [(i, "https://a.example/x", index.format(i)) for i in range(6)] + [(6, "https://a.example/y", story)]
    rows += [(10 + i, "https://b.example/x", notes.format(f"page{i}")) for i in range(4)] + [(20 + i, "https://c.example/x", notes.format("same")) for i in range(4)]
    got = {r.page_id: r for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[6].path.endswith("div.list") and got[6].text.count("sentences") == 8  # the host's path holds the teaser only
    assert all("No advice" not in got[10 + i].text and got[10 + i].text.count("page") == 2 for i in range(4))
    assert all("No advice" in got[20 + i].text for i in range(4))  # repeated pages are one text


def test_html_deep_and_tied(spark):
    started = time.time()
    assert html_extraction.main_text("<div>x" * 100_000, None).count("x") == 100_000
    assert time.time() - started < 10
    deep = "<html><body>" + "<div>" * 3000 + "<article><p>The text at the bottom of it all.</p></article><div class=x><p>aside</p></div>"
    rows = [(i, "https://deep.example/", deep) for i in range(3)] + [(5, "https://tie.example/", "<main><p>One</p></main>"), (6, "https://tie.example/", "<article><p>Two</p></article>"), (6, "https://tie.example/", "<article><p>Two</p></article>"), (7, "https://tie.example/", "<main><p>One</p></main>")]
    got = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got if r.page_id < 5} == {"The text at the bottom of it all."}
    assert {(r.path, r.text) for r in got if r.page_id >= 5} == {("/article", "One"), ("/article", "Two")}


# --- 8 -------------------------------------------------------------------------------------


def test_host_rules_odd(spark, odd_docs, no_docs):
    got = host_rules.host_rules(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r.base_failed and not r.kept for r in got if r.n_words < 20)
    assert host_rules.host_rules(no_docs).count() == 0
    stats = host_rules.text_stats(["a b c d e f g h " * 3, "x\ny\nx\n\n\nx"])
    assert [c[0] for c in stats] == [24, 24, 0, 0, 24] and stats[3][1] == 2


def test_host_verdicts(spark):
    rows = [("bad", True)] * 90 + [("bad", False)] * 10 + [("good", False)] * 95 + [("good", True)] * 5 + [("tiny", True)] + [(None, False)]
    got = {r.host: r.host_kept for r in host_rules.host_verdicts(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert got["bad"] is False and got["good"] is True and got[None] is True


# --- 9 -------------------------------------------------------------------------------------


def brute_groups(rows):
    sets = {}
    for doc, text in rows:
        words = text.encode().split()
        sets[doc] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())
    root, links, at = {d: d for d in sets}, Counter(), defaultdict(list)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for other, n in Counter(o for g in s for o in at[g]).items():
            if n >= 0.8 * (len(s) + len(sets[other]) - n):
                links[d] += 1
                links[other] += 1
                a, b = sorted((find(d), find(other)))
                root[b] = a
        for g in s:
            at[g].append(d)
    return {d: (find(d), links[d]) for d in sets}


@pytest.mark.parametrize("block", [(jaccard_join.BLOCK_SHINGLES, jaccard_join.BLOCK_CLASSES), (300, 3)])
def test_jaccard(spark, sf, block):
    rng = np.random.default_rng(8)
    base = [f"v{i}" for i in rng.integers(0, 5000, 120)]
    more = [(10_000 + i, " ".join(w if rng.random() > 0.008 else "edit" for w in base)) for i in range(40)]
    docs = table(spark, sf, "documents").select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    want = brute_groups((r.doc_id, r.text or "") for r in docs.orderBy("doc_id").collect())
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.near_duplicates(docs, block=block).collect()}
    assert got == want


def test_jaccard_chains(spark):
    """Texts of which each shares half with the next are no group; the work is as long as the chain."""
    rng = np.random.default_rng(12)
    words = [f"c{i}" for i in range(40 * 3000)]
    rows = [(i, " ".join(words[20 * i : 20 * i + 80])) for i in range(3000)]  # each shares 60 of 80 words with the next one
    rows += [(5000 + i, " ".join(w if rng.random() > 0.01 else "edit" for w in words[:80])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == brute_groups(rows)
    signed = jaccard_join.signatures(docs, "doc_id", "text", *jaccard_join.choose_bands(0.8), 5).dropDuplicates(["digest"])
    per = jaccard_join.unit_members(signed, (1 << 30, 1 << 30)).select(F.explode("own.unit").alias("unit")).groupBy("unit").count()
    assert per.agg(F.sum(F.col("count") * F.col("count"))).first()[0] < 30 * len(rows)


def test_verify_leaves_pairs_to_lesser_units():
    sets = [np.arange(10), np.arange(10), np.arange(10)]
    units = [np.array([3, 7]), np.array([3, 7]), np.array([7])]
    links, label = jaccard_join.verify(sets, np.ones(3, int), np.zeros(3, int), True, 0.8, units, 7)
    assert links.tolist() == [1, 1, 2] and label.tolist() == [0, 0, 0]
    links, _ = jaccard_join.verify(sets[:2], np.ones(2, int), np.zeros(2, int), True, 0.8, units[:2], 7)
    assert links.tolist() == [0, 0]


def test_keep_one_few_tasks(spark, monkeypatch):
    """With many shuffle partitions the groups aren't written as a file for each, and what stays is one of each group, and texts without words."""
    from sluicework.operators import components

    word = lambda k: f"w{k * 7919 % 10007}"
    rows = [(k, " ".join(word(i) for i in range(40 * (k // 3), 40 * (k // 3) + 40)) + (f" e{k}" if k % 3 == 1 else "")) for k in range(30)] + [(90, " "), (91, " "), (None, "q q q q q q")]
    docs, files = spark.createDataFrame(rows, "doc_id long, text string"), {}
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: spark.conf.get(k) for k in conf}
    for module in (jaccard_join, components):
        plain = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, plain=plain: [out := plain(df, label), files.__setitem__(label, len(out.inputFiles()))][0])
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = {r.doc_id for r in jaccard_join.keep_one(docs).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {*range(0, 30, 3), 90, 91, None}
    assert [files[x] for x in ("classes", "least", "groups", "kept")] == [1, 1, 1, 1]


def test_keep_one_alike_rows(spark):
    rows = [(1, "five words of one text here", x) for x in "qps"] + [(2, "five words of one text here", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert [tuple(r) for n in (1, 3) for r in jaccard_join.keep_one(docs.repartition(n, "lang")).collect()] == [(1, rows[0][1], "p")] * 2


def test_jaccard_empty_blocks(spark):
    rows = []
    for group in range(25):
        words = [f"g{group}w{i}" for i in range(120)]
        rows += [(group * 10 + k, " ".join([*words, *(f"end{k}{i}" for i in range(k))])) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.near_duplicates(docs, block=(120, 1000)).collect()}
    assert got == brute_groups(rows)  # as many blocks as classes, so that some get none


def test_jaccard_alike_rows_go_to_units_once(spark, tmp_path, monkeypatch):
    """Many rows of no id and one text, and near copies of it: tasks that verify hold a few rows."""
    words = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(words))] * 20_000 + [(i, " ".join([*words[:-1], f"x{i}"])) for i in range(5)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(f"{tmp_path}/docs")
    seen = f"{tmp_path}/seen"
    plain = jaccard_join._verify_units

    def counted(threshold):
        run = plain(threshold)

        def outer(batches):
            yield from run(write(b) for b in batches)

        def write(batch):
            with open(seen, "a") as f:
                f.write(f"{len(batch)}\n")
            return batch

        return outer

    monkeypatch.setattr(jaccard_join, "_verify_units", counted)
    got = jaccard_join.near_duplicates(spark.read.parquet(f"{tmp_path}/docs")).collect()
    assert {r.class_id for r in got} == {None} and {r.n_links for r in got} == {20_004} and Counter(r.n_copies for r in got) == {20_000: 20_000, 1: 5}
    with open(seen) as f:
        assert sum(map(int, f)) < 1000


def test_jaccard_odd(spark, odd_docs, no_docs):
    got = jaccard_join.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count() and jaccard_join.near_duplicates(no_docs).count() == 0
    kept = jaccard_join.keep_one(odd_docs)
    rows = kept.collect()
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in rows) == Counter([1, None, None, 3, 4, 5, 6, 7, 8])


def test_bands():
    for threshold in (0.5, 0.8, 0.9):
        bands, rows = jaccard_join.choose_bands(threshold, 0.99)
        assert 1 - (1 - threshold**rows) ** bands >= 0.99
    with pytest.raises(ValueError):
        jaccard_join.choose_bands(0.05, 0.9999)


def test_word_hashes():
    words, counts = word_hashes(["a b  c".encode(), b"", "é\x0b\x85x a".encode()])
    assert counts.tolist() == [3, 0, 3] and words[0] == words[5] and len(set(words.tolist())) == 5
    grams, per = shingles(words, counts, 3)
    assert per.tolist() == [1, 0, 1] and len(grams) == 2 and grams[0] != grams[1]


# --- 10 ------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        more = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not more:
            return {s: 3.0 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= more


@pytest.mark.parametrize("group_rows", [mixing.GROUP_ROWS, 5])
def test_mixing(spark, sf, group_rows):
    docs = table(spark, sf, "documents")
    got = mixing.copies(docs.repartition(3), group_rows=group_rows).toPandas()
    again = mixing.copies(docs, group_rows=group_rows).toPandas()
    assert dict(zip(got.doc_id, got.copies)) == dict(zip(again.doc_id, again.copies))
    sizes = {d: len(t.encode().split()) for d, t, _ in documents(spark, sf)}
    assert dict(zip(got.doc_id, got["size"])) == sizes
    want = brute_targets(got.groupby("source")["size"].sum().to_dict())
    for source, rows in got.groupby("source"):
        assert abs(rows.target.iloc[0] - want[source]) < 1e-6
        assert abs((rows.copies * rows["size"]).sum() - want[source]) <= rows["size"].max() / 2 + 1
    assert got.copies.max() <= 3


def test_targets_capped(spark):
    sizes = {"a": 1, "b": 1000, "c": 10, None: 50, "e": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-9 for s in got)


def test_pivot_expectation():
    rng = np.random.default_rng(4)
    parts, sizes = np.full(6, 0.4), np.array([50, 40, 30, 20, 10, 10])
    runs = np.array([mixing.pivot(parts, sizes, rng.random(6))[0] for _ in range(3000)])
    assert np.abs(runs[:, :3].mean(axis=0) - 0.4).max() < 0.06


@pytest.mark.parametrize("sizes, part", [([1000] + [10] * 9, 0.3), ([60, 55, 50, 45, 40, 35], 0.4), ([7] * 8, 0.75), ([500, 400, 3, 2, 1, 1, 1], 0.5)])
def test_pivot_expectation_of_each(sizes, part):
    rng = np.random.default_rng(9)
    sizes = np.array(sizes)
    runs = [mixing.pivot(np.full(len(sizes), part), sizes, rng.random(len(sizes))) for _ in range(10_000)]
    out = np.array([r for r, _ in runs])
    assert np.abs(out.mean(axis=0) - part).max() < 0.02
    assert np.allclose(out @ sizes, part * sizes.sum())  # trades move words, and none is lost
    assert all(((row == 0) | (row == 1) | (np.arange(len(sizes)) == at)).all() for row, at in runs)


def test_mixing_keeps_odds(spark):
    rows = [(i, " ".join(["w"] * (1000 if i % 7 == 0 else 10)), "a" if i % 3 else "b") for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn = [mixing.copies(docs, seed=s, group_rows=64).toPandas() for s in range(12)]
    every = drawn[0].assign(mean=sum(d.set_index("doc_id").copies for d in drawn).reindex(drawn[0].doc_id).to_numpy() / 12)
    for (_, size), g in every.groupby(["source", "size"]):
        assert abs(g["mean"].mean() - (g.target / g.source_size).iloc[0]) < 0.06, size
    for d in drawn:
        got = d.assign(took=d.copies * d["size"]).groupby("source").agg(took=("took", "sum"), target=("target", "first"))
        assert ((got.took - got.target).abs() <= 500).all()


def test_mix_alike_rows(spark):
    rows = [(1, " ".join(["w"] * 50), "a", x) for x in "pqrs"] + [(2, "z " * 500, "b", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = [sorted(map(tuple, mixing.mix(docs.repartition(n, "lang")).collect())) for n in (1, 3)]
    assert got[0] == got[1] and got[0]


def test_mix_rows(spark, odd_docs, no_docs):
    got, drawn = mixing.mix(odd_docs), mixing.copies(odd_docs)
    assert got.columns == odd_docs.columns
    assert got.count() == drawn.agg(F.sum("copies")).first()[0]
    assert mixing.mix(no_docs).count() == 0 and mixing.copies(no_docs).count() == 0
