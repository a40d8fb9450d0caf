"""Queries against their SQL, and the pipeline against its operators."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from sluicework.llm import decontamination, jaccard_join, mixing, quality_classifier
from sluicework.llm.common import materialize, table
from sluicework.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", SQL)
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages", "benchmark", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(SQL[name]).df()
    columns = sorted(want.columns)
    got = QUERIES[name](spark, sf).select(columns).toPandas()
    key = lambda df: sorted(map(repr, df[columns].astype(object).itertuples(index=False, name=None)))
    assert key(got) == key(want)


def test_host_rules_with_rejected_hosts(spark, tmp_path):
    """On the given tables no host is rejected; here one is, and its sound documents go with it."""
    sound = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, sound(i) if i % 10 == 0 else "too short", "en", "bad", 1) for i in range(300)] + [(1000 + i, sound(i) if i % 20 else "short", "en", f"h{i % 12}", 1) for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(SQL["op8_host_rules"]).df()
    columns = sorted(want.columns)
    got = QUERIES["op8_host_rules"](spark, str(tmp_path)).select(columns).toPandas()
    assert (~got.base_failed & ~got.kept).sum() == 30 and (got.kept & (got.doc_id >= 1000)).sum() == 570
    assert got.sort_values("doc_id").values.tolist() == want.sort_values("doc_id")[columns].values.tolist()


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    columns, ids = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf), "stage")
        assert docs.columns == columns
        ids.append((before, docs))
    sets = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    (a, b), (_, c), (_, d), (_, e) = ids
    bad = {r.doc_id for r in quality_classifier.scores(a, table(spark, sf, "labels")).where("predicted = 0").collect()}
    assert sets(b) == sets(a) - bad
    assert sets(c) == {r.class_id for r in jaccard_join.near_duplicates(b).collect()} and c.count() == len(sets(c))
    assert sets(d) == sets(c) - {r.doc_id for r in decontamination.leaks(c, table(spark, sf, "benchmark")).collect()}
    assert e.count() == sum(r.copies for r in mixing.copies(d).collect())
    assert corpus_pipeline.run(spark, sf).count() == e.count()


def test_pipeline_leaves_its_product(sf, tmp_path):
    """A second process reads it after the first has ended."""
    out = f"file://{tmp_path}/product"
    first = f"""
from pyspark.sql import SparkSession
import corpus_pipeline
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{tmp_path}/shared").getOrCreate()
print("ROWS", corpus_pipeline.run(spark, "{sf}", "{out}").count())
"""
    second = f"""
import zlib
import pyarrow.dataset as ds
from sluicework.llm.token_output import Reader
reader, rows = Reader("{out}/tokens"), ds.dataset("{tmp_path}/product/rows").to_table().to_pylist()
assert all(zlib.crc32(reader.get(r["doc_id"], r["copy"]).astype("<u4").tobytes()) == r["ids_crc32"] for r in rows)
print("ROWS", len(rows), reader.manifest["n_keys"])
"""
    said = [subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, cwd=str(Path(corpus_pipeline.__file__).parent)) for code in (first, second)]
    counts = [re.findall(r"ROWS (.*)", x.stdout)[0].split() for x in said]
    assert counts[1] == counts[0] * 2 and int(counts[0][0]) > 0, [x.stderr[-800:] for x in said]
    assert not any(p.is_file() for p in Path(tmp_path, "shared").rglob("*"))
