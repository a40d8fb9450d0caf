"""Text files inside archives against the same files outside."""

import io
import tracemalloc
import zipfile

import pytest

from sluicework.sources import archives


@pytest.fixture()
def folder(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("x/one.csv", "﻿id,name,at\r\n1,\"a, b\",2024-01-02\r\n\r\n2,é,\r\nzz,c,no\r\n")
        z.writestr("x/", "")
        z.writestr("readme.txt", "id\n9,not this,\n")
        z.writestr("empty.csv", "")
    with zipfile.ZipFile(tmp_path / "b.ZIP", "w") as z:
        z.writestr("two.csv", "id,name,at\n3,last line without an end,2024-01-03")
    (tmp_path / "c.txt").write_text("no archive")
    return f"file://{tmp_path}"


def test_zip_csv(spark, folder):
    got = archives.read_zip_csv(spark, folder, "id int, name string, at date")
    rows = sorted((r.member, r.number, r.id, r.name, str(r.at)) for r in got.collect())
    assert rows == [("two.csv", 1, 3, "last line without an end", "2024-01-03"), ("x/one.csv", 1, 1, "a, b", "2024-01-02"), ("x/one.csv", 3, 2, "é", "None"), ("x/one.csv", 4, None, "c", "None")]
    one = archives.read_zip_csv(spark, f"{folder}/a.zip", "id int, name string, at date", members="none")
    assert one.count() == 0


def test_zip_plans_a_task_for_each_member(spark, folder):
    reader = archives.ZipLinesReader({"path": folder, "members": r".*\.csv"})
    assert [(m.archive.rsplit("/", 1)[1], m.name) for m in reader.partitions()] == [("a.zip", "x/one.csv"), ("a.zip", "empty.csv"), ("b.ZIP", "two.csv")]
    with pytest.raises(zipfile.BadZipFile):
        archives.ZipLinesReader({"path": f"{folder}/c.txt"}).partitions()


def test_zip_equals_plain_files(spark, sf, tmp_path):
    """A table as text in many members, read back: the rows of the plain files."""
    spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").write.csv(f"{tmp_path}/plain", header=True)
    with zipfile.ZipFile(tmp_path / "all.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for i, part in enumerate(sorted((tmp_path / "plain").glob("part-*"))):
            z.writestr(f"part{i}.csv", part.read_bytes() * (3 if i else 1))
    schema = "l_orderkey long, l_linenumber int, l_quantity double, l_returnflag string"
    got = archives.read_zip_csv(spark, f"file://{tmp_path}/all.zip", schema, members="part0.csv").drop("archive", "member", "number")
    want = spark.read.schema(schema).csv(str(sorted((tmp_path / "plain").glob("part-*"))[0]), header=True)
    assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count() and got.count() > 0


def test_members_are_inflated_piece_by_piece(tmp_path):
    """A member of 200 MB in an archive of less than one, read with a few MB."""
    path = tmp_path / "big.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z, z.open("big.csv", "w") as f:
        for _ in range(200):
            f.write(b"a line of the member, which is as long as lines are\n" * 20_000)
    reader = archives.ZipLinesReader({"path": f"file://{path}"})
    tracemalloc.start()
    n = sum(b.num_rows for b in reader.read(reader.partitions()[0]))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 4_000_000 and path.stat().st_size < 1 << 20 and most < 16 << 20


def test_lines():
    read = lambda b, e="utf-8": list(archives.lines(io.BytesIO(b), e, 4))
    assert read(b"") == [] and read(b"\n\n") == ["", ""] and read(b"a\rb\r\nc") == ["a\rb", "c"]
    assert read("éü日本\n".encode()) == ["éü日本"] and read(b"\xff\n") == ["�"] and read(b"\xe9", "latin-1") == ["é"]
