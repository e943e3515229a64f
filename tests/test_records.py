"""Delimited files cut into records by many tasks, against the csv module."""

import csv
import io
import random

import pytest

from foliograph.sources.delimited import read_records
from foliograph.sources.records import split_records

HEADER = "id,title,abstract,authors,categories,submitted,update_date,journal-ref,doi,comments"
NAMES = HEADER.split(",")


@pytest.fixture
def small_blocks(spark):
    """Scan tasks of two thousand bytes; a text of 7,000 spans several."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_rows(seed, n):
    rng = random.Random(seed)
    texts = ["plain", "", "two\nlines", 'a "quoted" word', "comma, here", "\n\n", '"', "é 漢", '""\n"', "x" * 40, "\n".join("line" * 9 for _ in range(30))]
    rows = [[str(i), *(rng.choice(texts) for _ in range(9))] for i in range(n)]
    rows[n // 2][3] = "one, \"long\"\n" * 500
    return rows


def written(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as out:
        maker = csv.writer(out, lineterminator=end, quoting=quoting)
        maker.writerow(NAMES)
        maker.writerows(rows)
    return str(path)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_read_by_many_tasks(spark, tmp_path, small_blocks, seed, end):
    rows = random_rows(seed, 40)
    path = written(tmp_path / "one.csv", rows, end)
    got = read_records(spark, path)
    assert got.rdd.getNumPartitions() > 8
    want = sorted(tuple(v or None for v in r) for r in rows)
    assert sorted(map(tuple, got.collect())) == want


def test_lines_and_files(spark, tmp_path, small_blocks):
    """Every record once, with the line it begins in."""
    rows = random_rows(9, 40)
    for name in ("a.csv", "b.csv", "empty.csv"):
        written(tmp_path / name, rows if name != "empty.csv" else [])
    found = split_records(spark, str(tmp_path)).collect()
    lines, at = {}, 0
    text = (tmp_path / "a.csv").read_text(encoding="utf-8")
    reader = csv.reader(io.StringIO(text, newline=""))
    for record in reader:
        lines[at + 1] = record
        at = reader.line_num
    for name, n in (("a.csv", 41), ("b.csv", 41), ("empty.csv", 1)):
        own = {r["line"]: r["text"] for r in found if r["file"].endswith(name)}
        assert len(own) == n
        if n > 1:
            assert {k: next(csv.reader(io.StringIO(v, newline=""))) for k, v in own.items()} == lines


def test_ragged_rows_are_an_error_or_go_to_the_rejects(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text(HEADER + '\n1,"a\nb",c,d,e,f,g,h,i,j\n2,too,few\n\n3,a,b,c,d,e,f,g,h,i,j,too,many\n4,b,c,d,e,f,g,h,i,j\n')
    with pytest.raises(Exception, match=r"line 4 of .*ragged.csv has not the fields"):
        read_records(spark, str(path)).filter("id <> '3'").collect()
    with pytest.raises(Exception, match="has not the fields"):
        read_records(spark, str(path)).collect()
    good = read_records(spark, str(path), rejects=str(tmp_path / "rejects"))
    assert sorted(r["id"] for r in good.collect()) == ["1", "4"]
    bad = sorted((r["line"], r["record"]) for r in spark.read.parquet(str(tmp_path / "rejects")).collect())
    assert bad == [(4, "2,too,few"), (6, "3,a,b,c,d,e,f,g,h,i,j,too,many")]
    # Ragged rows are as many tasks' affair as others.
    read_records(spark, str(path), rejects=str(tmp_path / "rejects")).count()
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2


def test_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n1,b,c,d,e,f,g,h,i,j\n")
    (tmp_path / "b.csv").write_text("﻿".join(["", HEADER]) + "\n")
    assert read_records(spark, str(tmp_path / "a.csv")).count() == 1
    assert read_records(spark, str(tmp_path / "b.csv")).count() == 0
    (tmp_path / "c.csv").write_text(HEADER.replace("id,title", "title,id") + "\nb,1,c,d,e,f,g,h,i,j\n")
    assert read_records(spark, str(tmp_path / "c.csv")).first()["id"] == "1"
    with pytest.raises(ValueError, match="the header of"):
        read_records(spark, f"{tmp_path}/[ac].csv")
    (tmp_path / "d.csv").write_text(HEADER + ",doi\n")
    with pytest.raises(ValueError, match="twice"):
        read_records(spark, str(tmp_path / "d.csv"))
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(ValueError, match="missing required"):
        read_records(spark, str(tmp_path / "e.csv"))


def test_an_open_quote_is_an_error(spark, tmp_path):
    (tmp_path / "open.csv").write_text(HEADER + '\n1,"b,c,d,e,f,g,h,i,j\n2,b,c,d,e,f,g,h,i,j\n')
    with pytest.raises(ValueError, match="never closed"):
        read_records(spark, str(tmp_path / "open.csv"))


def test_files_without_line_breaks_in_texts(spark, tmp_path, small_blocks):
    rows = [[str(i), *"bcdefghi", 'say ""x""' if i % 2 else "j, k"] for i in range(50)]
    path = written(tmp_path / "flat.csv", rows)
    for multi in (True, False):
        assert sorted(map(tuple, read_records(spark, path, multi_line=multi).collect())) == sorted(map(tuple, rows))
