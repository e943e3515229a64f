"""Files and catalog tables."""

import json

import pytest
from pyspark.sql import functions as F

from foliograph.plans import adapter, clean
from foliograph.plans.ingest import ingest
from foliograph.sources import documents, tables
from foliograph.sources.delimited import NULL_TOKENS, read_records, validate_columns, write_records

HEADER = "id,title,abstract,authors,categories,submitted,update_date,journal-ref,doi,comments"
LINE = "Mon, 2 Apr 2007 19:18:42 GMT"


def csv(tmp_path, *lines, header=HEADER, name="in.csv"):
    path = tmp_path / name
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_quoted_multiline_and_identifiers(spark, tmp_path):
    path = csv(
        tmp_path,
        f'0704.0010,"A ""quoted"" title","line one\nline, two",A,cs.AI,"{LINE}",2008,,,é',
        f'0704.0020, padded ,"x",NA,cs.AI,"{LINE}",2008,nan,None,n/a',
    )
    one, two = read_records(spark, path).orderBy("id").collect()
    assert one["id"] == "0704.0010" and one["title"] == 'A "quoted" title'
    assert one["abstract"] == "line one\nline, two" and one["comments"] == "é"
    assert one["doi"] is None
    assert two["title"] == " padded " and two["authors"] is None
    assert (two["journal-ref"], two["doi"], two["comments"]) == (None, None, None)


def test_column_order_and_extra_columns(spark, tmp_path):
    path = csv(tmp_path, "c,1,extra,t,a,au,s,u,j,d", header="comments,id,more,title,abstract,authors,submitted,update_date,journal-ref,doi,categories".replace(",categories", ""))
    with pytest.raises(ValueError, match="categories"):
        read_records(spark, path)
    path = csv(tmp_path, "c,1,extra,t,a,au,s,u,j,d,k", name="b.csv",
               header="comments,id,more,title,abstract,authors,submitted,update_date,journal-ref,doi,categories")
    row = read_records(spark, path).first()
    assert (row["id"], row["categories"], row["comments"]) == ("1", "k", "c")


def test_all_missing_columns_are_listed(spark):
    with pytest.raises(ValueError, match=r"\['abstract', 'categories', 'journal-ref'\]"):
        validate_columns(spark.createDataFrame([(1,) * 7], "id int, title int, authors int, submitted int, update_date int, doi int, comments int"))


def test_records_survive_a_round_trip(spark, sf, tmp_path):
    records = adapter.paper_records(spark, sf)
    write_records(records, str(tmp_path / "out"))
    back = read_records(spark, str(tmp_path / "out"))
    want = records.select(*[
        F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in records.columns
    ])
    assert sorted(map(repr, back.collect())) == sorted(map(repr, want.select(*back.columns).collect()))


def test_json_keeps_nulls_and_text(spark, tmp_path):
    df = spark.createDataFrame([("é", None, [("a", 1.5)])], "t string, n string, s array<struct<k: string, d: double>>")
    documents.write_json(df, str(tmp_path / "j"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "j").glob("*.json"))
    assert "é" in text
    assert json.loads(text) == {"t": "é", "n": None, "s": [{"k": "a", "d": 1.5}]}


def test_questions(spark, tmp_path):
    items = [
        {"id": 1, "question": "q", "category_filter": None, "year_filter": "2020",
         "grading": {"type": "keyword_match", "must_contain_any": ["a", "b"], "min_keyword_hits": 2}},
        {"id": 2, "question": "r", "category_filter": "cs.AI", "year_filter": 2021},
    ]
    (tmp_path / "q.json").write_text(json.dumps(items, indent=2))
    (tmp_path / "q.jsonl").write_text("\n".join(map(json.dumps, items)))
    array, lines = (
        df.withColumn("id", F.col("id").cast("string")).orderBy("id").collect()
        for df in (
            documents.read_questions(spark, str(tmp_path / "q.json")),
            documents.read_questions(spark, str(tmp_path / "q.jsonl"), json_lines=True),
        )
    )
    assert array == lines
    assert array[0]["grading"]["must_contain_any"] == ["a", "b"]
    assert array[1]["year_filter"] == "2021" and array[1]["grading"] is None


def test_tables_from_a_snapshot(spark, tmp_path):
    for name in (tables.RAW_TABLE, *tables.CLEAN_TABLES):
        spark.sql(f"drop table if exists {name}")
    with pytest.raises(RuntimeError, match="raw_papers|papers"):
        tables.papers_table(spark)
    lines = [f'{i},T{i},some words here,"A, B",{c},"{LINE}",2008,J,,' for i, c in enumerate(["cs.AI", "cs.LG", "math.X"])]
    raw = ingest(spark, csv(tmp_path, *lines), json_path=str(tmp_path / "json"))
    assert {r["arxiv_id"] for r in raw.collect()} == {"0", "1"}  # the default categories
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    with pytest.raises(RuntimeError, match="author_stats"):
        tables.ensure_clean_tables(spark)
    tables.ensure_clean_tables(spark, rebuild=True)
    for name in tables.CLEAN_TABLES:
        assert spark.catalog.tableExists(name) and spark.table(name).count() > 0
    assert [r["author"] for r in spark.table("author_stats").collect()] == ["A", "B"]

    # full refresh: a new snapshot replaces everything
    ingest(spark, csv(tmp_path, *lines), categories=["math.X"])
    tables.build_clean_tables(spark)
    assert [r["arxiv_id"] for r in tables.papers_table(spark).collect()] == ["2"]
    assert [r["category"] for r in spark.table("category_stats").collect()] == ["math.X"]
    ingest(spark, csv(tmp_path, *lines), categories=["cs.AI", "cs.LG", "math.X"], sample_size=2)
    assert spark.table("raw_papers").count() == 2


def test_ordered_tables_are_sorted_within_and_across_files(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(5)
    tables.replace_table(df, "sorted_table", ("k",))
    ranges = []
    for path in spark.table("sorted_table").inputFiles():
        keys = [r["k"] for r in spark.read.parquet(path).collect()]
        assert keys == sorted(keys)
        ranges.append((keys[0], keys[-1]))
    ranges.sort()
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_cleaning_reads_only_what_it_needs(spark, sf):
    raw = clean.raw_papers(adapter.paper_records(spark, sf))
    plan = clean.clean_papers(raw)._jdf.queryExecution().executedPlan().toString()
    assert "n_chars" not in plan.split("ReadSchema")[-1]
