"""Hand-worked records through cleaning and statistics."""

import pytest
from pyspark.sql import Window, functions as F

from foliograph.plans import clean, stats

GOOD = {
    "id": "1", "title": "T", "abstract": "one two", "authors": "A B", "categories": "cs.AI",
    "submitted": "Mon, 2 Apr 2007 19:18:42 GMT", "update_date": "2008-01-01",
    "journal-ref": None, "doi": None, "comments": None,
}
SCHEMA = ", ".join(f"`{c}` string" for c in clean.RAW_COLUMNS)


def records(spark, *changes):
    rows = [tuple({**GOOD, "id": str(i), **c}[k] for k in clean.RAW_COLUMNS) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, SCHEMA)


def papers(spark, *changes):
    rows = clean.clean_papers(clean.raw_papers(records(spark, *changes))).collect()
    return {r["arxiv_id"]: r for r in rows}


@pytest.mark.parametrize(
    "submitted, year",
    [
        ("Mon, 2 Apr 2007 19:18:42 GMT", 2007),
        ("Mon,  2  Apr  2007 x", 2007),
        ("2007-04-02", None),
        ("Mon, 2 Apr", None),
        ("a b", None),
        ("Mon, 2 Apr 2007x z", 2007),
        ("a b c d", 0),
    ],
)
def test_year(spark, submitted, year):
    got = papers(spark, {"submitted": submitted})
    assert (got["0"]["submitted_year"] if got else None) == year


def test_authors(spark):
    got = papers(
        spark, {"authors": " , "}, {"authors": ", A B"}, {"authors": "A, A"}, {"authors": "A and B"}
    )
    assert "0" not in got
    assert (got["1"]["first_author"], got["1"]["author_count"]) == ("", 1)
    assert (got["2"]["first_author"], got["2"]["author_count"]) == ("A", 2)
    assert got["3"]["author_count"] == 1


def test_blank_fields_and_trimming(spark):
    got = papers(
        spark,
        {"title": " "}, {"abstract": None}, {"categories": ""}, {"submitted": "  "},
        {"id": "  "}, {"id": None}, {"id": " 7 ", "abstract": "\t"},
    )
    assert set(got) == {"7"}
    assert got["7"]["abstract_word_count"] == 0


def test_area_and_status(spark):
    got = papers(
        spark,
        {"categories": "math", "journal-ref": " "},
        {"categories": ".x", "journal-ref": None},
        {"categories": "cs.AI stat.ML", "journal-ref": "J"},
    )
    assert [got[i]["subject_area"] for i in "012"] == ["math", "", "cs"]
    assert [got[i]["pub_status"] for i in "012"] == ["unpublished", "unpublished", "published"]
    assert got["2"]["primary_category"] == "cs.AI"


def test_incomplete_copy_never_shadows(spark):
    got = papers(
        spark,
        {"id": "x", "title": " ", "submitted": "Wed, 9 Apr 2009 0 GMT"},
        {"id": "x", "title": "kept"},
    )
    assert got["x"]["title"] == "kept"


def test_dates_compare_as_text(spark):
    got = papers(
        spark,
        {"id": "x", "submitted": "Wed, 3 Jan 2001 0 GMT"},
        {"id": "x", "submitted": "Mon, 1 Jan 2020 0 GMT"},
    )
    assert got["x"]["submitted_year"] == 2001


def test_winner_without_year_takes_the_id_with_it(spark):
    assert not papers(
        spark,
        {"id": "x", "submitted": "Zzz"},
        {"id": "x", "submitted": "Mon, 1 Jan 2020 0 GMT"},
    )


def test_ties_are_settled_by_the_other_columns(spark):
    copies = [{"id": "x", "abstract": f"text {i % 9}"} for i in range(40)]
    for order in (copies, copies[::-1]):
        assert papers(spark, *order)["x"]["abstract"] == "text 0"


def test_many_copies_of_one_id_shuffle_one_row_per_task(spark, tmp_path):
    raw = clean.raw_papers(records(spark, *[{"id": "hot"}] * 300, {"id": "cold"})).repartition(3)
    plan = clean.deduplicated(raw)._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange hashpartitioning(arxiv_id") < partial
    assert clean.clean_papers(raw).count() == 2


def test_category_filter(spark):
    df = records(
        spark, {"categories": "cs.AI stat.ML"}, {"categories": None}, {"categories": " "},
        {"categories": "cs.AIx"}, {"categories": "q\tstat.ML"},
    )
    assert [r["id"] for r in clean.filter_categories(df, ["stat.ML"]).orderBy("id").collect()] == ["0", "4"]
    assert clean.filter_categories(df, []).count() == 5
    assert [r["id"] for r in clean.filter_categories(df).orderBy("id").collect()] == ["0", "4"]
    raw = clean.raw_papers(df).orderBy("arxiv_id").collect()
    assert [r["primary_category"] for r in raw] == ["cs.AI", None, None, "cs.AIx", "q"]


def test_row_local_counts_equal_joined_counts(spark, sf):
    from foliograph.plans import adapter

    unique = clean.deduplicated(clean.raw_papers(adapter.paper_records(spark, sf)))
    names = (
        unique.select("arxiv_id", F.explode(F.split("authors", ",")).alias("n"))
        .filter(F.trim("n") != "").groupBy("arxiv_id").agg(F.count("*").cast("int").alias("author_count"))
    )
    words = (
        unique.select("arxiv_id", F.explode(F.split(F.translate("abstract", "\r\n\t", "   "), " ")).alias("w"))
        .filter("w <> ''").groupBy("arxiv_id").agg(F.count("*").cast("int").alias("abstract_word_count"))
    )
    years = clean.with_submitted_year(unique).select("arxiv_id", "submitted_year")
    joined = unique.select("arxiv_id").join(names, "arxiv_id").join(words, "arxiv_id").join(years, "arxiv_id")
    direct = clean.clean_papers(clean.raw_papers(adapter.paper_records(spark, sf))).select(*joined.columns)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, direct.collect()))


def test_statistics(spark):
    rows = clean.clean_papers(clean.raw_papers(records(
        spark,
        {"authors": "A, A", "categories": "b", "journal-ref": "J"},
        {"authors": "A", "categories": "a", "submitted": "x x x 1999"},
        {"authors": "A, B", "categories": "a"},
        {"authors": "B", "categories": "b"},
    )))
    by_author = {r["author"]: tuple(r)[1:] for r in stats.author_stats(rows).collect()}
    # twice on one paper counts twice; equal counts go to the first name
    assert by_author == {"A": (4, 1999, 2007, "a"), "B": (2, 2007, 2007, "a")}
    by_category = {r["category"]: tuple(r)[1:] for r in stats.category_stats(rows).collect()}
    assert by_category == {"a": (2, 0, 0.0), "b": (2, 1, 50.0)}


def test_rate_is_a_double_with_two_places(spark):
    rows = clean.clean_papers(clean.raw_papers(records(spark, {"journal-ref": "J"}, {}, {})))
    result = stats.category_stats(rows)
    assert result.schema["publish_rate_pct"].dataType.typeName() == "double"
    assert result.first()["publish_rate_pct"] == 33.33


def test_author_stats_equal_the_windowed_form(spark, sf):
    from foliograph.plans import adapter

    rows = clean.clean_papers(clean.raw_papers(adapter.paper_records(spark, sf)))
    names = stats.paper_authors(rows)
    best = Window.partitionBy("author").orderBy(F.desc("n"), "primary_category")
    tops = (
        names.groupBy("author", "primary_category").agg(F.count("*").alias("n"))
        .withColumn("rn", F.row_number().over(best)).filter("rn = 1")
        .select("author", F.col("primary_category").alias("top_category"))
    )
    totals = names.groupBy("author").agg(
        F.count("*"), F.min("submitted_year"), F.max("submitted_year")
    )
    want = totals.join(tops, "author")
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, stats.author_stats(rows).collect()))


def test_statistics_shuffle_no_abstract(spark, sf):
    from foliograph.checks.queries import QUERIES

    def above_deduplication(name):
        """Plans print top down: what comes after the last exchange is below it."""
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        return plan[: plan.rindex("Exchange hashpartitioning(arxiv_id")]

    assert "abstract#" not in above_deduplication("category_stats")
    assert "abstract#" in above_deduplication("papers_clean")


def test_papers_without_abstracts_are_the_same(spark):
    raw = clean.raw_papers(records(
        spark, {"id": "x", "abstract": "b"}, {"id": "x", "abstract": "a b"}, {"id": "x", "title": "S"},
        {"id": "y", "abstract": " "}, {"id": "z", "abstract": None}, {"id": "w"}, {"id": "w"},
    ))
    narrow = clean.clean_papers(raw, abstracts=False)
    whole = clean.clean_papers(raw).select(narrow.columns)
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, whole.collect()))
    assert "abstract" not in narrow.columns and narrow.count() == 2
