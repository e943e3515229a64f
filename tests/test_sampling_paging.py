"""Exact samples and pages."""

import collections

import pytest
from pyspark.sql import functions as F

from foliograph.operators.sampling import sample_key, sample_rows
from foliograph.plans.listing import list_papers, list_papers_after, with_page_count


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(500).select("id", F.concat(F.lit("t"), F.col("id") % 7).alias("t"))


@pytest.mark.parametrize("n, size", [(1, 0), (3, 2), (5, 2), (7, 4)])
def test_half_rounds_to_even(spark, n, size):
    assert sample_rows(spark.range(n), frac=0.5).count() == size


def test_size_is_exact_and_capped(table):
    got = rows(sample_rows(table, size=123))
    assert len(got) == len(set(got)) == 123 and set(got) <= set(rows(table))
    assert rows(sample_rows(table, size=10_000)) == rows(table)
    assert rows(sample_rows(table, frac=1.0)) == rows(table)
    assert rows(sample_rows(table)) == rows(table)


def test_same_seed_same_rows(table):
    first = rows(sample_rows(table, size=50, seed=1))
    assert first == rows(sample_rows(table.repartition(9), size=50, seed=1))
    assert first != rows(sample_rows(table, size=50, seed=2))


@pytest.mark.parametrize("n", [1, 60, 250, 499, 500, 600])
def test_rows_of_the_smallest_keys(table, n):
    want = table.orderBy(sample_key(table, 42)).limit(n)
    assert rows(sample_rows(table, size=n)) == rows(want)


def test_copies_are_taken_as_often_as_they_exist(spark):
    copies = spark.range(400).select(F.lit("same").alias("t"), F.lit(None).cast("int").alias("v"))
    mixed = copies.unionByName(spark.range(200).select(F.concat(F.lit("r"), "id").alias("t"), F.lit(1).alias("v")))
    for n in (1, 150, 300, 450, 600):
        got = collections.Counter(map(tuple, sample_rows(mixed, size=n).collect()))
        assert sum(got.values()) == n and got[("same", None)] <= 400
        assert all(v == 1 for k, v in got.items() if k[0] != "same")


def test_different_rows_never_share_a_key(spark):
    rows_ = [("a|b", "c")] * 10 + [("a", "b|c")] * 10
    df = spark.createDataFrame(rows_, "x string, y string")
    for n in range(1, 21):
        got = collections.Counter(map(tuple, sample_rows(df, size=n).collect()))
        assert sum(got.values()) == n and max(got.values()) <= 10


@pytest.mark.parametrize(
    "options", [{"size": 1, "frac": 0.5}, {"frac": 0}, {"frac": 1.5}, {"size": 0}, {"size": -1}]
)
def test_sample_bounds(table, options):
    with pytest.raises(ValueError):
        sample_rows(table, **options)


@pytest.fixture(scope="module")
def papers(spark):
    return spark.range(300).select(
        F.concat(F.lit("p"), F.col("id")).alias("arxiv_id"),
        F.lit("T").alias("title"), F.lit("c").alias("primary_category"),
        (F.lit(2000) + F.col("id") % 5).alias("submitted_year"),
        F.when(F.col("id") % 2 == 0, "published").otherwise("unpublished").alias("pub_status"),
        F.lit("A").alias("first_author"),
    ).repartition(6).cache()


@pytest.mark.parametrize("limit, offset", [(20, 0), (7, 55), (200, 150), (1, 299), (10, 300), (200, 1000)])
def test_pages_both_ways(papers, limit, offset):
    everything = sorted(
        (-r["submitted_year"], r["arxiv_id"]) for r in papers.collect()
    )[offset : offset + limit]
    for bound in (100_000, 40, 3, 0):
        listed = list_papers(papers, limit, offset, top_k_rows=bound)
        assert [(-r["year"], r["arxiv_id"]) for r in listed.collect()] == everything
        plan = listed._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan  # a top-k, never a sort of all rows


def test_deep_pages_with_odd_keys(spark):
    """Missing years, ids that are prefixes of others, other scripts, copies of one id, and an empty listing."""
    ids = ["", "a", "ab", "abc", "abcd", "abd", "b", "é", "漢字", "z" * 9] + [f"x{i}" for i in range(40)] + ["same"] * 30
    rows = [(i, "T", "c", y, "published", "A") for y in (2001, 2000, -5, None) for i in ids]
    df = spark.createDataFrame(rows, "arxiv_id string, title string, primary_category string, submitted_year bigint, pub_status string, first_author string").repartition(5)
    want = sorted(((y is None, -(y or 0), i) for i, _, _, y, _, _ in rows), key=lambda k: (k[0], k[1], k[2].encode()))
    for offset in (0, 1, 10, 70, 79, 80, 100, 159, 170, 241, 300, 319, 320, 500):
        for bound in (0, 12):
            got = list_papers(df, 25, offset, top_k_rows=bound).collect()
            assert [(r["year"] is None, -(r["year"] or 0), r["arxiv_id"]) for r in got] == want[offset : offset + 25]
    assert list_papers(df.limit(0), 5, 7, top_k_rows=0).count() == 0


def test_page_count_and_labels(papers):
    page = with_page_count(list_papers(papers, 3, 0)).collect()
    assert [r["item_count"] for r in page] == [3, 3, 3]
    assert {r["pub_status"] for r in page} <= {"Published", "Preprint"}


@pytest.mark.parametrize("limit, offset", [(0, 0), (201, 0), (1, -1)])
def test_page_bounds(papers, limit, offset):
    with pytest.raises(ValueError):
        list_papers(papers, limit, offset)


@pytest.mark.parametrize("limit", [1, 3, 200])
def test_pages_after_a_key_follow_each_other(papers, limit):
    papers = papers.unionByName(papers.limit(1).withColumns({"arxiv_id": F.lit("zz"), "submitted_year": F.lit(None)}))
    want = [tuple(r) for at in (0, 200) for r in list_papers(papers, 200, at).collect()]
    got = [tuple(r) for r in list_papers(papers, limit).collect()]
    for _ in range(3):
        got += [tuple(r) for r in list_papers_after(papers, got[-1][3], got[-1][0], limit).collect()]
    assert got == want[: len(got)] and len(got) == min(len(want), 4 * limit)


def test_page_after_bounds(papers):
    with pytest.raises(ValueError):
        list_papers_after(papers, 2010, "a", 201)
