"""Registered queries against their SQL, and facts that hold at every scale."""

import pytest
from compare import difference, duck, type_difference
from pyspark.sql import functions as F

import __spark_entry__ as contract
from foliograph.checks.oracles import ORACLES
from foliograph.checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    got = [tuple(r) for r in df.collect()]
    assert got
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert slow not in plan
    if name in ORACLES:
        want = con.execute(ORACLES[name])
        columns = [d[0] for d in want.description]
        assert difference(df.columns, got, columns, want.fetchall()) is None
        assert type_difference(df, want.description) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["category", "total_papers", "published_count", "publish_rate_pct"]
    assert result.count() > 0


def test_paper_invariants(spark, sf):
    papers = QUERIES["papers_clean"](spark, sf).cache()
    assert papers.count() == papers.select("arxiv_id").distinct().count()
    for name in ("arxiv_id", "title", "abstract", "authors", "primary_category", "submitted"):
        assert papers.filter(F.col(name).isNull() | (F.col(name) == "")).isEmpty()
    assert papers.filter(~F.col("pub_status").isin("published", "unpublished")).isEmpty()
    papers.unpersist()


def test_partitioning_does_not_change_results(spark, sf):
    from foliograph.plans import adapter, clean

    raw = clean.raw_papers(adapter.paper_records(spark, sf))
    one = clean.clean_papers(raw.coalesce(1))
    many = clean.clean_papers(raw.repartition(7, F.rand(3)))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_ann_recall_is_reported(spark, sf):
    row = QUERIES["ann_recall"](spark, sf).first()
    assert row["expected"] == 80 and row["recall"] >= 0.95 and 0 < row["searched_share"] <= 1
