"""Chart frames against pandas and numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliograph.operators.histogram import density_histogram
from foliograph.plans import summaries


def counted(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double")
    return df.groupBy("g", "v").agg(F.count("*").alias("n"))


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(11)
    groups = {f"g{i}": rng.integers(0, 7 + 41 * i, size=200) for i in range(8)}
    groups["edges"] = np.arange(0, 301)  # values on bin edges
    groups["third"] = np.array([1, 2, 4, 7, 11, 61])
    groups["one"] = np.array([5, 5, 5])
    got = {}
    for r in density_histogram(counted(spark, groups), "g", "v", "n", 30).orderBy("g", "bin").collect():
        got.setdefault(r["g"], []).append(r)
    for name, values in groups.items():
        density, edges = np.histogram(values, bins=30, density=True)
        count, _ = np.histogram(values, bins=30)
        assert [r["row_count"] for r in got[name]] == count.tolist()
        assert np.allclose([r["density"] for r in got[name]], density)
        assert np.allclose([r["left_edge"] for r in got[name]], edges[:-1])
        assert np.allclose([r["right_edge"] for r in got[name]], edges[1:])


def test_degenerate_range(spark):
    rows = density_histogram(counted(spark, {"g": [5, 5, 5]}), "g", "v", "n", 3).orderBy("bin").collect()
    assert [round(r["density"], 9) for r in rows] == [0, 3, 0]
    assert (rows[0]["left_edge"], rows[-1]["right_edge"]) == (4.5, 5.5)
    with pytest.raises(ValueError):
        density_histogram(counted(spark, {"g": [1]}), "g", "v", "n", 0)


@pytest.fixture(scope="module")
def prepared(spark):
    rows = []
    for i, (category, count) in enumerate({"a": 5, "b": 4, "c": 3, "d": 2, "f": 1, "e": 1, "g": 1}.items()):
        for j in range(count):
            rows.append((category, "published" if j % 2 else "unpublished", str(2000 + i + 3 * j), str(j)))
    rows += [(None, "published", "2000", "1"), ("a", "published", "x", "1"), ("a", None, "2000", "1")]
    df = spark.createDataFrame(
        rows, "primary_category string, pub_status string, submitted_year string, abstract_word_count string"
    )
    return summaries.prepare_papers(df).cache()


def test_preparation_drops_incomplete_rows(prepared):
    assert prepared.count() == 17
    assert dict(prepared.dtypes)["submitted_year"] == "bigint"


def test_boundary_tie_goes_to_the_first_name(prepared):
    got = [(r["category"], r["paper_count"]) for r in summaries.largest_categories(prepared).collect()]
    assert got == [("a", 5), ("b", 4), ("c", 3), ("d", 2), ("e", 1)]


def test_pivot(prepared):
    got = [tuple(r) for r in summaries.category_pivot(prepared).collect()]
    assert got[0] == ("a", 2, 3, 5, 2) and [r[0] for r in got] == ["a", "b", "c", "d", "e", "f", "g"]


def test_trend_is_dense_and_complete(prepared):
    rows = summaries.year_trend(prepared).collect()
    years = {r["year"] for r in rows}
    assert len(rows) == 6 * len(years) and sum(r["paper_count"] for r in rows) == 17
    other = {r["year"]: r["paper_count"] for r in rows if r["category_group"] == "Other"}
    assert sum(other.values()) == 2 and 0 in other.values()


def test_status_share(prepared):
    got = {r["pub_status"]: tuple(r)[1:] for r in summaries.status_share(prepared).collect()}
    assert got == {"published": ("Published", 6, 35.3), "unpublished": ("Unpublished", 11, 64.7)}
    empty = summaries.status_share(prepared.limit(0)).collect()
    assert [(r["paper_count"], r["share_pct"]) for r in empty] == [(0, None), (0, None)]


def test_length_histogram_has_all_groups(prepared):
    rows = summaries.length_histogram(prepared, bins=4).collect()
    assert {r["category_group"] for r in rows} == {"a", "b", "c", "d", "e", "Other"}
    assert sum(r["row_count"] for r in rows) == 17 and len(rows) == 24
