"""Retrieval, filters, answers, sources and grades on small indexes."""

import pytest
from pyspark.sql import functions as F

from foliograph.plans import index, qa, retrieval
from foliograph.plans.embed import embed

QUESTION = "id int, question string, category_filter string, year_filter string"
HIT = (
    "array<struct<rank: int, chunk_id: string, chunk_text: string, arxiv_id: string, title: string, "
    "category: string, year: bigint, pub_status: string, first_author: string, distance: double>>"
)


def hit(rank, arxiv_id="a", category="c", year=2000, title="T", text="x"):
    return (rank, f"{arxiv_id}:{rank}", text, arxiv_id, title, category, year, "Preprint", "A", 0.1 * rank)


def found(spark, hits, category=None, year=None):
    row = (1, "q", category, year, hits, None)
    return spark.createDataFrame([row], f"{QUESTION}, hits {HIT}, error string")


def kept(spark, hits, category=None, year=None):
    row = qa.with_filtered_hits(found(spark, hits, category, year)).first()
    return [h["rank"] for h in row["kept"]]


@pytest.fixture(scope="module")
def chunks(spark):
    rows = [
        (str(i), f"Title {i}", text, cat, str(2000 + i), "published", "A")
        for i, (text, cat) in enumerate(
            [("red apple pie", "cs.AI"), ("green apple tart", "cs.LG"), ("blue sky", "cs.AI"), ("red sky", "q")]
        )
    ]
    papers = spark.createDataFrame(
        rows,
        "arxiv_id string, title string, abstract string, primary_category string, submitted_year string, "
        "pub_status string, first_author string",
    )
    return index.embedded_chunks(papers).cache()


def test_query_text(spark):
    rows = [
        (1, " q ", "cs.AI", None), (2, "q", "", "2020"), (3, "q", None, "n/a"), (4, None, None, None),
    ]
    got = qa.with_query_text(spark.createDataFrame(rows, QUESTION)).orderBy("id").collect()
    assert [r["query_text"] for r in got] == ["q category cs.AI", "q year 2020", "q year n/a", ""]


def test_filters(spark):
    hits = [hit(1), hit(2, category=" d "), hit(3, category="d", year=2001), hit(4, category="")]
    assert kept(spark, hits) == [1, 2, 3, 4]
    assert kept(spark, hits, category=" d") == [2, 3]
    assert kept(spark, hits, category="d", year=" 2001 ") == [3]
    assert kept(spark, hits, category="none") == [1, 2, 3, 4]  # nothing passes: all are used
    assert kept(spark, hits, year="n/a") == [1, 2, 3, 4]
    assert kept(spark, hits, category="") == [1, 2, 3, 4]
    assert kept(spark, hits, category="  ") == [4]
    assert kept(spark, [], category="d") == []


def test_sources_take_the_first_hit_of_each_paper(spark):
    hits = [hit(1), hit(2), hit(3, "b"), hit(4, " "), hit(5, " b "), *[hit(i, f"p{i}") for i in range(6, 12)]]
    row = qa.with_filtered_hits(found(spark, hits)).select(qa.sources("kept").alias("s")).first()
    assert [s["arxiv_id"] for s in row["s"]] == ["a", "b", "p6", "p7", "p8"]
    assert row["s"][1]["distance"] == pytest.approx(0.3)


def test_answer_text(spark):
    hits = [hit(i, title=f" t{i} ", text="word\nnext") for i in range(1, 5)]
    df = qa.with_filtered_hits(found(spark, hits)).select(qa.answer_text("kept").alias("a"))
    assert df.first()["a"] == "t1: word next t2: word next t3: word next"
    none = qa.with_filtered_hits(found(spark, [])).select(qa.answer_text("kept").alias("a"))
    assert none.first()["a"] == qa.NO_EVIDENCE


def test_retrieve(spark, chunks):
    asked = spark.createDataFrame(
        [("x", "red apple"), ("y", "  "), ("z", None), ("w", "red apple")], "who string, query_text string"
    )
    rows = retrieval.retrieve(asked, chunks, 2).orderBy("who", "rank").collect()
    assert [(r["who"], r["rank"], r["arxiv_id"]) for r in rows] == [
        ("w", 1, "0"), ("w", 2, "3"), ("x", 1, "0"), ("x", 2, "3"),
    ]
    assert rows[0]["distance"] == pytest.approx(1 - 2 / 6**0.5)
    # short of k: the rest follows by id at distance one
    full = retrieval.retrieve(asked.limit(1), chunks, 50).orderBy("rank").collect()
    assert len(full) == 4 and full[-1]["distance"] == 1.0
    assert retrieval.retrieve(asked.limit(1), chunks, 0).count() == 4  # default of five
    assert retrieval.retrive is retrieval.retrieve


def test_request_bounds():
    assert retrieval.checked_top_k(50) == 50
    for bad in (0, 51):
        with pytest.raises(ValueError):
            retrieval.checked_top_k(bad)


def test_answers_keep_every_question(spark, chunks):
    rows = [(1, "red apple", "cs.LG", None), (2, "", None, None), (3, "sky", None, "2002"), (1, "red apple", "cs.LG", None)]
    got = qa.answer_questions(spark.createDataFrame(rows, QUESTION), chunks, model="m").orderBy("question_id").collect()
    assert [r["question_id"] for r in got] == [1, 1, 2, 3]
    assert got[0] == got[1] and got[0]["answer"] == "Title 1: green apple tart"
    assert got[2]["answer"] == qa.NO_EVIDENCE and got[2]["sources"] == []
    assert [s["arxiv_id"] for s in got[3]["sources"]] == ["2"]
    assert got[0]["model_used"] == "m" and got[3]["year_filter"] == "2002"


def test_failed_question_becomes_an_answer(spark, chunks):
    def fake_model():
        def run(texts):
            if any("fail" in t for t in texts):
                raise ConnectionError("down")
            return [
                {"index": i, "embedding": [float("red" in t), float("apple" in t), float("sky" in t), 0.1]}
                for i, t in reversed(list(enumerate(texts)))
            ]

        return run

    external = embed(
        chunks.drop("embedding"), "chunk_text", "external", factory=fake_model, normalize=True
    ).drop("error").cache()
    rows = [(1, "red apple", None, None), (2, "please fail", None, None), (3, "sky", None, None)]
    got = qa.answer_questions(
        spark.createDataFrame(rows, QUESTION), external, k=1, backend="external",
        factory=fake_model, normalize=True, attempts=2, backoff=0.0,
    ).orderBy("question_id").collect()
    assert got[0]["answer"].startswith("Title 0:") and got[2]["answer"].startswith("Title 2:")
    assert got[1]["answer"].startswith("Query failed: ") and "down" in got[1]["answer"]
    assert got[1]["sources"] == []


def test_grading(spark):
    rows = [
        (1, "A BERT encoder", (["bert", "Encoder", "topic"], 2)),
        (2, "A BERT encoder", (["bert", "topic"], 2)),
        (3, "nothing", ([], 0)),
    ]
    df = spark.createDataFrame(
        rows, "question_id int, answer string, grading struct<must_contain_any: array<string>, min_keyword_hits: int>"
    )
    got = qa.grade_answers(df).orderBy("question_id").collect()
    assert [(r["keyword_hits"], r["passed"]) for r in got] == [(2, True), (1, False), (0, True)]


def test_source_rows(spark, chunks):
    rows = [(7, "red apple", None, None)]
    listed = qa.source_rows(qa.answer_questions(spark.createDataFrame(rows, QUESTION), chunks)).collect()
    assert [r["position"] for r in listed] == [1, 2, 3, 4]
    assert listed[0]["arxiv_id"] == "0" and listed[0]["pub_status"] == "Published"


def test_metadata_defaults(spark, chunks):
    bare = chunks.withColumns({
        "title": F.lit(None).cast("string"), "year": F.lit(None).cast("bigint"),
        "pub_status": F.lit(None).cast("string"),
        "arxiv_id": F.when(F.col("arxiv_id") != "3", F.col("arxiv_id")),
    })
    asked = spark.createDataFrame([("red",)], "query_text string")
    rows = retrieval.retrieve(asked, bare, 2).collect()
    # the hit without metadata is dropped after ranking
    assert [(r["arxiv_id"], r["title"], r["year"], r["pub_status"]) for r in rows] == [("0", "", 0, "Preprint")]
