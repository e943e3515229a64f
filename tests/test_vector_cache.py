"""The vector cache: every text is sent once, by content."""

import collections
import json
import uuid

import pytest
from pyspark.sql import functions as F

from foliograph.operators.vector_cache import VectorCache
from foliograph.plans.embed import embed


def counting(folder, refused=()):
    """A model that notes each text it is sent and how many came together."""

    def factory():
        def model(texts):
            (folder / uuid.uuid4().hex).write_text(json.dumps(texts))
            if any(t in refused for t in texts):
                raise ValueError("refused")
            return [{"index": i, "embedding": [float(len(t)), 1.0]} for i, t in enumerate(texts)]

        return model

    return factory


def sent(folder):
    return [json.loads(p.read_text()) for p in folder.iterdir()]


@pytest.fixture
def folder(tmp_path):
    made = tmp_path / "sent"
    made.mkdir()
    return made


@pytest.mark.parametrize("bound", [1000, 0])
def test_each_text_is_sent_once(spark, tmp_path, folder, bound):
    cache = VectorCache(spark, str(tmp_path / "cache"), "m")
    first = spark.createDataFrame([(i, f"text {i % 7}") for i in range(60)] + [(99, None), (98, "")], "id int, t string").repartition(5)
    more = spark.createDataFrame([(i, f"text {i % 12}") for i in range(50)], "id int, t string").repartition(3)
    for _ in range(2):
        for df in (first, more):
            rows = cache.infer(df, "t", counting(folder), broadcast_keys=bound)
            assert rows.columns == ["id", "t", "embedding", "error"]
            got = rows.collect()
            assert len(got) == df.count()
            assert all(r["embedding"] == (None if r["t"] is None else [float(len(r["t"])), 1.0]) and r["error"] is None for r in got)
    seen = collections.Counter(t for texts in sent(folder) for t in texts)
    assert set(seen) == {"", *(f"text {i}" for i in range(12))} and set(seen.values()) == {1}


def test_models_do_not_share_vectors(spark, tmp_path, folder):
    df = spark.createDataFrame([("a",)], "t string")
    for name in ("m", "n", "m"):
        embed(df, "t", "external", factory=counting(folder), cache=VectorCache(spark, str(tmp_path / "cache"), name)).collect()
    assert [len(t) for t in sent(folder)] == [1, 1]
    for bad in ("", "a/b", ".x"):
        with pytest.raises(ValueError):
            VectorCache(spark, str(tmp_path), bad)
    with pytest.raises(ValueError):
        VectorCache(spark, str(tmp_path), "m").infer(df.withColumn("key", F.lit(1)), "t", counting(folder))


def test_failures_are_asked_again(spark, tmp_path, folder):
    cache = VectorCache(spark, str(tmp_path / "cache"), "m")
    df = spark.createDataFrame([(i, "bad" if i == 3 else f"t{i}") for i in range(6)], "id int, t string")
    options = {"batch": 1, "attempts": 1, "on_error": "record"}
    got = {r["id"]: r for r in cache.infer(df, "t", counting(folder, ("bad",)), **options).collect()}
    assert got[3]["embedding"] is None and "refused" in got[3]["error"] and got[2]["embedding"] == [2.0, 1.0]
    got = {r["id"]: r for r in cache.infer(df, "t", counting(folder), **options).collect()}
    assert got[3]["embedding"] == [3.0, 1.0] and got[3]["error"] is None
    assert collections.Counter(t for texts in sent(folder) for t in texts)["bad"] == 2
    with pytest.raises(Exception, match="refused"):
        cache.infer(spark.createDataFrame([("worse",)], "t string"), "t", counting(folder, ("worse",)), attempts=1).collect()
    assert cache.stored().count() == 6


def test_texts_of_like_length_share_a_request(spark, tmp_path, folder):
    df = spark.createDataFrame([("x" * (i * 37 % 100 + 1) + str(i),) for i in range(100)], "t string").coalesce(1)
    embed(df, "t", "external", factory=counting(folder), cache=VectorCache(spark, str(tmp_path / "c"), "m"), batch=10).collect()
    spans = [max(map(len, t)) - min(map(len, t)) for t in sent(folder)]
    assert max(spans) <= 60 and sum(spans) / len(spans) < 50


def test_unit_vectors_from_the_cache(spark, tmp_path, folder):
    df = spark.createDataFrame([("abc",)], "t string")
    for _ in range(2):
        rows = embed(df, "t", "external", factory=counting(folder), cache=VectorCache(spark, str(tmp_path / "c"), "m"), normalize=True)
        assert [round(x, 6) for x in rows.first()["embedding"]] == [0.948683, 0.316228]
    assert len(sent(folder)) == 1
