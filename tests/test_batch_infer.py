"""External embedding: batches, retries, checks, back ends."""

import pytest
from pyspark.sql import functions as F

from foliograph.operators import batch_infer as b
from foliograph.plans.embed import embed


class Flaky:
    """A model that fails a number of times first."""

    def __init__(self, failures):
        self.failures, self.calls = failures, 0

    def __call__(self, texts):
        self.calls += 1
        if self.calls <= self.failures:
            raise ConnectionError("busy")
        return [{"index": i, "embedding": [float(i)]} for i in range(len(texts))][::-1]


def test_retry_then_success(monkeypatch):
    waits = []
    monkeypatch.setattr(b.time, "sleep", waits.append)
    assert b.call_with_retry(Flaky(3), ["a", "b", "c"]) == [[0.0], [1.0], [2.0]]
    assert waits == [1.5, 3.0, 4.5]


def test_four_failures_raise(monkeypatch):
    monkeypatch.setattr(b.time, "sleep", lambda _: None)
    model = Flaky(4)
    with pytest.raises(RuntimeError, match="after 4 attempts"):
        b.call_with_retry(model, ["a"])
    assert model.calls == 4


def test_short_answer_is_an_error_without_retry():
    calls = []

    def model(texts):
        calls.append(texts)
        return []

    with pytest.raises(RuntimeError, match="0 embeddings for 2"):
        b.call_with_retry(model, ["a", "b"])
    assert len(calls) == 1


def test_batches_of_32_keep_rows_and_order(spark):
    def factory():
        return lambda texts: [
            {"index": i, "embedding": [float(t), float(len(texts))]} for i, t in reversed(list(enumerate(texts)))
        ]

    df = spark.range(0, 70, 1, 1).select("id", F.col("id").cast("string").alias("t"))
    rows = b.batch_infer(df, "t", factory).orderBy("id").collect()
    assert [r["embedding"][0] for r in rows] == [float(i) for i in range(70)]
    assert [r["embedding"][1] for r in rows] == [32.0] * 64 + [6.0] * 6
    assert all(r["error"] is None for r in rows)


def test_model_is_made_once_per_process(spark):
    def factory():
        import os
        import random

        token = random.random()
        return lambda texts: [{"embedding": [float(os.getpid()), token]} for _ in texts]

    df = spark.range(0, 400, 1, 8).select(F.col("id").cast("string").alias("t"))
    rows = b.batch_infer(df, "t", factory, handle_name="test-model").collect()
    seen = {tuple(r["embedding"]) for r in rows}
    assert len(seen) == len({pid for pid, _ in seen})


def test_recorded_failures_keep_their_batch_only(spark):
    def factory():
        def model(texts):
            if "bad" in texts:
                raise ValueError("no")
            return [{"index": i, "embedding": [1.0]} for i in range(len(texts))]

        return model

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "t string").coalesce(1)
    rows = b.batch_infer(df, "t", factory, batch=1, attempts=1, on_error="record").collect()
    assert [(r["t"], r["embedding"]) for r in rows] == [("a", [1.0]), ("bad", None), ("c", [1.0])]
    assert "no" in rows[1]["error"]
    with pytest.raises(Exception, match="after 1 attempts"):
        b.batch_infer(df, "t", factory, attempts=1).collect()


@pytest.mark.parametrize("options", [{"batch": 0}, {"attempts": 0}, {"on_error": "ignore"}])
def test_bounds(spark, options):
    with pytest.raises(ValueError):
        b.batch_infer(spark.range(1), "id", dict, **options)


def test_back_ends(spark):
    def missing():
        raise ImportError("no model here")

    df = spark.createDataFrame([("a b a",)], "t string")
    hashed = embed(df, "t", "Hashed").first()
    assert sum(hashed["embedding"]["tf"]) == 3 and hashed["error"] is None
    with pytest.warns(UserWarning, match="cannot be created"):
        assert embed(df, "t", "external", factory=missing, fallback="hashed").first() == hashed
    with pytest.raises(Exception, match="no model here"):
        embed(df, "t", "external", factory=missing, attempts=1).collect()
    with pytest.raises(ValueError):
        embed(df, "t", "other")
    unit = embed(
        df, "t", "external", factory=lambda: lambda ts: [{"embedding": [3, 4]} for _ in ts], normalize=True
    )
    assert unit.first()["embedding"] == [0.6, 0.8]


@pytest.mark.parametrize("index", [[0, 0], [0, None], [1, 2]])
def test_wrong_indexes_are_an_error(index):
    items = [{"index": i, "embedding": [1.0]} if i is not None else {"embedding": [1.0]} for i in index]
    with pytest.raises(RuntimeError, match="wrong indexes"):
        b.call_with_retry(lambda texts: items, ["a", "b"])


def test_answers_without_index_keep_their_order():
    items = [{"embedding": [2.0]}, {"embedding": [1.0]}]
    assert b.call_with_retry(lambda texts: items, ["a", "b"]) == [[2.0], [1.0]]
