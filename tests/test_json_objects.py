"""JSON arrays cut into objects by many tasks."""

import json
import random

import pytest
from pyspark.sql import functions as F

from foliograph.plans.requests import ANSWER_SCHEMA
from foliograph.sources.documents import read_questions, write_json
from foliograph.sources.json_objects import split_objects


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def objects(n, seed=1):
    rng = random.Random(seed)
    texts = ["plain", "a } b", "{ [ ] }", 'quote " and \\ backslash', '\\"}', "é 漢\n", "", "}" * 9, "long }\" text " * 40]
    rows = []
    for i in range(n):
        row = {"id": rng.choice([i, f"q-{i}", i + 0.5]), "question": rng.choice(texts), "year_filter": rng.choice([None, "2020", 2021])}
        if rng.random() < 0.5:
            row["grading"] = {"type": rng.choice(texts), "must_contain_any": rng.choices(texts, k=2), "min_keyword_hits": 1}
        rows.append(row)
    rows[n // 2]["question"] = "}{\"" * 900  # an object over several blocks
    return rows


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_", [True, False])
def test_array_and_lines_agree(spark, tmp_path, small_blocks, indent, ascii_):
    items = objects(60)
    (tmp_path / "q.json").write_text(json.dumps(items, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    (tmp_path / "q.jsonl").write_text("\n".join(json.dumps(i) for i in items))
    cut = split_objects(spark, str(tmp_path / "q.json"))
    assert sorted(json.dumps(json.loads(r["text"])) for r in cut.collect()) == sorted(map(json.dumps, items))
    assert cut.rdd.getNumPartitions() > 8
    lines = split_objects(spark, str(tmp_path / "q.jsonl"))  # objects one after the other
    assert sorted(json.dumps(json.loads(r["text"])) for r in lines.collect()) == sorted(map(json.dumps, items))
    array, lines = (
        sorted(r[0] for r in df.select(F.to_json(F.struct("*"))).collect())
        for df in (read_questions(spark, str(tmp_path / "q.json")), read_questions(spark, str(tmp_path / "q.jsonl"), json_lines=True))
    )
    assert array == lines and len(array) == 60


def test_ids_are_kept_as_given(spark, tmp_path):
    ids = [1, "1", "q-7", 2.5, None, 12345678901234567890]
    (tmp_path / "q.json").write_text(json.dumps([{"id": i, "question": "x"} for i in ids]))
    asked = read_questions(spark, str(tmp_path / "q.json"))
    write_json(asked.select(F.col("id").alias("question_id"), "question"), str(tmp_path / "a"))
    back = [json.loads(x)["question_id"] for p in (tmp_path / "a").glob("*.json") for x in p.read_text().splitlines()]
    assert sorted(map(repr, back)) == sorted(map(repr, ids))
    stored = spark.read.schema(ANSWER_SCHEMA).json(str(tmp_path / "a"))
    texts = [r[0] for r in stored.select(F.col("question_id").cast("string")).collect()]
    assert sorted(map(str, texts)) == sorted(map(str, ids))


@pytest.mark.parametrize("text", ["[]", "", " \n", "[ ]"])
def test_nothing(spark, tmp_path, text):
    (tmp_path / "q.json").write_text(text)
    assert split_objects(spark, str(tmp_path / "q.json")).count() == 0


@pytest.mark.parametrize("text", ['[{"id": 1}', '[{"id": "1}]', '[{"id": 1}}]', '{"id": [1}'])
def test_brackets_that_do_not_match(spark, tmp_path, text):
    (tmp_path / "q.json").write_text(text)
    with pytest.raises(ValueError, match="do not match"):
        split_objects(spark, str(tmp_path / "q.json"))


@pytest.mark.parametrize("text", ['[{"id": 1}, 2]', '["x", {"id": 1}]', '[{"id": 1}] x', '[{"id": ]}]'])
def test_other_things_than_objects(spark, tmp_path, text):
    (tmp_path / "q.json").write_text(text)
    with pytest.raises(Exception):
        read_questions(spark, str(tmp_path / "q.json")).collect()
