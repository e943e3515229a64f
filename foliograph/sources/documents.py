"""JSON records: paper exports, question lists and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foliograph.sources.json_objects import split_objects

# An id is kept as it is given, a number as a number and a text as a text.
QUESTION_SCHEMA = (
    "id variant, question string, category_filter string, year_filter string, "
    "grading struct<type: string, must_contain_any: array<string>, min_keyword_hits: int>"
)


def read_questions(spark: SparkSession, path: str, json_lines: bool = False) -> DataFrame:
    """A question list: one JSON array per file, or one object per line.

    A broken file is an error.  Both forms are read by many tasks.
    """
    if json_lines:
        return spark.read.schema(QUESTION_SCHEMA).option("mode", "FAILFAST").json(path)
    parsed = F.from_json("text", QUESTION_SCHEMA, {"mode": "FAILFAST"})
    return split_objects(spark, path).select(parsed.alias("q")).select("q.*")


def write_json(df: DataFrame, path: str) -> None:
    """One object per line, nulls written, text kept as it is."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
