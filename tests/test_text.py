"""Column functions against plain Python on awkward texts."""

import hashlib
import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from foliograph.functions import text as t
from foliograph.functions import vectors as v

ALPHABET = "aB9,. \t\n\r\x0b\x1c\x85  　éΣİß"


def random_texts(n=300, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 25))) for _ in range(n)]


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr.alias("y")).orderBy("i").collect()]


def test_whitespace_set_is_pythons():
    assert set(t.PY_WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_and_words_follow_python(spark):
    texts = random_texts()
    assert column(spark, texts, t.py_strip("x")) == [x.strip() for x in texts]
    assert column(spark, texts, t.py_words("x")) == [x.split() for x in texts]


def test_space_rules_ignore_other_whitespace(spark):
    texts = random_texts()
    assert column(spark, texts, t.sql_trim("x")) == [x.strip(" ") for x in texts]
    assert column(spark, texts, t.space_tokens("x")) == [[w for w in x.split(" ") if w] for x in texts]
    expected = [len([w for w in re.split("[ \t\r\n]", x) if w]) for x in texts]
    assert column(spark, texts, t.word_count("x")) == expected
    names = [[w.strip(" ") for w in x.split(",") if w.strip(" ")] for x in texts]
    assert column(spark, texts, t.comma_names("x")) == names


def test_word_count_edges(spark):
    # tab, newline and space separate; a no-break space does not
    assert column(spark, ["a\tb\n c", "\t", "a b"], t.word_count("x")) == [3, 0, 1]
    assert column(spark, ["a b"], F.size(t.py_words("x"))) == [2]


def test_prefix_integer(spark):
    values = ["2007", "2007x", "d", "", "-5a", "+7", "\t2007", "9" * 30, "-" + "9" * 30, None]
    expected = [2007, 2007, 0, 0, -5, 7, 2007, t.LONG_MAX, t.LONG_MIN, None]
    assert column(spark, values, t.prefix_integer("x")) == expected


def test_strict_integer(spark):
    values = [" 2021\n", "+3", "2021.0", "n/a", "", None, "2_021", "_1", "9" * 25]
    expected = [2021, 3, None, None, None, None, 2021, None, t.LONG_MAX]
    assert column(spark, values, t.strict_integer("x")) == expected


def test_status_label(spark):
    values = ["published", "unpublished", " PUBLISHED ", None, ""]
    assert column(spark, values, t.status_label("x")) == [
        "Published", "Preprint", "Published", "Preprint", "Preprint",
    ]


def test_snippet(spark):
    exact, over, padded = "a" * 280, "b" * 281, "c" * 270 + " " * 10 + "d" * 10
    got = column(spark, [exact, over, padded, " x\ny "], t.snippet("x"))
    assert got == [exact, "b" * 277 + "...", "c" * 270 + "...", "x y"]


def test_first_of_list_and_area(spark):
    assert column(spark, ["a.b.c", "math", ".x"], t.before_first("x", ".")) == ["a", "math", ""]


def test_token_buckets(spark):
    # fixed values
    assert column(spark, ["the", "naïve", "transformer,"], v.token_bucket("x")) == [15, 355, 93]


def test_hashed_vectors_match_a_direct_count(spark):
    texts = random_texts(200, seed=9) + ["", " \t", "the the THE cat"]

    def direct(text):
        digests = (hashlib.md5(w.encode()).digest() for w in text.lower().split())
        return dict(Counter((d[0] | d[1] << 8 | d[2] << 16 | d[3] << 24) % 384 for d in digests))

    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string")
    rows = v.with_hashed_vector(df, "x").select(
        "i", "embedding", v.unit_weights("embedding").alias("w"), v.dense_vector("embedding").alias("d")
    ).orderBy("i").collect()
    for text, row in zip(texts, rows):
        want = direct(text)
        assert row["embedding"]["idx"] == sorted(want)
        assert dict(zip(row["embedding"]["idx"], row["embedding"]["tf"])) == want
        norm = math.sqrt(sum(c * c for c in want.values()))
        assert len(row["d"]) == 384
        for bucket, weight in zip(row["embedding"]["idx"], row["w"]):
            assert abs(weight - want[bucket] / norm) < 1e-12
            assert row["d"][bucket] == weight
        assert abs(sum(x * x for x in row["d"]) - (1.0 if want else 0.0)) < 1e-9


def test_null_text_gives_null_vector(spark):
    df = spark.createDataFrame([(None,)], "x string")
    assert v.with_hashed_vector(df, "x").first()["embedding"] is None


def test_unit_vector_of_zeros_stays_zero(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "x array<double>")
    assert [r["y"] for r in df.select(v.unit("x").alias("y")).collect()] == [[0.0, 0.0], [0.6, 0.8]]


def test_whitespace_of_the_hashed_words(spark):
    texts = [f"a{chr(c)}b" for c in (*range(1, 0x3002), 0xFEFF, 0x1F600) if not 0xD800 <= c < 0xE000]
    texts += ["", " ", "　x\x1c", "x" * 3000, None] + ["same words"] * 1200
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").repartition(3)
    words = t.py_words(F.lower("x"))
    rows = v.with_hashed_vector(df, "x").select(F.aggregate("embedding.tf", F.lit(0), lambda a, n: a + n).alias("n"), F.size(words).alias("want"))
    assert rows.filter(~F.col("n").eqNullSafe(F.when(F.col("want") >= 0, F.col("want")))).isEmpty()
    assert rows.count() == len(texts)


def test_vectors_are_counted_by_batches(spark):
    # no function of an array runs token by token in the plan, and no weight where counts are asked for
    df = spark.createDataFrame([("i", "the cat the")], "chunk_id string, x string")
    hashed = v.with_hashed_vector(df, "x")
    plan = v.postings(hashed, "chunk_id").select("chunk_id", "bucket", "tf")._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambda" not in plan and "md5" not in plan
    got = {r["tf"]: r["weight"] for r in v.postings(hashed, "chunk_id").collect()}
    assert got == {1: 1 / math.sqrt(5), 2: 2 / math.sqrt(5)}
