"""Snapshots of collections and tables: failures, repeats, readers and writers at the same time."""

import pytest
from pyspark.sql import functions as F

from foliograph.operators import lookup
from foliograph.operators.lookup import KeyedFiles, fetch, key_ranges, rows_for
from foliograph.plans import index, retrieval
from foliograph.sources import files
from foliograph.sources.chunk_store import ChunkStore
from foliograph.sources.tables import replace_table

SCHEMA = "chunk_id string, chunk_text string"


def chunks(spark, *rows):
    return spark.createDataFrame([(i, t) for i, t in rows], SCHEMA)


def held(store, number=None):
    return sorted(map(tuple, store.read(number).collect()))


def failing(df):
    """``df`` with a column that cannot be computed."""
    return df.withColumn("chunk_text", F.raise_error(F.lit("broken")).cast("string"))


def test_a_small_file_is_written_once(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    assert files.write_once(spark, path, "a") and not files.write_once(spark, path, "b")
    assert (tmp_path / "log/1.json").read_text() == "a"
    assert files.names(spark, f"{tmp_path}/log") == ["1.json"] and files.names(spark, f"{tmp_path}/none") == []


def test_a_failed_change_leaves_the_snapshot(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path))
    with pytest.raises(Exception, match="broken"):
        store.replace(failing(chunks(spark, ("a", "1"))))
    assert store.is_empty()
    store.replace(chunks(spark, ("a", "1")))
    for change in (store.replace, store.append):
        with pytest.raises(Exception, match="broken"):
            change(failing(chunks(spark, ("b", "2"))))
    with pytest.raises(Exception, match="broken"):
        store.append(chunks(spark, ("b", "2")), prepare=failing)
    assert held(store) == [("a", "1")] and store.snapshot()["number"] == 1


def test_readers_keep_their_snapshot(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path))
    store.replace(chunks(spark, ("a", "1")))
    before = store.read()
    store.append(chunks(spark, ("a", "other"), ("b", "2")))
    between = store.read()
    store.replace(chunks(spark, ("c", "3")))
    assert sorted(map(tuple, before.collect())) == [("a", "1")]
    assert sorted(map(tuple, between.collect())) == [("a", "1"), ("b", "2")]
    assert [held(store, n) for n in (1, 2, 3)] == [[("a", "1")], [("a", "1"), ("b", "2")], [("c", "3")]]
    # A writer that reads the collection it replaces.
    store.replace(store.read().withColumn("chunk_text", F.lit("new")))
    assert held(store) == [("c", "new")]
    store.clean(keep=2)
    assert held(store) == [("c", "new")] and held(store, 3) == [("c", "3")]
    assert len(files.names(spark, f"{store.path}/data")) == 2
    with pytest.raises(ValueError):
        store.clean(0)


def test_a_batch_is_applied_once(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path))
    store.append(chunks(spark, ("a", "1")), source="s", batch=0)
    store.append(failing(chunks(spark, ("x", "1"))), source="s", batch=0)  # known: not even read
    store.append(chunks(spark, ("b", "1")), source="s", batch=3)
    store.append(chunks(spark, ("c", "1")), source="other", batch=0)
    store.append(chunks(spark, ("a", "again")), source="s", batch=4)
    store.append(chunks(spark, ("a", "again")))  # no source: its ids are stored
    assert [i for i, _ in held(store)] == ["a", "b", "c"]
    assert store.snapshot()["applied"] == {"s": 4, "other": 0} and store.snapshot()["number"] == 4
    store.replace(chunks(spark, ("z", "1")))
    store.append(chunks(spark, ("a", "1")), source="s", batch=0)  # after a reset a stream may start again
    assert [i for i, _ in held(store)] == ["a", "z"]


def overtaken(store, change, times=1):
    """``store`` whose next commits are preceded by ``change``."""
    commit, left = store._commit, [times]

    def late(*args, **kwargs):
        if left[0]:
            left[0] -= 1
            change()
        return commit(*args, **kwargs)

    store._commit = late
    return store


def test_two_appenders_store_no_id_twice(spark, tmp_path):
    one, two = (ChunkStore(spark, str(tmp_path)) for _ in range(2))
    one.replace(chunks(spark, ("a", "1")))
    extra = chunks(spark, ("b", "two"), ("c", "two"))
    overtaken(one, lambda: two.append(extra)).append(chunks(spark, ("b", "one"), ("d", "one")))
    assert held(two) == [("a", "1"), ("b", "two"), ("c", "two"), ("d", "one")]

    three = ChunkStore(spark, str(tmp_path), "first")
    first = ChunkStore(spark, str(tmp_path), "first")
    overtaken(three, lambda: first.append(extra)).append(chunks(spark, ("b", "one"), ("d", "one")))
    assert held(first) == [("b", "two"), ("c", "two"), ("d", "one")]


def test_an_append_overtaken_by_a_reset_or_by_itself(spark, tmp_path):
    one, two = (ChunkStore(spark, str(tmp_path)) for _ in range(2))
    one.replace(chunks(spark, ("a", "1")))
    overtaken(one, lambda: two.replace(chunks(spark, ("b", "2")))).append(chunks(spark, ("a", "again"), ("b", "again")))
    assert held(two) == [("a", "again"), ("b", "2")]
    again = ChunkStore(spark, str(tmp_path))
    new = chunks(spark, ("c", "3"))
    overtaken(again, lambda: two.append(new, source="s", batch=1)).append(new, source="s", batch=1)
    assert held(two) == [("a", "again"), ("b", "2"), ("c", "3")]


def test_back_ends_do_not_mix(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path))
    text = chunks(spark, ("a", "some words"))
    assert store.backend() is None
    store.replace(index.with_vectors(text))
    other = {"backend": "external", "factory": lambda: lambda texts: [{"embedding": [1.0]} for _ in texts]}
    with pytest.raises(ValueError, match="hashed vectors, not external"):
        store.append(chunks(spark, ("b", "x")), lambda new: index.with_vectors(new, **other))
    assert store.backend() == "hashed" and store.size() == 1
    asked = spark.createDataFrame([("words",)], "query_text string")
    with pytest.raises(ValueError, match="another back end"):
        retrieval.retrieve(asked, store.read(), **other)
    health = index.index_health(spark, store, backend="external", model="m").first()
    assert (health["embedding_backend"], health["embedding_model"], health["snapshot"]) == ("hashed", "m", 1)


def test_an_organised_store(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = ChunkStore(spark, str(tmp_path))
        assert store.keyed_files() is None
        with pytest.raises(ValueError):
            store.organise()
        store.replace(spark.range(400).select(F.concat(F.lit("c"), F.col("id") * 7 % 400).alias("chunk_id"), F.col("id").cast("string").alias("chunk_text")))
        rows = held(store)
        assert store.keyed_files() is None
        store.organise()
        assert held(store) == rows
        keyed = store.keyed_files()
        assert keyed.ranges.count() == len(store.read().inputFiles()) >= 3
        ids = spark.createDataFrame([("c5",), ("c6",), ("nothing",), (None,)], "chunk_id string")
        # Each id is in one file, known from the ranges alone.
        assert sorted(r["chunk_id"] for r in keyed.located(ids).collect() if r["chunk_id"] != "nothing") == ["c5", "c6"]
        assert "chunk_text" not in keyed.located(ids)._jdf.queryExecution().executedPlan().toString()
        found = fetch(store.read(), ids, "chunk_id", ["chunk_id", "chunk_text"], keyed=keyed)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 2 and "In(chunk_id" in plan  # statistics and Bloom filters see the ids
        store.append(chunks(spark, ("new", "1")))
        assert store.keyed_files() is None  # the new folder is not organised
        store.organise()
        assert store.keyed_files().ranges.count() >= 3 and store.size() == 401
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("organised", [True, False])
def test_many_hits_do_not_move_the_table(spark, tmp_path, organised):
    """More ids than one broadcast holds: groups of files, each with its own ids."""
    path = str(tmp_path / "t")
    rows = spark.range(5000).select("id", F.concat(F.lit("t"), "id").alias("t"))
    (rows.repartitionByRange(12, "id") if organised else rows.repartition(12)).write.parquet(path)
    table = spark.read.parquet(path)
    hits = spark.range(9000).select((F.col("id") * 3 % 6000).alias("id"), F.col("id").alias("tag"))
    hits.write.parquet(str(tmp_path / "hits"))
    hits = spark.read.parquet(str(tmp_path / "hits"))
    keyed = KeyedFiles(table, "id", key_ranges(table, "id")) if organised else None
    want = sorted(map(tuple, table.join(hits, "id").select("id", "t", "tag").collect()))
    seen = []
    real = lookup._by_groups

    def watched(table, placed, *args):
        for line in placed._jdf.queryExecution().executedPlan().toString().splitlines():
            assert "Exchange" not in line or "#t" not in line
        seen.append(placed.count())
        return real(table, placed, *args)

    lookup._by_groups = watched
    try:
        for bound in (10_000, 300):
            got = rows_for(table, hits, "id", ["id", "t"], keyed=keyed, broadcast_rows=bound, many_files=1)
            assert sorted(map(tuple, got.select("id", "t", "tag").collect())) == want
    finally:
        lookup._by_groups = real
    assert len(seen) == 1 and seen[0] >= 1667
    derived = table.select("id", F.upper("t").alias("t"))
    assert rows_for(derived, hits, "id", ["id", "t"], broadcast_rows=300).count() == len(want)
    assert rows_for(table, hits.limit(0), "id", ["id", "t"], keyed=keyed).count() == 0


def test_overlapping_ranges(spark, tmp_path):
    for name, low, high in (("a", 0, 100), ("b", 10, 20), ("c", 50, 300)):
        spark.range(low, high).select("id", F.lit(name).alias("t")).coalesce(1).write.parquet(str(tmp_path / name))
    table = spark.read.parquet(*[str(tmp_path / n) for n in "abc"])
    keyed = KeyedFiles(table, "id", key_ranges(table, "id"))
    ids = spark.createDataFrame([(5,), (15,), (60,), (250,), (999,)], "id bigint")
    assert keyed.located(ids).groupBy("id").count().orderBy("id").collect() == [(5, 1), (15, 2), (60, 2), (250, 1)]
    got = fetch(table, ids, "id", ["id", "t"], keyed=keyed).orderBy("id", "t").collect()
    assert [tuple(r) for r in got] == [(5, "a"), (15, "a"), (15, "b"), (60, "a"), (60, "c"), (250, "c")]


def test_a_failed_refresh_leaves_the_table(spark):
    spark.sql("drop table if exists refreshed")
    replace_table(spark.range(5).select("id"), "refreshed", ("id",))
    before = spark.table("refreshed")
    with pytest.raises(Exception, match="broken"):
        replace_table(spark.range(9).select(F.raise_error(F.lit("broken")).cast("bigint").alias("id")), "refreshed")
    assert spark.table("refreshed").count() == 5
    replace_table(spark.table("refreshed").filter("id > 2"), "refreshed")  # reads what it replaces
    assert before.count() == 5 and spark.table("refreshed").count() == 2
    replace_table(spark.range(3).select(F.col("id").cast("string").alias("name")), "refreshed")  # other columns
    assert spark.table("refreshed").columns == ["name"]
    replace_table(spark.range(4).select(F.col("id").cast("string").alias("name")), "refreshed")
    assert spark.table("refreshed").count() == 4
