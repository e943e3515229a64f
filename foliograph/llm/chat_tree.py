"""Conversations as prefix trees: shared first turns are emitted once.

A turn becomes ``<|turn|>role<|text|>text<|end|>``.  Inside roles and texts
each ``<``, ``[`` and backslash is followed by a backslash, so no control
string of this or the common bracket templates can occur there; taking those
backslashes away restores the text.

A node is a turn in the context of all turns before it; conversations that
start alike share nodes.  Trees are emitted depth-first: sorted by the path of
a node's ancestors.  A node's place in its tree is a prefix sum in two levels,
inside sorted ranges and over the ranges' sums, so that a tree of any size
(a first turn that a third of all conversations share) is spread over tasks.
Every node carries the position of its first token in its conversation, and
the intervals of the tree that its ancestors take: what its tokens may attend
to besides themselves.  A token is one code point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from foliograph.session import scratch_path

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def _segment(turn: Column) -> Column:
    return F.concat(F.lit(TURN), escaped(turn["role"]), F.lit(TEXT), escaped(turn["text"]), F.lit(END))


def _paths(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv, turns, path``: per conversation its segments in order and the key of every prefix."""
    rows = conversations.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"),
            F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    segments = F.transform(
        "turns",
        lambda t: F.struct(
            _segment(t).alias("segment"),
            (t["role"] == LEARNED_ROLE).alias("learned"),
            (F.length(escaped(t["role"])) + len(TURN) + len(TEXT)).alias("head"),
        ),
    )
    with_segments = turns.select("conv", segments.alias("turns"))
    path = F.aggregate(
        "turns",
        F.array().cast("array<string>"),
        lambda done, t: F.concat(
            done, F.array(F.md5(F.concat(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), t["segment"])))
        ),
    )
    return with_segments.withColumn("path", path)


def _nodes(paths: DataFrame) -> DataFrame:
    """One row per distinct prefix: ``node, path, position, segment, learned, head``."""
    each = paths.select("path", "turns", F.posexplode("turns").alias("i", "t")).select(
        F.get("path", F.col("i")).alias("node"),
        F.slice("path", F.lit(1), F.col("i") + 1).alias("path"),
        F.aggregate(
            F.slice("turns", F.lit(1), F.col("i")), F.lit(0).cast("bigint"), lambda n, t: n + F.length(t["segment"])
        ).alias("position"),
        "t.segment", "t.learned", "t.head",
    )
    return each.groupBy("node").agg(
        *[F.any_value(c).alias(c) for c in ("path", "position", "segment", "learned", "head")]
    )


def prefix_trees(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The emitted nodes and the conversations that lie in them.

    Nodes: ``tree, node, start, end`` (place in the tree's depth-first
    sequence), ``position`` (of the first token in its conversation),
    ``attends`` (intervals of the ancestors), ``segment``, ``loss_from`` and
    ``loss_length`` (the span of an assistant's text in the segment, else
    length 0).  Conversations: ``conv, path`` (node keys from the first turn to
    the last).

    Turns are ordered by number, ties by role and text, null numbers first.
    Null roles and texts are empty; rows without a conversation id form one
    conversation; repeated rows are further turns; no rows give no trees.
    """
    spark = conversations.sparkSession
    where = scratch_path(spark, "chat-tree")
    _paths(conversations, conv_col, turn_col, role_col, text_col).write.parquet(f"{where}/paths")
    paths = spark.read.parquet(f"{where}/paths")
    _nodes(paths).repartitionByRange("path").sortWithinPartitions("path").withColumn(
        "range", F.spark_partition_id()
    ).write.parquet(f"{where}/nodes")
    size = F.length("segment").cast("bigint")
    nodes = spark.read.parquet(f"{where}/nodes").withColumn("tree", F.get("path", F.lit(0)))
    ranges = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        nodes.groupBy("tree", "range").agg(F.sum(size).alias("n"))
        .select("tree", "range", F.coalesce(F.sum("n").over(ranges), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("tree", "range").orderBy("path")
    placed = nodes.join(base, ["tree", "range"]).withColumn(
        "end", F.col("base") + F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ).withColumn("start", F.col("end") - size)
    placed.drop("base", "range").write.parquet(f"{where}/placed")
    placed = spark.read.parquet(f"{where}/placed")
    above = placed.select("node", F.explode(F.slice("path", F.lit(1), F.size("path") - 1)).alias("ancestor"))
    seen = (
        above.join(placed.select(F.col("node").alias("ancestor"), "start", "end"), "ancestor")
        .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("attends"))
    )
    none = F.array().cast(seen.schema["attends"].dataType)
    emitted = placed.join(seen, "node", "left").select(
        "tree", "node", "start", "end", "position",
        F.coalesce("attends", none).alias("attends"),
        "segment",
        F.col("head").cast("bigint").alias("loss_from"),
        F.when(F.col("learned"), size - F.col("head") - len(END)).otherwise(0).alias("loss_length"),
    )
    return emitted, paths.select("conv", "path")


def read_back(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """Per conversation what its part of the trees says: turns, learned text and length."""
    body = F.substring("segment", F.lit(len(TURN) + 1), F.length("segment") - len(TURN) - len(END))
    cut = F.split(body, TEXT.replace("|", r"\|"), 2)
    parts = nodes.select(
        "node",
        F.struct(
            F.concat(unescaped(cut[0]), F.lit("\n"), unescaped(cut[1]), F.lit("\n")).alias("turn"),
            unescaped(F.expr("substring(segment, loss_from + 1, loss_length)")).alias("learned"),
            F.length("segment").alias("size"),
        ).alias("part"),
    )
    each = conversations.select("conv", F.posexplode("path").alias("i", "node")).join(parts, "node")
    whole = each.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("i", "part"))).alias("parts"))
    turns = F.array_join(F.transform("parts", lambda p: p["part"]["turn"]), "")
    learned = F.array_join(F.transform("parts", lambda p: p["part"]["learned"]), "")
    return whole.select(
        F.col("conv").alias("conv_id"),
        F.size("parts").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["part"]["size"]).alias("formatted_chars"),
    )
