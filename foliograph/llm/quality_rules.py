"""Cross-document line frequency and per-document quality counts.

Built of DataFrame functions only.  A line is lower-cased, its white space
squeezed, and hashed.  Per host the distinct documents (exact copies of a text
count once) that hold a line are counted; a line above both limits, a number
of documents and a share of the host's documents, is removed everywhere on
that host, and a document that loses too large a part of its words is rejected.

Counting goes in two levels, first by (host, line, document), then by (host,
line) with partial sums, so a line that stands in every document of a large
host is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from foliograph.session import checkpoint_root

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 8

# Frequent lines, and their places with the documents that have any, up to which
# they are broadcast.
BROADCAST_ROWS = 200_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the text."""

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, i: F.least(F.coalesce(F.get(places, i + 1) - p, F.lit(size)), F.lit(size))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    def places(pairs: Column) -> Column:
        same = F.filter(
            pairs,
            lambda e, i: F.coalesce(F.get(pairs, i - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(pairs, i + 1)["h"] == e["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(same, lambda e: e["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
            let(let(pairs, places), covered)
        )

    def hashed(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(size)))
        )

    return let(words, lambda w: F.when(F.size(w) < size, 0).otherwise(let(hashed(w), count)))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``base_failed``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(WORD)))
    rows = docs.select(
        "*",
        let(
            words,
            lambda w: F.struct(
                F.size(w).cast("bigint").alias("n_words"),
                F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                repeated_words(w).cast("bigint").alias("n_repeat_words"),
            ),
        ).alias("_counts"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    )
    n, repeated = F.col("_counts.n_words"), F.col("_counts.n_repeat_words")
    return rows.select(
        *docs.columns, "_counts.*", "n_symbols", "n_dup_lines",
        ((n < 20) | (100 * repeated > 30 * n)).alias("base_failed"),
    )


def line_key(line: Column) -> Column:
    """A line without case and outer or repeated white space, hashed."""
    return F.xxhash64(F.trim(F.regexp_replace(F.lower(line), SPACE, " ")))


def _lines(docs: DataFrame) -> DataFrame:
    """``id, content, host, at, line, n`` per line with words."""
    return docs.select("id", "content", "host", F.posexplode(F.split("text", "\n")).alias("at", "raw")).select(
        "id", "content", "host", "at",
        line_key(F.col("raw")).alias("line"), F.regexp_count("raw", F.lit(WORD)).alias("n"),
    ).filter("n > 0")


def frequent_lines(docs: DataFrame, max_docs: int, max_share: float) -> DataFrame:
    """``host, line`` above both limits; ``docs`` has ``content, host, text``."""
    totals = (
        docs.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("documents"))
    )
    holders = _lines(docs).select("host", "line", "content").distinct()
    counts = holders.groupBy("host", "line").agg(F.count("*").alias("holders")).filter(F.col("holders") > max_docs)
    return counts.join(totals, "host").filter(F.col("holders") > max_share * F.col("documents")).select("host", "line")


def line_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = 20,
    max_share: float = 0.01,
    min_left: float = 0.5,
) -> DataFrame:
    """Per row: id, the base counts, ``base_failed``, ``n_removed_words`` and ``kept``.

    ``kept`` is false if the base rules fail, or if fewer than ``min_left`` of
    the words are left without frequent lines.  A null text has no words and
    fails; a null host is one host; copies of a row give copies of its result;
    an empty table gives none.
    """
    rows = _rows(docs.select(F.col(f"`{id_col}`").alias("id"), text_col, host_col), text_col, host_col)
    out = _judged(rows, base_counts(rows).drop("text"), max_docs, max_share, min_left)
    return out.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "n_removed_words", "kept",
    )


def _rows(docs: DataFrame, text_col: str, host_col: str, *carried: Column) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(
        "id",
        F.xxhash64(text).alias("content"),
        F.coalesce(F.concat(F.lit("h"), F.col(f"`{host_col}`").cast("string")), F.lit("")).alias("host"),
        text.alias("text"),
        *carried,
    )


def _judged(rows: DataFrame, measured: DataFrame, max_docs: int, max_share: float, min_left: float) -> DataFrame:
    """``measured`` with ``n_removed_words``, ``kept`` and ``at``, the numbers of the lines that go."""
    checkpoint_root(rows.sparkSession)
    frequent = frequent_lines(rows, max_docs, max_share).checkpoint()
    small = frequent.count() <= BROADCAST_ROWS
    hits = _lines(rows).join(F.broadcast(frequent) if small else frequent, ["host", "line"], "left_semi")
    key = F.xxhash64("id", "host").alias("row")
    removed = (
        # Copies of a row meet in one document: each of its lines counts once.
        hits.groupBy(key, "content", "at").agg(F.max("n").alias("n"))
        .groupBy("row", "content").agg(F.sum("n").alias("n_removed_words"), F.collect_list("at").alias("at"))
        .checkpoint()
    )
    # A long document has a long list of places: they are counted, not the rows.
    places = removed.agg(F.sum(F.size("at") + 1)).first()[0] or 0
    side = F.broadcast(removed) if places <= BROADCAST_ROWS else removed
    out = measured.withColumn("row", F.xxhash64("id", "host")).join(side, ["row", "content"], "left")
    n_removed = F.coalesce("n_removed_words", F.lit(0)).cast("bigint")
    left = F.col("n_words") - n_removed >= min_left * F.col("n_words")
    return out.withColumn("n_removed_words", n_removed).withColumn("kept", ~F.col("base_failed") & left)


def kept_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_docs: int = 20,
    max_share: float = 0.01,
    min_left: float = 0.5,
) -> DataFrame:
    """The kept rows of ``docs`` with all their columns, frequent lines cut out of their texts."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("doc")
    named = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{host_col}`").alias("source"), whole)
    narrow = _rows(named.drop("doc"), "text", "source")
    rows = _rows(named, "text", "source", F.col("doc"))
    out = _judged(narrow, base_counts(rows), max_docs, max_share, min_left).filter("kept")
    lines = F.filter(F.split("text", "\n"), lambda line, i: ~F.array_contains("at", i))
    text = F.when(F.col("at").isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    return out.select(*[text.alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in docs.columns])
