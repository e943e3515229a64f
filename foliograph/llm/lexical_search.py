"""Ranked lexical search, term at a time with limited accumulators.

All documents are ranked for each of a set of queries.  A document's score is
the sum, over the query's terms with repeats, of

    w * ((10^9 tf) div (1000 tf + 12 m)),  m = 75 + (25 n N) div L

with ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``; ``N`` counts documents with
a term, ``L`` their terms, ``n`` one document's terms, ``df`` the documents that
hold the term and ``tf`` its occurrences in the document.

* Queries go through in blocks of about ``BLOCK_TERMS`` terms.  A block's terms
  are broadcast, each text is read once, and of each document its length and
  the counts of these terms are stored.  ``N``, ``L`` and the few thousand ``df``
  come from there by partial sums.
* Stored counts are searched shard by shard, up to ``SHARD_POSTINGS`` at a time.
  A query takes its terms rarest first; a shard's greatest contribution of each
  term bounds what the terms to come can add.  Once that is below the
  ``k``-th partial score (or the ``k``-th score of the task's earlier shards) no
  accumulator is created any more, and those that exist are updated to the end,
  so their scores are exact.
* A task sends at most ``k`` rows per query and shard, which meet in a ranking
  that drops all but ``k`` per task before its shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from foliograph.llm.textbytes import TERM_BYTES, hash_spans, lower_ascii, split_words, text_slices
from foliograph.session import scratch_path

BLOCK_TERMS = 200_000
SHARD_POSTINGS = 4_000_000
SHARD_DOCS = 1 << 16


def _text(name: str) -> Column:
    return F.col(f"`{name}`").cast("string").alias("text")


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms, and per text its first one."""
    data = lower_ascii(data)
    starts, ends, first = split_words(data, offsets, TERM_BYTES)
    return hash_spans(data, starts, ends), first


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, text -> item, terms (hashes as bytes)."""
    for batch in batches:
        for begin, last, data, offsets in text_slices(batch.column(1)):
            terms, first = _terms(data, offsets)
            held = [terms[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, last - begin), pa.array(held, pa.binary())], names=["item", "terms"]
            )


def _counts(batches: Iterator[pa.RecordBatch], known: np.ndarray) -> Iterator[pa.RecordBatch]:
    """id, text -> id, number of terms, places in ``known`` of the known ones and their counts (as bytes)."""
    for batch in batches:
        for begin, _, data, offsets in text_slices(batch.column(1)):
            terms, first = _terms(data, offsets)
            at = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
            held = np.flatnonzero(known[at] == terms) if len(known) else np.empty(0, np.int64)
            text = np.searchsorted(first, held, "right") - 1
            pair, tf = np.unique(text * max(len(known), 1) + at[held], return_counts=True)
            text, place = pair // max(len(known), 1), (pair % max(len(known), 1)).astype(np.int32)
            edge = np.searchsorted(text, np.arange(len(first)))
            rows = np.flatnonzero(np.diff(first))
            tf = tf.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows + begin)),
                    pa.array(np.diff(first)[rows]),
                    pa.array([place[edge[r] : edge[r + 1]].tobytes() for r in rows], pa.binary()),
                    pa.array([tf[edge[r] : edge[r + 1]].tobytes() for r in rows], pa.binary()),
                ],
                names=["id", "n", "terms", "tfs"],
            )


def _document_frequencies(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    held = np.zeros(size, np.int64)
    for batch in batches:
        held += np.bincount(_numbers(batch.column(0)), minlength=size)
    some = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["term", "df"])


def _numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32)


class Queries:
    """One block of queries: their items, and per query its distinct terms, rarest first, with repeats."""

    def __init__(self, items: pa.Array, terms: list[np.ndarray], known: np.ndarray, df: np.ndarray, docs: int, length: int, k: int):
        self.items, self.docs, self.length, self.k = items, docs, length, k
        self.weight = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * f + 1))) for f in df.tolist()], np.int64)
        self.terms = []
        for own in terms:
            at, times = np.unique(np.searchsorted(known, own), return_counts=True)
            order = np.argsort(df[at], kind="stable")
            order = order[df[at[order]] > 0]
            self.terms.append((at[order], times[order].astype(np.int64)))

    def normed(self, n: np.ndarray) -> np.ndarray:
        """``m`` per document."""
        if 25 * int(n.max(initial=0)) * self.docs < 1 << 63:
            return 75 + 25 * n * self.docs // self.length
        return np.array([75 + 25 * x * self.docs // self.length for x in n.tolist()], np.int64)


class Shard:
    """Contributions of a bounded set of documents by term."""

    def __init__(self, queries: Queries, n: np.ndarray, per_doc: np.ndarray, terms: np.ndarray, tf: np.ndarray):
        self.queries, self.size = queries, len(n)
        doc = np.repeat(np.arange(self.size), per_doc)
        order = np.argsort(terms, kind="stable")  # by term, then document
        terms, tf, self.doc = terms[order], tf[order].astype(np.int64), doc[order]
        m = queries.normed(n)
        self.gain = queries.weight[terms] * (1_000_000_000 * tf // (1000 * tf + 12 * m[self.doc]))
        self.edge = np.searchsorted(terms, np.arange(len(queries.weight) + 1))
        self.most = np.zeros(len(queries.weight), np.int64)
        some = np.flatnonzero(np.diff(self.edge))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.gain, self.edge[some])
        self.score = np.zeros(self.size, np.int64)

    def best(self, query: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and exact scores; holds all that are among the shard's best ``k`` and reach ``least``."""
        terms, times = self.queries.terms[query]
        k, score = self.queries.k, self.score
        score[:] = 0
        most = self.most[terms] * times
        seen = np.cumsum(most)  # bound of every partial score
        rest = seen[-1] - seen if len(seen) else seen  # bound of what is still to come
        survivors = None if len(seen) and seen[-1] >= least else np.empty(0, np.int64)
        for i, (term, repeat) in enumerate(zip(terms.tolist(), times.tolist())):
            docs, gain = (x[self.edge[term] : self.edge[term + 1]] for x in (self.doc, self.gain))
            if survivors is None:
                score[docs] += repeat * gain
                limit = least
                if rest[i] < seen[i] and self.size > k:
                    limit = max(limit, int(np.partition(score, self.size - k)[self.size - k]))
                if rest[i] < limit:
                    survivors = np.flatnonzero(score)
            elif len(survivors) * 16 < len(docs):
                at = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
                held = docs[at] == survivors
                score[survivors[held]] += repeat * gain[at[held]]
            else:
                held = score[docs] > 0
                score[docs[held]] += repeat * gain[held]
        found = np.flatnonzero(score >= max(least, 1))
        return found, score[found]


def _search(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[pa.RecordBatch]:
    """id, n, terms, tfs -> query, item, id, score."""
    least = np.zeros(len(queries.terms), np.int64)  # k-th score of the shards so far
    top = [np.empty(0, np.int64)] * len(queries.terms)
    held: list[pa.RecordBatch] = []
    docs = postings = 0

    def shard() -> pa.RecordBatch:
        ids = pa.concat_arrays([b.column(0) for b in held])
        place = np.empty(len(ids), np.int64)  # ids in order, nulls last
        place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        sizes = np.concatenate([pc.binary_length(b.column(2)).to_numpy(zero_copy_only=False) for b in held]) // 4
        n = np.concatenate([b.column(1).to_numpy() for b in held])
        one = Shard(queries, n, sizes, *(np.concatenate([_numbers(b.column(c)) for b in held]) for c in (2, 3)))
        query, row, score = [], [], []
        for q in range(len(queries.terms)):
            found, scores = one.best(q, int(least[q]))
            order = np.lexsort((place[found], -scores))[: queries.k]
            query.append(np.full(len(order), q))
            row.append(found[order])
            score.append(scores[order])
            top[q] = -np.sort(-np.concatenate([top[q], score[-1]]))[: queries.k]
            if len(top[q]) == queries.k:
                least[q] = top[q][-1]
        query, row, score = (np.concatenate([np.empty(0, np.int64), *x]) for x in (query, row, score))
        return pa.RecordBatch.from_arrays(
            [pa.array(query), queries.items.take(pa.array(query)), ids.take(pa.array(row)), pa.array(score)],
            names=["query", "item", "id", "score"],
        )

    for batch in batches:
        step = 4096
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            docs += part.num_rows
            postings += pc.sum(pc.binary_length(part.column(2))).as_py() // 4
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                yield shard()
                held, docs, postings = [], 0, 0
    if held:
        yield shard()


def _searched(docs: DataFrame, items: pa.Table, k: int, schema: T.StructType) -> DataFrame:
    """One block of queries against all documents: query, item, id, score."""
    spark = docs.sparkSession
    terms = [np.frombuffer(t, np.uint64) for t in items.column(1).to_pylist()]
    known = np.unique(np.concatenate([np.empty(0, np.uint64), *terms]))
    shared = spark.sparkContext.broadcast(known)
    path = scratch_path(spark, "term-counts")
    counts = T.StructType(
        [
            T.StructField("id", docs.schema["id"].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.BinaryType()),
            T.StructField("tfs", T.BinaryType()),
        ]
    )
    docs.mapInArrow(lambda b: _counts(b, shared.value), counts).write.parquet(path)
    stored = spark.read.parquet(path)
    total = stored.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    size = len(known)
    held = (
        stored.select("terms")
        .mapInArrow(lambda b: _document_frequencies(b, size), "term bigint, df bigint")
        .groupBy("term").agg(F.sum("df").alias("df"))
        .toArrow()  # at most one row per term of the block
    )
    df = np.zeros(size, np.int64)
    df[held.column("term").to_numpy()] = held.column("df").to_numpy()
    named = items.column(0).combine_chunks()
    queries = spark.sparkContext.broadcast(Queries(named, terms, known, df, total["docs"], total["length"], k))
    return stored.mapInArrow(lambda b: _search(b, queries.value), schema)


def ranked(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 20,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_col: str = "item_id",
    query_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``<query_col>, rank, <id_col>, score``: the ``k`` best documents with a score above 0 of each query.

    Equal scores rank by id, null ids last.  Terms are runs of digits, letters
    and characters outside ASCII after A-Z are lower-cased.  Null and empty
    texts hold no term: such a document is not counted and such a query gives
    no rows.  Every row of ``queries`` is a query and every row of ``docs`` a
    document of its own, also where ids repeat or are null.  Empty tables give
    no rows; other columns are not looked at.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = docs.sparkSession
    path = scratch_path(spark, "queries")
    item = F.col(f"`{query_col}`")
    kind = queries.schema[query_col].dataType
    asked = queries.select(item.alias("item"), _text(query_text_col))
    split = asked.mapInArrow(
        _query_terms, T.StructType([T.StructField("item", kind), T.StructField("terms", T.BinaryType())])
    )
    split.withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)
    total = stored.agg(F.coalesce(F.sum(F.octet_length("terms") / 8 + 1), F.lit(0.0)).cast("bigint")).first()[0]
    blocks = max(1, -(-total // block_terms))
    schema = T.StructType(
        [
            T.StructField("query", T.LongType()),
            T.StructField("item", kind),
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("score", T.LongType()),
        ]
    )
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), _text(text_col))
    found = None
    for block in range(blocks):
        held = stored.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("row").select("item", "terms").toArrow()
        if held.num_rows or found is None and block == blocks - 1:
            one = _searched(texts, held, k, schema).withColumn("block", F.lit(block))
            found = one if found is None else found.unionByName(one)
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select(F.col("item").alias(query_col), "rank", F.col("id").alias(id_col), "score")
