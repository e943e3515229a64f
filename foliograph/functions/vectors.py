"""Vector expressions: hashed bag-of-words vectors, norms and unit vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: width of the hashed vector.
HASH_DIM = 384
HASHED = T.StructType([T.StructField(name, T.ArrayType(T.IntegerType())) for name in ("idx", "tf")])
# Texts whose tokens are told apart at a time, and texts counted at a time.
HASH_ROWS = 10_000
COUNTED_AT_ONCE = 500


def _digest_head(token: Column | str) -> Column:
    """First four bytes of the token's md5 digest as a number, first byte highest."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def _le_bucket(head: Column) -> Column:
    """The four bytes read little-endian, modulo the vector width."""
    swapped = F.lit(0)
    for at in range(4):
        swapped += F.shiftright(head, 24 - 8 * at).bitwiseAND(255) * (1 << 8 * at)
    return (swapped % HASH_DIM).cast("int")


def token_bucket(token: Column | str) -> Column:
    """Bucket of one lower-cased token."""
    return _le_bucket(_digest_head(token))


def _buckets(tokens: pa.Array) -> np.ndarray:
    """Bucket of each lower-cased token, -1 for an empty one; a digest is taken once per distinct token."""
    coded = tokens.dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    digests = b"".join([hashlib.md5(word, usedforsecurity=False).digest() for word in words])
    bucket = (np.frombuffer(digests, "<u4")[::4] % HASH_DIM).astype(np.int64)  # the first of four numbers
    bucket[[i for i, word in enumerate(words) if not word]] = -1
    return bucket[coded.indices.to_numpy()]


def _hashed(texts: pa.Array) -> pa.Array:
    """Token counts per bucket of lower-cased texts; Arrow's whitespace is that of ``py_words``."""
    tokens = pc.utf8_split_whitespace(texts.fill_null(""))
    bucket = _buckets(tokens.flatten())
    sizes = tokens.value_lengths().to_numpy()
    first = np.concatenate([[0], np.cumsum(sizes)])
    idx, tf, held = [], [], [np.zeros(1, np.int64)]
    for at in range(0, len(sizes), COUNTED_AT_ONCE):
        size = sizes[at : at + COUNTED_AT_ONCE]
        own = bucket[first[at] : first[at + len(size)]]
        cell = np.repeat(np.arange(len(size)) * HASH_DIM, size) + own
        counts = np.bincount(cell[own >= 0], minlength=len(size) * HASH_DIM)
        cell = np.flatnonzero(counts)
        idx.append((cell % HASH_DIM).astype(np.int32))
        tf.append(counts[cell].astype(np.int32))
        held.append(np.bincount(cell // HASH_DIM, minlength=len(size)))
    ends = pa.array(np.cumsum(np.concatenate(held)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(values))) for values in (idx, tf)]
    return pa.StructArray.from_arrays(lists, names=["idx", "tf"], mask=texts.is_null())


def with_hashed_vector(df: DataFrame, text_col: str, out: str = "embedding") -> DataFrame:
    """Add ``out = struct<idx: array<int>, tf: array<int>>``, the token count per bucket.

    A row's vector depends on that row alone, so nothing is shuffled: tasks
    count the tokens of Arrow batches, and a token's digest is taken once per
    batch, not once per occurrence.  Counts stay integers, which keeps cosine
    distances exact; ``unit_weights`` turns them into the L2-normalised form.
    """
    rows = df.drop(out)
    schema = T.StructType([*rows.schema.fields, T.StructField(out, HASHED)])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HASH_ROWS):
                *columns, texts = batch.slice(at, HASH_ROWS).columns
                yield pa.RecordBatch.from_arrays([*columns, _hashed(texts)], names=schema.names)

    # Spark's own lower case, so that tokens are those of ``token_bucket``.
    return rows.withColumn("_lower", F.lower(F.col(text_col))).mapInArrow(hashed, schema)


def sum_of_squares(values: Column | str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v)


def unit(values: Column | str) -> Column:
    """L2-normalised copy of an array of doubles; a zero vector stays zero."""
    col = (F.col(values) if isinstance(values, str) else values).cast("array<double>")
    norm = F.array_repeat(F.sqrt(sum_of_squares(col)), F.size(col))
    return F.zip_with(col, norm, lambda v, n: F.when(n > 0, v / n).otherwise(F.lit(0.0)))


def unit_weights(vector: Column | str) -> Column:
    """Weights of a hashed vector, aligned with its ``idx``."""
    col = F.col(vector) if isinstance(vector, str) else vector
    return unit(col["tf"])


def dense_vector(vector: Column | str) -> Column:
    """Hashed vector as ``HASH_DIM`` L2-normalised doubles."""
    col = F.col(vector) if isinstance(vector, str) else vector
    weights = F.map_from_arrays(col["idx"], unit_weights(col))
    return F.transform(
        F.sequence(F.lit(0), F.lit(HASH_DIM - 1)),
        lambda i: F.coalesce(F.try_element_at(weights, i), F.lit(0.0)),
    )


def postings(df: DataFrame, id_col: str, vector_col: str = "embedding") -> DataFrame:
    """Long form of hashed vectors: ``id, bucket, tf, weight``.

    The norm is a column of its own, so that counts alone do not cost it.
    """
    counts = F.col(f"{vector_col}.tf")
    entry = F.arrays_zip(F.col(f"{vector_col}.idx").alias("bucket"), counts.alias("tf"))
    norm = F.sqrt(sum_of_squares(counts.cast("array<double>")))
    rows = df.select(id_col, norm.alias("norm"), F.explode(entry).alias("p"))
    weight = F.when(F.col("norm") > 0, F.col("p.tf") / F.col("norm")).otherwise(F.lit(0.0))
    return rows.select(id_col, F.col("p.bucket").alias("bucket"), F.col("p.tf").alias("tf"), weight.alias("weight"))
