"""Vectors of an external model kept by the texts' content, so that no text is sent twice."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from foliograph.operators.batch_infer import batch_infer
from foliograph.session import kept

# Keys up to which a batch is broadcast to the scan of the cache, instead of
# shuffling all cached keys.
BROADCAST_KEYS = 200_000


class VectorCache:
    """``key`` (the text's SHA-256) and ``vector`` under a folder on shared storage, one folder per model.

    Every run adds a folder of its own.  Two runs at a time may both ask for a
    text; one of the vectors is used.
    """

    def __init__(self, spark: SparkSession, root: str, model: str) -> None:
        if not model or "/" in model or model.startswith((".", "_")):
            raise ValueError(f"not a name for a model's vectors: {model!r}")
        self.spark, self.path = spark, f"{root.rstrip('/')}/{model}"

    def stored(self) -> DataFrame:
        """``key, vector``; a key may occur twice."""
        schema = "key string, vector array<double>"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/*")
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], schema)
            raise

    def _known(self, keys: DataFrame, columns: list[str], broadcast_keys: int) -> DataFrame:
        """Cached rows with these keys, one per key; ``keys`` is kept."""
        wanted = F.broadcast(keys) if keys.count() <= broadcast_keys else keys
        return self.stored().select(*columns).join(wanted, "key", "left_semi").dropDuplicates(["key"])

    def infer(
        self,
        df: DataFrame,
        text_col: str,
        factory: Callable[[], Callable],
        *,
        out: str = "embedding",
        broadcast_keys: int = BROADCAST_KEYS,
        **options,
    ) -> DataFrame:
        """Add ``out`` and ``error`` as ``batch_infer`` does; the model sees each text not cached yet once.

        ``df`` is read three times and should be stored, if it is dear.  Texts of like length share a request.  Failures are not cached; a null
        text has neither vector nor error.
        """
        if {"key", out, "error"} & set(df.columns):
            raise ValueError(f"columns key, {out} and error must not be there")
        keyed = df.withColumn("key", F.sha2(text_col, 256))
        keys = kept(keyed.select("key").filter(F.col("key").isNotNull()).distinct())
        known = self._known(keys, ["key"], broadcast_keys)
        missing = kept(keys.join(known, "key", "left_anti"))
        texts = keyed.select("key", F.col(text_col).alias("text"))
        if missing.count() <= broadcast_keys:
            texts = texts.join(F.broadcast(missing), "key", "left_semi")
        else:
            texts = texts.join(missing, "key", "left_semi")
        asked = texts.dropDuplicates(["key"]).sortWithinPartitions(F.length("text"), "key")
        folder = f"{self.path}/{uuid.uuid4().hex}"
        made = kept(batch_infer(asked, "text", factory, out="vector", **options).drop("text"))
        made.filter(F.col("error").isNull()).select("key", "vector").write.parquet(folder)
        failed = made.filter(F.col("error").isNotNull()).select("key", F.lit(None).cast("array<double>").alias("vector"), "error")
        vectors = self._known(keys, ["key", "vector"], broadcast_keys).withColumn("error", F.lit(None).cast("string"))
        answers = vectors.unionByName(failed).withColumnRenamed("vector", out)
        schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType())), T.StructField("error", T.StringType())])
        return keyed.join(answers, "key", "left").select(*schema.names)
