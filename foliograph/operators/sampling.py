"""Seeded samples of an exact size, without replacement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_DIGITS = 4  # hex digits settled per counting pass: at most 65,536 counts


def sample_key(df: DataFrame, seed: int) -> Column:
    """md5 over the seed and all columns, each with its length: only equal rows share a key."""
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def sample_rows(
    df: DataFrame,
    size: int | None = None,
    frac: float | None = None,
    seed: int = 42,
) -> DataFrame:
    """``size`` rows, or ``frac`` of the row count rounded half to even.

    The rows with the smallest keys are taken, so a seed always gives the same
    rows.  With neither option the input is returned unchanged.
    """
    if size is not None and frac is not None:
        raise ValueError("give a sample size or a sample fraction, not both")
    if frac is not None:
        if not 0 < frac <= 1:
            raise ValueError("sample fraction must be in the range (0, 1]")
        return _smallest(df, round(frac * df.count()), seed)
    if size is not None:
        if size <= 0:
            raise ValueError("sample size must be a positive integer")
        return _smallest(df, size, seed)
    return df


def _smallest(df: DataFrame, n: int, seed: int) -> DataFrame:
    """Finds the key prefix that holds the n-th row by counting rows per prefix.

    Whatever lies before it is in.  The prefix grows until its rows fit or it
    is a whole key: rows that share that are copies of one row, which is
    repeated as often as needed.  No row is ordered or moved.
    """
    columns = [f"`{c}`" for c in df.columns]
    if n == 0:
        return df.limit(0)
    keyed = df.withColumn("_key", sample_key(df, seed))
    keys = keyed.select("_key")
    prefix, need = "", n
    for width in range(_DIGITS, 32 + 1, _DIGITS):
        counts = (
            keys.filter(F.col("_key").startswith(prefix))
            .groupBy(F.substring("_key", 1, width).alias("p"))
            .agg(F.count("*").alias("c"))
            .orderBy("p")
            .collect()
        )
        for row in counts:
            if need <= row["c"]:
                break
            need -= row["c"]
        else:
            return df  # fewer rows than asked for
        prefix, inside = row["p"], row["c"]
        if need == inside:
            break
    head = F.substring("_key", 1, len(prefix))
    before = keyed.filter(head <= prefix if need == inside else head < prefix).select(*columns)
    if need == inside:
        return before
    copy = keyed.filter(F.col("_key") == prefix).limit(1).select(F.struct(*columns).alias("r")).scalar()
    return before.unionByName(df.sparkSession.range(need).select(copy.alias("r")).select("r.*"))
