"""Equal-width density histograms per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def density_histogram(
    counts: DataFrame, group: str, value: str, count: str, bins: int = 30
) -> DataFrame:
    """Histogram between each group's own extremes, from counts per value.

    Bins are half open, the last one closed; a group with a single value gets
    a range of one around it.  Empty bins are kept.  The input is counted per
    value already, so its size does not follow the number of rows behind it;
    a value may come in several rows.
    """
    if bins < 1:
        raise ValueError("bins must be positive")
    counts = (
        counts.filter(F.col(value).isNotNull())
        .groupBy(group, F.col(value).cast("double").alias("_v"))
        .agg(F.sum(count).alias("_n"))
    )
    spread = F.when(F.col("_min") == F.col("_max"), F.lit(0.5)).otherwise(F.lit(0.0))
    ranges = (
        counts.groupBy(F.col(group).alias("_group"))
        .agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"), F.sum("_n").alias("_total"))
        .select("_group", "_total", (F.col("_min") - spread).alias("_lo"), (F.col("_max") + spread).alias("_hi"))
        .withColumn("_step", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    )

    def edge(i: Column) -> Column:
        return F.when(i == bins, F.col("_hi")).otherwise(i * F.col("_step") + F.col("_lo"))

    # The quotient can fall one bin beside the edges it is reported with.
    guess = F.least(
        F.floor((F.col("_v") - F.col("_lo")) * F.lit(float(bins)) / (F.col("_hi") - F.col("_lo"))),
        F.lit(bins - 1),
    ).cast("int")
    settled = (
        F.when(F.col("_v") < edge(F.col("_guess")), F.col("_guess") - 1)
        .when(
            (F.col("_guess") < bins - 1) & (F.col("_v") >= edge(F.col("_guess") + 1)),
            F.col("_guess") + 1,
        )
        .otherwise(F.col("_guess"))
    )
    per_bin = (
        counts.join(ranges, F.col(group).eqNullSafe(F.col("_group")))
        .withColumn("_guess", guess)
        .groupBy("_group", "_total", "_lo", "_hi", "_step", settled.alias("bin"))
        .agg(F.sum("_n").alias("_n"))
    )
    # At most ``bins`` entries per group: a map fills the empty ones.
    filled = per_bin.groupBy("_group", "_total", "_lo", "_hi", "_step").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "_n"))).alias("_bins")
    )
    n = F.coalesce(F.try_element_at("_bins", F.col("bin")), F.lit(0))
    left, right = edge(F.col("bin")), edge(F.col("bin") + 1)
    return filled.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        F.col("_group").alias(group),
        "bin",
        left.alias("left_edge"),
        right.alias("right_edge"),
        n.alias("row_count"),
        (n / (right - left) / F.col("_total")).alias("density"),
    )
