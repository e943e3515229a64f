"""Delimited paper records."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foliograph.plans.clean import RAW_COLUMNS
from foliograph.sources.records import split_records

# Texts read as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def validate_columns(df: DataFrame) -> None:
    """Raise with the full list of required columns that are absent."""
    missing = [name for name in RAW_COLUMNS if name not in df.columns]
    if missing:
        raise ValueError(f"missing required input columns: {missing}")


# The rules of a record; a quote inside a quoted text is doubled.
_RULES = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_ragged",
}


def _header(records: DataFrame) -> list[str]:
    """Column names of the first record of every file, which must be the same."""
    heads = records.filter(F.col("line") == 1).groupBy("text").agg(F.min("file").alias("file"), F.count("*").alias("n"))
    found = heads.orderBy(F.desc("n"), "text").limit(2).collect()
    if not found:
        return []
    if len(found) > 1:
        raise ValueError(f"the header of {found[1]['file']} is not that of {found[0]['file']}")
    names = next(csv.reader(io.StringIO(found[0]["text"].removeprefix("\ufeff"), newline="")))
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns occur twice in the header: {twice}")
    return names


def read_records(spark: SparkSession, path: str, multi_line: bool = True, rejects: str | None = None) -> DataFrame:
    """Comma-separated files with a header and quoted multi-line texts.

    All columns are strings: identifiers such as ``0704.0010`` keep their
    zeros.  Every file has the same header.  A file is read by many tasks, also
    where texts hold line breaks; ``multi_line=False`` says that none does.

    A record with more or fewer fields than the header is an error that names
    its file and line.  With ``rejects``, a folder, such records are written
    there as ``file, line, record`` instead, and the others returned.
    """
    records = split_records(spark, path, multi_line)
    names = _header(records)
    missing = [name for name in RAW_COLUMNS if name not in names]
    if missing:
        raise ValueError(f"missing required input columns: {missing}")
    fields = ", ".join([*(f"c{i} string" for i in range(len(names))), "_ragged string"])
    rows = records.filter(F.col("line") > 1).select("file", "line", "text", F.from_csv("text", fields, _RULES).alias("r"))
    if rejects is not None:
        bad = rows.filter(F.col("r._ragged").isNotNull())
        bad.select("file", "line", F.col("text").alias("record")).write.mode("overwrite").parquet(rejects)
        rows = rows.filter(F.col("r._ragged").isNull())
        checked = F.col
    else:
        where = F.format_string("line %s of %s has not the fields of the header", "line", "file")

        def checked(name: str) -> Column:
            return F.when(F.col("r._ragged").isNull(), F.col(name)).otherwise(F.raise_error(where).cast("string"))

    values = {name: checked(f"r.c{names.index(name)}") for name in RAW_COLUMNS}
    return rows.select(*[F.when(~v.isin(*NULL_TOKENS), v).alias(name) for name, v in values.items()])


def write_records(records: DataFrame, path: str) -> None:
    """Comma-separated files that ``read_records`` gives back unchanged."""
    (
        records.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
