"""Catalog tables: full-refresh writes and presence checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliograph.plans.clean import clean_papers
from foliograph.plans.stats import STATISTICS, TABLE_ORDER
from foliograph.sources.files import names, remove

RAW_TABLE = "raw_papers"
CLEAN_TABLES = ("papers", *STATISTICS)


def replace_table(df: DataFrame, name: str, order: tuple[str, ...] = ()) -> None:
    """Write ``df`` as table ``name``, in ``order`` if given.

    Ordered tables are sorted by range, each file holding one stretch of keys.
    The rows go to a folder of their own, and the table is pointed to it once
    it is complete: a refresh that fails leaves the old rows, and queries that
    read these finish.  Folders before that of the old rows are deleted.
    """
    spark = df.sparkSession
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    database, table = name.split(".") if "." in name else (spark.catalog.currentDatabase(), name)
    root = f"{spark.catalog.getDatabase(database).locationUri}/{table}.versions"
    number = max([int(n) for n in names(spark, root) if n.isdigit()], default=0) + 1
    folder = f"{root}/{number:012d}"
    rows.write.parquet(folder)
    exists = spark.catalog.tableExists(name)
    before = _location(spark, name) if exists else ""
    if exists and spark.table(name).schema == spark.read.parquet(folder).schema:
        spark.sql(f"alter table {name} set location '{folder}'")
    else:
        spark.sql(f"drop table if exists {name}")
        spark.sql(f"create table {name} using parquet location '{folder}'")
    spark.catalog.refreshTable(name)
    for old in names(spark, root):
        if old.isdigit() and int(old) < number and not before.endswith(f"/{table}.versions/{old}"):
            remove(spark, f"{root}/{old}")


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"describe table extended {name}").filter("col_name = 'Location'").first()["data_type"]


def require_tables(spark: SparkSession, *names: str) -> None:
    missing = [name for name in names if not spark.catalog.tableExists(name)]
    if missing:
        raise RuntimeError(f"missing tables: {missing}; build the clean tables first")


def build_clean_tables(spark: SparkSession) -> None:
    """Refresh ``papers`` from the raw table, then the statistics from ``papers``."""
    require_tables(spark, RAW_TABLE)
    replace_table(clean_papers(spark.table(RAW_TABLE)), "papers")
    for name, statistics in STATISTICS.items():
        replace_table(statistics(spark.table("papers")), name, TABLE_ORDER[name])


def ensure_clean_tables(spark: SparkSession, rebuild: bool = False) -> None:
    """Nothing if all five tables are there; else rebuild them, or fail unless asked to."""
    if all(spark.catalog.tableExists(name) for name in CLEAN_TABLES):
        return
    if not rebuild:
        require_tables(spark, *CLEAN_TABLES)
    build_clean_tables(spark)


def papers_table(spark: SparkSession) -> DataFrame:
    require_tables(spark, "papers")
    return spark.table("papers")
