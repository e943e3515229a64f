"""Paper records and questions derived from the driver's test tables.

The test tables hold no paper metadata.  This view gives every document the
shape of a paper record, with duplicate ids, blanks, short dates and odd
author lists spread over the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_RECORDS = """
    cast(doc_id - case when doc_id % 10 = 9 then 1 else 0 end as string) as id,
    case when doc_id % 29 = 0 then ' ' else substr(text, 1, 60) end as title,
    case when doc_id % 31 = 0 then null else text end as abstract,
    case when doc_id % 37 = 0 then ' , '
         when doc_id % 41 = 0 then ', Author 0'
         else 'Author ' || cast(doc_id % 43 as string)
              || case when doc_id % 2 = 0
                      then ', Author ' || cast((doc_id * 7) % 53 as string) else '' end
    end as authors,
    lang || '.' || source || '  x.' || cast(doc_id % 3 as string) as categories,
    case when doc_id % 23 = 0 then '2007-04-02'
         when doc_id % 47 = 0 then 'Mon, 2 Apr 2010x z'
         else 'Mon,  2 Apr ' || cast(2007 + doc_id % 17 as string) || ' 19:18:42 GMT'
    end as submitted,
    cast(2015 + doc_id % 5 as string) || '-01-01' as update_date,
    case when doc_id % 3 = 0 then source end as `journal-ref`,
    cast(null as string) as doi,
    cast(null as string) as comments
"""

_QUESTIONS = """
    item_id as id,
    text as question,
    case when item_id % 3 = 0 then 'en.src' || cast(item_id % 20 as string) end as category_filter,
    case when item_id % 11 = 10 then 'n/a'
         when item_id % 4 = 0 then cast(2007 + item_id % 17 as string) end as year_filter
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paper_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "documents"), _RECORDS)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "benchmark"), _QUESTIONS)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings")


def _select(table: DataFrame, columns: str) -> DataFrame:
    return table.sparkSession.sql(f"select {columns} from {{t}}", t=table)
