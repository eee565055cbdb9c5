"""Inputs of the registered queries: the given tables, and rules made from them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ruleframe.session import fresh_path
from ruleframe.sources.rules import FILE_COLUMNS

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, text: str) -> None:
    """Temporary views of the tables that a SQL text names."""
    for name in set(TABLES).intersection(re.findall(r"\w+", text)):
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def sql_file(spark: SparkSession, text: str) -> str:
    """A SQL file in the shared folder; SQL steps take paths."""
    path = fresh_path(spark, "sql")
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.text(path)
    return path


# One rule per part. The select list is plain SQL that both engines understand, so the queries and
# their comparison text share it. Names repeat within a brand, levels run from 0 to 4.
PART_RULES = """
SELECT CAST(p_partkey + 1 AS INT) AS seq_no,
       p_name AS Name,
       p_brand AS TableName,
       concat('c', CAST(p_partkey % 40 AS STRING)) AS ColumnName,
       CASE p_size % 4 WHEN 0 THEN 'INT' WHEN 1 THEN 'DECIMAL(18,2)' WHEN 2 THEN 'varchar(10)'
                       ELSE 'DOUBLE' END AS DataType,
       concat(' ', CAST(p_size % 5 AS STRING), ' ') AS Level,
       CASE p_size % 3
         WHEN 0 THEN concat('c', CAST((p_partkey * 7) % 40 AS STRING), ' * 1.5e3 + sum(c',
                            CAST((p_partkey * 11) % 40 AS STRING), ') OVER (PARTITION BY c',
                            CAST(p_size % 40 AS STRING), ')')
         WHEN 1 THEN concat('CASE WHEN C', CAST((p_partkey * 13) % 40 AS STRING),
                            ' BETWEEN 1 AND 10L THEN ''c1 is it'' ELSE NULL END')
         ELSE concat('datediff(current_date, ', split_part(p_name, ' ', 1),
                     ') + c', CAST((p_partkey * 3) % 40 AS STRING)) END AS Expression,
       p_type AS OracleDataType,
       'part' AS SourceTable,
       '1' AS Version
FROM part
"""

# The same with faults: blank names, types without a length, levels that are no number.
FAULTY_PART_RULES = f"""
SELECT seq_no, Name, TableName,
       CASE WHEN seq_no % 17 = 0 THEN ' ' ELSE ColumnName END AS ColumnName,
       CASE WHEN seq_no % 19 = 0 THEN 'VARCHAR' ELSE DataType END AS DataType,
       CASE WHEN seq_no % 23 = 0 THEN '1+2' ELSE Level END AS Level,
       CASE WHEN seq_no % 29 = 0 THEN NULL ELSE Expression END AS Expression,
       OracleDataType, SourceTable, Version
FROM ({PART_RULES}) AS r
"""

# Rules without any problem: every name once, level 0 first, later levels use level 0 only.
SOUND_PART_RULES = """
SELECT CAST(p_partkey + 1 AS INT) AS seq_no,
       p_type AS Name,
       'flat_part' AS TableName,
       concat('"col', CAST(p_partkey AS STRING), '"') AS ColumnName,
       'DOUBLE' AS DataType,
       CASE WHEN p_partkey % 2 = 0 THEN '0' ELSE '2' END AS Level,
       CASE WHEN p_partkey % 2 = 0 THEN 'p_retailprice'
            ELSE concat('"col', CAST(p_partkey - 1 AS STRING), ' * ', CAST(p_size AS STRING), '"')
       END AS Expression,
       CAST(NULL AS STRING) AS OracleDataType,
       'part' AS SourceTable,
       '1' AS Version
FROM part
"""


def rules_from(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Rules selected from the part table by one of the texts above."""
    register_tables(spark, sf_dir, text)
    return spark.sql(text)


def rules_file(spark: SparkSession, rules: DataFrame) -> str:
    """The rules as a tab-separated file with a header, without their numbers."""
    path = fresh_path(spark, "rules")
    rules.select(*FILE_COLUMNS).write.csv(path, sep="\t", header=True)
    return path
