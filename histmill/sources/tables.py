"""Table scans (SRC1).

Scans are lazy parquet reads; Catalyst prunes columns and pushes filters into
them, which replaces the hand-written column lists and appended ``where``
clauses of the original export. On a cluster the same helpers take a catalog
table name or a JDBC relation instead of a path.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None) -> DataFrame:
    """SRC1: scan one table, optionally with an explicit column list."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_tables(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> None:
    """Expose base tables to SQL under their own names."""
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)


def read_jdbc_table(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int,
                    partitions: int, properties: dict | None = None) -> DataFrame:
    """SRC1 against the live tracker database: a range-partitioned parallel JDBC scan."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=properties or {})
