"""Sinks (SNK1-SNK8). Every writer is a distributed DataFrame write; ordered
text outputs carry their sort key and are written with a global ``orderBy``
(range-partitioned, so no single task holds the whole document)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmill.sinks.versions import VersionedTable


def write_stage(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK3/SNK4: create or replace a stage table (as the next version of
    ``sinks.versions.VersionedTable``, so that a failed write leaves the old one; read it with
    ``read_stage``), or append to a plain parquet folder."""
    if mode == "overwrite":
        VersionedTable(df.sparkSession, path).replace(df)
    else:
        df.write.mode(mode).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a stage table."""
    return VersionedTable(spark, path).read()


def write_by_group(df: DataFrame, path: str, group_col: str = "ImportGroup",
                   max_records_per_file: int = 5_000_000) -> None:
    """SNK8: one output folder per import group in a single job.

    Rows are not regrouped before the write (a group holding a third of the data
    would otherwise be written by one task): every task writes its share of each
    group, and files are capped at ``max_records_per_file`` rows."""
    (df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(group_col).parquet(path))


def write_issue_documents(docs: DataFrame, path: str) -> None:
    """SNK1: one canonical JSON document per line, ordered by external id (as text)."""
    docs.orderBy(F.col("externalId").cast("string")).select("json").write.mode("overwrite").text(path)


def write_lines(lines: DataFrame, path: str, order: tuple[str, ...] = ("seq", "key")) -> None:
    """SNK5/SNK6: a text document stored as ordered lines (header, body, footer)."""
    lines.orderBy(*order).select("line").write.mode("overwrite").text(path)


def write_users_csv(users: DataFrame, path: str) -> None:
    """SNK2: name,email,fullname,active,group1,group2 with proper quoting, sorted by name."""
    (users.orderBy("name").select("name", "email", "fullname", "active", "group1", "group2")
     .write.mode("overwrite").option("header", True).csv(path))


def write_report(report: DataFrame, path: str) -> None:
    """SNK7: reconciliation report ComponentId,ComponentName,Assignee,Result."""
    (report.select("ComponentId", "ComponentName", "Assignee", "Result")
     .write.mode("overwrite").option("header", True).csv(path))


#: Non-ASCII characters are written as escapes in every part of the import document.
ASCII = {"writeNonAsciiCharacterAsCodePoint": "true"}


def write_import(path: str, issue_docs: DataFrame, users: DataFrame, components: DataFrame, versions: DataFrame,
                 links: DataFrame, project_name: str, project_key: str) -> None:
    """SNK1 + CMP7: the import as four outputs under ``path``: ``issues/`` (one canonical
    JSON document per issue, ordered by external id), ``users/`` (sorted by name),
    ``links/`` and ``project/`` (name, key, sorted components and versions). Each is a
    distributed write; nothing is assembled into a single value."""
    write_issue_documents(issue_docs, f"{path}/issues")
    user_doc = F.to_json(F.struct(*[F.col(c) for c in sorted(users.columns) if c != "user_key"]), ASCII)
    users.orderBy("name").select(user_doc.alias("json")).write.mode("overwrite").text(f"{path}/users")
    link_doc = F.to_json(F.struct("destinationId", "name", "sourceId"), ASCII)
    links.select(link_doc.alias("json")).write.mode("overwrite").text(f"{path}/links")
    comps = components.select(F.lit(0).alias("seq"), F.col("name"))
    vers = versions.select(F.lit(1).alias("seq"), F.col("name"))
    head = components.sparkSession.createDataFrame([(project_name, project_key)], "pname string, pkey string")
    rows = comps.unionByName(vers).orderBy("seq", "name").select(
        F.when(F.col("seq") == 0, F.lit("component")).otherwise(F.lit("version")).alias("kind"), "name")
    head.write.mode("overwrite").options(**ASCII).json(f"{path}/project/header")
    rows.write.mode("overwrite").options(**ASCII).json(f"{path}/project/entries")
