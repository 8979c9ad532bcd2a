"""DQ3 and PRJ4: row checks with rejects and a limit, and tables whose columns change.

The original stops at the first row that breaks a rule. Here one pass writes all rows, the
rejected ones beside the accepted, and counts them on the way (``DataFrame.observe``). The new
version is published only if the counts stay within the limit, so ``limit=0`` is the original's
fail-fast, with the offending rows kept to look at.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from histmill.sinks.versions import VersionedTable

REASONS = "reasons"


class RejectedRows(RuntimeError):
    """More rows broke a rule than allowed. ``counts`` by rule; ``version`` holds the rows."""

    def __init__(self, counts: dict[str, int], rows: int, version: str):
        super().__init__(f"{rows} rows rejected: " + ", ".join(f"{k} {n}" for k, n in counts.items() if n))
        self.counts, self.rows, self.version = counts, rows, version


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``reasons``: names of the rules (conditions that must hold) that a row breaks, in
    the order of ``rules``. A condition that is NULL is broken."""
    return df.withColumn(REASONS, F.array_compact(F.array(*[
        F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()])))


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected rows with their reasons)."""
    judged = with_reasons(df, rules)
    return judged.where(F.size(REASONS) == 0).drop(REASONS), judged.where(F.size(REASONS) > 0)


def write_checked(df: DataFrame, rules: Mapping[str, Column], table: VersionedTable,
                  limit: int | None = 0) -> dict[str, int]:
    """Write ``df`` as the next version of ``table``; returns the rejected rows by rule.

    More than ``limit`` rejected rows (None: any number is fine) raise ``RejectedRows`` and the
    version stays unpublished: the counts are checked before the pointer moves.
    """
    seen = Observation()
    judged = with_reasons(df, rules).withColumn("rejected", F.size(REASONS) > 0)
    counted = judged.observe(seen, F.count_if("rejected").alias("rejected"), *[
        F.count_if(F.array_contains(REASONS, name)).alias(f"rule_{k}") for k, name in enumerate(rules)])
    version = table.stage(counted)
    counts = {name: seen.get[f"rule_{k}"] for k, name in enumerate(rules)}
    if limit is not None and seen.get["rejected"] > limit:
        raise RejectedRows(counts, seen.get["rejected"], version)
    table.publish(version)
    return counts


def accepted(table: VersionedTable, version: str | None = None) -> DataFrame:
    return table.read(version).where(~F.col("rejected")).drop("rejected", REASONS)


def rejects(table: VersionedTable, version: str | None = None) -> DataFrame:
    return table.read(version).where("rejected").drop("rejected")


# --- tables whose columns change (PRJ4) ---------------------------------------------------------

def create_table(df: DataFrame, name: str, path: str) -> None:
    """A catalog table over a folder of its own."""
    df.write.format("parquet").option("path", path).saveAsTable(name)


def add_column(session: SparkSession, name: str, column: str, kind: str, default: str | None = None) -> None:
    """Add a column; rows already there read as ``default`` (an SQL literal) without being rewritten,
    and later inserts that leave it out take it."""
    tail = "" if default is None else f" DEFAULT {default}"
    session.sql(f"ALTER TABLE {name} ADD COLUMNS ({column} {kind}{tail})")


def rewrite(session: SparkSession, name: str, path: str, backfill: Mapping[str, Column] | None = None, drop: Sequence[str] = (),
            not_null: Sequence[str] = ()) -> None:
    """Backfill, drop and tighten columns of table ``name`` in one pass, into the new folder ``path``.

    ``backfill`` gives new values from the old row. A NULL in a ``not_null`` column fails the
    job inside that pass, and the table stays as it was: the catalog turns to the new folder
    only when all is written.
    """
    df = session.table(name)
    out = df.withColumns(dict(backfill or {})).drop(*drop)
    for column in not_null:
        missing = F.raise_error(F.lit(f"{name}.{column} is NULL")).cast(out.schema[column].dataType)
        out = out.withColumn(column, F.coalesce(F.col(column), missing))
    out.write.parquet(path)
    session.sql(f"DROP TABLE {name}")
    session.catalog.createTable(name, path, "parquet")
