"""Order-dependent computations that stay distributed (WIN3, WIN4).

A window without ``partitionBy`` runs in one task, and a window partitioned by
a hot key sorts that whole group in one task. Both are replaced here by a
two-phase scheme:

1. range-partition the rows on the full ordering key (a hot group spans many
   partitions) and write them to the reliable checkpoint folder, so partition
   ids stay stable if an executor is lost and the stage is recomputed. The table
   is bucketed by partition id, as the rows already lie;
2. compute per-partition local results with ordinary windows partitioned by
   the partition id (bounded by the partition size), which shuffle nothing;
3. build a per-partition summary (one row per non-empty partition, so its size
   is bounded by the partition count, not by the data) that carries counts and
   boundary rows forward, and broadcast it back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histmill.session import stage_as_dealt

PID = "_pid"
POS = "_pos"

def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in names]


def stage_by_range(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """Range-partition on ``order``, tag partition id and local position, write as a stage table."""
    staged = _range_table(df, order, partitions)
    w = Window.partitionBy(PID).orderBy(*_cols(order))
    return staged.withColumn(POS, F.row_number().over(w))


def _range_table(df: DataFrame, order: Sequence[str | Column], partitions: int | None = None) -> DataFrame:
    """The stage table of ``stage_by_range``: partition ids without positions."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_name = all(isinstance(c, str) for c in order)
    return stage_as_dealt(df.repartitionByRange(n, *_cols(order)).withColumn(PID, F.spark_partition_id()), PID, n,
                          tuple(dict.fromkeys(order)) if by_name else ())


def _partition_offsets(staged: DataFrame) -> DataFrame:
    """(_pid, _before): number of rows in all earlier partitions (tiny table)."""
    counts = staged.groupBy(PID).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(PID, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before"))


def global_row_number(staged: DataFrame, out_col: str) -> DataFrame:
    """Row number in the global order of a range-staged frame."""
    offsets = _partition_offsets(staged)
    return (staged.join(F.broadcast(offsets), PID)
            .withColumn(out_col, F.col(POS) + F.col("_before")).drop("_before"))


def _handed_over(summary: DataFrame, running: Column, out_col: str) -> DataFrame:
    """(_pid, _first_g, out_col): ``running`` over the earlier partitions whose last group is
    the first group of this one.

    Those partitions lie side by side just before it, so it is the running value at the
    nearest earlier partition, if that one ends in the same group: two windows over the
    summary, which has one row per partition, and no join of it with itself.
    """
    same = Window.partitionBy("_last_g").orderBy(PID).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy(PID)
    return (summary.withColumn("_upto", running.over(same))
            .withColumn("_prev_g", F.lag("_last_g").over(before)).withColumn("_prev", F.lag("_upto").over(before))
            .select(PID, "_first_g", F.when(F.col("_prev_g").eqNullSafe(F.col("_first_g")), F.col("_prev"))
                    .alias(out_col)))


def grouped_running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], value: Column,
                        out_col: str, partitions: int | None = None) -> DataFrame:
    """``sum(value) over (partition by group order by order rows unbounded preceding)``
    that tolerates a hot group (one group may span many partitions).

    Rows are range-partitioned on (group, order). Inside a partition the local
    sum restarts per group run; a group continued from earlier partitions is
    always the first group of its partition, so it gets a carry equal to its
    total in earlier partitions, read from the per-partition summary (one row
    per partition). NULL group keys form one group, as in SQL.
    """
    staged = stage_by_range(df.withColumn("_val", value), [*group, *order], partitions)
    gkey = F.struct(*[F.col(g) for g in group])
    # same window spec as the staging step: no new exchange, only a local sort
    w = Window.partitionBy(PID).orderBy(POS)
    run_start = F.when(F.lag(gkey).over(w).eqNullSafe(gkey), F.lit(None)).otherwise(F.col(POS))
    local = (staged.withColumn("_gkey", gkey).withColumn("_start", run_start)
             .withColumn("_run", F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("_local", F.sum("_val").over(Window.partitionBy(PID, "_run").orderBy(POS)
                                                      .rowsBetween(Window.unboundedPreceding, 0)))
             .drop("_start", "_run"))
    summary = local.groupBy(PID).agg(
        F.min_by("_gkey", POS).alias("_first_g"),
        F.max_by("_gkey", POS).alias("_last_g"),
        F.max_by("_local", POS).alias("_last_sum"),
    )
    offsets = _handed_over(summary, F.sum("_last_sum"), "_carry").withColumn(
        "_carry", F.coalesce("_carry", F.lit(0)))
    out = local.join(F.broadcast(offsets), PID)
    out = out.withColumn(out_col, F.col("_local")
                         + F.when(F.col("_gkey").eqNullSafe(F.col("_first_g")), F.col("_carry")).otherwise(0))
    return out.drop("_val", "_local", "_gkey", "_first_g", "_carry", PID, POS)


def with_group_first(df: DataFrame, group: Sequence[str], order: Sequence[str], out_col: str,
                     partitions: int | None = None) -> DataFrame:
    """``df`` with the struct of the ``order`` columns of its group's first row, tolerating a hot group.

    The first of the group in the range partition, or, for a group continued from earlier
    partitions, the first where it began, from the per-partition summary. Every row is moved
    once. NULL group keys form one group.
    """
    staged = _range_table(df, [*group, *order], partitions)
    gkey = F.struct(*[F.col(g) for g in group])
    rest = [c for c in order if c not in group]
    run = Window.partitionBy(PID, *group).rowsBetween(Window.unboundedPreceding, 0)
    run = run.orderBy(*_cols(rest)) if rest else run.orderBy(F.lit(0))
    local = staged.withColumn("_gkey", gkey).withColumn("_local", F.first(F.struct(*order)).over(run))
    summary = local.groupBy(PID).agg(F.min("_gkey").alias("_first_g"), F.max("_gkey").alias("_last_g"),
                                     F.max_by("_local", "_gkey").alias("_last_first"))
    begun = _handed_over(summary, F.first("_last_first"), "_carry")
    out = local.join(F.broadcast(begun), PID)
    earlier = F.when(F.col("_gkey").eqNullSafe(F.col("_first_g")), F.col("_carry"))
    return out.withColumn(out_col, F.coalesce(earlier, F.col("_local"))).drop("_local", "_gkey", "_first_g", "_carry", PID)


def grouped_row_number(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], out_col: str,
                       partitions: int | None = None) -> DataFrame:
    """``row_number() over (partition by group order by order)`` that tolerates a hot group."""
    out = grouped_running_sum(df, group, order, F.lit(1), out_col, partitions)
    return out.withColumn(out_col, F.col(out_col).cast("int"))


def global_islands(df: DataFrame, order: Sequence[str | Column], opens_island, carry_cols: Sequence[str],
                   out_col: str, start: int = 1, partitions: int | None = None) -> DataFrame:
    """Gap-and-island numbering in one global order (WIN4).

    ``opens_island(prev: dict[str, Column], cur: dict[str, Column]) -> Column``
    decides whether a row starts a new island given the previous row's
    ``carry_cols``; the island number is ``start`` plus the number of openings
    up to and including the row. The previous row of a partition's first row
    is the last row of the nearest earlier non-empty partition.
    """
    staged = stage_by_range(df, order, partitions)
    w = Window.partitionBy(PID).orderBy(POS)
    prev = {c: F.lag(c).over(w) for c in carry_cols}
    with_prev = staged.select("*", *[p.alias(f"_prev_{c}") for c, p in prev.items()])
    # last row of each partition, to seed the first row of the next one
    lasts = staged.groupBy(PID).agg(*[F.max_by(c, POS).alias(f"_last_{c}") for c in carry_cols])
    wl = Window.orderBy(PID)
    seeds = lasts.select(PID, *[F.lag(f"_last_{c}").over(wl).alias(f"_seed_{c}") for c in carry_cols])
    joined = with_prev.join(F.broadcast(seeds), PID)
    first = F.col(POS) == 1
    prev_cols = {c: F.when(first, F.col(f"_seed_{c}")).otherwise(F.col(f"_prev_{c}")) for c in carry_cols}
    cur_cols = {c: F.col(c) for c in carry_cols}
    flagged = joined.withColumn("_open", F.when(opens_island(prev_cols, cur_cols), 1).otherwise(0))
    flagged = flagged.drop(*[f"_prev_{c}" for c in carry_cols], *[f"_seed_{c}" for c in carry_cols])
    w_run = Window.partitionBy(PID).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    local = flagged.withColumn("_run", F.sum("_open").over(w_run))
    totals = local.groupBy(PID).agg(F.sum("_open").alias("_opens"))
    wt = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(PID, F.coalesce(F.sum("_opens").over(wt), F.lit(0)).alias("_carry"))
    out = local.join(F.broadcast(carry), PID).withColumn(out_col, F.lit(start) + F.col("_carry") + F.col("_run"))
    return out.drop("_open", "_run", "_carry", PID, POS)


def running_max(df: DataFrame, order: Sequence[str | Column], value: str, out_col: str,
                partitions: int | None = None) -> DataFrame:
    """``max(value) over (order by order rows unbounded preceding)`` in one global order: a local
    running maximum per range partition, and the maximum of all earlier partitions from the
    per-partition summary. NULL until the first value."""
    staged = stage_by_range(df, order, partitions)
    upto = Window.partitionBy(PID).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.withColumn("_local", F.max(value).over(upto))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = staged.groupBy(PID).agg(F.max(value).alias("_top")).select(PID, F.max("_top").over(before).alias("_carry"))
    out = local.join(F.broadcast(carry), PID)
    return out.withColumn(out_col, F.greatest("_local", "_carry")).drop("_local", "_carry", PID, POS)


def forward_fill(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], value_col: str, out_col: str,
                 partitions: int | None = None) -> DataFrame:
    """``last(value, ignorenulls) over (partition by group order by order rows unbounded preceding)``
    without sending a whole group (or, with no group, the whole input) to one task (WIN5).

    Inside a range partition the fill is local; the first group of a partition
    is seeded with the last non-null value of the same group in the nearest
    earlier partition that has one (read from the per-partition summary).
    """
    staged = stage_by_range(df, [*group, *order], partitions)
    gkey = F.struct(*[F.col(g) for g in group]) if group else F.struct(F.lit(0).alias("_all"))
    w = Window.partitionBy(PID).orderBy(POS)
    run_start = F.when(F.lag(gkey).over(w).eqNullSafe(gkey), F.lit(None)).otherwise(F.col(POS))
    local = (staged.withColumn("_gkey", gkey).withColumn("_start", run_start)
             .withColumn("_run", F.max("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    w_run = Window.partitionBy(PID, "_run").orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    local = local.withColumn("_fill", F.last(value_col, ignorenulls=True).over(w_run))
    summary = local.groupBy(PID).agg(F.min_by("_gkey", POS).alias("_first_g"), F.max_by("_gkey", POS).alias("_last_g"),
                                     F.max_by("_fill", POS).alias("_last_v"))
    seeds = _handed_over(summary, F.last("_last_v", ignorenulls=True), "_seed")
    out = local.join(F.broadcast(seeds), PID)
    seeded = F.when(F.col("_gkey").eqNullSafe(F.col("_first_g")), F.col("_seed"))
    out = out.withColumn(out_col, F.coalesce(F.col("_fill"), seeded))
    return out.drop("_gkey", "_start", "_run", "_fill", "_first_g", "_seed", PID, POS)
