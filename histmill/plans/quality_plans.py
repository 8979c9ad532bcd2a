"""Row checks with rejects, replaced stage tables and changing columns."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from histmill.operators import quality as q
from histmill.plans.common import v
from histmill.plans.registry import query
from histmill.session import ensure_checkpoint_dir
from histmill.sinks.versions import VersionedTable


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Conditions that a file change has to meet before it can be matched.
CHANGE_RULES = {
    "index": "FCIndex is not null",
    "from level": "try_cast(RevisionLevelFrom as decimal(19,4)) is not null",
    "range": "try_cast(RevisionLevelFrom as decimal(19,4)) < try_cast(RevisionLevelTo as decimal(19,4))",
}


@query("reject_rows", oracle=f"""
with judged as (
  select TransmittalID, FCIndex, FileChanged, RevisionLevelFrom, RevisionLevelTo, concat_ws(',',
    {", ".join(f"case when not coalesce({rule}, false) then '{name}' end" for name, rule in CHANGE_RULES.items())}) as reasons
  from v_file_change)
select * from judged where reasons <> ''""")
def reject_rows(spark, sf):
    """DQ3: file changes that break a rule, written beside the accepted ones in one pass and read back."""
    changes = v(spark, sf, "v_file_change").select("TransmittalID", "FCIndex", "FileChanged", "RevisionLevelFrom",
                                                   "RevisionLevelTo")
    table = VersionedTable(spark, _folder(spark, "checked"))
    q.write_checked(changes, {name: F.expr(rule) for name, rule in CHANGE_RULES.items()}, table, limit=None)
    return q.rejects(table).withColumn("reasons", F.array_join("reasons", ","))


@query("replace_stage", oracle="""
select TransmittalID, count(*) as n from v_link group by TransmittalID having count(*) > 3""")
def replace_stage(spark, sf):
    """SNK3: a stage table replaced by a query that reads its own earlier version."""
    table = VersionedTable(spark, _folder(spark, "stage"))
    table.replace(v(spark, sf, "v_link").groupBy("TransmittalID").agg(F.count(F.lit(1)).alias("n")))
    table.replace(table.read().where("n > 3"))
    table.clean()
    return table.read()


@query("evolve_schema", oracle="""
with grown as (
  select ReleaseLev, ReleaseID, true as IsReleased, 'none' as HotfixLabel from v_release
  union all select distinct 'L9', '9.' || cast(p_size as varchar), true, 'none' from part)
select ReleaseLev, ReleaseID, IsReleased and ReleaseLev <> 'L9' as IsReleased,
  case when ReleaseID like '%Hotfix' then 'HotFix' else HotfixLabel end as HotfixLabel
from grown""")
def evolve_schema(spark, sf):
    """PRJ4: columns added with a default, filled, dropped and made not null."""
    name = f"release_{uuid.uuid4().hex}"
    q.create_table(v(spark, sf, "v_release"), name, _folder(spark, name))
    q.add_column(spark, name, "IsReleased", "boolean", "true")
    q.add_column(spark, name, "HotfixLabel", "string", "'none'")
    q.add_column(spark, name, "IsNew", "boolean", "false")
    v(spark, sf, "v_release")  # registers part
    spark.sql(f"INSERT INTO {name} (ReleaseLev, ReleaseID, IsNew) "
              "SELECT DISTINCT 'L9', '9.' || cast(p_size as string), true FROM part")
    path = _folder(spark, name)
    q.rewrite(spark, name, path, drop=["IsNew"], not_null=["ReleaseLev", "ReleaseID", "IsReleased"], backfill={
        "IsReleased": F.col("IsReleased") & ~F.col("IsNew"),
        "HotfixLabel": F.when(F.col("ReleaseID").like("%Hotfix"), "HotFix").otherwise(F.col("HotfixLabel"))})
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)
