"""Import scope: the closure of defects and fixes to migrate (FIX1, FIX2, FLT2, SRT3, DQ1).

Releases are processed in list order; the first release that reaches an id
owns it. Per release: its fixes are seeds, its defects with no link to any fix
of a listed release are seeds, then defect and fix expansion alternate until
a round adds nothing. Fixes expand only into listed releases; defects into
every release that has a catalog row.

The loop is semi-naive and needs no table of what was reached before. Defects and fixes are the
two sides of an undirected graph (nodes without a catalog row, and fixes of releases that are not
listed, are not in it), so rounds are the levels of a breadth-first search, and a link joins two
successive levels: what a frontier links to is either new or in the level just before it. Each
round therefore anti-joins one level, whose size does not grow with the rounds done. The closure
of a release is closed under links, so a later release's search never meets it; only its seeds
are held against all earlier rows. The inherited branch and version of a defect (the max over its
included fixes) is the max over the frontier that first reached it.

Links of listed fixes are staged twice, bucketed by fix and by defect, and nodes bucketed by id, so a round
shuffles its frontier and never the graph. Rounds are written to one folder, a subfolder each,
which cuts the lineage and survives executor loss; the only driver round-trip is the emptiness
test, and the result is one scan of the folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmill.functions import codes
from histmill.functions.text import ci
from histmill.session import broadcast_by_measure, ensure_checkpoint_dir, forget_bucketed, stage_bucketed

CLOSURE = ("kind", "id", "ImportGroup", "Branch", "Version", "round")
CLOSURE_SCHEMA = "kind string, id long, ImportGroup string, Branch string, Version string, round int"


def _nodes(defects: DataFrame, fixes: DataFrame, catalog: DataFrame, listed: Sequence[str],
           inherit_version: str | None) -> tuple[DataFrame, DataFrame]:
    c = catalog.select("ReleaseLev", "ReleaseID", "JIRABranch", "AffectsVersion", "FixedVersion")
    fix_nodes = (fixes.where(F.col("ReleaseLev").isin(*listed))
                 .select("TransmittalId", F.col("ReleaseLev").alias("_lev"), "RlsLevelTarget", "WaitingOn")
                 .join(c, (ci(F.col("_lev")) == ci(F.col("ReleaseLev"))) & (ci(F.col("RlsLevelTarget")) == ci(F.col("ReleaseID"))))
                 .select(F.col("TransmittalId").cast("long").alias("fix"), F.col("_lev").alias("rel"),
                         F.col("JIRABranch").alias("f_branch"),
                         F.when(F.col("WaitingOn").isin(*codes.WAITING_DONE), F.col("FixedVersion"))
                         .otherwise(F.col("JIRABranch")).alias("f_version")))
    own = F.col("Release").isin(*listed)
    if inherit_version is not None:
        own = own & (ci(F.col("Version")) != ci(F.lit(inherit_version)))
    defect_nodes = (defects.select("SDRNum", "Release", "Version")
                    .join(c, (ci(F.col("Release")) == ci(F.col("ReleaseLev"))) & (ci(F.col("Version")) == ci(F.col("ReleaseID"))))
                    .select(F.col("SDRNum").cast("long").alias("sdr"), F.col("Release").alias("rel"),
                            F.col("JIRABranch").alias("d_branch"), F.col("AffectsVersion").alias("d_version"),
                            F.coalesce(own, F.lit(False)).alias("own")))
    return defect_nodes, fix_nodes


def closure_issues(links: DataFrame, defects: DataFrame, fixes: DataFrame, catalog: DataFrame,
                   releases: Sequence[str], inherit_version: str | None = None) -> DataFrame:
    """FIX1 + FIX2: the ReleaseIssues table as rows (kind 'sdr'|'fix', id, ImportGroup, Branch, Version, round)."""
    spark = links.sparkSession
    broadcast_by_measure(spark)  # a level of millions of ids is a few MB of files
    listed = list(releases)
    defect_nodes, fix_nodes = _nodes(defects, fixes, catalog, listed, inherit_version)
    defect_nodes, fix_nodes = stage_bucketed(defect_nodes, "sdr"), stage_bucketed(fix_nodes, "fix")
    listed_fix_ids = fixes.where(F.col("ReleaseLev").isin(*listed)).select(
        F.col("TransmittalId").cast("long").alias("_lf"))
    # a link of any other fix is never followed and keeps no defect from being a seed
    lk = (links.select(F.col("TransmittalID").cast("long").alias("l_fix"), F.col("SDR_Num").cast("long").alias("l_sdr"))
          .distinct().join(listed_fix_ids, F.col("l_fix") == F.col("_lf"), "left_semi"))
    by_fix = stage_bucketed(lk, "l_fix")
    by_sdr = stage_bucketed(by_fix, "l_sdr")

    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/closure-{uuid.uuid4().hex}"
    steps = 0

    def write(df: DataFrame) -> DataFrame:
        nonlocal steps
        steps += 1
        path = f"{folder}/step={steps}"
        df.select(*CLOSURE).write.parquet(path)
        return spark.read.schema(df.select(*CLOSURE).schema).parquet(path)

    def ids(df: DataFrame, kind: str) -> DataFrame:
        return df.where(F.col("kind") == kind).select(F.col("id").alias("_inc"))

    earlier: list[DataFrame] = []  # whole releases
    for release in listed:
        first = steps

        def seeds(nodes: DataFrame, node: str, kind: str, branch: str, version: str) -> DataFrame:
            new = nodes.where(F.col("rel") == release)
            for done in earlier:
                new = new.join(ids(done, kind), F.col(node) == F.col("_inc"), "left_anti")
            return new.select(F.lit(kind).alias("kind"), F.col(node).alias("id"), F.col("rel").alias("ImportGroup"),
                              F.col(branch).alias("Branch"), F.col(version).alias("Version"), F.lit(0).alias("round"))

        frontier = write(seeds(fix_nodes, "fix", "fix", "f_branch", "f_version"))
        alone = defect_nodes.join(by_sdr, F.col("sdr") == F.col("l_sdr"), "left_anti")
        write(seeds(alone, "sdr", "sdr", "d_branch", "d_version"))
        before, rnd = None, 0
        while not frontier.isEmpty():
            rnd += 1
            reached = (frontier.select(F.col("id").alias("_ff"), F.col("Branch").alias("_fb"),
                                       F.col("Version").alias("_fv"))
                       .join(by_fix, F.col("_ff") == F.col("l_fix"))
                       .groupBy("l_sdr").agg(F.max("_fb").alias("_mb"), F.max("_fv").alias("_mv"))
                       .join(defect_nodes, F.col("l_sdr") == F.col("sdr")))
            if before is not None:
                reached = reached.join(ids(before, "sdr"), F.col("sdr") == F.col("_inc"), "left_anti")
            new_d = write(reached.select(
                F.lit("sdr").alias("kind"), F.col("sdr").alias("id"), F.lit(release).alias("ImportGroup"),
                F.when(F.col("own"), F.col("d_branch")).otherwise(F.col("_mb")).alias("Branch"),
                F.when(F.col("own"), F.col("d_version")).otherwise(F.col("_mv")).alias("Version"),
                F.lit(2 * rnd - 1).alias("round")))
            new_f = (new_d.select(F.col("id").alias("_nd"))
                     .join(by_sdr, F.col("_nd") == F.col("l_sdr")).select("l_fix").distinct()
                     .join(ids(frontier, "fix"), F.col("l_fix") == F.col("_inc"), "left_anti")
                     .join(fix_nodes, F.col("l_fix") == F.col("fix")).select("fix", "f_branch", "f_version").distinct())
            before, frontier = new_d, write(new_f.select(
                F.lit("fix").alias("kind"), F.col("fix").alias("id"), F.lit(release).alias("ImportGroup"),
                F.col("f_branch").alias("Branch"), F.col("f_version").alias("Version"), F.lit(2 * rnd).alias("round")))
        earlier.append(spark.read.schema(CLOSURE_SCHEMA).parquet(*[f"{folder}/step={k}" for k in range(first + 1, steps + 1)]))
    forget_bucketed(defect_nodes, fix_nodes, by_fix, by_sdr)
    return spark.read.schema(CLOSURE_SCHEMA).parquet(*[f"{folder}/step={k}" for k in range(1, steps + 1)])


def check_unique(scope: DataFrame) -> DataFrame:
    """DQ1: ids that appear more than once (must be empty)."""
    return scope.groupBy("kind", "id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
