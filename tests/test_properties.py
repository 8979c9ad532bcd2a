"""Properties from the test strategy, checked on the registered queries (sf0.001)."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from histmill.plans.common import catalog, v
from histmill.plans.scope_plans import RELEASES

SF = "/root/testdata/sf0.001"
Q = entry.queries()


def test_renumbering_leaves_no_duplicate_index(spark):
    df = Q["renumber_dups"](spark, SF)
    assert df.groupBy("TransmittalID", "FCIndex").count().where("count > 1").count() == 0
    assert df.where(F.col("FCIndex").isNull()).count() == 0


def test_delete_propagation_audit_is_empty(spark):
    assert Q["audit_live_children"](spark, SF).count() == 0


def test_changeset_numbers_are_gap_free(spark):
    seqs = [r.PromoteSeq for r in Q["changesets"](spark, SF).where("PromoteSeq > 0")
            .select("PromoteSeq").distinct().collect()]
    assert sorted(seqs) == list(range(1, len(seqs) + 1))


def test_match_rows_are_unique(spark):
    df = Q["match_paths"](spark, SF)
    assert df.groupBy("TransmittalID", "FCIndex", "FileRevKey").count().where("count > 1").count() == 0


def test_closure_unique_and_closed(spark):
    scope = Q["closure_issues"](spark, SF)
    assert scope.groupBy("kind", "id").count().where("count > 1").count() == 0
    cat = catalog(spark, SF)
    res = v(spark, SF, "v_resolution")
    fixes = (res.where(F.col("ReleaseLev").isin(*RELEASES))
             .join(cat, (F.col("RlsLevelTarget") == F.col("ReleaseID")) & (res.ReleaseLev == cat.ReleaseLev))
             .select(F.col("TransmittalId").alias("fix")))
    defects = (v(spark, SF, "v_sdr").join(cat, (F.col("Version") == F.col("ReleaseID"))
                                          & (F.col("Release") == F.col("ReleaseLev")))
               .select(F.col("SDRNum").alias("sdr")))
    links = (v(spark, SF, "v_link").join(fixes, F.col("TransmittalID") == F.col("fix"))
             .join(defects, F.col("SDR_Num") == F.col("sdr")).select("fix", "sdr"))
    in_fix = scope.where("kind = 'fix'").select(F.col("id").alias("f_in"))
    in_sdr = scope.where("kind = 'sdr'").select(F.col("id").alias("d_in"))
    # a link with one end in scope has the other end in scope too
    half = (links.join(in_fix, F.col("fix") == F.col("f_in"), "left").join(in_sdr, F.col("sdr") == F.col("d_in"), "left")
            .where(F.col("f_in").isNull() != F.col("d_in").isNull()))
    assert half.count() == 0
