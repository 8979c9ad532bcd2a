"""Joins broadcast by the measured size of the rows, not by the size of compressed files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from histmill.operators import issues as iss
from histmill.session import UNMEASURED_BROADCAST, broadcast_by_measure, stage

STATIC = "spark.sql.autoBroadcastJoinThreshold"
MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@pytest.fixture
def session(spark):
    s = spark.newSession()
    s.conf.set(STATIC, "2m")
    return s


def test_rows_that_files_compress_are_not_broadcast(session):
    """600,000 keys are some hundred KB of files and 9 MB of rows; 3,000 keys are broadcast as before."""
    left = session.range(0, 900_000, 1, 2).select((F.col("id") % 5000).alias("a"))
    large = stage(session.range(0, 600_000, 1, 2).select(F.col("id").alias("k"), F.lit("x" * 40).alias("pad")))
    small = stage(session.range(0, 3000, 1, 1).select(F.col("id").alias("k")))

    def joined(right):
        df = left.join(right.select("k"), F.col("a") == F.col("k")).agg(F.count(F.lit(1)).alias("n"))
        return df.collect()[0].n, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]

    n, plan = joined(large)
    assert n == 900_000 and "BroadcastHashJoin" in plan  # what the size of the files leads to
    broadcast_by_measure(session)
    n, plan = joined(large)
    assert n == 900_000 and "BroadcastHashJoin" not in plan
    n, plan = joined(small)
    assert n == 540_000 and "BroadcastHashJoin" in plan


def test_broadcast_thresholds_of_the_session(session):
    for static, measured, want in (("2m", None, (str(UNMEASURED_BROADCAST), "2m")), ("100k", None, ("100k", None)),
                                   ("-1", None, ("-1", None)), ("32MB", "5m", (str(UNMEASURED_BROADCAST), "5m"))):
        session.conf.set(STATIC, static)
        session.conf.unset(MEASURED) if measured is None else session.conf.set(MEASURED, measured)
        for _ in range(2):
            broadcast_by_measure(session)
            assert (session.conf.get(STATIC), session.conf.get(MEASURED, None)) == want


@pytest.mark.parametrize("name", ["export_by_group", "nest_comments"])
def test_export_queries_broadcast_by_measure(session, name):
    from histmill.plans.registry import all_queries

    all_queries()[name](session, "/root/testdata/sf0.001")
    assert (session.conf.get(STATIC), session.conf.get(MEASURED)) == (str(UNMEASURED_BROADCAST), "2m")


def test_log_texts_by_number_give_the_entries_of_the_view(spark, tmp_path):
    """Repeated, missing and null documents and keys: the same entries as from whole texts, joined last."""
    from histmill.plans import issue_plans as plans
    from histmill.sources.views import view, view_by_text

    sf, as_df = str(tmp_path), spark.createDataFrame
    as_df([(0, " Zero. "), (1, "one\r\ntwo"), (1, "another"), (2, None), (None, "lost"), (4, "")],
          "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    kinds = ("error", "click", "view", "signup", "purchase", None)
    events = [(k, dt.datetime(2020, 1, 1, 0, k % 60), k % 11, kinds[k % 6]) for k in [*range(60), 7, 7, 13]] + [(None, None, None, "view")]
    as_df(events, "event_id long, ts timestamp_ntz, user_id long, event_type string").write.parquet(f"{sf}/events.parquet")
    as_df([(k,) for k in range(9)], "c_custkey long").write.parquet(f"{sf}/customer.parquet")
    as_df([(k,) for k in range(7)], "p_partkey long").write.parquet(f"{sf}/part.parquet")
    defects = as_df([(k, "L3" if k % 2 else "L0", "7.1") for k in [*range(6), 3]], "SDRNum long, Release string, Version string")
    records = as_df([(f"user{k}", f"name{k}") for k in (1, 2, 2, 7)], "user_key string, name string")
    numbered, texts = view_by_text(spark, sf, "v_sdr_log")
    whole = iss.defect_log_entries(view(spark, sf, "v_sdr_log"), defects, records, plans.PROFILE)
    late = iss.defect_log_entries(numbered, defects, records, plans.PROFILE, texts)
    assert whole.schema == late.schema
    rows = [sorted(str(tuple(r)) for r in d.collect()) for d in (whole, late)]
    assert rows[0] == rows[1] and len(rows[0]) > 60


def test_log_texts_are_joined_last(spark):
    from histmill.plans import issue_plans as plans

    sf = "/root/testdata/sf0.001"
    plan = plans.defect_log(spark, sf, plans.inputs(spark, sf))._jdf.queryExecution().optimizedPlan().toString()
    top = next(x for x in plan.splitlines() if "Join " in x)
    assert "_number" in top, top
