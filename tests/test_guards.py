"""Fail-fast guards, collation, sparse revision numbers, falsy descriptions, ASCII output."""

import json

import pytest
from pyspark.sql import functions as F

from histmill.operators import issues, revisions, snapshots, users
from histmill.sinks import writers

USERS = "NTUserName string, UserName string, FullName string, EmailAddr string, Active boolean"


def test_login_without_domain_fails(spark):
    bad = spark.createDataFrame([("nodomain", "u", "N", None, True)], USERS)
    with pytest.raises(Exception, match="Failed to parse nodomain"):
        users.build_users(bad).select("name").collect()
    assert users.build_users(bad, strict=False).first()["name"] is None


def test_promotion_needs_an_initial_transaction(spark):
    checkins = spark.createDataFrame([(1, "2020-01-01 00:00:00")], "tran_num long, t string").select(
        "tran_num", F.col("t").cast("timestamp_ntz").alias("checkin_time"))
    none = spark.createDataFrame([], "file string, initial_tran long")
    with pytest.raises(Exception, match="Did not find initial transaction"):
        snapshots.promote_set(checkins, none, "2021-01-01 00:00:00").collect()
    some = spark.createDataFrame([("a", 7), ("b", 7)], "file string, initial_tran long")
    got = snapshots.promote_set(checkins, some, "2021-01-01 00:00:00").collect()
    assert sorted(r.tran_num for r in got) == [1, 7, 7]


def test_target_transaction_must_exist(spark):
    log = spark.createDataFrame([("a", 5), ("a", 5), ("b", 6)], "file string, tran_num long")
    assert [tuple(r) for r in snapshots.required_transaction(log, 5, "file").collect()] == [("a", 5)]
    with pytest.raises(Exception, match="Did not find transaction 9"):
        snapshots.required_transaction(log, 9, "file").collect()


def _match(spark, claims, paths, revs):
    c = spark.createDataFrame(claims, "TransmittalID long, FCIndex int, FileChanged string, RevisionLevelFrom string, "
                                      "RevisionLevelTo string")
    f = spark.createDataFrame([(k, "L0") for k in {r[0] for r in claims}], "TransmittalId long, ReleaseLev string")
    p = spark.createDataFrame(paths, "FilePathKey long, Path string, IsProject boolean, Deleted boolean")
    r = spark.createDataFrame(revs, "FileRevKey long, FilePathKey long, Revision long")
    return sorted(tuple(x) for x in revisions.match_exact(c, f, p, r, ("L0",)).collect())


def test_range_match_over_sparse_revisions(spark):
    revs = [(1, 10, 1), (2, 10, 5_000_000_000), (3, 10, 7), (4, 11, 7), (5, 10, 7)]
    claims = [(1, 1, "$/R75/a", "0", "5000000000"), (2, 1, "$/R75/a", "1", "7"), (3, 1, "$/R75/a", "7", "7"),
              (4, 1, "$/R75/a", "x", "7"), (1, 1, "$/R75/a", "0", "1")]
    got = _match(spark, claims, [(10, "$/R75/a", False, False), (11, "$/R75/b", False, False)], revs)
    assert got == sorted([(1, 1, 1), (1, 1, 2), (1, 1, 3), (1, 1, 5), (2, 1, 3), (2, 1, 5), (1, 1, 1)])


def test_paths_match_whatever_the_case_and_trailing_spaces(spark):
    got = _match(spark, [(1, 1, "$/r75/A/B ", "0", "2")], [(10, "$/R75/a/b  ", False, False)], [(1, 10, 1)])
    assert got == [(1, 1, 1)]


def test_scope_joins_the_catalog_whatever_the_case(spark):
    cat = spark.createDataFrame([("L0", "7.1", "b", "a", "f")], "ReleaseLev string, ReleaseID string, JIRABranch string, "
                                                              "AffectsVersion string, FixedVersion string")
    d = spark.createDataFrame([(1, "l0 ", "7.1 ")], "SDRNum long, Release string, Version string")
    f = spark.createDataFrame([(2, "l0", "7.1", "Done")], "TransmittalId long, ReleaseLev string, RlsLevelTarget string, "
                                                          "WaitingOn string")
    ds, fs = issues.direct_scope(d, f, cat)
    assert ds.first()["Branch"] == "b" and fs.first()["Version"] == "f"


def test_change_text_follows_a_missing_description(spark):
    rows = spark.createDataFrame([(None, "x"), ("text", "x"), (None, None)], "description string, changes string")
    got = [r.description for r in issues.with_change_text(rows).collect()]
    heading = issues.CHANGE_HEADING
    assert got == [f"\n\n{heading}\nx", f"text\n\n{heading}\nx", None]


def test_import_parts_are_ascii(spark, tmp_path):
    docs = spark.createDataFrame([("1", json.dumps({"a": "ä"}))], "externalId string, json string")
    people = spark.createDataFrame([("ä", "e", "ß", True)], "name string, email string, fullname string, active boolean")
    names = spark.createDataFrame([("Kö",)], "name string")
    links = spark.createDataFrame([("n", "ä", "b")], "name string, sourceId string, destinationId string")
    out = str(tmp_path / "import")
    writers.write_import(out, docs, people, names, names, links, "Prä", "P")
    for part in ("users", "links", "project/header", "project/entries"):
        lines = [r.value for r in spark.read.text(f"{out}/{part}").collect()]
        assert lines and all(x.isascii() for x in lines)
        json.loads(lines[0])
