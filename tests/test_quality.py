"""Rejects with a limit, versioned stage tables, changing columns, record-wise logs, VARIANT documents."""

import json

import pytest
from pyspark.sql import functions as F

from histmill.functions.text import LOGIN_PATTERN
from histmill.operators import quality as q
from histmill.operators import snapshots as sn
from histmill.sinks.versions import VersionedTable
from histmill.sinks.writers import read_stage, write_stage
from histmill.sources.files import component_leads, project_components, read_lines, read_transactions

@pytest.fixture()
def rules(spark):
    return {"login": F.col("NTUserName").rlike(LOGIN_PATTERN), "name": F.length("UserName") > 0}


@pytest.fixture()
def users(spark):
    return spark.createDataFrame([("DOM\\ann", "ann"), ("nobody", "bob"), (None, None), ("DOM\\eve", "")],
                                 "NTUserName string, UserName string")


def test_a_bad_login_is_counted_and_written(spark, users, rules, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/users")
    assert q.write_checked(users, rules, table, limit=3) == {"login": 2, "name": 2}
    assert [r.UserName for r in q.accepted(table).collect()] == ["ann"]
    assert {(r.UserName, tuple(r.reasons)) for r in q.rejects(table).collect()} == {
        ("bob", ("login",)), (None, ("login", "name")), ("", ("name",))}
    good, bad = q.split_rejects(users, rules)
    assert (good.count(), bad.count()) == (1, 3) and good.columns == users.columns


def test_a_bad_login_is_fatal_on_demand(spark, users, rules, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/users")
    q.write_checked(users.where("UserName = 'ann'"), rules, table)
    before = table.current()
    with pytest.raises(q.RejectedRows, match="3 rows rejected: login 2, name 2") as failed:
        q.write_checked(users, rules, table)
    assert table.current() == before and q.accepted(table).count() == 1
    # the rows that broke the rules can still be looked at
    assert q.rejects(table, failed.value.version).count() == 3


def test_checks_of_an_empty_table(spark, users, rules, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/none")
    assert q.write_checked(users.limit(0), rules, table) == {"login": 0, "name": 0}


def test_a_failed_replace_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/stage"
    write_stage(spark.range(10).withColumnRenamed("id", "k"), path)
    broken = spark.range(0, 1000, 1, 8).select(F.when(F.col("id") == 700, F.raise_error(F.lit("mid-write")).cast("long"))
                                               .otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception, match="mid-write"):
        write_stage(broken, path)
    assert read_stage(spark, path).count() == 10
    write_stage(read_stage(spark, path).where("k < 3"), path)  # replaced by a query on itself
    assert sorted(r.k for r in read_stage(spark, path).collect()) == [0, 1, 2]
    table = VersionedTable(spark, path)
    running = table.read()
    assert running.count() == 3 and table.clean() >= 1 and read_stage(spark, path).count() == 3
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, f"{tmp_path}/nothing").read()


def test_columns_are_added_filled_dropped_and_tightened(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS changing")
    q.create_table(spark.createDataFrame([(1, "a"), (2, None)], "id int, lev string"), "changing", f"{tmp_path}/v1")
    q.add_column(spark, "changing", "done", "boolean", "true")
    q.add_column(spark, "changing", "note", "string")
    spark.sql("INSERT INTO changing (id, lev, note) VALUES (3, 'c', 'new')")
    assert {tuple(r) for r in spark.table("changing").collect()} == {
        (1, "a", True, None), (2, None, True, None), (3, "c", True, "new")}
    with pytest.raises(Exception, match="changing.lev is NULL"):
        q.rewrite(spark, "changing", f"{tmp_path}/v2", drop=["note"], not_null=["lev"])
    assert spark.table("changing").columns == ["id", "lev", "done", "note"]
    q.rewrite(spark, "changing", f"{tmp_path}/v3", {"lev": F.coalesce("lev", F.lit("?")), "done": F.col("note").isNull()},
              drop=["note"], not_null=["lev", "done"])
    assert {tuple(r) for r in spark.table("changing").collect()} == {(1, "a", True), (2, "?", True), (3, "c", False)}
    spark.sql("DROP TABLE changing")


LISTING = """noise before the first header
transaction 7; promote; x
  # SS a Time: 2024-01-02T03:04:05
transaction without a number
  # Import initial source tree
transaction 8; promote; y

  # SS b Time: 2024-01-03T03:04:05
transaction 9; keep
"""


def test_records_equal_the_line_scan(spark, tmp_path):
    for k, text in enumerate([LISTING, LISTING.partition("\n")[2].replace("7;", "17;"), "", "no header at all\n"]):
        (tmp_path / f"log{k}.txt").write_text(text)
    lines = sn.parse_tran_log(read_lines(spark, str(tmp_path)), "file", "line_no", "value")
    records = sn.parse_transactions(read_transactions(spark, str(tmp_path)))
    want = sorted((r.file, r.tran_num or -1, str(r.checkin_time), r.is_initial) for r in lines.collect())
    got = sorted((r.file, r.tran_num or -1, str(r.checkin_time), r.is_initial) for r in records.collect())
    assert got == want and len(got) == 18


def test_records_survive_block_boundaries(spark, tmp_path):
    body = "".join(f"transaction {k}; p\n" + "".join(f"  # SS f{j} Time: 2024-01-0{1 + j % 9}T00:00:00\n" for j in range(k % 5))
                   for k in range(4000))
    (tmp_path / "log.txt").write_text(body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        records = read_transactions(spark, str(tmp_path))
        assert records.rdd.getNumPartitions() > 5
        log = sn.parse_transactions(records)
        got = {r.tran_num: r.n for r in log.groupBy("tran_num").agg(F.count("checkin_time").alias("n")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {k: k % 5 for k in range(4000)}


def test_project_documents_whose_members_vary(spark):
    texts = [json.dumps({"key": "P", "components": [{"id": 1, "name": "a"}, {"name": "b", "extra": [1]}, 7, {"id": "x", "name": None}]}),
             json.dumps({"components": []}), json.dumps({"key": "Q"}), json.dumps({"key": 5, "components": {"id": 1}}), "{broken", None, "[]",
             json.dumps({"key": 5, "components": [{"id": {"a": 1}, "name": 2.5}]})]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")
    got = sorted(map(tuple, project_components(docs).collect()))
    assert [g[:3] for g in got] == [(0, "P", 0), (0, "P", 1), (0, "P", 2), (0, "P", 3), (7, "5", 0)]
    assert [g[4] for g in got] == ["a", "b", None, None, "2.5"]
    assert [g[3] for g in got][:4] == ["1", None, None, "x"]


def test_the_last_file_wins_a_lead(spark):
    rows = [("b.csv", 1, "x,late"), ("a.csv", 9, "x,early"), ("a.csv", 2, "y,")]
    got = component_leads(spark.createDataFrame(rows, "file string, line_no long, value string"))
    assert {tuple(r) for r in got.collect()} == {("x", "late"), ("y", "")}
