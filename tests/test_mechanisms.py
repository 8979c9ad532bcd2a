"""Mechanisms that keep one hot key, one large document or one long chain out of a single task:
salted joins, interval order of paths, level-wise closure, document fragments, record-wise logs."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from histmill.operators import issues as iss
from histmill.operators import revisions as rv
from histmill.operators import scope, skew
from histmill.operators.ordered import running_max
from histmill.plans import issue_plans
from histmill.session import stage
from histmill.sinks import documents

SF = "/root/testdata/sf0.001"


# --- skewed joins ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 30,000 claims has one suffix, a sixth another; 3,000 suffixes in all."""
    rng = random.Random(4)
    keys = ["hot"] * 10_000 + ["warm"] * 5_000 + [f"k{rng.randint(0, 2999)}" for _ in range(14_900)] + [None] * 100
    big = stage(spark.createDataFrame(list(enumerate(keys)), "id int, key string").repartition(5))
    small = spark.createDataFrame([("hot", 1), ("hot", 2), ("warm", 3), (None, 4)] + [(f"k{i}", i) for i in range(2900)],
                                  "small_key string, v int")
    return big, small


def test_the_sketch_finds_hot_keys_only(skewed):
    big, _ = skewed
    assert sorted(skew.heavy_hitters(big, F.col("key"), 0.05)) == ["hot", "warm"]
    assert skew.heavy_hitters(big.limit(0), F.col("key"), 0.05) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(skewed, how):
    big, small = skewed
    want = big.join(small, F.col("key") == F.col("small_key"), how)
    got = skew.salted_join(big, small, "key", "small_key", 8, how=how)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


def test_salted_join_rejects_outer_sides(skewed):
    with pytest.raises(ValueError):
        skew.salted_join(*skewed, "key", "small_key", how="full_outer")


def test_no_task_gets_three_times_the_median(spark, skewed):
    big, small = skewed
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        joined = skew.salted_join(big, small, "key", "small_key", how="left_semi")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        plain = big.join(small, F.col("key") == F.col("small_key"), "left_semi")
        uneven = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)
    assert uneven[-1] > 3 * uneven[len(uneven) // 2]
    assert sizes[-1] < 3 * sizes[len(sizes) // 2]


def test_hot_suffix_matches_equal_brute_force(spark):
    """A third of the claims names files that share one long suffix."""
    rng = random.Random(9)
    tail = "/common/long/suffix/of/every/file.src"
    paths = [(i, f"$/R75/p{i}{tail if i < 3 else f'/other/place/number/{i}/in/the/tree.src'}", False, i % 7 == 6)
             for i in range(40)]
    revs = [(100 * i + r, i, r) for i in range(40) for r in range(1, 6)]
    claims = []
    for k in range(600):
        i = rng.randint(0, 2) if k % 3 == 0 else rng.randint(0, 39)
        name = paths[i][1] if k % 2 else "X:" + paths[i][1][5:]
        claims.append((k % 20, k, name, str(rng.choice([0, 1, 2, "n/a"])), str(rng.randint(2, 6))))
    as_df = spark.createDataFrame
    got = rv.match_all(as_df(claims, "TransmittalID int, FCIndex int, FileChanged string, RevisionLevelFrom string, RevisionLevelTo string"),
                       as_df([(k, "L1") for k in range(20)], "TransmittalId int, ReleaseLev string"),
                       as_df(paths, "FilePathKey int, Path string, IsProject boolean, Deleted boolean"),
                       as_df(revs, "FileRevKey int, FilePathKey int, Revision int"), ["L1"], 30)
    want = set()
    for fix, index, name, low, high in claims:
        if low != "n/a":
            for key, path, _, gone in paths:
                for rev, of, level in revs:
                    if of == key and not gone and int(low) < level <= int(high):
                        if path.lower() == name.lower():
                            want.add((fix, index, rev, 1))
                        elif len(path) > 30 and path.lower()[-30:] == name.lower()[-30:]:
                            want.add((fix, index, rev, 2))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


# --- interval order of paths -----------------------------------------------------------------

def test_running_max_crosses_partitions(spark):
    df = spark.createDataFrame([(i, (i * 37) % 50 if i % 4 == 0 else None) for i in range(200)], "i int, v int").repartition(7)
    got = {r.i: r.m for r in running_max(df, ["i"], "v", "m", 6).collect()}
    top = None
    for i in range(200):
        if i % 4 == 0:
            top = max((i * 37) % 50, top if top is not None else -1)
        assert got[i] == top


def test_deletes_reach_descendants_and_nothing_else(spark):
    rng = random.Random(2)
    words = ["a", "A", "ab", "a b", "b!", "b\"", "é", "", "0", "a  "]
    rows = [(i, "/".join(rng.choice(words) for _ in range(rng.randint(1, 5))), rng.random() < 0.4, rng.random() < 0.2)
            for i in range(1500)]
    got = {r.FilePathKey: r.Deleted for r in rv.propagate_deletes(
        spark.createDataFrame(rows, "FilePathKey int, Path string, IsProject boolean, Deleted boolean")).collect()}
    dead = {p.rstrip(" ").lower() + "/" for _, p, project, gone in rows if project and gone}
    assert len(got) == len(rows)
    for key, path, _, gone in rows:
        assert got[key] == (gone or any(path.lower().startswith(d) for d in dead)), path


def test_audits_find_the_rows_that_they_look_for(spark):
    as_df = spark.createDataFrame
    paths = as_df([(1, "$/a", True, True), (2, "$/a/b", False, False), (3, "$/ab", False, False)],
                  "FilePathKey int, Path string, IsProject boolean, Deleted boolean")
    assert [tuple(r) for r in rv.live_children_of_deleted(paths).collect()] == [("$/a", "$/a/b")]
    links = as_df([(1, 1, 7), (1, 1, 7), (1, 2, 7)], "TransmittalID int, FCIndex int, FileRevKey int")
    assert [tuple(r) for r in rv.duplicate_links(links).collect()] == [(1, 1, 7, 2)]
    grouped = as_df([(1, 2, None), (2, 2, 5)], "FileRevKey int, FilePathKey int, PromoteSeq long")
    assert [tuple(r) for r in rv.ungrouped_revisions(grouped).collect()] == [(1, 2)]


# --- closure ---------------------------------------------------------------------------------

def test_only_links_of_listed_fixes_are_staged(spark, monkeypatch):
    """Fix 2 is of no listed release: its link is not staged, leads nowhere and leaves its defect a seed."""
    staged, as_df = {}, spark.createDataFrame

    def watched(df, key, buckets=None):
        staged[key] = sorted(tuple(r) for r in df.collect())
        return bucketed(df, key, buckets)

    bucketed = scope.stage_bucketed
    monkeypatch.setattr(scope, "stage_bucketed", watched)
    got = scope.closure_issues(
        as_df([(1, 10), (1, 10), (2, 11), (2, 12), (3, 12)], "TransmittalID long, SDR_Num long"),
        as_df([(10, "L2", "7.2"), (11, "L0", "7.0"), (12, "L0", "7.0")], "SDRNum long, Release string, Version string"),
        as_df([(1, "L0", "7.0", "QA"), (2, "L2", "7.2", "QA"), (3, "L1", "7.1", "QA")],
              "TransmittalId long, ReleaseLev string, RlsLevelTarget string, WaitingOn string"),
        as_df([(f"L{i}", f"7.{i}", f"b{i}", f"a{i}", f"f{i}") for i in range(3)],
              "ReleaseLev string, ReleaseID string, JIRABranch string, AffectsVersion string, FixedVersion string"), ["L0", "L1"])
    assert {(r.kind, r.id, r.ImportGroup) for r in got.collect()} == {
        ("fix", 1, "L0"), ("sdr", 10, "L0"), ("sdr", 11, "L0"), ("fix", 3, "L1"), ("sdr", 12, "L1")}
    assert staged["l_fix"] == [(1, 10), (3, 12)] and staged["l_sdr"] == [(1, 10), (3, 12)]


def closed_by_hand(links, defects, fixes, catalog, releases):
    cat = {(lev, rid): (branch, affects, fixed) for lev, rid, branch, affects, fixed in catalog}
    fix = {t: (lev, *cat[lev, target]) for t, lev, target, _ in fixes if lev in releases and (lev, target) in cat}
    sdr = {d: (lev, *cat[lev, version]) for d, lev, version in defects if (lev, version) in cat}
    listed = {t for t, lev, _, _ in fixes if lev in releases}
    done = {}
    for release in releases:
        front = {t for t, f in fix.items() if f[0] == release and ("fix", t) not in done}
        done.update({("fix", t): (release, fix[t][1], fix[t][1], 0) for t in front})
        for d, s in sdr.items():
            if s[0] == release and ("sdr", d) not in done and not any(e == d and t in listed for t, e in links):
                done["sdr", d] = (release, s[1], s[2], 0)
        k = 0
        while front:
            k += 1
            new = {d for t, d in links if t in front and d in sdr and ("sdr", d) not in done}
            for d in new:
                over = [done["fix", t] for t, e in links if e == d and t in front]
                own = sdr[d][0] in releases
                done["sdr", d] = (release, sdr[d][1] if own else max(o[1] for o in over),
                                  sdr[d][2] if own else max(o[2] for o in over), 2 * k - 1)
            front = {t for t, d in links if d in new and t in fix and ("fix", t) not in done}
            done.update({("fix", t): (release, fix[t][1], fix[t][1], 2 * k) for t in front})
    return {(kind, i, *row) for (kind, i), row in done.items()}


def run_closure(spark, links, defects, fixes, catalog, releases):
    as_df = spark.createDataFrame
    got = scope.closure_issues(
        as_df(links, "TransmittalID int, SDR_Num int"), as_df(defects, "SDRNum int, Release string, Version string"),
        as_df(fixes, "TransmittalId int, ReleaseLev string, RlsLevelTarget string, WaitingOn string"),
        as_df(catalog, "ReleaseLev string, ReleaseID string, JIRABranch string, AffectsVersion string, FixedVersion string"),
        releases)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


CATALOG = [(lev, rid, f"b{lev}{rid}", f"a{lev}{rid}", f"f{lev}{rid}") for lev in "XYZ" for rid in "12"]


def test_closure_of_a_chain_of_sixty_rounds(spark):
    """Fix k and defect k, defect k and fix k + 1: one release owns the first fix only."""
    n = 30
    links = [(k, k) for k in range(n)] + [(k + 1, k) for k in range(n)]
    fixes = [(k, "X" if k == 0 else "Y", "1", "QA") for k in range(n + 1)]
    defects = [(k, "Z", "2") for k in range(n)]
    got = run_closure(spark, links, defects, fixes, CATALOG, ["X", "Y"])
    assert got == closed_by_hand(links, defects, fixes, CATALOG, ["X", "Y"])
    assert max(r[-1] for r in got) == 2 * n and {r[2] for r in got} == {"X"}


def test_closure_of_random_graphs(spark):
    rng = random.Random(12)
    links = sorted({(rng.randint(0, 79), rng.randint(0, 79)) for _ in range(110)})
    fixes = [(k, rng.choice("XYZ"), rng.choice("123"), "QA") for k in range(80)]
    defects = [(k, rng.choice("XYZ"), rng.choice("123")) for k in range(80)]
    got = run_closure(spark, links, defects, fixes, CATALOG, ["Y", "X"])
    assert got == closed_by_hand(links, defects, fixes, CATALOG, ["Y", "X"])


# --- documents -------------------------------------------------------------------------------

def written(path):
    return b"".join(open(f, "rb").read() for f in documents.document_files(path))


def test_streamed_documents_have_the_same_bytes(spark, tmp_path):
    rows, entries = (stage(df) for df in issue_plans.document_parts(spark, SF))
    want = "".join(r.json + "\n" for r in iss.issue_documents(rows, iss.nest(entries)).orderBy("externalId").collect())
    fragments = stage(iss.document_fragments(rows, entries))
    for giant in (documents.GIANT, 2):  # whole issues in a file, issues over several files
        path = f"{tmp_path}/out{giant}"
        documents.write_documents(fragments, path, giant, 5)
        assert written(path).decode() == want
    # the next version replaces the first, and leaves nothing of it
    documents.write_documents(fragments.where("externalId < '2'"), path, 2, 3)
    assert written(path).decode() == "".join(x + "\n" for x in want.splitlines() if json.loads(x)["externalId"] < "2")
    assert len(list((tmp_path / "out2").iterdir())) == len(documents.document_files(path)) + 1


def issue_row(spark, key):
    empty = spark.range(1).select(F.lit(key).alias("externalId"), F.lit("defect").alias("kind"), F.lit(1).alias("issue_num"))
    for name in iss.DOCUMENT_FIELDS:
        if name not in iss.NESTED_FIELDS and name != "externalId":
            empty = empty.withColumn(name, F.lit(None).cast("string"))
    return empty


def test_one_issue_of_a_million_comments(spark, tmp_path):
    n = 1_000_000
    place = F.struct(F.lit(0).alias("g"), F.lit(None).cast("timestamp_ntz").alias("t"), F.col("id").alias("o"))
    entries = spark.range(n).select(
        F.lit("7").alias("externalId"), place.alias("ord"),
        F.lit(None).cast("struct<author:string>").alias("h"),
        F.struct(F.concat(F.lit("é "), F.col("id").cast("string")).alias("body")).alias("c"))
    fragments = iss.document_fragments(issue_row(spark, "7").unionByName(issue_row(spark, "8")), entries)
    path = str(tmp_path / "giant")
    documents.write_documents(fragments, path, 1000, 8)
    assert len(documents.document_files(path)) >= 4
    lines = written(path).decode().splitlines()
    assert [list(json.loads(x)) for x in lines] == [["comments", "externalId"], ["externalId"]]
    bodies = [c["body"] for c in json.loads(lines[0])["comments"]]
    assert len(bodies) == n and bodies[:2] == ["é 0", "é 1"] and bodies[-1] == f"é {n - 1}"
    assert "é" not in lines[0]


def test_a_failed_write_leaves_the_earlier_documents(spark, tmp_path):
    rows = issue_row(spark, "1").unionByName(issue_row(spark, "2"))
    entries = spark.createDataFrame([], "externalId string, ord struct<o:long>, h struct<a:string>, c struct<a:string>")
    fragments = iss.document_fragments(rows, entries)
    path = str(tmp_path / "docs")
    documents.write_documents(fragments, path, partitions=2)
    before = written(path)
    bad = fragments.withColumn("text", F.when(F.col("externalId") == "2", F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="broken"):
        documents.write_documents(stage_less(bad), path, partitions=2)
    assert written(path) == before and b'"externalId":"2"' in before
    assert not [p for p in (tmp_path / "docs").iterdir() if p.name.startswith("_attempt")]


def stage_less(df):
    """The optimiser may not drop the failing column."""
    return df.withColumn("text", F.col("text").cast("string"))


def test_equal_places_keep_their_commas(spark, tmp_path):
    entries = spark.createDataFrame([("1", (5,), None, ("x",)), ("1", (5,), None, ("x",)), ("1", (6,), None, ("y",))],
                                    "externalId string, ord struct<o:long>, h struct<a:string>, c struct<a:string>")
    path = str(tmp_path / "ties")
    documents.write_documents(iss.document_fragments(issue_row(spark, "1"), entries), path, 1, 4)
    assert json.loads(written(path))["comments"] == [{"a": "x"}, {"a": "x"}, {"a": "y"}]
