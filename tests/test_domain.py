"""Hand-written cases (invented values) for branches the test-data views do not reach."""

import datetime as dt

from pyspark.sql import functions as F

from histmill.functions import text as T
from histmill.functions.dates import utc_iso
from histmill.operators import issues as iss
from histmill.operators import releases, revisions, snapshots, users
from histmill.operators.status import defect_status
from histmill.sources.files import read_component_leads, read_project
from histmill.operators.components import reconcile_components


def one(spark, value, expr, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("x")).alias("y")).first()["y"]


# ------------------------------------------------------------------ text ---

def test_first_sentence(spark):
    assert one(spark, "  Fix the crash. Then more.", T.first_sentence) == "Fix the crash"
    assert one(spark, "Version 7.5 fails. Next", T.first_sentence) == "Version 7.5 fails"
    assert one(spark, "Line one\nline two", T.first_sentence) == "Line one"
    assert one(spark, "ab", T.first_sentence) == "ab"            # no match: unchanged
    long_text = "x" * 60000 + ". tail"
    assert one(spark, long_text, T.first_sentence) == "x" * 60000


def test_first_sentence_raw_and_escape(spark):
    assert one(spark, " a<b & c>d. e", lambda c: T.xml_escape(T.first_sentence_raw(c))) == " a&lt;b &amp; c&gt;d"


def test_trim_single_line(spark):
    assert one(spark, "  one line \n", T.trim_single_line) == "one line"
    assert one(spark, " two\nlines ", T.trim_single_line) == " two\nlines "


def test_truthy_and_flip(spark):
    df = spark.createDataFrame([(None,), ("",), ("0",), (" ",), ("a",)], "x string")
    assert [r.t for r in df.select(T.truthy(F.col("x")).alias("t")).collect()] == [False, False, False, True, True]
    assert one(spark, "Doe, Jane", T.flip_name) == "Jane Doe"
    assert one(spark, ",Jane", T.flip_name) == ",Jane"
    assert one(spark, "DOM\\jdoe  ", T.login_name) == "jdoe"
    assert one(spark, "nodomain", T.login_name) is None


def test_utc_iso(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 20, 0, 0),), (dt.datetime(2020, 1, 1, 20, 0, 0, 250000),)],
                               "t timestamp_ntz")
    out = [r.s for r in df.select(utc_iso(F.col("t")).alias("s")).collect()]
    assert out == ["2020-01-02T01:00:00", "2020-01-02T01:00:00.250"]


# ------------------------------------------------------------- releases ---

def test_release_rules(spark):
    raw = spark.createDataFrame([
        ("7.50", "7.50A_Spanish"), ("7.50", "7.50b_HOTFIX"), ("7.50", "7.50C_FrenchHF"), ("7.50", "7.50"),
        ("7.30", "7.30M"), ("8.0", "8.0"), ("LEDO", "LEDO 5.10"), ("INAP", "INAP 7.50.4"), ("BI", "BI 1"),
        ("BI", "BI 1_Hotfix"), ("7.10", "7.10x"), ("7.30", "7.3NF"),
    ], "ReleaseLev string, ReleaseID string")
    got = {r.ReleaseID: r for r in releases.apply_release_rules(raw).collect()}
    sp = got["7.50A_Spanish"]
    assert (sp.LanguageLabel, sp.HotfixLabel, sp.AffectsVersion, sp.JIRABranch, sp.FixedVersion) == \
        ("Spanish", None, "7.50A", "7_50A", "7_50A")
    assert got["7.50b_HOTFIX"].HotfixLabel == "HotFix"
    fr = got["7.50C_FrenchHF"]
    assert (fr.LanguageLabel, fr.HotfixLabel) == ("French", "HotFix")
    assert got["7.50"].JIRABranch == "7_50_DEV" and got["7.50"].IsReleased
    m = got["7.30M"]
    assert (m.JIRABranch, m.FixedVersion, m.AffectsVersion, m.IsReleased) == ("7_30_DEV",) * 3 + (False,)
    e = got["8.0"]
    assert (e.AffectsVersion, e.JIRABranch, e.IsReleased) == ("8_00_DEV", "8_00_DEV", False)
    ledo = got["LEDO 5.10"]
    assert (ledo.JIRABranch, ledo.AffectsVersion, ledo.FixedVersion, ledo.IsReleased) == \
        ("LEDO_DEV", "LEDO_DEV", "LEDO_DEV", False)
    assert got["INAP 7.50.4"].JIRABranch == "INAP_DEV"
    bi = got["BI 1"]
    assert (bi.HotfixLabel, bi.LanguageLabel, bi.JIRABranch) == ("BI1", None, "7_50")
    bih = got["BI 1_Hotfix"]  # another hotfix label: rule 130 gives the language label
    assert (bih.HotfixLabel, bih.LanguageLabel, bih.JIRABranch) == ("HotFix", "BI1", "7_50")
    assert got["7.10x"].JIRABranch == "7_10"
    nf = got["7.3NF"]
    assert (nf.JIRABranch, nf.HotfixLabel, nf.FixedVersion) == ("7_30", "NotaFiscal", "7_30")


def test_catalog_fan_out_prefers_same_level(spark):
    cat = spark.createDataFrame([("A", "v1", True), ("B", "v1", False), ("C", "v2", True)],
                                "ReleaseLev string, ReleaseID string, IsReleased boolean")
    items = spark.createDataFrame([(1, "v1", "B"), (2, "v1", "Z"), (3, "v9", "A")], "k int, ver string, lev string")
    got = {r.k: r for r in releases.catalog_for_version(cat, items, "ver", "lev").collect()}
    assert got[1].ReleaseLev == "B" and got[2].ReleaseLev == "A" and got[3].ReleaseLev is None


# -------------------------------------------------------------- statuses ---

def test_defect_status_branches(spark):
    rows = [
        # sdr, status, reason, trans_count, unresolved, min_last, released -> (status, resolution)
        (1, "O", None, None, None, None, True, "Open", ""),
        (2, "W", "Mystery", None, None, None, True, "Resolved", "Cannot Reproduce"),
        (3, "W", "Other", None, None, None, True, "Resolved", ""),
        (4, "C", "No Fix", None, None, None, True, "Resolved", "No Plans to Fix"),
        (5, "C", "Whatever", None, None, None, True, "Resolved", "No Longer Valid"),
        (6, "C", None, 2, 0, 6, True, "Resolved", "Fixed"),
        (7, "C", None, 2, 0, 7, False, "Awaiting Resolutions", "Waiting"),
        (8, "C", None, 2, 0, 8, None, "Awaiting Resolutions", "Waiting"),
        (9, "O", None, 1, 1, 12, True, "Open", ""),
        (10, "C", None, 1, 1, 12, True, "Resolved", "Fixed Other"),
        (11, "C", None, 1, 1, 11, True, "Awaiting Resolutions", "Waiting"),
    ]
    df = spark.createDataFrame([r[:7] for r in rows], "SDRNum long, Status string, ReasonCode string, "
                               "TransCount long, Unresolved long, MinLast long, IsReleased boolean")
    st, res = defect_status(F.col("Status"), F.col("SDRNum"), F.col("TransCount"), F.col("Unresolved"),
                            F.col("MinLast"), F.col("IsReleased"))
    got = {r.SDRNum: (r.s, r.r) for r in df.select("SDRNum", st.alias("s"), res.alias("r")).collect()}
    assert got == {r[0]: (r[7], r[8]) for r in rows}


# ----------------------------------------------------------------- users ---

def test_user_lookup(spark):
    raw = spark.createDataFrame([
        ("DOM\\amy", "amy", "Smith, Amy", "amy@x.org", True),
        ("DOM\\bob", "bob", "Bob", " ", False),
    ], "NTUserName string, UserName string, ExchangeName string, EmailAddr string, Active boolean")
    recs = users.build_users(users.clean_users(raw))
    r = {x.user_key: x for x in recs.collect()}
    assert (r["amy"].name, r["amy"].groups, r["amy"].fullname) == ("amy", ["jira-users", "jira-developers"],
                                                                   "Amy Smith")
    assert (r["bob"].name, r["bob"].email, r["bob"].active) == ("Legacy_bob", "bob@example.com", False)
    refs = spark.createDataFrame([("amy",), ("AMY",), ("bob",), ("zed",), (" ",), (None,)], "ref string")
    out = [x.u for x in users.resolve_user(refs, "ref", "u", recs).collect()]
    assert sorted(out, key=repr) == sorted(["amy", "Legacy_AMY", "Legacy_bob", "Legacy_zed", "Legacy_NON",
                                            "Legacy_NON"], key=repr)
    used = {x.name for x in users.used_users(refs, "ref", recs).collect()}
    assert used == {"amy", "Legacy_bob", "Legacy_AMY", "Legacy_zed"}


# ------------------------------------------------------------- revisions ---

def test_renumber_duplicates(spark):
    rows = [(1, None, "a", 1), (1, None, "b", 2), (1, None, "c", 3), (1, 2, "d", 4), (1, 2, "e", 5), (1, 5, "f", 6),
            (2, None, "g", 7), (3, 1, "h", 8), (3, 1, "i", 9)]
    fc = spark.createDataFrame(rows, "TransmittalID long, FCIndex int, FileChanged string, ord int")
    fixes = spark.createDataFrame([(1,), (2,)], "TransmittalId long")  # fix 3 is unknown
    got = {r.FileChanged: r.FCIndex for r in revisions.renumber_duplicates(fc, fixes, ["ord"]).collect()}
    # fix 1: max 5; extras by order: b, c (NULL group), e (index 2) -> 6, 7, 8; first NULL -> 0
    assert got == {"a": 0, "b": 6, "c": 7, "d": 2, "e": 8, "f": 5, "g": 0, "h": 1, "i": 1}


def test_delete_propagation(spark):
    paths = spark.createDataFrame([
        (1, "$/R/P", True, True), (2, "$/R/P/x.c", False, False), (3, "$/R/p/Sub/y.c", False, False),
        (4, "$/R/PX/z.c", False, False), (5, "$/R/Q", True, False), (6, "$/R/Q/w.c", False, False),
    ], "FilePathKey long, Path string, IsProject boolean, Deleted boolean")
    got = {r.FilePathKey: r.Deleted for r in revisions.propagate_deletes(paths).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False}


def test_range_matching_edges(spark):
    paths = spark.createDataFrame([(1, "$/R75/a/b.c", False, False)],
                                  "FilePathKey long, Path string, IsProject boolean, Deleted boolean")
    revs = spark.createDataFrame([(10 + i, 1, i) for i in range(1, 8)], "FileRevKey long, FilePathKey long, Revision long")
    fixes = spark.createDataFrame([(1, "7.50")], "TransmittalId long, ReleaseLev string")
    changes = spark.createDataFrame([
        (1, 1, "R75\\a\\b.c", "2", "4"), (1, 2, "$/R75/A/B.C", "n/a", "4"), (1, 3, "$/R75/a/b.c", "$1", "3"),
        (1, 4, "$/R75/a/b.c", "3", "3"), (1, 5, "$/R75/a/b.c", "1e0", "2"),
    ], "TransmittalID long, FCIndex int, FileChanged string, RevisionLevelFrom string, RevisionLevelTo string")
    got = sorted((r.FCIndex, r.FileRevKey) for r in
                 revisions.match_exact(changes, fixes, paths, revs, ["7.50"]).collect())
    assert got == [(1, 13), (1, 14), (5, 12)]


def test_changesets_rules(spark):
    paths = spark.createDataFrame([(1, "$/a", False, False), (2, "$/b", False, True)],
                                  "FilePathKey long, Path string, IsProject boolean, Deleted boolean")
    t = dt.datetime(2024, 1, 1)
    revs = spark.createDataFrame([
        (1, 1, 1, "u1", "fix it", t + dt.timedelta(seconds=1)),
        (2, 1, 2, "U1", "fixit ", t + dt.timedelta(seconds=2)),       # same user (case), comment w/o spaces
        (3, 1, 3, None, "other", t + dt.timedelta(seconds=3)),        # NULL user, comment differs -> new
        (4, 1, 4, "u2", "x", t + dt.timedelta(seconds=4)),            # previous user NULL -> same changeset
        (5, 1, 5, "u2", "x\r\n", t + dt.timedelta(seconds=5)),        # CRLF removed -> same
        (6, 1, 6, "u2", "x\n", t + dt.timedelta(seconds=6)),          # lone LF kept -> new
        (7, 2, 1, "u9", "gone", t + dt.timedelta(seconds=7)),         # deleted path -> -1
    ], "FileRevKey long, FilePathKey long, Revision long, Usr string, Comment string, CommitTime timestamp_ntz")
    got = {r.FileRevKey: r.PromoteSeq for r in revisions.changesets(revs, paths, partitions=3).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: 2, 5: 2, 6: 3, 7: -1}


# ------------------------------------------------------------- snapshots ---

def test_tran_log_parse(spark):
    lines = ["  # SS orphan Time: 2024-01-01T00:00:00", "transaction 7; promote;",
             "  # SS a Time: 2024-01-02T00:00:00", "  # Import initial source", "transaction 9; keep;",
             "  # SS b Time: 2024-01-03T00:00:00", "  # Import initial source", "transaction 11;"]
    df = spark.createDataFrame([("f", i, s) for i, s in enumerate(lines)], "file string, line_no int, value string")
    log = snapshots.parse_tran_log(df, "file", "line_no", "value")
    got = [(r.line_no, r.tran_num, r.checkin_time is not None, r.is_initial) for r in log.orderBy("line_no").collect()]
    assert got == [(0, None, True, False), (1, 7, False, False), (2, 7, True, False), (3, 7, False, True),
                   (4, 9, False, False), (5, 9, True, False), (6, 9, False, True), (7, 11, False, False)]
    init = snapshots.initial_transaction(log, "file", "line_no").first()
    assert init.initial_tran == 9
    times = snapshots.transaction_times(log)
    assert times.count() == 2


def test_asof_labels(spark):
    t = dt.datetime(2024, 1, 10)
    ck = spark.createDataFrame([(1, t, 1), (1, t + dt.timedelta(hours=2), 2), (2, t + dt.timedelta(hours=1), 3),
                                (3, t + dt.timedelta(hours=1), 4)],
                               "tran_num long, checkin_time timestamp_ntz, line_no long")
    spec = [("before", "2024-01-09T00:00:00"), ("equal", "2024-01-10T01:00:00"), ("after", "2024-02-01T00:00:00")]
    labels = snapshots.labels_frame(spark, spec)
    got = {r.label: (r.tran_num, r.first_time)
           for r in snapshots.asof_labels(labels, ck).collect()}
    assert got["before"] == (None, None)
    assert got["equal"][0] == 3                        # tie on time: highest transaction
    assert got["after"] == (1, t)                      # display time = first check-in of the transaction
    sorted_got = {r.label: r.tran_num for r in snapshots.asof_labels_sorted(labels, ck).collect()}
    assert sorted_got == {"before": None, "equal": 3, "after": 1}


# ------------------------------------------------------------ components ---

def test_component_leads_file(spark, tmp_path):
    p = tmp_path / "leads.csv"
    p.write_text("Alpha,ann\nno comma here\nBeta,\nA,B,C\nAlpha,zoe\nGamma,0\nDelta,dan\n")
    leads = {r.name: r.lead for r in read_component_leads(spark, str(p)).collect()}
    assert leads == {"Alpha": "zoe", "Beta": "", "Gamma": "0", "Delta": "dan"}
    proj = tmp_path / "project.json"
    proj.write_text('{"key": "K", "name": "N", "components": [{"id": "10", "name": "Alpha"}, '
                    '{"id": "11", "name": "Beta"}, {"id": "12", "name": "Gamma"}, {"id": "13", "name": "Omega"}]}')
    comps = read_project(spark, str(proj))
    rep = {r.ComponentName: (r.Assignee, r.Result, r.payload)
           for r in reconcile_components(comps, read_component_leads(spark, str(p))).collect()}
    assert rep["Alpha"] == ("zoe", "to_update", '{"leadUserName":"zoe","assigneeType":"COMPONENT_LEAD"}')
    assert rep["Beta"][:2] == ("", "no change") and rep["Gamma"][:2] == ("0", "no change")
    assert rep["Omega"][:2] == ("not specified", "no change")
    assert rep["Delta"][:2] == ("", "Not Found")


# ---------------------------------------------------------------- issues ---

def test_version_aliases(spark):
    df = spark.createDataFrame([(["8.0", "7.1"], ["8_0"], [("Branch", "t", "8_0")], "[8_0] text")],
                               "affectedVersions array<string>, fixedVersions array<string>, "
                               "customFieldValues array<struct<fieldName:string,fieldType:string,value:string>>, "
                               "summary string")
    r = iss.apply_version_aliases(df, True).first()
    assert r.affectedVersions == ["8.00", "7.1"] and r.fixedVersions == ["8_00"]
    assert r.customFieldValues[0].value == "8_00" and r.summary == "[8_00] text"


def test_defect_log_comment_rules(spark):
    recs = spark.createDataFrame([("u1", "one")], "user_key string, name string")
    defects = spark.createDataFrame([(1, "FSX", "9.9")], "SDRNum long, Release string, Version string")
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([
        (1, 1, t, "u1", "Comment", None, "  hello  "),         # comment type omitted
        (2, 1, t, "u1", "Note", "Why", "0"),                    # '0' text is empty
        (3, 1, t, "", "Wait", "no fix", " a\nb "),              # history; two-line text kept
        (4, 1, t, "u1", "Wait", None, "  "),                    # history, blank text: no comment
        (5, 1, t, "u1", "Reported", None, None),                # origin note appended
        (6, 1, t, "u1", "Assigned", "u1", "x"),
        (7, 1, t, "u1", "Reason", "bogus", None),               # unknown reason: no history
    ], "event_id long, SDR_Num long, EntryDate timestamp_ntz, Person string, LineType string, "
       "ReasonCode string, Description string")
    prof = iss.ExportProfile(origin_release="FSX")
    got = {r.event_id: r for r in iss.defect_log_entries(log, defects, recs, prof).collect()}
    assert got[1].body == "hello" and got[1].items is None
    assert got[2].body == "Note (Why)"
    assert got[3].body == "Wait no fix:  a\nb " and [i.field for i in got[3].items] == ["status", "resolution"]
    assert got[3].author == ""
    assert got[4].body is None and got[4].items[0].to == "3"
    assert got[5].body == "Reported: Originated from version 9.9"
    assert got[6].items[0].to == "one" and got[6].body == "Assigned u1: x"
    assert got[7].items is None and got[7].body == "Reason (bogus)"


def test_changesets_plain_and_two_phase_agree(spark):
    paths = spark.createDataFrame([(k, f"$/p{k}", False, k == 3) for k in range(5)],
                                  "FilePathKey long, Path string, IsProject boolean, Deleted boolean")
    t = dt.datetime(2024, 1, 1)
    users_ = ["a", "a", None, "b", "B", None]
    comments = ["x", " x", "y", None, "", "y"]
    revs = spark.createDataFrame(
        [(i, i % 5, i, users_[i % 6], comments[(i // 2) % 6], t + dt.timedelta(seconds=i)) for i in range(120)],
        "FileRevKey long, FilePathKey long, Revision long, Usr string, Comment string, CommitTime timestamp_ntz")
    a = {r.FileRevKey: r.PromoteSeq for r in revisions.changesets(revs, paths, 5).collect()}
    b = {r.FileRevKey: r.PromoteSeq for r in revisions.changesets(revs, paths).collect()}
    assert a == b


def test_link_edges_duplicate_top_pair(spark):
    links = spark.createDataFrame([(1, 10), (1, 10), (1, 5), (2, 7)], "TransmittalID long, SDR_Num long")
    dscope = spark.createDataFrame([(10,), (5,), (7,)], "SDRNum long")
    fscope = spark.createDataFrame([(1,), (2,), (3,)], "TransmittalId long")
    fix_rows = spark.createDataFrame([(3, 0, "Awaiting Resolutions", "Waiting", "u", "u", "c", ["v"], None, "s",
                                       None, "Bug")],
                                     "issue_num long, SDRCount long, parentIssueStatus string, "
                                     "parentIssueResolution string, reporter string, assignee string, created string, "
                                     "fixedVersions array<string>, components array<string>, summary string, "
                                     "description string, parentIssueType string")
    prof = iss.ExportProfile()
    got = sorted(tuple(r) for r in iss.link_edges(links, dscope, fscope, fix_rows, prof).collect())
    assert got == sorted([("sub-task-link", "100001", "10"), ("Fixed", "10", "100001"), ("Fixed", "5", "100001"),
                          ("sub-task-link", "100002", "7"), ("sub-task-link", "100003", "D3")])


def test_write_by_group_and_issue_lines(spark, tmp_path):
    from histmill.sinks.writers import write_by_group, write_lines
    df = spark.createDataFrame([(1, "L0"), (2, "L1"), (3, "L0")], "id int, ImportGroup string")
    write_by_group(df, str(tmp_path / "scope"))
    back = spark.read.parquet(str(tmp_path / "scope"))
    assert sorted((r.id, r.ImportGroup) for r in back.collect()) == [(1, "L0"), (2, "L1"), (3, "L0")]
    lines = snapshots.xml_tran_lines(spark.createDataFrame([(12,), (3,)], "tran_num long"))
    write_lines(lines, str(tmp_path / "xml"))
    text = "".join(open(f).read() for f in sorted((tmp_path / "xml").glob("part-*")))
    assert text.splitlines() == ['<?xml version="1.0" encoding="UTF-8"?>', "<transactions>", "<id>12</id>",
                                 "<id>3</id>", "</transactions>"]


def test_duplicate_component_names_consume_one_lead(spark):
    comps = spark.createDataFrame([("1", "Alpha", 0), ("2", "Alpha", 1)], "id string, name string, pos int")
    leads = spark.createDataFrame([("Alpha", "ann")], "name string, lead string")
    rep = sorted((r.ComponentId, r.Assignee, r.Result) for r in reconcile_components(comps, leads).collect())
    assert rep == [("1", "ann", "to_update"), ("2", "not specified", "no change")]


def test_write_import(spark, tmp_path):
    import json
    from histmill.sinks.writers import write_import
    docs = spark.createDataFrame([("2", "d", '{"externalId":"2"}'), ("10", "d", '{"externalId":"10"}')],
                                 "externalId string, kind string, json string")
    users_ = spark.createDataFrame([("k", "bob", None, True, "b@x", None)],
                                   "user_key string, name string, groups array<string>, active boolean, "
                                   "email string, fullname string")
    comps = spark.createDataFrame([("B",), ("A",)], "name string")
    vers = spark.createDataFrame([("7.1",)], "name string")
    links = spark.createDataFrame([("Fixed", "1", "100002")], "name string, sourceId string, destinationId string")
    write_import(str(tmp_path), docs, users_, comps, vers, links, "Legacy Project", "LEGACY")
    issues_text = "".join(open(f).read() for f in sorted((tmp_path / "issues").glob("part-*")))
    assert issues_text.splitlines() == ['{"externalId":"10"}', '{"externalId":"2"}']   # text order
    user = json.loads("".join(open(f).read() for f in (tmp_path / "users").glob("part-*")))
    assert list(user) == sorted(user) and user["name"] == "bob"
    entries = spark.read.json(str(tmp_path / "project" / "entries")).collect()
    assert sorted((r.kind, r.name) for r in entries) == [("component", "A"), ("component", "B"), ("version", "7.1")]


def test_range_matching_of_few_and_many(spark, monkeypatch):
    """Paths with few revisions or claims are joined on the path, the others by position."""
    monkeypatch.setattr(revisions, "FEW", 3)
    paths = spark.createDataFrame([(k, f"$/R75/a/{k}.c", False, False) for k in (1, 2, 3)],
                                  "FilePathKey long, Path string, IsProject boolean, Deleted boolean")
    counts = {1: 2, 2: 9, 3: 9}
    rev_rows = [(100 * k + i, k, 2 * i) for k, n in counts.items() for i in range(1, n + 1)] + [(999, 2, None)]
    revs = spark.createDataFrame(rev_rows, "FileRevKey long, FilePathKey long, Revision long")
    fixes = spark.createDataFrame([(1, "7.50")], "TransmittalId long, ReleaseLev string")
    claims = [(1, 10 * k + j, f"$/R75/a/{k}.c", str(j), str(2 * j)) for k, n in ((1, 6), (2, 2), (3, 7)) for j in range(n)]
    changes = spark.createDataFrame(claims, "TransmittalID long, FCIndex int, FileChanged string, "
                                            "RevisionLevelFrom string, RevisionLevelTo string")
    got = sorted((r.FCIndex, r.FileRevKey) for r in revisions.match_exact(changes, fixes, paths, revs, ["7.50"]).collect())
    assert got == sorted((c[1], r[0]) for c in claims for r in rev_rows
                         if c[2] == f"$/R75/a/{r[1]}.c" and r[2] and int(c[3]) < r[2] <= int(c[4]))


def test_version_alias_moves_first_sentences_only(spark):
    """The summary needs a text's first sentence: it is cut out before the shuffle of the fixes."""
    from histmill.plans.registry import all_queries

    plan = all_queries()["version_alias"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    cut = next(x for x in plan.splitlines() if "AS _sentence" in x)
    assert "Join" in plan and plan.index("Join") < plan.index(cut)
    assert not any("AS description" in x for x in plan.splitlines())


def test_single_line_trim_equals_its_regex(spark):
    import itertools
    import re

    texts = ["".join(t) for n in range(6) for t in itertools.product("a \n\r", repeat=n)] + ["\u00a0x\u2028 ", "\x0b\x0cx y\t", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", T.trim_single_line(F.col("t")).alias("y"))
    want = [t if t is None else re.sub(r"^\s*(.*?)\s*$", r"\1", t, count=1, flags=re.ASCII) for t in texts]
    assert {r.i: r.y for r in got.collect()} == dict(enumerate(want))


def test_log_texts_are_trimmed_once_without_a_regex(spark):
    log = spark.createDataFrame([(1, 5, None, None, "Comment", None, " a text \n")], "event_id int, SDR_Num int, EntryDate timestamp_ntz, "
                                "Person string, LineType string, ReasonCode string, Description string")
    defects = spark.createDataFrame([(5, "L3", "7.1")], "SDRNum int, Release string, Version string")
    records = spark.createDataFrame([], "user_key string, name string")
    rows = iss.defect_log_entries(log, defects, records, iss.ExportProfile(origin_release="L3")).where(F.col("body").isNotNull())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "(.*?)" not in plan and plan.count("replace(Description") == 1
    assert [r.body for r in rows.collect()] == ["a text"]


def test_texts_by_number_give_the_rows_of_the_view(spark, tmp_path):
    """Repeated document ids and fixes, documents that are missing or null: the same fixes as from whole texts."""
    from histmill.plans import issue_plans as plans
    from histmill.sources.views import view, view_by_text

    sf = str(tmp_path)
    spark.createDataFrame([(0, "Zero. More"), (1, "one\r\ntwo"), (1, "another"), (2, None), (None, "lost"), (4, "")],
                          "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    orders = [(k, k, "F", dt.datetime(2020, 1, 1 + k), f"{1 + k % 5}-X") for k in [*range(12), 1, 6]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz, "
                                  "o_orderpriority string").write.parquet(f"{sf}/orders.parquet")
    spark.createDataFrame([(k,) for k in range(9)], "c_custkey long").write.parquet(f"{sf}/customer.parquet")
    whole = view(spark, sf, "v_resolution")
    numbered, texts = view_by_text(spark, sf, "v_resolution")
    names = [c for c in whole.columns if c != "ReadMe"]
    joined = numbered.join(texts, F.col("ReadMe") == F.col("text_id"), "left").select(*names, "text")
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(key, joined.collect())) == sorted(map(key, whole.select(*names, "ReadMe").collect()))

    as_df = spark.createDataFrame
    links = as_df([(3, 7)], "TransmittalID long, SDR_Num long")
    defects = as_df([(7, "L1", "P", "a", "b", "brief")], "SDRNum long, Release string, Priority string, Level2 string, Level3 string, "
                                                         "ProblemBrief string")
    tlog = as_df([], "TransmittalID long, entrydate timestamp_ntz")
    cat = as_df([("L1", "7.1", True, None, None)], "ReleaseLev string, ReleaseID string, IsReleased boolean, "
                                                   "LanguageLabel string, HotfixLabel string")
    dscope = as_df([(7,)], "SDRNum long")
    fscope = as_df([(k, "B", "V") for k in range(10)], "TransmittalId long, Branch string, Version string")
    records = as_df([], "user_key string, name string")
    made = [iss.fix_issues(fixes, links, defects, tlog, cat, dscope, fscope, records, plans.PROFILE, None, described, of)
            for described in (True, False) for fixes, of in ((whole, None), (numbered, texts))]
    rows = [sorted(str(tuple(r)) for r in d.collect()) for d in made]
    assert rows[0] == rows[1] and rows[2] == rows[3] and len(rows[0]) > 12


def test_fix_texts_are_joined_last(spark):
    """No text of a fix crosses a shuffle: its number does, and the texts come in the last join."""
    from histmill.plans.registry import all_queries

    for name in ("resolution_issue", "dummy_parents"):
        q = all_queries()[name](spark, "/root/testdata/sf0.001")
        top = next(x for x in q._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x)
        assert "_read_me" in top, top
