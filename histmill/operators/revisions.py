"""Revision-history operators (WIN2-WIN4, WIN6, JN5-JN9, JN15, JN16, AGG4, DQ2, RPT1-2, SRC7).

Inputs, by column:
* file changes: TransmittalID, FCIndex, FileChanged, RevisionLevelFrom, RevisionLevelTo (+ order key)
* file paths:   FilePathKey, Path, IsProject, Deleted
* file revs:    FileRevKey, FilePathKey, Revision, Usr, Comment, CommitTime, Action
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmill.functions.text import ci
from histmill.operators.ordered import global_islands, grouped_running_sum, running_max, with_group_first
from histmill.operators.skew import salted_join
from histmill.operators.texts import normalize_path
from histmill.session import stage

MONEY = "decimal(19,4)"


# ---------------------------------------------------------------- duplicates ---

def duplicate_groups(changes: DataFrame, keys: Sequence[str] = ("TransmittalID", "FCIndex")) -> DataFrame:
    """AGG4/DQ1: key groups with more than one row (NULL keys group together)."""
    return changes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def renumber_duplicates(changes: DataFrame, fixes: DataFrame, order_key: Sequence[str]) -> DataFrame:
    """WIN2 + WIN3 + JN8 + PRJ8: make (TransmittalID, FCIndex) unique.

    Within each duplicated (fix, index) group the first row (by ``order_key``,
    the identity order of the original) keeps its index; the others are numbered
    after the fix's highest index, in ``order_key`` order across the fix. Only
    changes of known fixes are renumbered. Remaining NULL indexes become 0.

    One range-staged scan, which a hot group cannot overload, finds the first row of
    each group. All rows move once for it; only the others, the extra rows, move again,
    to be counted within their fix and to meet its highest index. No row is ever joined
    back by its order key.
    """
    tagged = with_group_first(changes.where(F.col("TransmittalID").isNotNull()), ["TransmittalID", "FCIndex"],
                              list(order_key), "_first_ok")
    is_extra = ~F.struct(*order_key).eqNullSafe(F.col("_first_ok"))
    kept, extra = tagged.where(~is_extra).drop("_first_ok"), tagged.where(is_extra).drop("_first_ok")
    per_fix = tagged.groupBy(F.col("TransmittalID").alias("_m_fix")).agg(
        F.coalesce(F.max("FCIndex"), F.lit(0)).alias("_max_idx"))
    known = (fixes.select(F.col("TransmittalId").alias("_k_fix")).distinct()
             .join(per_fix, F.col("_k_fix") == F.col("_m_fix")).drop("_k_fix"))
    counted = (grouped_running_sum(extra, ["TransmittalID"], list(order_key), F.lit(1), "_offset")
               .join(known, F.col("TransmittalID") == F.col("_m_fix"), "left"))
    new_idx = (F.col("_max_idx") + F.col("_offset")).cast(changes.schema["FCIndex"].dataType)
    renumbered = counted.withColumn("FCIndex", F.coalesce(new_idx, F.col("FCIndex"), F.lit(0)))
    return (kept.withColumn("FCIndex", F.coalesce("FCIndex", F.lit(0))).select(*changes.columns)
            .unionByName(renumbered.select(*changes.columns)))


# --------------------------------------------------------- delete propagation ---

def proper_ancestors(path: Column) -> Column:
    """All prefixes of ``path`` that end just before a '/' (array, possibly empty)."""
    parts = F.split(path, "/", -1)
    n = F.size(parts)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))) \
        .otherwise(F.array().cast("array<string>"))


def interval_key(path: Column) -> Column:
    """A text whose order puts a path's descendants, and nothing else, right behind the path:
    hexadecimal segments parted by '!', which comes before every digit."""
    return F.array_join(F.transform(F.split(F.lower(path), "/", -1), lambda x: F.hex(x)), "!")


def propagate_deletes(paths: DataFrame) -> DataFrame:
    """JN7: a live path below a deleted project becomes deleted (one pass, input flags).

    In the order of ``interval_key`` the descendants of a project are one interval, which begins
    at its key with '!' and ends before its key with '"'. Intervals are nested or apart, so a path
    is covered exactly if the farthest end of the intervals begun before it lies behind it: a
    running maximum over paths and begin marks, carried from task to task by the ordered scan. No
    ancestor is exploded, and no project gathers its descendants in one task.
    """
    key = interval_key(F.rtrim("Path"))
    begins = paths.where(F.col("IsProject") & F.col("Deleted")).select(
        F.concat(key, F.lit("!")).alias("_at"), F.lit(0).alias("_kind"), F.concat(key, F.lit('"')).alias("_end")).distinct()
    rows = paths.select("*", interval_key(F.col("Path")).alias("_at"), F.lit(1).alias("_kind"),
                        F.lit(None).cast("string").alias("_end"))
    scanned = running_max(rows.unionByName(begins, allowMissingColumns=True), ["_at", "_kind"], "_end", "_reach")
    covered = F.coalesce(F.col("_reach") > F.col("_at"), F.lit(False))
    return (scanned.where("_kind = 1").withColumn("Deleted", F.col("Deleted") | covered)
            .select(paths.columns))


def live_children_of_deleted(paths: DataFrame) -> DataFrame:
    """DQ2 audit: (parent, child) pairs that propagation must leave empty."""
    parents = paths.where(F.col("IsProject") & F.col("Deleted")).select(
        F.col("Path").alias("parent_path"), ci(F.col("Path")).alias("_anc"))
    live = paths.where(~F.col("Deleted")).select(
        F.col("Path").alias("child_path"), F.explode(proper_ancestors(F.col("Path"))).alias("_a"))
    return live.join(parents, ci(F.col("_a")) == F.col("_anc")).select("parent_path", "child_path")


# ------------------------------------------------------------------ matching ---

#: Revisions, and claims, of a path up to which every pair of the two is looked at.
FEW = 64
LEVEL = "decimal(23,4)"


def _range_join(claims: DataFrame, revs: DataFrame, lo: str, hi: str) -> DataFrame:
    """Join claims to revisions of the same path with ``lo < Revision <= hi``.

    A path with few revisions or few claims has at most ``FEW`` times as many pairs as it has
    rows: the two are joined on the path, with the claims of a hot path dealt over all tasks.
    Paths with many of both go through ``_position_join``, whose work is that of the result.
    ``claims`` is read several times.
    """
    known = revs.where(F.col("Revision").isNotNull()).select(
        F.col("FilePathKey").alias("_r_path"), F.col("Revision").cast(LEVEL).alias("_level"), "FileRevKey")
    busy = stage(known.groupBy("_r_path").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW)
                 .select(F.col("_r_path").alias("_busy")))
    if busy.isEmpty():
        return _pairs_in_range(claims, known, lo, hi)
    many = stage(claims.join(busy, F.col("_c_path") == F.col("_busy"), "left_semi").groupBy("_c_path")
                 .agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > FEW).select(F.col("_c_path").alias("_many")))
    few = _pairs_in_range(claims, known.join(many, F.col("_r_path") == F.col("_many"), "left_anti"), lo, hi)
    scanned = _position_join(claims.join(many, F.col("_c_path") == F.col("_many"), "left_semi"),
                             known.join(many, F.col("_r_path") == F.col("_many"), "left_semi"), lo, hi)
    cols = [*claims.columns, "FileRevKey"]
    return few.select(*cols).unionByName(scanned.select(*cols))


def _pairs_in_range(claims: DataFrame, known: DataFrame, lo: str, hi: str) -> DataFrame:
    """``claims`` with the revisions (_r_path, _level, FileRevKey) of their path in range."""
    return salted_join(claims, known, "_c_path", "_r_path").where(
        (F.col("_level") > F.col(lo).cast(LEVEL)) & (F.col("_level") <= F.col(hi).cast(LEVEL)))


def _position_join(claims: DataFrame, known: DataFrame, lo: str, hi: str) -> DataFrame:
    """``claims`` with the revisions (_r_path, _level, FileRevKey) of their path in range, by position.

    Revisions of a path are numbered by the distributed running count, which also counts
    them up to every bound that a claim names. A claim then covers the positions after its
    lower bound's count up to its upper bound's: exactly the rows of the result, whatever
    the gaps between revision numbers are, and an equi join on (path, position).
    """
    rows = known.select(F.col("_r_path").alias("_path"), "_level", F.lit(0).alias("_kind"),
                        F.col("FileRevKey").alias("_key"))
    bounds = claims.select("_c_path", F.explode(F.array(F.col(lo).cast(LEVEL), F.col(hi).cast(LEVEL))).alias("_level"))
    marks = bounds.distinct().select(F.col("_c_path").alias("_path"), "_level", F.lit(1).alias("_kind"),
                                     F.lit(None).cast(known.schema["FileRevKey"].dataType).alias("_key"))
    counted = stage(grouped_running_sum(rows.unionByName(marks), ["_path"], ["_level", "_kind", "_key"],
                                        1 - F.col("_kind"), "_upto"))
    upto = counted.where("_kind = 1").select("_path", "_level", "_upto")
    low = upto.select(F.col("_path").alias("_lp"), F.col("_level").alias("_lv"), F.col("_upto").alias("_after"))
    high = upto.select(F.col("_path").alias("_hp"), F.col("_level").alias("_hv"), F.col("_upto").alias("_until"))
    placed = (claims.join(low, (F.col("_c_path") == F.col("_lp")) & (F.col(lo).cast(LEVEL) == F.col("_lv")))
              .join(high, (F.col("_c_path") == F.col("_hp")) & (F.col(hi).cast(LEVEL) == F.col("_hv")))
              .where("_until > _after").withColumn("_at", F.explode(F.sequence(F.col("_after") + 1, F.col("_until")))))
    at = counted.where("_kind = 0").select(F.col("_path").alias("_r_path"), F.col("_upto").alias("_r_at"),
                                           F.col("_key").alias("FileRevKey"))
    return placed.join(at, (F.col("_c_path") == F.col("_r_path")) & (F.col("_at") == F.col("_r_at")))


def _numeric_claims(changes: DataFrame) -> DataFrame:
    """FLT6 + SC21: both revision levels must parse as money; others never match."""
    return (changes.withColumn("_from", F.expr(f"try_cast(RevisionLevelFrom as {MONEY})"))
            .withColumn("_to", F.expr(f"try_cast(RevisionLevelTo as {MONEY})"))
            .where(F.col("_from").isNotNull() & F.col("_to").isNotNull()))


def _claims(changes: DataFrame, fixes: DataFrame, levels: Sequence[str] | None) -> DataFrame:
    """Claims with numeric revision levels of the fixes in ``levels`` (None: all)."""
    f = fixes.select(F.col("TransmittalId").alias("_fix"), "ReleaseLev")
    c = changes.join(f, F.col("TransmittalID") == F.col("_fix"))
    if levels:
        c = c.where(F.col("ReleaseLev").isin(*levels))
    return _numeric_claims(c).select("TransmittalID", "FCIndex", "FileChanged", "ReleaseLev", "_from", "_to")


CLAIMED = ("TransmittalID", "FCIndex", "_c_path", "_from", "_to")


def _exact_claims(claims: DataFrame, paths: DataFrame) -> DataFrame:
    """Claims with the live path that equals their normalised path."""
    live = paths.where(~F.col("Deleted")).select(F.col("FilePathKey").alias("_c_path"), ci(F.col("Path")).alias("_p"))
    c = claims.withColumn("_norm", ci(normalize_path(F.col("FileChanged"), F.col("ReleaseLev"))))
    return c.join(live, F.col("_norm") == F.col("_p")).select(*CLAIMED)


def _suffix_claims(claims: DataFrame, paths: DataFrame, width: int) -> DataFrame:
    """Claims with the live paths longer than ``width`` that end as they do. Claims of a suffix
    that is found to be hot are dealt over all tasks, its few paths are sent to each."""
    c = claims.withColumn("_suffix", ci(F.right(F.col("FileChanged"), F.lit(width))))
    live = (paths.where(~F.col("Deleted") & (F.length(F.rtrim("Path")) > width))
            .select(F.col("FilePathKey").alias("_c_path"), ci(F.right(F.col("Path"), F.lit(width))).alias("_ps")))
    return salted_join(c, live, "_suffix", "_ps").select(*CLAIMED)


def match_exact(changes: DataFrame, fixes: DataFrame, paths: DataFrame, revs: DataFrame,
                levels: Sequence[str] | None) -> DataFrame:
    """JN5: claims of fixes in ``levels`` whose normalised path equals a live path and
    whose revision range ``(From, To]`` contains the revision."""
    m = _range_join(stage(_exact_claims(_claims(changes, fixes, levels), paths)), revs, "_from", "_to")
    return m.select("TransmittalID", "FCIndex", "FileRevKey")


def match_all(changes: DataFrame, fixes: DataFrame, paths: DataFrame, revs: DataFrame, levels: Sequence[str] | None,
              width: int) -> DataFrame:
    """JN6 + SET1: exact matches (pass 1) followed by the matches on the last ``width`` characters
    that are new (pass 2, null-unsafe key comparison, as in SQL).

    The claims are built once, and one join finds the revisions for both passes."""
    claims = stage(_claims(changes, fixes, levels))
    both = stage(_exact_claims(claims, paths).withColumn("pass", F.lit(1)).unionByName(
        _suffix_claims(claims, paths, width).withColumn("pass", F.lit(2))))
    found = stage(_range_join(both, revs, "_from", "_to").select("TransmittalID", "FCIndex", "FileRevKey", "pass"))
    exact, approximate = found.where("pass = 1"), found.where("pass = 2")
    old = exact.select(F.col("TransmittalID").alias("_o_fix"), F.col("FCIndex").alias("_o_idx"),
                       F.col("FileRevKey").alias("_o_rev"))
    return exact.unionByName(approximate.join(
        old, (F.col("TransmittalID") == F.col("_o_fix")) & (F.col("FCIndex") == F.col("_o_idx"))
        & (F.col("FileRevKey") == F.col("_o_rev")), "left_anti"))


def duplicate_links(links: DataFrame) -> DataFrame:
    """DQ2 audit: link rows that occur more than once (must be empty)."""
    return (links.groupBy("TransmittalID", "FCIndex", "FileRevKey").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def ungrouped_revisions(grouped: DataFrame) -> DataFrame:
    """DQ2 audit: revisions without a changeset number (must be empty, the column is not nullable)."""
    return grouped.where(F.col("PromoteSeq").isNull()).select("FileRevKey", "FilePathKey")


def approximate_matches(links: DataFrame, changes: DataFrame, paths: DataFrame, revs: DataFrame) -> DataFrame:
    """DQ2 audit: link rows whose live path differs from the claimed path."""
    c = changes.select(F.col("TransmittalID").alias("_c_fix"), F.col("FCIndex").alias("_c_idx"), "FileChanged")
    r = revs.select(F.col("FileRevKey").alias("_r_key"), F.col("FilePathKey").alias("_r_path"))
    p = paths.select(F.col("FilePathKey").alias("_p_key"), "Path")
    j = (links.join(c, (F.col("TransmittalID") == F.col("_c_fix")) & (F.col("FCIndex") == F.col("_c_idx")))
         .join(r, F.col("FileRevKey") == F.col("_r_key")).join(p, F.col("_r_path") == F.col("_p_key")))
    return j.where(ci(F.col("Path")) != ci(F.col("FileChanged"))).select(
        "FileChanged", "Path", "TransmittalID", "FCIndex", "FileRevKey")


# ---------------------------------------------------------------- changesets ---

def comment_key(c: Column) -> Column:
    """Comment compare text: CRLF and spaces removed (lone LF kept), NULL as ''."""
    return F.coalesce(F.replace(F.replace(c, F.lit("\r\n"), F.lit("")), F.lit(" "), F.lit("")), F.lit(""))


def _opens(prev: dict, cur: dict) -> Column:
    """New changeset when the previous user is set and the user or comment differs
    (case-insensitive; a NULL current user differs only through the comment)."""
    user_differs = F.coalesce(cur["_user"] != prev["_user"], F.lit(False))
    return prev["_user"].isNotNull() & (user_differs | (cur["_ckey"] != prev["_ckey"]))


CHANGESET_ORDER = ("CommitTime", "_user", "FilePathKey", "Revision", "FileRevKey")


def changesets(revs: DataFrame, paths: DataFrame, partitions: int | None = None) -> DataFrame:
    """WIN4 + WIN6: changeset number per revision in one global order.

    Order: commit time, user (case-insensitive), path key, then revision and
    revision key to make it total. Revisions of deleted paths get -1.
    """
    p = paths.select(F.col("FilePathKey").alias("_p_key"), "Deleted")
    joined = revs.join(p, F.col("FilePathKey") == F.col("_p_key")).drop("_p_key")
    live = (joined.where(~F.col("Deleted"))
            .withColumn("_user", F.lower(F.rtrim(F.col("Usr"))))
            .withColumn("_ckey", F.lower(comment_key(F.col("Comment")))))
    grouped = global_islands(live, list(CHANGESET_ORDER), _opens, ["_user", "_ckey"], "PromoteSeq",
                             partitions=partitions)
    dead = joined.where(F.col("Deleted")).withColumn("PromoteSeq", F.lit(-1).cast("long"))
    cols = [*revs.columns, "PromoteSeq"]
    return grouped.select(*cols).unionByName(dead.select(*cols))


# ----------------------------------------------------------------- snapshots ---

def tree_asof(revs: DataFrame, paths: DataFrame, at: str, deleted_actions: Sequence[str] = ()) -> DataFrame:
    """JN15: per live path, its latest revision committed at or before ``at``.

    A path whose latest revision is a delete action is absent from the tree.
    """
    p = paths.where(~F.col("Deleted")).select(F.col("FilePathKey").alias("_p_key"))
    r = revs.where(F.col("CommitTime") <= F.lit(at).cast("timestamp_ntz"))
    r = r.join(p, F.col("FilePathKey") == F.col("_p_key"), "left_semi")
    latest = r.groupBy("FilePathKey").agg(
        F.max_by(F.struct("Revision", "FileRevKey", "CommitTime", "Action"),
                 F.struct("CommitTime", "Revision", "FileRevKey")).alias("_l"))
    out = latest.select("FilePathKey", "_l.Revision", "_l.FileRevKey", "_l.CommitTime", "_l.Action")
    if deleted_actions:
        out = out.where(~F.col("Action").isin(*deleted_actions))
    return out.drop("Action")


def tree_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """JN16: added / changed / missing paths from tree state ``a`` to ``b``."""
    x = a.select(F.col("FilePathKey").alias("_ka"), F.col("FileRevKey").alias("rev_a"))
    y = b.select(F.col("FilePathKey").alias("_kb"), F.col("FileRevKey").alias("rev_b"))
    j = x.join(y, F.col("_ka") == F.col("_kb"), "full_outer")
    change = (F.when(F.col("_ka").isNull(), "added").when(F.col("_kb").isNull(), "missing")
              .when(F.col("rev_a") != F.col("rev_b"), "changed"))
    return (j.select(F.coalesce("_ka", "_kb").alias("FilePathKey"), "rev_a", "rev_b", change.alias("change"))
            .where(F.col("change").isNotNull()))


# ------------------------------------------------------------ pin manifests ---

PIN_PATTERN = r'get\s+(?:"([^"]*)"|(\S+))\s+-V(\d+)\b.*-GL"([^"]*)"'


def parse_pin_manifest(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """SRC7: ``get <path> -V<n> ... -GL"<dir>"`` lines -> (path, revision, target_dir)."""
    m = lines.where(F.col(text_col).rlike(PIN_PATTERN))
    quoted, bare = F.regexp_extract(text_col, PIN_PATTERN, 1), F.regexp_extract(text_col, PIN_PATTERN, 2)
    return m.select(F.when(bare != "", bare).otherwise(quoted).alias("path"),
                    F.regexp_extract(text_col, PIN_PATTERN, 3).cast("long").alias("revision"),
                    F.regexp_extract(text_col, PIN_PATTERN, 4).alias("target_dir"))


def select_pinned(pins: DataFrame, paths: DataFrame, revs: DataFrame) -> DataFrame:
    """Pins joined to their revision by (path, revision); unmatched pins keep a NULL key."""
    pr = (revs.join(paths.select(F.col("FilePathKey").alias("_pk"), "Path"), F.col("FilePathKey") == F.col("_pk"))
          .select(ci(F.col("Path")).alias("_path"), F.col("Revision").alias("_rev"), "FileRevKey"))
    return (pins.join(pr, (ci(F.col("path")) == F.col("_path")) & (F.col("revision") == F.col("_rev")), "left")
            .select("path", "revision", "target_dir", "FileRevKey"))
