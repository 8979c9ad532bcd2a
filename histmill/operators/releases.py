"""Release catalog cleanup (PRJ6, SC12, SC13).

The original runs fifty UPDATE statements over the catalog. Here the catalog
is one lazy DataFrame and each rule is a column expression:

* the suffix rules all read only ``ReleaseID`` and set label columns, so they
  fold into one CASE per output column where the last matching rule wins;
* the later rules read columns written before them, so they are applied as
  staged ``withColumns`` in source order.

Comparisons follow the source server's case-insensitive collation (compare
lower-cased values).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmill.functions.text import ci

# ---- fixed values: release-id suffix rules, in source order ------------------
# (suffixes, language label, hotfix label); a label of None leaves it untouched.
SUFFIX_RULES: list[tuple[tuple[str, ...], str | None, str | None]] = [
    (("_Spanish",), "Spanish", None),
    (("_Chinese",), "Chinese", None),
    (("_MC",), "Chinese", None),
    (("_Dutch",), "Dutch", None),
    (("_French",), "French", None),
    (("_German",), "German", None),
    (("_Italian",), "Italian", None),
    (("_Japan", "_Japanese"), "Japanese", None),
    (("_JE",), "JapaneseEnglish", None),
    (("_ME",), "MainlandEnglish", None),
    (("_Portug",), "Portuguese", None),
    (("_Taiwan", "_Taiwanese"), "Taiwanese", None),
    (("_TE",), "TaiwaneseEnglish", None),
    (("_HotFix", "_Hotfix"), None, "HotFix"),
    (("_ChineseHF",), "Chinese", "HotFix"),
    (("_FrenchHF",), "French", "HotFix"),
    (("_GermanHF",), "German", "HotFix"),
    (("_JapanHF",), "Japanese", "HotFix"),
    (("_SpanishHF",), "Spanish", "HotFix"),
    (("_TaiwanHF",), "Taiwanese", "HotFix"),
    (("_MEHF",), "MainlandEnglish", "HotFix"),
    (("_Utility",), None, "Utility"),
]
UNRELEASED_IDS = ("LEDO 5.10", "INAP 7.50.4", "Visibar 5.5D", "8.0")
VERSION_ALIASES = {"8.0": "8.00"}
PREFIXES_STRIPPED = ("LEDO ", "INAP ")
# AffectsVersion -> development branch that replaces branch, fixed and affects version
DEV_BRANCHES = {"7.30M": "7_30_DEV", "7.40L": "7_40_DEV", "7.50F": "7_50_DEV", "8.00": "8_00_DEV"}
# product line release level -> (branch, development version)
PRODUCT_LINES = {"LEDO": ("LEDO_DEV", "5.10"), "INAP": ("INAP_DEV", "7.50.4")}
# (AffectsVersion, branch, hotfix label, released?) for the named add-on releases
ADDON_RELEASES = [("BI 2", "7_50C", "BI2", None), ("BI 3", "7_50_DEV", "BI3", False),
                  ("BRM 5.0", "7_30", "BRM50", None), ("BRM 5.7", "7_40", "BRM57", None)]
BI1 = ("BI 1", "7_50", "BI1")
LEVEL_BRANCHES = {"7.00": "7_00", "7.10": "7_10", "7.20": "7_20"}
NOTA_FISCAL = ("7.3NF", "7_30", "NotaFiscal")
# AffectsVersion prefix -> development branch for unlabelled releases outside INAP
PREFIX_DEV_BRANCHES = [("7.30", "7_30_DEV"), ("7.40", "7_40_DEV"), ("7.50", "7_50_DEV")]
# ------------------------------------------------------------------------------


def _ci_eq(c: Column, value: str) -> Column:
    """Equality under a case-insensitive, trailing-space-insensitive collation."""
    return F.lower(F.rtrim(c)) == F.lit(value.lower().rstrip())


def _ci_in(c: Column, values) -> Column:
    return F.lower(F.rtrim(c)).isin(*[v.lower().rstrip() for v in values])


def _suffix_match(release_id: Column, suffixes) -> Column:
    cond = None
    for s in suffixes:
        one = F.lower(F.right(release_id, F.lit(len(s)))) == F.lit(s.lower())
        cond = one if cond is None else (cond | one)
    return cond


def suffix_labels(release_id: Column) -> tuple[Column, Column, Column]:
    """SC12: (LanguageLabel, HotfixLabel, matched) for a release id; last matching rule wins."""
    lang = F.lit(None).cast("string")
    hotfix = F.lit(None).cast("string")
    matched = F.lit(False)
    for suffixes, lang_label, hotfix_label in SUFFIX_RULES:
        cond = _suffix_match(release_id, suffixes)
        if lang_label is not None:
            lang = F.when(cond, F.lit(lang_label)).otherwise(lang)
        if hotfix_label is not None:
            hotfix = F.when(cond, F.lit(hotfix_label)).otherwise(hotfix)
        matched = matched | cond
    return lang, hotfix, matched


def version_before_underscore(release_id: Column) -> Column:
    """Text before the first '_' (only meaningful when one exists)."""
    return F.substring_index(release_id, "_", 1)


def _suffix_state(release_id: Column) -> dict[str, Column]:
    """First stage: defaults plus the suffix rules, as column expressions."""
    lang, hotfix, matched = suffix_labels(release_id)
    return {
        "IsReleased": F.lit(True),
        "LanguageLabel": lang,
        "HotfixLabel": hotfix,
        "AffectsVersion": F.when(matched & (F.locate("_", release_id) > 0),
                                 version_before_underscore(release_id)).otherwise(release_id),
    }


def apply_suffix_rules(releases: DataFrame) -> DataFrame:
    """SC12 only: defaults plus the suffix rules."""
    return releases.withColumns(_suffix_state(F.col("ReleaseID")))


def _set(state: dict[str, Column], cond: Column, **values) -> None:
    """One UPDATE ... SET ... WHERE cond: every SET reads the values before the update."""
    new = {k: F.when(cond, v if isinstance(v, Column) else F.lit(v)).otherwise(state[k]) for k, v in values.items()}
    state.update(new)


OUTPUT_COLUMNS = ("ReleaseLev", "ReleaseID", "IsReleased", "LanguageLabel", "HotfixLabel", "AffectsVersion",
                  "FixedVersion", "JIRABranch")


def apply_release_rules(releases: DataFrame) -> DataFrame:
    """PRJ6: raw ``(ReleaseLev, ReleaseID)`` -> clean catalog with labels, versions, branch and released flag.

    The ordered rules are composed as column expressions on the driver (each rule
    reads the expressions left by the rules before it) and applied in a single
    projection: one analysis pass instead of one per rule.
    """
    rid, lev = F.col("ReleaseID"), F.col("ReleaseLev")
    st = _suffix_state(rid)
    # materialise the suffix stage once so later rules reference columns, not the whole suffix CASE
    base = releases.select("ReleaseLev", "ReleaseID", *[v.alias(k) for k, v in st.items()])
    st = {k: F.col(k) for k in ("IsReleased", "LanguageLabel", "HotfixLabel", "AffectsVersion")}
    _set(st, _ci_in(rid, UNRELEASED_IDS), IsReleased=False)
    for old, new in VERSION_ALIASES.items():
        _set(st, _ci_eq(rid, old), AffectsVersion=new)
    av = st["AffectsVersion"]
    _set(st, _ci_in(F.left(av, F.lit(5)), PREFIXES_STRIPPED), AffectsVersion=F.substr(av, F.lit(6)))
    base = base.select("ReleaseLev", "ReleaseID", *[v.alias(k) for k, v in st.items()])
    st = {k: F.col(k) for k in ("IsReleased", "LanguageLabel", "HotfixLabel", "AffectsVersion")}
    st["FixedVersion"] = st["AffectsVersion"]
    st["JIRABranch"] = F.translate(F.coalesce(st["AffectsVersion"], rid), ". ", "__")
    for version, branch in DEV_BRANCHES.items():
        _set(st, _ci_eq(st["AffectsVersion"], version), JIRABranch=branch, FixedVersion=branch,
             AffectsVersion=branch, IsReleased=False)
    for level, (branch, dev_version) in PRODUCT_LINES.items():
        _set(st, _ci_eq(lev, level), JIRABranch=branch)
        _set(st, _ci_eq(st["AffectsVersion"], dev_version), FixedVersion=branch, AffectsVersion=branch,
             IsReleased=False)
    base = base.select("ReleaseLev", "ReleaseID", *[v.alias(k) for k, v in st.items()])
    st = {k: F.col(k) for k in OUTPUT_COLUMNS[2:]}
    bi1_version, bi1_branch, bi1_label = BI1
    is_bi1 = _ci_eq(st["AffectsVersion"], bi1_version)
    _set(st, is_bi1 & st["HotfixLabel"].isNull(), JIRABranch=bi1_branch, HotfixLabel=bi1_label)
    _set(st, is_bi1 & st["LanguageLabel"].isNull() & ~_ci_eq(st["HotfixLabel"], bi1_label),
         JIRABranch=bi1_branch, LanguageLabel=bi1_label)
    for version, branch, label, released in ADDON_RELEASES:
        values = {"JIRABranch": branch, "HotfixLabel": label}
        if released is not None:
            values["IsReleased"] = released
        _set(st, _ci_eq(st["AffectsVersion"], version), **values)
    for level, branch in LEVEL_BRANCHES.items():
        _set(st, _ci_eq(lev, level), JIRABranch=branch)
    nf_id, nf_branch, nf_label = NOTA_FISCAL
    _set(st, _ci_eq(rid, nf_id), JIRABranch=nf_branch, HotfixLabel=nf_label)
    unlabelled = F.coalesce(st["HotfixLabel"], st["LanguageLabel"]).isNull()
    for prefix, branch in PREFIX_DEV_BRANCHES:
        _set(st, ~_ci_eq(lev, "INAP") & F.lower(st["AffectsVersion"]).startswith(prefix.lower()) & unlabelled,
             JIRABranch=branch)
    unlabelled = F.coalesce(st["HotfixLabel"], st["LanguageLabel"]).isNull()
    _set(st, ~unlabelled & ~_ci_in(lev, tuple(PRODUCT_LINES)), FixedVersion=st["JIRABranch"])
    return base.select("ReleaseLev", "ReleaseID", *[st[k].alias(k) for k in OUTPUT_COLUMNS[2:]])


def catalog_for_version(catalog: DataFrame, items: DataFrame, version_col: str, level_col: str,
                        keep: list[str] | None = None) -> DataFrame:
    """Left lookup of one catalog row per item by version (ledger #5).

    The original joins on the version only and keeps whichever row came last, so
    an item may meet several rows. Here exactly one is kept: the row whose level
    equals the item's level, else the lowest (ReleaseLev, ReleaseID). Both
    lookups are joins against catalog-sized relations, so the item side is never
    regrouped; the catalog columns (or only ``keep``) are appended to ``items``.
    """
    cols = catalog.columns  # starts with ReleaseLev, ReleaseID
    exact = catalog.select(ci(F.col("ReleaseID")).alias("_cat_v"), ci(F.col("ReleaseLev")).alias("_cat_l"),
                           F.struct(*cols).alias("_cat_exact"))
    fallback = catalog.groupBy(ci(F.col("ReleaseID")).alias("_cat_fv")).agg(F.min(F.struct(*cols)).alias("_cat_fb"))
    out = (items.join(exact, (ci(F.col(version_col)) == F.col("_cat_v")) & (ci(F.col(level_col)) == F.col("_cat_l")), "left")
           .join(fallback, ci(F.col(version_col)) == F.col("_cat_fv"), "left")
           .withColumn("_cat", F.coalesce("_cat_exact", "_cat_fb")))
    return out.select(*items.columns, *[F.col("_cat")[c].alias(c) for c in (keep or cols)])
