"""Text functions over whole texts: cleaning, summaries, paths, payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from histmill.functions.text import crlf_to_lf, first_sentence, trim_single_line
from histmill.operators import texts
from histmill.plans.common import v
from histmill.plans.registry import query
from histmill.plans.revision_plans import NORM_SQL
from histmill.sources.tables import read_table

TAB = "chr(9)"


@query("text_clean", oracle=r"""
select event_id,
  regexp_replace(replace(Description, chr(13) || chr(10), chr(10)), '^\s*(.*?)\s*$', '\1') as description
from v_sdr_log""")
def text_clean(spark, sf):
    """SC2 + SC4: CRLF -> LF, then trim a text that has a single content line."""
    log = v(spark, sf, "v_sdr_log")
    return log.select("event_id", trim_single_line(crlf_to_lf(F.col("Description"))).alias("description"))


@query("first_sentence", oracle=r"""
select doc_id,
  regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '^\s*(\S.{2}([^.\n]|\.\d)*).*$', '\1', 's') as summary
from documents""")
def first_sentence_q(spark, sf):
    """SC5 over every whole document text."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", first_sentence(crlf_to_lf(F.col("text"))).alias("summary"))


@query("path_normalize", oracle=f"""
with claim_paths as (
  select f.TransmittalID, f.FCIndex, f.FileChanged, r.ReleaseLev,
    replace(rtrim(ltrim(replace(f.FileChanged, chr(9), ''))), chr(92), '/') as np
  from v_file_change f join v_resolution r on r.TransmittalId = f.TransmittalID)
select TransmittalID, FCIndex, FileChanged, {NORM_SQL.strip()} as NormalPath from claim_paths""")
def path_normalize(spark, sf):
    """SC3 + SC11: normalised claim path (needs the fix's release level)."""
    f = v(spark, sf, "v_file_change").select("TransmittalID", "FCIndex", "FileChanged")
    r = v(spark, sf, "v_resolution").select(F.col("TransmittalId").alias("_fix"), "ReleaseLev")
    j = f.join(r, F.col("TransmittalID") == F.col("_fix"))
    return j.select("TransmittalID", "FCIndex", "FileChanged",
                    texts.normalize_path(F.col("FileChanged"), F.col("ReleaseLev")).alias("NormalPath"))


#: An invented pair for the optional namespace rewrite.
NAMESPACE = ("\\Brand1", "\\Ns.BrandOne")
REWRITES = texts.rewrite_pairs(NAMESPACE)


def _rewrite_sql(expr: str) -> str:
    out = expr
    for old, new in REWRITES:
        pat = "".join("\\" + ch if ch in "\\.$[](){}*+?^|" else ch for ch in old)
        out = f"regexp_replace({out}, '{pat}', '{new.replace(chr(92), chr(92) * 2)}', 'gi')"
    return f"rtrim(ltrim({out}))"


@query("path_rewrite", oracle=f"""
select TransmittalID, FCIndex, FileChanged, {_rewrite_sql('FileChanged')} as ModifiedFileChanged from v_file_change""")
def path_rewrite(spark, sf):
    """SC1: ordered, case-insensitive rewrite chain on every claimed path."""
    f = v(spark, sf, "v_file_change").select("TransmittalID", "FCIndex", "FileChanged")
    return f.withColumn("ModifiedFileChanged", texts.rewrite_path(F.col("FileChanged"), REWRITES))


MANIFEST_TARGET_LIKE = "7.1_%"
MANIFEST_FIX_IDS = (3, 5, 7)
MANIFEST_EXCLUDED = ((32, 2), (33, 3))


@query("copy_manifest", oracle=f"""
with wanted as (
  select TransmittalId from v_resolution where RlsLevelTarget ilike '7.1_%'
  union select TransmittalId from v_resolution where TransmittalId in (3, 5, 7)),
excluded(fix, idx) as (values (32, 2), (33, 3)),
picked as (
  select f.FileChanged from v_file_change f semi join wanted w on w.TransmittalId = f.TransmittalID
  where f.FileChanged > '' and not contains(lower(f.FileChanged), '/translation/transaction')
    and not exists (select 1 from excluded e where e.fix = f.TransmittalID and (f.FCIndex is null or f.FCIndex = e.idx)))
select 0 as seq, cast(null as varchar) as path,
  concat('set fromdir=c:', chr(92), 'fromdir', chr(10), 'set todir=c:', chr(92), 'todir', chr(10)) as line
union all
select 1, m, concat('XCOPY /Y "%fromdir%', m, '" "%todir%', m, '*"', chr(10))
from (select distinct {_rewrite_sql('FileChanged')} as m from picked)""")
def copy_manifest_q(spark, sf):
    """SNK6 + AGG5: copy commands for the distinct rewritten paths of the selected fixes."""
    r = v(spark, sf, "v_resolution").select("TransmittalId", "RlsLevelTarget")
    f = v(spark, sf, "v_file_change").select(F.col("TransmittalID").alias("_fix"), "FCIndex", "FileChanged")
    cond = (F.col("RlsLevelTarget").ilike(MANIFEST_TARGET_LIKE) | F.col("TransmittalId").isin(*MANIFEST_FIX_IDS)) \
        & (F.col("FileChanged") > "") & ~F.col("FileChanged").ilike("%/Translation/Transaction%")
    for fix, idx in MANIFEST_EXCLUDED:
        cond = cond & ~((F.col("TransmittalId") == fix) & (F.col("FCIndex") == idx))
    picked = r.join(f, F.col("TransmittalId") == F.col("_fix")).where(cond)
    return texts.copy_manifest(picked.select(texts.rewrite_path(F.col("FileChanged"), REWRITES).alias("ModifiedFileChanged")))


PAYLOAD_LEVELS = ("L0", "L1", "L3")
DEPOT = "MAIN"


@query("xml_payload", oracle=r"""
select TransmittalId,
  '<?xml version="1.0" encoding="UTF-8"?>' || chr(10) || '<newIssue issueDB="MAIN">' || chr(10) || chr(9) || '<issue>'
  || chr(10) || chr(9) || chr(9) || '<shortDescription fid="4">'
  || replace(replace(replace(regexp_replace(replace(ReadMe, chr(13) || chr(10), chr(10)),
       '^(.{3}([^.\n]|\.\d)*)(.|\n|$).*$', '\1', 's'), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')
  || '</shortDescription>' || chr(10) || chr(9) || chr(9) || '<type fid="7">defect</type>' || chr(10) || chr(9)
  || '</issue>' || chr(10) || '</newIssue>' || chr(10) as payload
from v_resolution where ReleaseLev in ('L0', 'L1', 'L3')""")
def xml_payload(spark, sf):
    """SNK5 + SC6 + SC7: one issue-creation payload per fix of the listed levels."""
    r = v(spark, sf, "v_resolution").where(F.col("ReleaseLev").isin(*PAYLOAD_LEVELS))
    return r.select("TransmittalId", texts.issue_payload(F.col("ReadMe"), DEPOT).alias("payload"))


REPLY_PATTERN = r"<title>([^<&]+)<"


@query("extract_id_split", oracle=r"""
select page_id, case when regexp_matches(html, '<title>([^<&]+)<') then regexp_extract(html, '<title>([^<&]+)<', 1) end as issue,
  case when regexp_matches(html, '<title>([^<&]+)<') then 'link' else 'reject' end as outcome
from pages""")
def extract_id_split(spark, sf):
    """SRC5: parse an id out of each reply; matched rows become links, the rest rejects."""
    pages = read_table(spark, sf, "pages", ["page_id", "html"])
    return texts.extract_issue_ids(pages, "html", REPLY_PATTERN).select("page_id", "issue", "outcome")
