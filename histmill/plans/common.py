"""Shared inputs of the registered queries: domain views and cleaned stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from histmill.functions import codes
from histmill.operators.releases import apply_release_rules
from histmill.session import stage
from histmill.sources.views import view


def v(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return view(spark, sf_dir, name)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean release catalog (PRJ6 applied to the raw catalog view), staged once per query."""
    return stage(apply_release_rules(v(spark, sf_dir, "v_release")))


def case_of(expr: str, table: dict, default: str | None = None) -> str:
    """SQL for a code map of ``functions.codes``."""
    arms = " ".join(f"when '{k}' then '{x}'" for k, x in table.items())
    tail = "null" if default is None else f"'{default}'"
    return f"case {expr} {arms} else {tail} end"


DONE = ", ".join(f"'{w}'" for w in codes.WAITING_DONE)


def link_stats_sql(name: str, keep: str = "true") -> str:
    """CTE ``name``: per defect the number of its fixes, of the unresolved ones, and the least
    of their highest defects; ``keep`` restricts the links."""
    return f"""
{name}_top as (
  select TransmittalID, SDR_Num, max(SDR_Num) over (partition by TransmittalID) as top from v_link where {keep}),
{name} as (
  select t.SDR_Num, count(*) as TransCount, count(*) filter (coalesce(x.WaitingOn, '') not in ({DONE})) as UnresolvedCount,
    min(t.top) as MinLastSDR
  from {name}_top t join v_resolution x on x.TransmittalId = t.TransmittalID group by t.SDR_Num)"""


# a defect's situation, from its row, its link statistics and its catalog row
SITUATION_SQL = """coalesce(TransCount, 0) > 0 as has_fixes, coalesce(MinLastSDR = SDRNum, false) as leads,
    coalesce(MinLastSDR > SDRNum, false) as follows,
    coalesce(Status = 'C' and UnresolvedCount = 0 and IsReleased, false) as shipped"""
STATUS_SQL = """if(has_fixes and leads, if(shipped, 'Resolved', 'Awaiting Resolutions'),
    if(coalesce(Status, '') = 'O', 'Open', 'Resolved'))"""
RESOLUTION_SQL = f"""case when has_fixes and follows then if(coalesce(Status, '') = 'O', '', 'Fixed Other')
    when has_fixes then if(shipped, 'Fixed', 'Waiting')
    when Status = 'W' then {case_of('ReasonCode', codes.WAITING_REASONS, '')}
    when Status = 'C' then {case_of('ReasonCode', codes.CLOSED_REASONS, codes.CLOSED_REASON_DEFAULT)}
    else '' end"""


# Oracle twin of apply_release_rules over v_release, as staged CTEs in source order.
# Every comparison is case-insensitive, as in the Spark rules.
CATALOG_SQL = r"""
rel0 as (
  select ReleaseLev, ReleaseID, lower(ReleaseID) as rid from v_release),
rel1 as (
  select ReleaseLev, ReleaseID,
    case when rid like '%\_spanishhf' escape '\' then 'Spanish' when rid like '%\_taiwanhf' escape '\' then 'Taiwanese'
         when rid like '%\_mehf' escape '\' then 'MainlandEnglish' when rid like '%\_japanhf' escape '\' then 'Japanese'
         when rid like '%\_germanhf' escape '\' then 'German' when rid like '%\_frenchhf' escape '\' then 'French'
         when rid like '%\_chinesehf' escape '\' then 'Chinese' when rid like '%\_te' escape '\' then 'TaiwaneseEnglish'
         when rid like '%\_taiwan' escape '\' or rid like '%\_taiwanese' escape '\' then 'Taiwanese'
         when rid like '%\_portug' escape '\' then 'Portuguese' when rid like '%\_me' escape '\' then 'MainlandEnglish'
         when rid like '%\_je' escape '\' then 'JapaneseEnglish'
         when rid like '%\_japan' escape '\' or rid like '%\_japanese' escape '\' then 'Japanese'
         when rid like '%\_italian' escape '\' then 'Italian' when rid like '%\_german' escape '\' then 'German'
         when rid like '%\_french' escape '\' then 'French' when rid like '%\_dutch' escape '\' then 'Dutch'
         when rid like '%\_mc' escape '\' then 'Chinese' when rid like '%\_chinese' escape '\' then 'Chinese'
         when rid like '%\_spanish' escape '\' then 'Spanish' end as LanguageLabel,
    case when rid like '%\_utility' escape '\' then 'Utility'
         when rid like '%\_mehf' escape '\' or rid like '%\_taiwanhf' escape '\' or rid like '%\_spanishhf' escape '\'
           or rid like '%\_japanhf' escape '\' or rid like '%\_germanhf' escape '\' or rid like '%\_frenchhf' escape '\'
           or rid like '%\_chinesehf' escape '\' or rid like '%\_hotfix' escape '\' then 'HotFix' end as HotfixLabel,
    regexp_matches(rid, '_(spanish|chinese|mc|dutch|french|german|italian|japan|japanese|je|me|portug|taiwan|taiwanese|te|hotfix|chinesehf|frenchhf|germanhf|japanhf|spanishhf|taiwanhf|mehf|utility)$') as matched
  from rel0),
rel2 as (
  select ReleaseLev, ReleaseID, LanguageLabel, HotfixLabel,
    case when lower(ReleaseID) in ('ledo 5.10', 'inap 7.50.4', 'visibar 5.5d', '8.0') then false else true end as IsReleased,
    case when matched then split_part(ReleaseID, '_', 1) else ReleaseID end as av0
  from rel1),
rel3 as (
  select *, case when lower(ReleaseID) = '8.0' then '8.00' else av0 end as av1 from rel2),
rel4 as (
  select *, case when lower(rtrim(left(av1, 5))) in ('ledo', 'inap') then substring(av1, 6, 20) else av1 end as av2 from rel3),
rel5 as (
  select ReleaseLev, ReleaseID, LanguageLabel, HotfixLabel, IsReleased, av2,
    translate(coalesce(av2, ReleaseID), '. ', '__') as br0 from rel4),
rel6 as (
  select ReleaseLev, ReleaseID, LanguageLabel, HotfixLabel,
    case when lower(av2) in ('7.30m', '7.40l', '7.50f', '8.00') then false else IsReleased end as IsReleased,
    case lower(av2) when '7.30m' then '7_30_DEV' when '7.40l' then '7_40_DEV' when '7.50f' then '7_50_DEV'
      when '8.00' then '8_00_DEV' else av2 end as AffectsVersion,
    case lower(av2) when '7.30m' then '7_30_DEV' when '7.40l' then '7_40_DEV' when '7.50f' then '7_50_DEV'
      when '8.00' then '8_00_DEV' else av2 end as FixedVersion,
    case lower(av2) when '7.30m' then '7_30_DEV' when '7.40l' then '7_40_DEV' when '7.50f' then '7_50_DEV'
      when '8.00' then '8_00_DEV' else br0 end as JIRABranch
  from rel5),
rel7 as (
  select ReleaseLev, ReleaseID, LanguageLabel, HotfixLabel,
    case when lower(ReleaseLev) = 'ledo' then 'LEDO_DEV' else JIRABranch end as JIRABranch,
    case when lower(AffectsVersion) = '5.10' then false else IsReleased end as IsReleased,
    case when lower(AffectsVersion) = '5.10' then 'LEDO_DEV' else FixedVersion end as FixedVersion,
    case when lower(AffectsVersion) = '5.10' then 'LEDO_DEV' else AffectsVersion end as AffectsVersion
  from rel6),
rel8 as (
  select ReleaseLev, ReleaseID, LanguageLabel, HotfixLabel,
    case when lower(ReleaseLev) = 'inap' then 'INAP_DEV' else JIRABranch end as JIRABranch,
    case when lower(AffectsVersion) = '7.50.4' then false else IsReleased end as IsReleased,
    case when lower(AffectsVersion) = '7.50.4' then 'INAP_DEV' else FixedVersion end as FixedVersion,
    case when lower(AffectsVersion) = '7.50.4' then 'INAP_DEV' else AffectsVersion end as AffectsVersion
  from rel7),
rel9 as (
  select ReleaseLev, ReleaseID, LanguageLabel, IsReleased, FixedVersion, AffectsVersion,
    case when lower(AffectsVersion) = 'bi 1' and HotfixLabel is null then '7_50' else JIRABranch end as JIRABranch,
    case when lower(AffectsVersion) = 'bi 1' and HotfixLabel is null then 'BI1' else HotfixLabel end as HotfixLabel
  from rel8),
rel10 as (
  select ReleaseLev, ReleaseID, HotfixLabel, FixedVersion, AffectsVersion,
    case when lower(AffectsVersion) = 'bi 1' and LanguageLabel is null and lower(HotfixLabel) <> 'bi1' then '7_50'
         when lower(AffectsVersion) = 'bi 2' then '7_50C' when lower(AffectsVersion) = 'bi 3' then '7_50_DEV'
         when lower(AffectsVersion) = 'brm 5.0' then '7_30' when lower(AffectsVersion) = 'brm 5.7' then '7_40'
         else JIRABranch end as JIRABranch,
    case when lower(AffectsVersion) = 'bi 1' and LanguageLabel is null and lower(HotfixLabel) <> 'bi1' then 'BI1'
         else LanguageLabel end as LanguageLabel,
    case when lower(AffectsVersion) = 'bi 3' then false else IsReleased end as IsReleased
  from rel9),
rel11 as (
  select ReleaseLev, ReleaseID, LanguageLabel, FixedVersion, AffectsVersion, IsReleased,
    case lower(AffectsVersion) when 'bi 2' then 'BI2' when 'bi 3' then 'BI3' when 'brm 5.0' then 'BRM50'
      when 'brm 5.7' then 'BRM57' else HotfixLabel end as HotfixLabel, JIRABranch
  from rel10),
rel12 as (
  select ReleaseLev, ReleaseID, LanguageLabel, FixedVersion, AffectsVersion, IsReleased,
    case when lower(ReleaseID) = '7.3nf' then 'NotaFiscal' else HotfixLabel end as HotfixLabel,
    case when lower(ReleaseID) = '7.3nf' then '7_30'
         when lower(ReleaseLev) = '7.20' then '7_20' when lower(ReleaseLev) = '7.10' then '7_10'
         when lower(ReleaseLev) = '7.00' then '7_00' else JIRABranch end as JIRABranch
  from rel11),
rel13 as (
  select ReleaseLev, ReleaseID, LanguageLabel, FixedVersion, AffectsVersion, IsReleased, HotfixLabel,
    case when lower(ReleaseLev) <> 'inap' and coalesce(HotfixLabel, LanguageLabel) is null
           and starts_with(lower(AffectsVersion), '7.50') then '7_50_DEV'
         when lower(ReleaseLev) <> 'inap' and coalesce(HotfixLabel, LanguageLabel) is null
           and starts_with(lower(AffectsVersion), '7.40') then '7_40_DEV'
         when lower(ReleaseLev) <> 'inap' and coalesce(HotfixLabel, LanguageLabel) is null
           and starts_with(lower(AffectsVersion), '7.30') then '7_30_DEV'
         else JIRABranch end as JIRABranch
  from rel12),
catalog as (
  select ReleaseLev, ReleaseID, IsReleased, LanguageLabel, HotfixLabel, AffectsVersion,
    case when coalesce(HotfixLabel, LanguageLabel) is not null and lower(ReleaseLev) not in ('ledo', 'inap')
         then JIRABranch else FixedVersion end as FixedVersion, JIRABranch
  from rel13)"""


def with_catalog(sql: str) -> str:
    """Prefix an oracle query that reads ``catalog`` with the staged catalog CTEs."""
    sql = sql.strip()
    return "with " + CATALOG_SQL.strip() + ("" if sql.startswith(",") else "\n") + sql
