"""Import-scope closure query."""

from __future__ import annotations

from histmill.operators import scope as sc
from histmill.plans.common import CATALOG_SQL, catalog, v
from histmill.plans.registry import query

RELEASES = ("L0", "L1")


def closure_ctes(releases=RELEASES, inherit_version: str | None = None) -> str:
    """The closure as recursive CTEs; the last one is ``scope`` (kind, id, ImportGroup, Branch, Version)."""
    listed = "(" + ", ".join(f"'{r}'" for r in releases) + ")"
    special = f" and lower(s.Version) <> lower('{inherit_version}')" if inherit_version else ""
    parts = [CATALOG_SQL.strip(), f"""
fixn as (
  select r.TransmittalId as id, r.ReleaseLev as rel, c.JIRABranch as br,
    case when r.WaitingOn in ('Pull', 'Done') then c.FixedVersion else c.JIRABranch end as ver
  from v_resolution r join catalog c on c.ReleaseLev = r.ReleaseLev and c.ReleaseID = r.RlsLevelTarget
  where r.ReleaseLev in {listed}),
sdrn as (
  select s.SDRNum as id, s.Release as rel, c.JIRABranch as br, c.AffectsVersion as ver,
    coalesce(s.Release in {listed}{special}, false) as own
  from v_sdr s join catalog c on c.ReleaseLev = s.Release and c.ReleaseID = s.Version),
lnk as (select distinct TransmittalID as f, SDR_Num as d from v_link),
listed_linked as (
  select distinct l.d from lnk l join v_resolution r on r.TransmittalId = l.f where r.ReleaseLev in {listed}),
edges as (
  select 'fix' as sk, l.f as src, 'sdr' as dk, l.d as dst from lnk l join sdrn n on n.id = l.d
  union all
  select 'sdr', l.d, 'fix', l.f from lnk l join fixn n on n.id = l.f)"""]
    done = "select 'x' as kind, -1 as id where false"
    for i, rel in enumerate(releases):
        parts.append(f"""
prev{i} as ({done}),
seedf{i} as (select id from fixn where rel = '{rel}' and ('fix', id) not in (select kind, id from prev{i})),
seedd{i} as (
  select id from sdrn where rel = '{rel}' and id not in (select d from listed_linked)
    and ('sdr', id) not in (select kind, id from prev{i})),
reach{i}(kind, id, lvl) using key (kind, id) as (
  select 'fix', id, 0 from seedf{i}
  union
  select e.dk, e.dst, min(r.lvl) + 1 from reach{i} r join edges e on e.sk = r.kind and e.src = r.id
    left join recurring.reach{i} as seen on seen.kind = e.dk and seen.id = e.dst
  where seen.id is null and (e.dk, e.dst) not in (select kind, id from prev{i}) group by e.dk, e.dst),
lvl{i} as (select kind, id, lvl from reach{i}),
inh{i} as (
  select d.id, max(fx.br) as mb, max(fx.ver) as mv
  from lvl{i} d join lnk l on l.d = d.id join lvl{i} fl on fl.kind = 'fix' and fl.id = l.f and fl.lvl < d.lvl
  join fixn fx on fx.id = fl.id
  where d.kind = 'sdr' group by d.id),
rows{i} as (
  select 'fix' as kind, l.id, '{rel}' as ImportGroup, n.br as Branch, n.ver as Version
  from lvl{i} l join fixn n on n.id = l.id where l.kind = 'fix'
  union all
  select 'sdr', l.id, '{rel}', case when n.own then n.br else h.mb end, case when n.own then n.ver else h.mv end
  from lvl{i} l join sdrn n on n.id = l.id left join inh{i} h on h.id = l.id where l.kind = 'sdr'
  union all
  select 'sdr', s.id, '{rel}', n.br, n.ver from seedd{i} s join sdrn n on n.id = s.id
    where ('sdr', s.id) not in (select kind, id from lvl{i}))""")
        done = f"{done} union all select kind, id from rows{i}"
    union = " union all ".join(f"select * from rows{i}" for i in range(len(releases)))
    return ",".join([*parts, f"\nscope as ({union})"])


INHERITED = "7.11"


@query("closure_issues", oracle=f"with recursive {closure_ctes()}\nselect kind, id, ImportGroup, Branch, Version from scope")
def closure_issues(spark, sf):
    """FIX1 + FIX2 + FLT2 + SRT3: per listed release in order, seeds then alternating
    defect / fix expansion to a fixpoint (semi-naive, checkpointed frontiers)."""
    out = sc.closure_issues(v(spark, sf, "v_link"), v(spark, sf, "v_sdr"), v(spark, sf, "v_resolution"),
                            catalog(spark, sf), RELEASES)
    return out.select("kind", "id", "ImportGroup", "Branch", "Version")


@query("closure_inherited", oracle=f"with recursive {closure_ctes(inherit_version=INHERITED)}\n"
       "select kind, id, ImportGroup, Branch, Version from scope")
def closure_inherited(spark, sf):
    """FIX2: defects of the special version inherit branch and version from their fixes."""
    out = sc.closure_issues(v(spark, sf, "v_link"), v(spark, sf, "v_sdr"), v(spark, sf, "v_resolution"),
                            catalog(spark, sf), RELEASES, inherit_version=INHERITED)
    return out.select("kind", "id", "ImportGroup", "Branch", "Version")
