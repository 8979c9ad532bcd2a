"""Release catalog rules and user queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histmill.functions.text import login_domain, login_name, truthy
from histmill.operators import releases, users
from histmill.plans.common import CATALOG_SQL, catalog, v, with_catalog
from histmill.plans.registry import query
from histmill.session import stage

PROFILE = users.UserProfile()
OVERRIDES = users.UserOverrides(
    deactivate=("DOM\\login3", "dom\\LOGIN4"),
    full_names={"First7 Last7": "Last7 First7", "first9 last9": "Last9 First9"},
    emails={"DOM\\login10": "ten@example.net"},
)


@query("release_rules", oracle=with_catalog("select * from catalog"))
def release_rules(spark, sf):
    """PRJ6 + SC12 + SC13: the whole ordered rule cascade on the catalog."""
    return catalog(spark, sf)


@query("suffix_rules", oracle="with " + CATALOG_SQL.strip().split("rel2 as (")[0].rstrip().rstrip(",") + """
select ReleaseLev, ReleaseID, LanguageLabel, HotfixLabel,
  case when matched then split_part(ReleaseID, '_', 1) else ReleaseID end as AffectsVersion from rel1""")
def suffix_rules(spark, sf):
    """SC12: suffix rules only (last matching rule wins per output column)."""
    return releases.apply_suffix_rules(v(spark, sf, "v_release")).select(
        "ReleaseLev", "ReleaseID", "LanguageLabel", "HotfixLabel", "AffectsVersion")


FLIP_SQL = r"regexp_replace(ExchangeName, '^([^,]+), *(.*)$', '\2 \1', 's')"


@query("name_flip", oracle=f"select NTUserName, {FLIP_SQL} as FullName from v_user")
def name_flip(spark, sf):
    """SC9 + SC8."""
    return users.clean_users(v(spark, sf, "v_user")).select("NTUserName", "FullName")


LOGIN_RE = r"'^([^\\]*)\\(\S*)\s*$'"


@query("login_split", oracle=rf"""
select NTUserName,
  case when regexp_matches(NTUserName, {LOGIN_RE}) then regexp_extract(NTUserName, {LOGIN_RE}, 1) end as domain,
  case when regexp_matches(NTUserName, {LOGIN_RE}) then regexp_extract(NTUserName, {LOGIN_RE}, 2) end as login
from v_user""")
def login_split(spark, sf):
    """SC10: DOMAIN\\user split (NULL parts when unparsable)."""
    u = v(spark, sf, "v_user")
    return u.select("NTUserName", login_domain(F.col("NTUserName")).alias("domain"),
                    login_name(F.col("NTUserName")).alias("login"))


CLEAN_USERS_SQL = f"""
clean_users as (
  select NTUserName, UserName,
    case lower(FullName0) when 'first7 last7' then 'Last7 First7' when 'first9 last9' then 'Last9 First9'
      else FullName0 end as FullName,
    case when lower(NTUserName) = 'dom' || chr(92) || 'login10' then 'ten@example.net' else EmailAddr end as EmailAddr,
    case when lower(NTUserName) in ('dom' || chr(92) || 'login3', 'dom' || chr(92) || 'login4') then false
      else Active end as Active
  from (select *, {FLIP_SQL} as FullName0 from v_user))"""


def clean_user_table(spark, sf):
    return users.apply_overrides(spark, users.clean_users(v(spark, sf, "v_user")), OVERRIDES)


@query("user_overrides", oracle=f"with {CLEAN_USERS_SQL.strip()} select * from clean_users")
def user_overrides(spark, sf):
    """PRJ7: deactivation list, full-name fixes and e-mail fixes as broadcast literal joins."""
    return clean_user_table(spark, sf).select("NTUserName", "UserName", "FullName", "EmailAddr", "Active")


USER_RECORDS_SQL = CLEAN_USERS_SQL + """,
records as (
  select UserName as user_key,
    case when Active then regexp_extract(NTUserName, '^([^\\\\]*)\\\\(\\S*)\\s*$', 2)
         else 'Legacy_' || regexp_extract(NTUserName, '^([^\\\\]*)\\\\(\\S*)\\s*$', 2) end as name,
    case when Active then 'jira-users,jira-developers' end as groups,
    Active as active,
    case when regexp_matches(coalesce(EmailAddr, ''), '\\S') then EmailAddr
         else regexp_extract(NTUserName, '^([^\\\\]*)\\\\(\\S*)\\s*$', 2) || '@example.com' end as email,
    case when FullName is not null and FullName not in ('', '0') then FullName end as fullname
  from clean_users)"""


def user_records_df(spark, sf):
    return stage(users.build_users(clean_user_table(spark, sf), PROFILE))


@query("user_records", oracle=f"with {USER_RECORDS_SQL.strip()} select * from records")
def user_records(spark, sf):
    """CMP8: target user records (groups compared as joined text)."""
    return user_records_df(spark, sf).withColumn("groups", F.array_join("groups", ","))


RESOLVE_SQL = USER_RECORDS_SQL + """,
refs as (
  select SDRNum, Submitter, case when AssignedTo is not null and AssignedTo not in ('', '0') then AssignedTo
    else 'unassigned' end as assignee_ref
  from v_sdr)"""


@query("user_resolve", oracle=f"""with {RESOLVE_SQL.strip()}
select r.SDRNum,
  case when r.Submitter is null or r.Submitter in ('', '0') then r.Submitter
       when not regexp_matches(r.Submitter, '\\S') then 'Legacy_NON'
       else coalesce(a.name, 'Legacy_' || r.Submitter) end as reporter,
  case when not regexp_matches(r.assignee_ref, '\\S') then 'Legacy_NON'
       else coalesce(b.name, 'Legacy_' || r.assignee_ref) end as assignee
from refs r left join records a on a.user_key = r.Submitter left join records b on b.user_key = r.assignee_ref""")
def user_resolve(spark, sf):
    """JN11: reporter (when set) and assignee (default user when blank) of each defect."""
    recs = user_records_df(spark, sf)
    s = v(spark, sf, "v_sdr").select("SDRNum", "Submitter", "AssignedTo")
    s = s.withColumn("assignee_ref", F.when(truthy(F.col("AssignedTo")), F.col("AssignedTo"))
                     .otherwise(F.lit(PROFILE.default_assignee)))
    s = users.resolve_user(s, "Submitter", "reporter_res", recs, PROFILE)
    s = users.resolve_user(s, "assignee_ref", "assignee", recs, PROFILE)
    return s.select("SDRNum", F.when(truthy(F.col("Submitter")), F.col("reporter_res"))
                    .otherwise(F.col("Submitter")).alias("reporter"), "assignee")


@query("user_csv_shape", oracle=f"""with {RESOLVE_SQL.strip()},
allrefs as (
  select Submitter as ref from refs where Submitter is not null and Submitter not in ('', '0')
  union all select assignee_ref from refs),
used as (select distinct ref from allrefs where regexp_matches(ref, '\\S'))
select name, email, fullname, case when active then '1' else '0' end as active,
  split_part(groups, ',', 1) as group1, nullif(split_part(groups, ',', 2), '') as group2
from records where user_key in (select ref from used)
  or (user_key = 'NON' and exists (select 1 from allrefs where not regexp_matches(ref, '\\S')))
  or (name in (select 'Legacy_' || ref from used where ref not in (select user_key from records)))
union all
select 'Legacy_' || ref, ref || '@example.com', null, '0', null, null from used
where ref not in (select user_key from records) and 'Legacy_' || ref not in (select name from records)""")
def user_csv_shape(spark, sf):
    """SNK2 + AGG7: the used users (records referenced by defects plus synthesized ones) as CSV rows."""
    recs = user_records_df(spark, sf)
    s = v(spark, sf, "v_sdr").select("Submitter", "AssignedTo")
    reporter_refs = s.where(truthy(F.col("Submitter"))).select(F.col("Submitter").alias("ref"))
    assignee_refs = s.select(F.when(truthy(F.col("AssignedTo")), F.col("AssignedTo"))
                             .otherwise(F.lit(PROFILE.default_assignee)).alias("ref"))
    used = users.used_users(reporter_refs.unionByName(assignee_refs), "ref", recs, PROFILE)
    return users.users_csv_rows(used)
