"""User cleanup, user records and user lookup (PRJ7, SC9, SC10, CMP8, JN11, SNK2).

The user table is a dimension: every lookup is a left join against it and AQE
broadcasts it when its measured size is under the threshold, otherwise the
join stays a shuffle join. Override tables are driver-built literals.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histmill.functions.text import flip_name, has_non_space, login_name, LOGIN_PATTERN


@dataclass(frozen=True)
class UserProfile:
    """Naming conventions of the target system (parameters, neutral defaults)."""

    placeholder_prefix: str = "Legacy_"          # inactive / unknown users
    blank_user: str = "NON"                       # key used for blank references
    default_email_domain: str = "example.com"
    # ---- fixed values: group names given to active users ----
    active_groups: tuple[str, ...] = ("jira-users", "jira-developers")
    default_assignee: str = "unassigned"


@dataclass(frozen=True)
class UserOverrides:
    """PRJ7 overrides: logins to deactivate, full-name fixes, e-mail fixes."""

    deactivate: tuple[str, ...] = ()
    full_names: dict = field(default_factory=dict)   # old full name -> new
    emails: dict = field(default_factory=dict)       # login -> e-mail


def clean_users(raw: DataFrame, active_like: str | None = None) -> DataFrame:
    """UserInfo stage: full name from 'Last, First'; optional active flag from the login domain."""
    out = raw.withColumn("FullName", flip_name(F.col("ExchangeName")))
    if active_like is not None:
        # T-SQL LIKE has no escape character: use one that cannot occur in a login
        out = out.withColumn("Active", F.like(F.lower(F.col("NTUserName")), F.lit(active_like.lower()), F.lit("\u0001")))
    return out.drop("ExchangeName")


def apply_overrides(spark: SparkSession, users: DataFrame, overrides: UserOverrides) -> DataFrame:
    """PRJ7: value overrides by key, as left joins against literal override tables."""
    out = users
    if overrides.deactivate:
        off = spark.createDataFrame([(k.lower(),) for k in overrides.deactivate], "_off_login string")
        out = (out.join(F.broadcast(off), F.lower(F.col("NTUserName")) == F.col("_off_login"), "left")
               .withColumn("Active", F.when(F.col("_off_login").isNotNull(), F.lit(False)).otherwise(F.col("Active")))
               .drop("_off_login"))
    if overrides.full_names:
        names = spark.createDataFrame(list(overrides.full_names.items()), "_old_name string, _new_name string")
        out = (out.join(F.broadcast(names), F.lower(F.col("FullName")) == F.lower(F.col("_old_name")), "left")
               .withColumn("FullName", F.coalesce("_new_name", "FullName")).drop("_old_name", "_new_name"))
    if overrides.emails:
        mails = spark.createDataFrame([(k.lower(), v) for k, v in overrides.emails.items()],
                                      "_mail_login string, _new_mail string")
        out = (out.join(F.broadcast(mails), F.lower(F.col("NTUserName")) == F.col("_mail_login"), "left")
               .withColumn("EmailAddr", F.coalesce("_new_mail", "EmailAddr")).drop("_mail_login", "_new_mail"))
    return out


def required_login(login: Column) -> Column:
    """DQ3: the user part of DOMAIN\\user; a login of another form fails the job.

    The check is part of the value itself, so no optimiser rule can drop it.
    """
    return F.when(login.rlike(LOGIN_PATTERN), login_name(login)).otherwise(
        F.raise_error(F.concat(F.lit("Failed to parse "), F.coalesce(login, F.lit("NULL")))).cast("string"))


def build_users(users: DataFrame, profile: UserProfile = UserProfile(), strict: bool = True) -> DataFrame:
    """CMP8: one target user record per source user, keyed by ``UserName``."""
    login = required_login(F.col("NTUserName")) if strict else login_name(F.col("NTUserName"))
    active = F.col("Active") == F.lit(True)
    return users.select(
        F.col("UserName").alias("user_key"),
        F.when(active, login).otherwise(F.concat(F.lit(profile.placeholder_prefix), login)).alias("name"),
        F.when(active, F.array(*[F.lit(g) for g in profile.active_groups])).alias("groups"),
        active.alias("active"),
        F.when(has_non_space(F.col("EmailAddr")), F.col("EmailAddr"))
        .otherwise(F.concat(login, F.lit("@" + profile.default_email_domain))).alias("email"),
        F.when(F.col("FullName").isNotNull() & ~F.col("FullName").isin("", "0"), F.col("FullName")).alias("fullname"),
    )


def resolve_user(df: DataFrame, ref_col: str, out_col: str, records: DataFrame,
                 profile: UserProfile = UserProfile()) -> DataFrame:
    """JN11: replace a user reference by the target user name.

    exact ``user_key`` -> that user's name; otherwise the prefixed reference (which
    is also the name of a matching placeholder user, if one exists); blank -> the
    fixed blank user. One left join against the user dimension.
    """
    exact = records.select(F.col("user_key").alias("_u_key"), F.col("name").alias("_u_exact"))
    ref = F.col(ref_col)
    resolved = (F.when(~has_non_space(ref), F.lit(profile.placeholder_prefix + profile.blank_user))
                .otherwise(F.coalesce(F.col("_u_exact"), F.concat(F.lit(profile.placeholder_prefix), ref))))
    return (df.join(exact, ref == F.col("_u_key"), "left")
            .withColumn(out_col, resolved).drop("_u_key", "_u_exact"))


def used_users(refs: DataFrame, ref_col: str, records: DataFrame, profile: UserProfile = UserProfile()) -> DataFrame:
    """AGG7 + JN11: the user records referenced anywhere, plus synthesized inactive users.

    ``refs`` is a one-column union of all user references. Exact keys keep their
    record; references matching a placeholder name map to that record; the rest
    become synthesized inactive users. Blank references record the blank user
    only if it exists.
    """
    distinct_refs = refs.select(F.col(ref_col).alias("ref")).where(has_non_space(F.col("ref"))).distinct()
    exact = distinct_refs.join(records, F.col("ref") == F.col("user_key"), "left_semi")
    rest = distinct_refs.join(records, F.col("ref") == F.col("user_key"), "left_anti")
    by_name = records.withColumnRenamed("user_key", "_rk")
    placeholder = (rest.join(by_name, F.concat(F.lit(profile.placeholder_prefix), F.col("ref")) == F.col("name"),
                             "inner").groupBy("_rk").agg(F.lit(1).alias("_one")))
    unknown = rest.join(by_name, F.concat(F.lit(profile.placeholder_prefix), F.col("ref")) == F.col("name"),
                        "left_anti")
    known_keys = (exact.select(F.col("ref").alias("k"))
                  .unionByName(placeholder.select(F.col("_rk").alias("k")))
                  .unionByName(refs.where(~has_non_space(F.col(ref_col)))
                               .select(F.lit(profile.blank_user).alias("k")).distinct()))
    known = records.join(known_keys.distinct(), F.col("user_key") == F.col("k"), "left_semi")
    synthesized = unknown.select(
        F.col("ref").alias("user_key"),
        F.concat(F.lit(profile.placeholder_prefix), F.col("ref")).alias("name"),
        F.lit(None).cast("array<string>").alias("groups"),
        F.lit(False).alias("active"),
        F.concat(F.col("ref"), F.lit("@" + profile.default_email_domain)).alias("email"),
        F.lit(None).cast("string").alias("fullname"))
    return known.unionByName(synthesized)


def users_csv_rows(users: DataFrame) -> DataFrame:
    """SNK2 shape: name,email,fullname,active,group1,group2."""
    return users.select(
        "name", "email", "fullname",
        F.when(F.col("active"), F.lit("1")).otherwise(F.lit("0")).alias("active"),
        F.get(F.col("groups"), 0).alias("group1"),
        F.get(F.col("groups"), 1).alias("group2"),
    )
