"""URL verdicts: explicit rules first, gradient-boosted trees for the rest.

A rule names a host (its subdomains included) and the beginning of a path; the longest rule
that fits decides. The URLs that a rule decides are the labelled ones, unless others are
given, and trees are fitted on them from lexical features: lengths, depth, digit ratio,
character entropy, parameter counts, punctuation, and smoothed block rates of the host's
last two labels and of the first directory. The features are SQL expressions, training and
scoring are Spark's own ``GBTClassifier``.

Training takes at most ``TRAIN_ROWS`` labelled URLs, those with the smallest hash, in one
partition so that the result does not depend on how the table is split. The block rates
count all labelled URLs.

Defined results: a null URL, or one without ``://``, has an empty host and path and fits no
rule; without labelled URLs of both kinds the trees' verdict is the one kind there is, or
allow; repeated rows get equal verdicts; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import ascii_lower, ensure_columns, stage

TRAIN_ROWS = 20_000
TREES, DEPTH, RATE = 20, 4, 0.25
#: Labelled URLs that the overall rate counts for in a block rate.
PRIOR = 10.0
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rules(lines: Sequence[str]) -> list[Rule]:
    """``allow com/`` and the like: verdict, then host up to the first slash, then path."""
    rules = []
    for line in lines:
        verdict, target = line.split()
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"no verdict: {line}")
        host, slash, rest = target.partition("/")
        rules.append(Rule(verdict, host.lower(), slash + rest))
    return rules


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(rules: Sequence[Rule], host: Column, path: Column, give: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, give))).otherwise(out)
    return out


def _occurrences(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("double")


def features(urls: DataFrame) -> tuple[DataFrame, list[str]]:
    """``urls`` (url, host, path, ...) with lexical feature columns, suffix and directory."""
    url = F.coalesce(F.col("url"), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1)).cast("double")
    chars = F.array_distinct(F.split(url, ""))
    entropy = F.aggregate(
        F.filter(chars, lambda c: c != ""), F.lit(0.0),
        lambda h, c: h - ((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n)
        * F.log2((F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    # one name per feature; the table's own columns may have any names but these
    made = {
        "__f_length": F.length(url).cast("double"), "__f_host": F.length("host").cast("double"),
        "__f_path": F.length("path").cast("double"),
        "__f_depth": F.size(F.filter(F.split("path", "/"), lambda s: s != "")).cast("double"),
        "__f_digits": _occurrences(url, "0123456789") / n, "__f_host_digits": _occurrences(F.col("host"), "0123456789"),
        "__f_entropy": entropy,
        "__f_params": F.when(query == "", 0.0).otherwise(_occurrences(query, "&") + 1),
        "__f_labels": _occurrences(F.col("host"), "."), "__f_hyphens": _occurrences(F.col("host"), "-"),
        "__f_secure": url.startswith("https:").cast("double"), "__f_fragment": url.contains("#").cast("double"),
        "__f_file": F.col("path").rlike(r"\.[A-Za-z0-9]+$").cast("double"),
    }
    labels = F.split("host", r"\.")
    out = urls.withColumns(made).withColumns({
        "__suffix": F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."),
        "__dir": F.regexp_extract("path", r"^(/[^/]*/?)", 1)})
    return out, [*made, "__f_suffix_rate", "__f_suffix_seen", "__f_dir_rate"]


def _rates(labelled: DataFrame, key: str, overall: float) -> DataFrame:
    """Smoothed block rate per key; staged, so that a join on a hot key can be split."""
    return stage(labelled.groupBy(key).agg(
        ((F.sum("__y") + PRIOR * overall) / (F.count("*") + PRIOR)).alias(f"{key}_rate"),
        F.log1p(F.count("*").cast("double")).alias(f"{key}_seen")).withColumnRenamed(key, f"{key}_key"))


def judge(urls: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None) -> DataFrame:
    """``urls`` (url and anything else) with host, path, rule, verdict.

    ``labelled`` (url, blocked) replaces the URLs that the rules decide as training rows.
    """
    ensure_columns(urls, "url")
    own = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]

    def parsed(df: DataFrame, *keep: str) -> DataFrame:
        return df.select(*keep, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    table = parsed(urls, *own)
    table = table.select("*", fitting_rule(rules, F.col("host"), F.col("path"), "name").alias("rule"),
                         fitting_rule(rules, F.col("host"), F.col("path"), "verdict").alias("__decided"))
    if labelled is None:
        known = table.filter("__decided is not null").select(
            "url", "host", "path", (F.col("__decided") == BLOCK).cast("double").alias("__y"))
    else:
        known = parsed(labelled.filter("blocked is not null"), "url", F.col("blocked").cast("double").alias("__y"))
    known, columns = features(known)
    known = stage(known)
    n, blocked = known.agg(F.count("*"), F.coalesce(F.sum("__y"), F.lit(0.0))).first()
    if blocked in (0, n):
        verdict = F.lit(BLOCK if n and blocked == n else ALLOW)
        return table.select(*own, "host", "path", "rule", F.coalesce("__decided", verdict).alias("verdict"))

    suffixes, dirs = _rates(known, "__suffix", blocked / n), _rates(known, "__dir", blocked / n)

    def with_rates(df: DataFrame) -> DataFrame:
        rated = (df.join(suffixes, F.col("__suffix") == F.col("__suffix_key"), "left")
                 .join(dirs.drop("__dir_seen"), F.col("__dir") == F.col("__dir_key"), "left"))
        return rated.withColumns({
            "__f_suffix_rate": F.coalesce("__suffix_rate", F.lit(blocked / n)),
            "__f_suffix_seen": F.coalesce("__suffix_seen", F.lit(0.0)),
            "__f_dir_rate": F.coalesce("__dir_rate", F.lit(blocked / n))})

    assemble = VectorAssembler(inputCols=columns, outputCol="__x")
    sample = known.orderBy(F.xxhash64("url"), "url", "__y").limit(TRAIN_ROWS).coalesce(1)
    sample = stage(with_rates(sample).select("url", "__y", *columns)).coalesce(1).sortWithinPartitions("url", "__y")
    trees = GBTClassifier(featuresCol="__x", labelCol="__y", predictionCol="__blocked", maxIter=TREES,
                          maxDepth=DEPTH, stepSize=RATE, seed=11)
    model = trees.fit(assemble.transform(sample))
    scored = model.transform(assemble.transform(with_rates(features(table)[0])))
    return scored.select(*own, "host", "path", "rule", F.coalesce(
        "__decided", F.when(F.col("__blocked") > 0.5, BLOCK).otherwise(ALLOW)).alias("verdict"))
