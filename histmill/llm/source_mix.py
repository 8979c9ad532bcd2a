"""Mixing sources to target weights by pivotal dependent rounding.

Every document starts with ``target / source_size`` fractional copies. The integer part is
taken as it is; the fractions of one source are paired, and mass (copies times size) moves
at random from one of the pair to the other until one of them is integral. The source's
taken words are therefore preserved by every step and each document's expected copies stay
what they were. Level 0 of the reduction tree works on (source, bucket) groups of bounded
size that a hash deals out; every group leaves one fractional residual, and the residuals
of FAN_IN groups meet in the next level until one is left per source.

A pair leaves its longer document open more often than not, so each group is worked in size
classes (a class spans one doubling) from long to short: the one document that a class
leaves open is paired with the whole next shorter class, whose copies make up together for
the words that it gains or loses, before that class is paired within. What a group sends up
the tree is therefore one of its shortest documents, and a source misses its target by about
one short document, as far as its shorter documents can make up for the longer ones.

Random numbers come from hashes of the group, so reruns and recomputed tasks agree.

Defined results: a null or empty text has size 0 and takes 0 words; a null source is a
source of its own, last in order; rows that repeat a doc_id are rounded as separate
documents; an empty table gives an empty result; other columns are ignored by ``mix`` and kept by
``mixed_rows`` (but for names that begin with two underscores, which it uses itself).
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histmill.llm.common import drop_stage, ensure_columns, stage, word_count

#: Documents per level-0 group, on average.
GROUP = 2000
#: Residuals that meet in one group of a higher level.
FAN_IN = 500
WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3.0
#: One row per source comes to the driver; a corpus with more sources than this needs coarser ones.
MAX_SOURCES = 1_000_000


def source_targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS,
                   share: float = 1.0, max_repeats: float = MAX_REPEATS) -> dict[str | None, float]:
    """Words to take per source: ``share`` of all words by cyclic weights in code point order
    (null last), at most ``max_repeats`` times the source, the excess reshared by weight."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), list(order), dict.fromkeys(order, 0.0)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > max_repeats * sizes[s]]
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = max_repeats * sizes[s]
        left -= sum(target[s] for s in over)
        open_ = [s for s in open_ if s not in set(over)]
    return target


def pivot(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> int:
    """Round the fractions ``p`` in place; return the index of the one left fractional, or -1.

    A step moves mass between the open document and the next so that ``p @ size`` does not
    change, up to the nearest integer on either side, each side with the probability that
    keeps both expectations.
    """
    rest = -1
    draws = rng.random(len(p))
    for j in range(len(p)):
        if not 1e-9 < p[j] < 1 - 1e-9:
            p[j] = round(p[j])
            continue
        if rest < 0:
            rest = j
            continue
        i, w = rest, size[j] / size[rest]
        up = min(1 - p[i], p[j] * w)      # i gains this much, j loses up / w
        down = min(p[i], (1 - p[j]) * w)  # i loses this much, j gains down / w
        move = up if draws[j] * (up + down) < down else -down
        p[i] += move
        p[j] -= move / w
        open_ = [k for k in (i, j) if 1e-9 < p[k] < 1 - 1e-9]
        for k in (i, j):
            if k not in open_:
                p[k] = round(p[k])
        rest = open_[0] if open_ else -1
    return rest


def _open(p: np.ndarray) -> np.ndarray:
    return (p > 1e-9) & (p < 1 - 1e-9)


def pivot_on_class(p: np.ndarray, size: np.ndarray, i: int, of: np.ndarray, rng: np.random.Generator) -> bool:
    """Move mass at random between document ``i`` and all the documents ``of`` a shorter class
    until ``i`` is integral or none of those is open; return whether ``i`` is still open.

    A class takes its share in proportion to ``p * (1 - p)``, so that every document's
    expectation stays; a step ends when ``i`` or one of the class becomes integral.
    """
    while _open(p[i:i + 1])[0]:
        live = of[_open(p[of])]
        if not len(live):
            return True
        q = p[live]
        weight = q * (1 - q)
        total = float(weight @ size[live])
        up = min((1 - p[i]) * size[i], total / float((1 - q).max()))  # words that i may gain
        down = min(p[i] * size[i], total / float(q.max()))
        move = up if rng.random() * (up + down) < down else -down
        p[i] += move / size[i]
        p[live] = q - weight * (move / total)
        for k in (i, *live):
            if not 1e-9 < p[k] < 1 - 1e-9:
                p[k] = round(p[k])
    return False


def round_by_class(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> int:
    """Round the fractions ``p`` of documents of ``size`` > 0 in place, from long to short ones;
    return the index of the one left fractional, or -1. ``p @ size`` changes by that one only."""
    classes = np.frexp(size)[1]
    rest = -1
    for kind in np.unique(classes[_open(p)])[::-1]:
        of = np.flatnonzero((classes == kind) & _open(p))
        if rest >= 0 and pivot_on_class(p, size, rest, of, rng):
            continue
        of = of[_open(p[of])]
        part = p[of]
        left = pivot(part, size[of], rng)
        p[of] = part
        rest = int(of[left]) if left >= 0 else -1
    return rest


def _rng(*key) -> np.random.Generator:
    return np.random.default_rng(zlib.crc32(repr(key).encode()))


def _round_group(seed: int, level: int, ids: Sequence[str]):
    """A function for one (source, bucket) group: ``extra`` per row, -1 for the residual."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([*ids, "size"], kind="stable", na_position="last").reset_index(drop=True)
        p, size = pdf["p"].to_numpy(float).copy(), pdf["size"].to_numpy(float)
        live = size > 0
        part = p[live]
        rest = round_by_class(part, size[live], _rng(seed, level, pdf["sid"].iloc[0], int(pdf["up"].iloc[0])))
        extra = np.zeros(len(p))
        extra[live] = part
        left = np.full(len(p), -1.0)
        if rest >= 0:
            k = np.flatnonzero(live)[rest]
            left[k], extra[k] = part[rest], -1
        pdf["extra"], pdf["left"] = extra.astype("int32"), left
        return pdf

    return work


def mix(docs: DataFrame, size: str = "size", source: str = "source", doc_id: str = "doc_id",
        weights: Sequence[float] = WEIGHTS, share: float = 1.0, max_repeats: float = MAX_REPEATS,
        seed: int = 17, mark: str | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, size): source_size, target and the copies to take.

    ``docs`` should be narrow; texts are not needed here. ``mark`` names a long (a hash of the
    text, say) that tells rows of one doc_id, or of none, apart, so that many of these are dealt
    to many groups. See ``source_targets`` for the targets. Returns doc_id, source, size, mark
    (if named), source_size, target, copies; other columns are ignored.
    """
    ensure_columns(docs, size, source, doc_id, *([mark] if mark else []))
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                         F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"),
                         (F.col(mark) if mark else F.lit(0)).cast("long").alias("mark"))
    narrow = stage(narrow)
    per_source = (narrow.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs"))
                  .limit(MAX_SOURCES + 1).collect())
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = {r["source"]: int(r["n"] or 0) for r in per_source}
    target = source_targets(sizes, weights, share, max_repeats)
    rows = [(r["source"], i, sizes[r["source"]], target[r["source"]], -(-int(r["docs"]) // GROUP))
            for i, r in enumerate(sorted(per_source, key=lambda r: (r["source"] is None, r["source"] or "")))]
    stats = spark.createDataFrame(rows, "ssource string, sid int, source_size long, target double, groups long")

    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    level0 = (narrow.join(stats, narrow["source"].eqNullSafe(stats["ssource"])).drop("ssource")
              .withColumn("whole", F.floor(ratio + 1e-12).cast("int"))
              .withColumn("p", F.greatest(ratio - F.col("whole"), F.lit(0.0)))
              .withColumn("up", F.pmod(F.xxhash64("doc_id", "mark", "size", F.lit(seed)), F.col("groups"))))
    schema = level0.schema.simpleString()[len("struct<"):-1].replace(":", " ")
    rounded = stage(level0.groupBy("sid", "up").applyInPandas(
        _round_group(seed, 0, ["doc_id", "mark"]), f"{schema}, extra int, left double"))

    # the residuals' tree: level n groups are dealt by integer division of the bucket number
    path = rounded.filter("left >= 0").select("sid", "up", "size", F.col("left").alias("p"))
    most = max([r[4] for r in rows], default=0)
    levels, level = [], 0
    while most > 0:
        level, most = level + 1, -(-most // FAN_IN) if most > 1 else 0
        if most == 0:
            break
        cur = (path.withColumn("below", F.col("up")).withColumn("up", F.floor(F.col("up") / FAN_IN).cast("long"))
               .select("sid", "below", "up", "size", "p"))
        done = stage(cur.groupBy("sid", "up").applyInPandas(
            _round_group(seed, level, ["below"]),
            "sid int, below long, up long, size long, p double, extra int, left double"))
        levels.append(done)
        path = done.filter("left >= 0").select("sid", "up", "size", F.col("left").alias("p"))

    # decide from the top down: the last residual of a source by one draw, the others by their group
    last = (path.withColumn("u", F.pmod(F.xxhash64("sid", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30))
            .select("sid", "up", F.when(F.col("u") < F.col("p"), 1).otherwise(0).alias("given")))
    for done in reversed(levels):
        last = (done.join(last, ["sid", "up"], "left")
                .select("sid", F.col("below").alias("up"),
                        F.when(F.col("left") >= 0, F.col("given")).otherwise(F.col("extra")).alias("given")))
    out = (rounded.join(last, ["sid", "up"], "left")
           .withColumn("copies", F.col("whole") + F.when(F.col("left") >= 0, F.col("given"))
                       .otherwise(F.col("extra"))))
    drop_stage(narrow)
    return out.select("doc_id", "source", "size", *(["mark"] if mark else []), "source_size", "target", F.col("copies").cast("long"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, source and anything else) with every row as often as the mix takes it.

    Decisions are made on (doc_id, source, size, text hash) rows and joined back. Rows equal in
    all of these share their copies evenly, the first by a hash of the row taking what is over.
    The numbering among them uses the join's own partitioning, so texts are shuffled once.
    """
    ensure_columns(docs, "doc_id", "text", "source")
    # a struct compares null members as equal, and join and window hash the same column
    key = ("doc_id", "source", "__size", "__mark")
    own = docs.withColumns({"__size": word_count(F.col("text")), "__mark": F.xxhash64("text")})
    taken = mix(own, size="__size", mark="__mark", **options)
    share = (taken.groupBy(F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(("doc_id", "source", "size", "mark"))])
                           .alias("__taken")).agg(F.count("*").alias("__rows"), F.sum("copies").alias("__copies"))
             .filter("__copies > 0"))
    keyed = own.withColumn("__key", F.struct(*[F.col(n).alias(f"k{i}") for i, n in enumerate(key)]))
    joined = keyed.join(share, F.col("__key") == F.col("__taken"))
    place = F.row_number().over(Window.partitionBy("__key").orderBy(F.xxhash64(*docs.columns)))
    times = F.expr("cast(__copies div __rows + if(__place <= __copies % __rows, 1, 0) as int)")
    return (joined.withColumn("__place", place).withColumn("__times", times).filter("__times > 0")
            .select(*[F.col(f"`{c}`") for c in docs.columns],
                    F.explode(F.sequence(F.lit(1), F.col("__times"))).alias("__copy")).drop("__copy"))
