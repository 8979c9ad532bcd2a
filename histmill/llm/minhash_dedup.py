"""Near-duplicate detection with b-bit MinHash.

1. One Arrow pass over the texts gives each document's set of word shingles (as 64-bit
   hashes), its size, a 128-bit hash of the whole set, 256 minima, the lowest two bits of
   each minimum packed into eight longs, and one key per band of five minima.
2. Documents with the same set are one class; its smallest doc_id stands for it.
3. A band bucket links its members to its smallest one: candidates, never all pairs. The
   packed bits give an estimate of the similarity by bit counts, corrected for the matches
   that two-bit values have by chance, and candidates more than five standard deviations
   below the threshold go. The others (at most one per class and band) are confirmed on the
   full sets, and components are formed.
4. Where the members of a leader's buckets are still in more than one component, pairs
   across components are found by an exact prefix filter on the members' differences from
   the leader (``_cross_pairs``), tested by bit counts and confirmed. No pair that a bucket
   offers is lost, a bucket that is one component costs nothing, and a large group of
   copies that are too far apart to be linked does not turn into all its pairs.

Rows that share a doc_id are one document. Rows without doc_id, and texts without a word
(null, empty, white space), are linked with nothing.

A pair of similarity 0.8 shares no bucket with probability (1 - 0.8**5) ** 51 = 2e-9.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import drop_stage, ensure_columns, small_batches, stage
from histmill.llm.components import components

HASHES, ROWS, BITS, LONGS = 256, 5, 2, 8
BANDS = HASHES // ROWS
#: Standard deviations of the estimate that a candidate may lie below the threshold.
SLACK = 5.0
#: Distinct words whose hashes a worker remembers.
WORD_CACHE = 1_000_000
_RNG = np.random.default_rng(20)
_MUL = (_RNG.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _RNG.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of a text, A-Z lower-cased.

    Words end at space and \\t..\\r, which is what ``bytes.split`` takes, and
    ``bytes.lower`` changes A-Z only.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - width + 1)
    h = np.zeros(n, np.uint64)
    for k in range(min(width, len(w))):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n] + np.uint64(k + 1))
    return np.unique(h)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The 256 minima of a set."""
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    best = np.full(HASHES, 2**32 - 1, np.uint32)
    for k in range(0, len(low), 512):
        np.minimum(best, (low[k:k + 512, None] * _MUL + _ADD).min(axis=0), out=best)
    return best


def packed_bits(best: np.ndarray) -> np.ndarray:
    """The lowest two bits of each (scrambled) minimum, 32 minima to a long."""
    two = mixed(best.astype(np.uint64)) & np.uint64(3)
    shift = np.arange(32, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(two.reshape(LONGS, 32) << shift, axis=1).view(np.int64)


def band_keys(best: np.ndarray) -> np.ndarray:
    rows = best[:BANDS * ROWS].astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return key.view(np.int64)


PRINTS = "doc_id long, n_shingles long, s1 long, s2 long, bits array<long>, bands array<long>"


def _print_batches(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            cols: list[list] = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width, hashes)
                cols[0].append(len(s))
                if not len(s):
                    for c in cols[1:]:
                        c.append(None)
                    continue
                whole = xxhash.xxh3_128_digest(s.tobytes())
                best = minima(s)
                cols[1].append(int.from_bytes(whole[:8], "little", signed=True))
                cols[2].append(int.from_bytes(whole[8:], "little", signed=True))
                cols[3].append(packed_bits(best))
                cols[4].append(band_keys(best))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]),
                 *(pa.array(c, longs) for c in cols[3:])],
                names=["doc_id", "n_shingles", "s1", "s2", "bits", "bands"])

    return run


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """The staged table of step 1, one row per document."""
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(narrow.mapInArrow(_print_batches(width), PRINTS))


def estimate(a: str, b: str) -> Column:
    """Similarity from the packed bits of two sides, corrected for chance matches."""
    odd = F.lit(0x5555555555555555)
    off = F.lit(0)
    for k in range(LONGS):
        x = F.get(F.col(f"{a}.bits"), F.lit(k)).bitwiseXOR(F.get(F.col(f"{b}.bits"), F.lit(k)))
        off = off + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(odd))
    chance = 2.0 ** -BITS
    return (1.0 - off / F.lit(float(HASHES)) - chance) / (1.0 - chance)


def estimate_cut(percent: int) -> float:
    chance, s = 2.0 ** -BITS, percent / 100
    p = chance + (1 - chance) * s
    return s - SLACK * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


def _confirm_batches(width: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, last_set = WordHashes(), None, None
        for batch in batches:
            yes = []
            for a_text, b, b_text in zip(batch.column("ta").to_pylist(), batch.column("b").to_pylist(),
                                         batch.column("tb").to_pylist(), strict=True):
                if b != last:
                    last, last_set = b, shingle_set(b_text, width, hashes)
                s = shingle_set(a_text, width, hashes)
                both = len(np.intersect1d(s, last_set, assume_unique=True))
                yes.append(100 * both >= percent * (len(s) + len(last_set) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(
                pa.array(yes, pa.bool_()))

    return run


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts``: node, text."""
    both = (pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
            .select("a", "b", "ta", "tb"))
    return stage(both.mapInArrow(_confirm_batches(width, percent), "a long, b long"))


def _difference_batches(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, pivot = WordHashes(), None, None
        for batch in batches:
            n, n_pivot, both, diff = [], [], [], []
            for lo, text, lo_text in zip(*(batch.column(c).to_pylist() for c in ("b", "ta", "tb")), strict=True):
                if lo != last:
                    last, pivot = lo, shingle_set(lo_text, width, hashes)
                s = shingle_set(text, width, hashes)
                d = np.setxor1d(s, pivot, assume_unique=True)
                n.append(len(s))
                n_pivot.append(len(pivot))
                both.append((len(s) + len(pivot) - len(d)) // 2)
                diff.append(d.view(np.int64))
            longs = (pa.array(c, pa.int64()) for c in (n, n_pivot, both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("b"), batch.column("a"), batch.column("label"), *longs,
                 pa.array(diff, pa.list_(pa.int64()))], names=["lo", "node", "label", "n", "np", "s", "diff"])

    return run


def _cross_pairs(stars: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Candidates (a, b) between components within the groups (lo, node, label) of leaders.

    With P the leader's set and D(x) the difference of x and P, two members share
    s(a) + s(b) - n(P) + |D(a) & D(b)| shingles, where s is the overlap with P. So
    they are similar enough only if their differences share at least
    ``need = ceil(percent * (n(a) + n(b)) / (100 + percent)) + n(P) - s(a) - s(b)`` elements,
    which is at least 1 unless both are linked to P, that is, in one component already.
    Differences are ordered rarest first; the first shared element must come early enough
    for ``need`` more to follow in both. Copies of one text that were edited in different
    places share few differences, so this offers few pairs where the group has many.
    """
    whole = percent + 100
    joined = (stars.select(F.col("node").alias("a"), F.col("lo").alias("b"), "label")
              .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
              .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
              .select("a", "b", "label", "ta", "tb"))
    diffs = stage(joined.mapInArrow(_difference_batches(width), "lo long, node long, label long, n long, np long, "
                                                                 "s long, diff array<long>"))
    short = F.ceil(F.lit(percent) * (F.col("n") + F.col("np")) / F.lit(float(whole))) - F.col("s")
    tokens = diffs.select("lo", "node", F.explode("diff").alias("tok"))
    common = stage(tokens.groupBy("lo", "tok").agg(F.count("*").alias("df")).filter("df > 1"))
    ordered = (tokens.join(common, ["lo", "tok"]).groupBy("lo", "node")
               .agg(F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("ranked")))
    facts = diffs.drop("diff").withColumn("short", F.greatest(short, F.lit(1)).cast("int")).withColumn(
        "far", short > 0)
    early = stage(ordered.join(facts, ["lo", "node"]).withColumn("c", F.size("ranked"))
                  .filter("c >= short")
                  .select("lo", "node", "label", "n", "np", "s", "far", "c",
                          F.posexplode(F.expr("slice(ranked, 1, c - short + 1)")).alias("pos", "x"))
                  .select("*", F.col("x.tok").alias("tok")).drop("x"))
    x, y = early.filter("far").alias("x"), early.alias("y")
    need = (F.ceil(F.lit(percent) * (F.col("x.n") + F.col("y.n")) / F.lit(float(whole))) + F.col("x.np")
            - F.col("x.s") - F.col("y.s"))
    apart = ((F.col("x.lo") == F.col("y.lo")) & (F.col("x.tok") == F.col("y.tok"))
             & (F.col("x.label") != F.col("y.label")) & (~F.col("y.far") | (F.col("x.node") < F.col("y.node")))
             & (F.least(F.col("x.c") - F.col("x.pos"), F.col("y.c") - F.col("y.pos")) >= need))
    return x.join(y, apart).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _labelled(df: DataFrame, node: str, label: str, labels: DataFrame) -> DataFrame:
    own = labels.select(F.col("node").alias("__n"), F.col("label").alias("__l"))
    return (df.join(own, F.col(node) == F.col("__n"), "left")
            .withColumn(label, F.coalesce("__l", F.col(node))).drop("__n", "__l"))


def _with_links(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links: components of the labels that the links join, then applied."""
    joined = _labelled(_labelled(links, "a", "la", labels), "b", "lb", labels)
    over = components(joined.select(F.col("la").alias("a"), F.col("lb").alias("b")))
    nodes = labels.select("node", "label").unionByName(
        links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        .join(labels, "node", "left_anti").withColumn("label", F.col("node")))
    return stage(_labelled(nodes, "label", "to", over).select("node", F.col("to").alias("label")))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text).

    Links join documents whose shingle sets have 100 * intersection >= percent * union.
    """
    ensure_columns(docs, "doc_id", "text")
    prints = fingerprints(docs, width)
    known = prints.filter("n_shingles > 0 and doc_id is not null")
    classes = stage(known.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")))
    reps = stage(known.join(classes.withColumnRenamed("rep", "doc_id"), ["s1", "s2", "doc_id"])
                 .select(F.col("doc_id").alias("node"), "bits", "bands"))
    rows = reps.select("node", F.explode("bands").alias("key"))
    buckets = stage(rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
                    .filter("lo <> hi").select("key", "lo"))
    members = stage(rows.join(buckets, "key").select("key", "node", "lo"))
    bits = reps.select("node", "bits")
    involved = members.select("node").distinct()
    bits = stage(bits.join(involved, "node", "left_semi"))
    texts = stage(docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(involved, "node", "left_semi"))

    cut = estimate_cut(percent)

    def with_bits(pairs: DataFrame) -> DataFrame:
        a, b = bits.alias("x"), bits.alias("y")
        return (pairs.join(a, F.col("a") == F.col("x.node")).join(b, F.col("b") == F.col("y.node"))
                .select("a", "b", estimate("x", "y").alias("est")).filter(F.col("est") >= cut))

    stars = members.filter("node <> lo").select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct()
    labels = components(confirm(with_bits(stars), texts, width, percent))

    # groups of a leader that are still in several components
    grouped = stage(_labelled(members.select("node", "lo").distinct(), "node", "label", labels))
    ends = grouped.select("lo", "label").unionByName(
        _labelled(grouped.select("lo").distinct(), "lo", "label", labels))
    split = stage(ends.groupBy("lo").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
                  .select("lo"))
    if not split.isEmpty():
        stars = stage(grouped.join(split, "lo").filter("node <> lo"))
        cross = _cross_pairs(stars, texts, width, percent)
        labels = _with_links(labels, confirm(with_bits(cross), texts, width, percent))

    of_class = stage(_labelled(classes, "rep", "label", labels).select("s1", "s2", "label"))
    of_rows = known.select("doc_id", "n_shingles", "s1", "s2").join(of_class, ["s1", "s2"])
    rest = prints.filter("n_shingles = 0 or doc_id is null").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return (of_rows.select("doc_id", "n_shingles", F.col("label").alias("component_id")).unionByName(rest)
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group (its smallest doc_id).

    Rows that share a doc_id but not their text are documents of their own, each under the hash
    of id and text; of rows equal in both one stays. Rows without doc_id stay.
    """
    ensure_columns(docs, "doc_id", "text")
    there = docs.filter("doc_id is not null")
    repeated = stage(there.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
                     .select(F.col("doc_id").alias("__shared_id")))
    if repeated.isEmpty():
        keyed = there.withColumn("__key", F.col("doc_id").cast("long"))
    else:
        own = F.xxhash64("doc_id", F.col("text").isNull(), "text").bitwiseAND(F.lit((1 << 63) - 1))
        keyed = (there.join(repeated, F.col("doc_id") == F.col("__shared_id"), "left")
                 .withColumn("__key", F.when(F.col("__shared_id").isNull(), F.col("doc_id").cast("long")).otherwise(-1 - own))
                 .drop("__shared_id"))
    near = near_duplicates(keyed.select(F.col("__key").alias("doc_id"), "text"), width, percent)
    keep = near.filter("kept").select(F.col("doc_id").alias("__keep")).distinct()
    kept = keyed.join(keep, F.col("__key") == F.col("__keep"), "left_semi")
    if not repeated.isEmpty():
        twice = F.col("doc_id") == F.col("__shared_id")
        equal = (kept.join(repeated, twice, "left_semi").groupBy("__key")
                 .agg(F.first(F.struct(*docs.columns)).alias("r")).select("__key", "r.*"))
        kept = kept.join(repeated, twice, "left_anti").unionByName(equal)
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))
