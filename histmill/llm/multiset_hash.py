"""Document fingerprints by a homomorphic multiset hash of paragraphs.

A paragraph (a line with a word) is hashed to a wide vector of 32-bit lanes; a document's
fingerprint is the sum of its paragraphs' vectors modulo 2**32, which no text that fits in a
row can wrap in a sketch lane. So the order of paragraphs
does not matter, and a paragraph is inserted or deleted by one vector addition or
subtraction without the rest of the text.

The first lanes are uniform hash values of the whole paragraph: two documents with the same
multiset of paragraphs agree in them, others practically never do. The other lanes are a
signed sketch of the paragraph's word pairs (each pair adds +1 or -1 to one lane). The
squared distance of two sketches estimates how many word pairs differ, also through sums,
and gives the likeness ``1 - |a - b|^2 / (|a|^2 + |b|^2)``, cut to 0..1.

The fingerprint is preceded by a count of paragraphs; texts without a word have the
fingerprint of the empty multiset, and two of those have likeness 1.

``edited_against_next`` compares every text with an edited copy and with the next document
in ascending doc_id. The texts are shuffled once, to ranges of (doc_id, hash of the text); the
first text of each range is also sent to the range before it, and a range is read as a stream
of sorted rows. Range limits are quantiles of the ids; an id that fills several ranges (and
the rows without one) is split over them by the hash.

Defined results: a null text is an empty one; rows without doc_id come first in the order;
rows that repeat a doc_id, or have none, are ordered by a hash of their text; a single
document is its own next one; an empty table gives an empty result; other columns are ignored,
so that their names cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import ensure_columns, shuffle_partitions, small_batches

EQUALITY_LANES, SKETCH_LANES = 8, 256
LANES = EQUALITY_LANES + SKETCH_LANES
#: Ranges of ids per shuffle partition: several, so that hashing ranges to partitions evens out.
RANGES_PER_PARTITION = 3


class _Words(dict):
    """word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def paragraphs(text: str | None) -> list[bytes]:
    return [p for p in (text or "").encode("utf-8", "replace").split(b"\n") if p.split()]


def vector_of(parts: list[bytes], words: _Words) -> np.ndarray:
    """Sum of the vectors of some paragraphs (uint32 lanes, modulo 2**32)."""
    lanes = np.zeros(LANES, np.uint32)
    pairs = []
    for part in parts:
        wide = hashlib.blake2b(part, digest_size=4 * EQUALITY_LANES).digest()
        lanes[:EQUALITY_LANES] += np.frombuffer(wide, "<u4")
        tokens = part.split()
        w = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
        pairs.append(w[:-1] * np.uint64(0x9E3779B97F4A7C15) + w[1:] if len(w) > 1 else w)
    if pairs:
        h = _scramble(np.concatenate(pairs))
        lane = ((h >> np.uint64(1)) % np.uint64(SKETCH_LANES)).astype(np.int64)
        sign = 1 - 2 * (h & np.uint64(1)).astype(np.int64)
        sums = np.bincount(lane, sign, SKETCH_LANES).astype(np.int64)
        lanes[EQUALITY_LANES:] += (sums & 0xFFFFFFFF).astype(np.uint32)
    return lanes


class Fingerprint:
    """A multiset of paragraphs under insertion and deletion."""

    def __init__(self, text: str | None = "", words: _Words | None = None):
        self.words = words if words is not None else _Words()
        parts = paragraphs(text)
        self.count, self.lanes = len(parts), vector_of(parts, self.words)

    def insert(self, paragraph: str) -> "Fingerprint":
        parts = paragraphs(paragraph)
        self.count, self.lanes = self.count + len(parts), self.lanes + vector_of(parts, self.words)
        return self

    def delete(self, paragraph: str) -> "Fingerprint":
        parts = paragraphs(paragraph)
        self.count, self.lanes = self.count - len(parts), self.lanes - vector_of(parts, self.words)
        return self

    def __str__(self) -> str:
        return f"{self.count}:{base64.b64encode(self.lanes.astype('<u4').tobytes()).decode()}"

    def likeness(self, other: "Fingerprint") -> float:
        """0 to 1 from the sketch lanes; 1 for equal fingerprints."""
        if self.count == other.count and np.array_equal(self.lanes, other.lanes):
            return 1.0
        a, b = (x.lanes[EQUALITY_LANES:].view(np.int32).astype(np.float64) for x in (self, other))
        both = float(a @ a + b @ b)
        if not both:
            return 0.0
        d = a - b
        return float(min(1.0, max(0.0, 1 - (d @ d) / both)))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_text(text: str, following: str) -> str:
    """The last half replaced by as many characters (or all) of the following text."""
    n = len(text) // 2
    return text[:len(text) - n] + following[:n]


def _compare_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (range, guest, doc_id): each row meets the next one of its range; the
    guest row that ends a range only serves as a next one."""
    words = _Words()
    held = None  # range, doc_id, text, fingerprint
    columns = [c.split()[0] for c in RESULT.split(", ")]
    for pdf in batches:
        out = []
        for rng, guest, doc_id, text in zip(pdf["rng"], pdf["guest"], pdf["doc_id"], pdf["text"], strict=True):
            text = text or ""
            if held is None or held[0] != rng:
                held = None if guest else (rng, doc_id, text, Fingerprint(text, words))
                continue
            _, own_id, own, print_ = held
            following = Fingerprint(text, words)
            changed = edited_text(own, text)
            edited = Fingerprint(changed, words)
            out.append((own_id, len(own), hashlib.sha256(changed.encode("utf-8", "replace")).hexdigest(),
                        str(print_), str(edited), print_.likeness(edited), print_.likeness(following)))
            held = None if guest else (rng, doc_id, text, following)
        made = pd.DataFrame(out, columns=columns)
        made["doc_id"] = made["doc_id"].astype("Int64")
        yield made


#: The id that rows without one are dealt by.
NO_ID = -(1 << 63)


def range_of(limits: np.ndarray):
    """A column function (id, text hash) -> number of the range, by binary search. Equal limits
    are ranges of one id, told apart by the hash; the numbers ascend with (id, hash)."""

    @F.pandas_udf("int")
    def find(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        own = ids.to_numpy(np.int64)
        first = np.searchsorted(limits, own, "left")
        more = np.searchsorted(limits, own, "right") - first
        share = hashes.to_numpy(np.int64) / 2.0 ** 64 + 0.5
        return pd.Series(first + np.minimum((share * (more + 1)).astype(np.int64), more)).astype("int32")

    return find


def edited_against_next(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next."""
    ensure_columns(docs, "doc_id", "text")
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    key = F.coalesce("doc_id", F.lit(NO_ID))
    parts = shuffle_partitions(spark) * RANGES_PER_PARTITION
    # limits of the ranges: quantiles of the ids, ``parts`` - 1 of them, to a tenth of a range
    shares = [k / parts for k in range(1, parts)]
    limits = rows.agg(F.percentile_approx(key, shares, max(10_000, 10 * parts))).first()[0] or []
    rows = rows.withColumn("th", F.xxhash64("text"))
    rng = range_of(np.array(limits, np.int64))(key, F.col("th"))
    # the first row of each range that has rows: at most ``parts`` rows
    heads = (rows.select(rng.alias("rng"), F.struct(F.col("doc_id").isNotNull().alias("has"), "doc_id", "th").alias("x"))
             .groupBy("rng").agg(F.min("x").alias("head")).orderBy("rng").collect())
    before = [(h["head"]["doc_id"], h["head"]["th"], heads[k - 1]["rng"]) for k, h in enumerate(heads)]
    guests = spark.createDataFrame(before, "head long, head_th long, to int")
    # a head's row goes to two ranges, every other to one
    own, guest = F.struct("rng", F.lit(0).alias("guest")), F.struct(F.col("to").alias("rng"), F.lit(1).alias("guest"))
    both = (rows.withColumn("rng", rng)
            .join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("th") == F.col("head_th")), "left")
            .withColumn("place", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, guest))))
            .select("place.rng", "place.guest", "doc_id", "th", "text"))
    dealt = (both.repartition("rng")
             .sortWithinPartitions("rng", "guest", F.col("doc_id").asc_nulls_first(), "th")
             .select("rng", "guest", "doc_id", "text"))
    return dealt.mapInPandas(_compare_stream, RESULT)
