"""Passages that repeat across documents, by a sparse suffix array.

Of every text, the suffixes that start at minimiser positions are kept: in each run of
``words - GRAM + 1`` consecutive ten-word grams, the one with the smallest hash. The choice
depends on the words alone, so two documents that share a passage of ``words`` words or more
keep the same suffix inside it. Suffixes whose first gram is unique in the corpus go. The
others are sorted by their words (as hashes of ten-word blocks) and, a second time, by the
words before them; in both orders a suffix meets its nearest neighbours from other
documents. The sort is a range partitioning written to a stage table, so a passage that a
third of all documents hold spreads over as many ranges as it fills, and each of its
suffixes still has only four neighbours.

The nearest neighbours need not be those that share ``words`` words around a suffix, so the
windows of ``words`` words are compared as well. A suffix stands for the windows that choose
it, and suffixes that agree in all words of these are one class. A class of several documents
links its members to its first or last document. Windows of the other classes are hashed one
by one and linked to the first or last document with the same hash, so that every repeated
window has a partner, at a cost linear in the text.

Pairs of both kinds are extended word by word to the left and right in the full texts;
matches of at least ``words`` words are the result.

Words are what white space (space, \\t..\\r) separates, with A-Z lower-cased.

Defined results: null, empty and shorter texts have no passages; a passage that repeats only
within one document is none; rows without doc_id are left out; rows that share a doc_id are
one document, of which every text is searched (positions are within a row's text; rows equal in
doc_id and words give their passages once); an empty table gives an empty result.

Texts are read once: a stage table holds the hashes of their words, which all later steps use.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from histmill.llm.common import drop_stage, ensure_columns, shuffle_partitions, small_batches, stage

WORDS = 50
GRAM = 10
WORD_CACHE = 1_000_000
#: Bytes kept of a word's hash. Two words that differ are taken as equal with a chance of 2^-48.
WIDTH = 6
#: Words that a task handles at a time, give or take a row.
CHUNK = 1 << 18
BASE = 0x9E3779B97F4A7C15


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(text: str | None, hashes: _WordHashes) -> np.ndarray:
    words = text.encode("utf-8", "replace").lower().split() if text else []
    return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))


def grams(w: np.ndarray) -> np.ndarray:
    """Hashes of all runs of GRAM words."""
    n = len(w) - GRAM + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k in range(GRAM if n > 0 else 0):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[k:k + n])
    return h


def _smallest(h: np.ndarray, window: int) -> np.ndarray:
    """Position of the smallest (leftmost) hash of every window, by windows of doubled length."""
    value, at, size = h, np.arange(len(h)), 1
    while size < window:
        step = min(size, window - size)  # the last two halves overlap
        later = value[step:] < value[:-step]
        value = np.where(later, value[step:], value[:-step])
        at = np.where(later, at[step:], at[:-step])
        size += step
    return at


def anchors(h: np.ndarray, window: int, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the smallest (leftmost) hash of every window (or of those at ``starts``, ascending),
    the first window that chooses each and the number of windows that do (they follow each other)."""
    if len(h) < window or starts is not None and not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    at = _smallest(h, window)
    if starts is None:
        starts = np.arange(len(at))
    else:
        at = at[starts]
    edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[edge], starts[edge], np.diff(np.append(edge, len(at)))


def minimisers(h: np.ndarray, window: int) -> np.ndarray:
    return anchors(h, window)[0]


@lru_cache(maxsize=32)
def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))


def span_hashes(w: np.ndarray, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Hashes of the ``size`` words from each start."""
    n = 1 << len(w).bit_length()
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * _powers(BASE, n)[:len(w)])])
    return _mix((sums[start + size] - sums[start]) * _powers(pow(BASE, -1, 1 << 64), n)[start])


def _contexts(h: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[np.ndarray]:
    """Two longs of the four blocks after each position, two of the four before it; blocks that do
    not begin between ``lo`` and ``hi``, the first and last gram of the text, are 0."""

    def block(k: int) -> np.ndarray:
        j = at + k * GRAM
        return np.where((j >= lo) & (j <= hi), h[np.clip(j, 0, len(h) - 1)] & np.uint64(0xFFFFFFFF), np.uint64(0))

    return [((block(a) << np.uint64(32)) | block(b)).view(np.int64) for a, b in ((1, 2), (3, 4), (-1, -2), (-3, -4))]


def _hash_batches(words: int) -> Callable:
    """Rows of ``words`` words or more, as the hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            ids, packed = [], []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                w = word_hashes(text, hashes)
                if len(w) >= words:
                    ids.append(doc_id)
                    packed.append(pack(w))
            marks = [xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in packed]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks, pa.int64()),
                                              pa.array(packed, pa.binary())], names=["doc_id", "mark", "words"])

    return run


def pack(w: np.ndarray) -> bytes:
    return w.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def unpack(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(packed, np.uint8).reshape(-1, WIDTH)
    w = np.zeros((len(raw), 8), np.uint8)
    w[:, :WIDTH] = raw
    return w.view("<u8").ravel()


def _suffix_columns(texts: list[np.ndarray], words: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of texts of ``words`` words or more, laid one behind the other: the number of the text of
    each suffix, and its columns."""
    sizes = np.array([len(w) for w in texts])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    w = np.concatenate(texts)
    h = grams(w)
    n_windows = sizes - words + 1
    # the windows inside one text
    starts = np.repeat(begins - np.cumsum(n_windows) + n_windows, n_windows) + np.arange(n_windows.sum())
    at, first, n = anchors(h, words - GRAM + 1, starts)
    of = np.searchsorted(ends, at, side="right")
    # the words of the windows that choose the suffix, and where in them it is
    ctx = _mix(span_hashes(w, first, n + (words - 1)) + (n * 64 + at - first).astype(np.uint64))
    return of, [h[at].view(np.int64), *_contexts(h, at, begins[of], ends[of] - GRAM), at - begins[of],
                ctx.view(np.int64), first - begins[of], n]


def _suffix_batches(words: int) -> Callable:
    names = ["doc_id", "row", "g", "r1", "r2", "l1", "l2", "pos", "ctx", "first", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = (batch.column(c).to_numpy() for c in ("doc_id", "row"))
            packed = batch.column("words")
            begin, held = 0, 0
            for k in range(len(packed)):
                held += len(packed[k].as_buffer()) // WIDTH
                if held >= CHUNK or k == len(packed) - 1:
                    of, cols = _suffix_columns([unpack(p.as_buffer()) for p in packed[begin:k + 1]], words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in (ids[begin:k + 1][of], rows[begin:k + 1][of], *cols)], names=names)
                    begin, held = k + 1, 0

    return run


def _diagonals(links: DataFrame) -> DataFrame:
    """One staged row per pair of rows with the diagonals that (a, pa, b, pb) lie on."""
    swap = F.col("a") > F.col("b")
    return stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                              F.when(swap, F.col("pa") - F.col("pb")).otherwise(F.col("pb") - F.col("pa")).alias("d"))
                 .groupBy("a", "b").agg(F.collect_set("d").alias("diagonals")))


def _neighbours(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of rows with diagonals: each suffix with the nearest one of another document on
    either side in the order of ``keys``, doc_id, row and pos, if both begin with the same gram."""
    order = [*keys, "doc_id", "row", "pos"]
    n = shuffle_partitions(suffixes.sparkSession)
    ranged = stage(suffixes.select(*order).repartitionByRange(n, *order).sortWithinPartitions(*order)
                   .withColumn("pid", F.spark_partition_id()))
    own = ["g", "doc_id", "row", "pos"]
    me = F.struct(*own)
    out = None
    for forward in (True, False):
        sort = order if forward else [F.col(c).desc() for c in order]
        w = Window.partitionBy("pid").orderBy(*sort)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = (ranged.withColumn("was", F.lag(me).over(w))
                  .withColumn("other", F.last(F.when(F.col("was.doc_id") != F.col("doc_id"), F.col("was")),
                                              ignorenulls=True).over(upto))
                  .select("pid", *own, "other", F.row_number().over(w).alias("rn")))
        # what the range before hands over: its last suffix, and that one's own neighbour. One row per range.
        last = (filled.groupBy("pid").agg(F.max_by(me, "rn").alias("last"),
                                          F.max_by("other", "rn").alias("older")))
        # the ranges are few (one row per partition), so one window over them is bounded
        across = Window.orderBy("pid" if forward else F.col("pid").desc())
        edge = stage(last.select("pid", F.lag("last").over(across).alias("e1"),
                                 F.lag("older").over(across).alias("e2")))
        joined = filled.join(F.broadcast(edge), "pid")
        best = F.coalesce("other", F.when(F.col("e1.doc_id") != F.col("doc_id"), F.col("e1")), F.col("e2"))
        found = (joined.withColumn("o", best).filter("o.g = g and o.doc_id <> doc_id")
                 .select(F.col("row").alias("a"), F.col("pos").alias("pa"), F.col("o.row").alias("b"),
                         F.col("o.pos").alias("pb")))
        out = found if out is None else out.unionByName(found)
    out = _diagonals(out)
    drop_stage(ranged)
    return out


def _window_batches(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(5)]
            for doc_id, row, runs, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(),
                                               batch.column("runs"), batch.column("words"), strict=True):
                w = unpack(text.as_buffer())
                packed = runs.values.to_numpy()
                n = packed >> 1 & 0xFFFF
                # every window of each run
                start = np.repeat((packed >> 17) - np.cumsum(n) + n, n) + np.arange(n.sum())
                lone = np.repeat(packed & 1, n).astype(bool)
                inside = start + words <= len(w)
                start, lone = start[inside], lone[inside]
                for c, v in zip(cols, [span_hashes(w, start, words).view(np.int64), np.full(len(start), doc_id, np.int64),
                                       np.full(len(start), row, np.int64), start, lone], strict=True):
                    c.append(v)
            if cols[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in cols],
                                                 names=["h", "doc_id", "row", "pos", "lone"])

    return run


def _other(first: str, last: str) -> list:
    """(a, pa, b, pb): a row's own place and the first, or else the last, place in another document."""
    o = F.when(F.col(f"{first}.doc_id") != F.col("doc_id"), F.col(first)).otherwise(F.col(last))
    return [F.col("row").alias("a"), F.col("pos").alias("pa"), o["row"].alias("b"), o["pos"].alias("pb")]


def _window_pairs(kept: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Pairs of rows with diagonals: every repeated window of every document with one other
    document that holds it."""
    place = F.struct("doc_id", "row", "pos")
    ends = [F.min(place).alias("lo"), F.max(place).alias("hi")]
    # staged, so that the joins on a hot class or window can be split
    classes = stage(kept.groupBy("g", "ctx").agg(*ends).filter("lo <> hi"))
    placed = stage(kept.select("g", "ctx", "doc_id", "row", "pos", "first", "n", "mixed").join(classes, ["g", "ctx"], "left")
                   .drop("g", "ctx"))
    drop_stage(classes)
    lone = F.coalesce(F.col("lo.doc_id") == F.col("hi.doc_id"), F.lit(True))
    # a class of several documents is only looked for by others: two of its suffixes do
    runs = (placed.filter(F.col("mixed") & (lone | (place == F.col("lo")) | (place == F.col("hi"))))
            .groupBy("row").agg(F.collect_list(F.shiftleft(F.col("first"), 17) + F.shiftleft(F.col("n"), 1)
                                                  + lone.cast("long")).alias("runs")))
    windows = stage(texts.join(runs, "row").select("doc_id", "row", "runs", "words")
                    .mapInArrow(_window_batches(words), "h long, doc_id long, row long, pos long, lone boolean"))
    held = stage(windows.groupBy("h").agg(*ends).filter("lo.doc_id <> hi.doc_id"))
    out = _diagonals(placed.filter(~lone).select(*_other("lo", "hi"))
                     .unionByName(windows.filter("lone").join(held, "h").select(*_other("lo", "hi"))))
    for staged in (placed, windows, held):
        drop_stage(staged)
    return out


def matches(wa: np.ndarray, wb: np.ndarray, diagonals: list[int], words: int) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the runs of equal words on each diagonal (pb - pa)."""
    found = []
    for d in diagonals:
        lo, hi = max(0, -d), min(len(wa), len(wb) - d)
        if hi - lo < words:
            continue
        same = np.concatenate([[False], wa[lo:hi] == wb[lo + d:hi + d], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - s >= words:
                found.append((lo + s, lo + s + d, e - s))
    return found


def _extend_batches(words: int) -> Callable:
    columns = ["doc_id", "mark", "start", "n_words", "other_id", "other_start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            a, mark_a, b, mark_b, diagonals = (batch.column(c).to_pylist() for c in ("a", "ma", "b", "mb", "diagonals"))
            for k, (wa, wb) in enumerate(zip(batch.column("wa"), batch.column("wb"), strict=True)):
                for sa, sb, n in matches(unpack(wa.as_buffer()), unpack(wb.as_buffer()), diagonals[k], words):
                    out += [(a[k], mark_a[k], sa, n, b[k], sb), (b[k], mark_b[k], sb, n, a[k], sa)]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(columns)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=columns)

    return run


def repeated_passages(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, start, n_words, other_id, other_start (in words): the repeated passages of each
    document with one other document that holds the passage.

    A passage is as long as that pair's match; passages of one document may overlap.
    """
    ensure_columns(docs, "doc_id", "text")
    if words < 2 * GRAM:
        raise ValueError(f"words must be at least {2 * GRAM}")
    small_batches(docs.sparkSession)
    narrow = (docs.filter("doc_id is not null and text is not null")
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    texts = stage(narrow.mapInArrow(_hash_batches(words), "doc_id long, mark long, words binary")
                  .withColumn("row", F.monotonically_increasing_id()))
    suffixes = stage(texts.select("doc_id", "row", "words").mapInArrow(
        _suffix_batches(words), "doc_id long, row long, g long, r1 long, r2 long, l1 long, l2 long, pos long, ctx long, "
                                "first long, n long"))
    # mixed: not all suffixes of the gram are of one class
    shared = stage(suffixes.groupBy("g").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"),
                                             (F.min("ctx") != F.max("ctx")).alias("mixed"))
                   .filter("x <> y").select("g", "mixed"))
    kept = stage(suffixes.join(shared, "g"))
    drop_stage(suffixes)
    pairs = (_neighbours(kept, ["g", "r1", "r2"]).unionByName(_neighbours(kept, ["g", "l1", "l2"]))
             .unionByName(_window_pairs(kept, texts, words)))
    pairs = stage(pairs.groupBy("a", "b").agg(F.array_distinct(F.flatten(F.collect_list("diagonals"))).alias("diagonals")))
    drop_stage(kept)

    def end(side: str) -> DataFrame:
        return texts.select(F.col("row").alias(side), F.col("doc_id").alias(f"d{side}"), F.col("mark").alias(f"m{side}"),
                            F.col("words").alias(f"w{side}"))

    both = (pairs.join(end("a"), "a").join(end("b"), "b")
            .select(F.col("da").alias("a"), "ma", F.col("db").alias("b"), "mb", "diagonals", "wa", "wb"))
    found = both.mapInArrow(_extend_batches(words), "doc_id long, mark long, start long, n_words long, other_id long, "
                                                    "other_start long")
    return (found.groupBy("doc_id", "mark", "start", "n_words").agg(F.min(F.struct("other_id", "other_start")).alias("o"))
            .select("doc_id", "start", "n_words", "o.other_id", "o.other_start"))
