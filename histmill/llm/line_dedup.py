"""Corpus-wide line deduplication, DataFrame operations only.

Lines are exploded with the hash of their normalised form, documents are counted per
hash, lines of a frequent hash go everywhere except in the document with the largest id,
and the rest is put together again by position. Line texts never leave their document's
row: only (128-bit hash, doc_id) pairs are shuffled, and they are made distinct before
counting, so a line that a third of all documents share is one partial row per map task.

Defined results: a null or empty text is one empty line and stays; rows that repeat a
doc_id count as one document and lose the same lines; rows without doc_id count as no
document, hold no line for the corpus, and keep all their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histmill.llm.common import SPACES, ascii_lower, ensure_columns, stage

MIN_CHARS = 40
MIN_DOCS = 5


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _key_hash(key: Column) -> Column:
    """128 bits in two independent longs."""
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(7), F.reverse(key)).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _line_hash(line: Column, min_chars: int) -> Column:
    """Hash of a line that is long enough to be judged, else null."""
    key = line_key(line)
    return F.when((F.length(line) >= min_chars) & (F.length(key) >= min_chars), _key_hash(key))


def frequent_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, dropped): per document the hashes of the lines that it has to lose."""
    long_lines = F.array_distinct(F.filter(
        F.transform(_lines(F.col("text")), lambda x: _line_hash(x, min_chars)), lambda h: h.isNotNull()))
    held = stage(docs.filter(F.col("doc_id").isNotNull())
                 .select("doc_id", F.explode(long_lines).alias("h"))
                 .select("doc_id", "h.a", "h.b").distinct())
    # staged, so that the join below deals both sides anew and a hot hash can be split
    counts = stage(held.groupBy("a", "b").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))
                   .filter(F.col("n_docs") >= min_docs))
    return (held.join(counts, ["a", "b"]).filter(F.col("doc_id") != F.col("keeper"))
            .groupBy("doc_id").agg(F.collect_set(F.struct("a", "b")).alias("dropped")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped`` added.

    ``docs`` needs ``doc_id`` and ``text``; other columns pass through, but columns of the
    three names above are replaced.
    """
    ensure_columns(docs, "doc_id", "text")
    gone = frequent_lines(docs, min_chars, min_docs).select(F.col("doc_id").alias("__id"),
                                                            F.col("dropped").alias("__drop"))
    lines = _lines(F.col("text"))
    kept = F.filter(lines, lambda x: ~F.coalesce(
        F.array_contains(F.col("__drop"), _line_hash(x, min_chars)), F.lit(False)))
    joined = (docs.join(gone, docs["doc_id"] == gone["__id"], "left")
              .drop("__id"))
    untouched = F.col("__drop").isNull()
    return (joined.withColumn("__kept", F.when(~untouched, kept))
            .withColumn("kept_text", F.when(untouched, F.coalesce("text", F.lit("")))
                        .otherwise(F.array_join("__kept", "\n")))
            .withColumn("n_lines", F.size(lines).cast("long"))
            .withColumn("n_dropped", F.when(untouched, F.lit(0)).otherwise(
                F.col("n_lines") - F.size("__kept")).cast("long"))
            .drop("__drop", "__kept"))
