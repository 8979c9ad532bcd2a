"""Transaction logs, as-of label resolution and promotion sets
(SRC4, SRC6, WIN5, JN13, AGG10, AGG11, CMP9, SNK5, SRT2, DQ3)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histmill.functions.dates import parse_iso
from histmill.operators.ordered import forward_fill
from histmill.session import stage


@dataclass(frozen=True)
class LogPatterns:
    """Line patterns of the source-control history listing."""

    # ---- fixed values: line formats of the history listing ----
    header: str = r"^transaction (\d+);"
    checkin: str = r"^  # SS [^\n]+Time: (\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})"
    initial: str = r"^  # Import initial source"


def parse_tran_log(lines: DataFrame, file_col: str, line_col: str, text_col: str,
                   patterns: LogPatterns = LogPatterns()) -> DataFrame:
    """SRC4 + WIN5 + FLT8 + SC20: numbered log lines -> one row per line with the
    sticky transaction number, the parsed check-in time (or NULL) and the
    initial-import marker flag."""
    header = F.when(F.col(text_col).rlike(patterns.header),
                    F.regexp_extract(text_col, patterns.header, 1).cast("long"))
    parsed = lines.withColumn("_hdr", header)
    filled = forward_fill(parsed, [file_col], [line_col], "_hdr", "tran_num")
    checkin = F.when(F.col(text_col).rlike(patterns.checkin),
                     parse_iso(F.regexp_extract(text_col, patterns.checkin, 1)))
    return filled.select(file_col, line_col, "tran_num", checkin.alias("checkin_time"),
                         F.col(text_col).rlike(patterns.initial).alias("is_initial")).drop("_hdr")


def parse_transactions(records: DataFrame, patterns: LogPatterns = LogPatterns()) -> DataFrame:
    """SRC4 on records of ``sources.files.read_transactions``: (file, at, tran_num, pos, checkin_time,
    is_initial), one row per line, in the tasks that read the listing. Empty lines at the end of
    a record are no lines (the last one of a file ends with its line feed)."""
    text = F.regexp_replace("value", r"\n++\z", "")
    lines = records.select("file", "at", "tran_num", F.posexplode(F.split(text, "\n", -1)).alias("pos", "_line"))
    checkin = F.when(F.col("_line").rlike(patterns.checkin), parse_iso(F.regexp_extract("_line", patterns.checkin, 1)))
    return lines.select("file", "at", "tran_num", "pos", checkin.alias("checkin_time"),
                        F.col("_line").rlike(patterns.initial).alias("is_initial"))


def transaction_times(log: DataFrame) -> DataFrame:
    """(file, tran_num, line, checkin_time) for check-in lines that follow a header."""
    return log.where(F.col("checkin_time").isNotNull() & F.col("tran_num").isNotNull())


def initial_transaction(log: DataFrame, file_col: str, line_col: str) -> DataFrame:
    """Per file, the transaction of the last initial-import marker line (last match wins)."""
    return (log.where(F.col("is_initial") & F.col("tran_num").isNotNull())
            .groupBy(file_col).agg(F.max_by("tran_num", line_col).alias("initial_tran")))


def labels_frame(spark: SparkSession, labels: Sequence[tuple[str, str]]) -> DataFrame:
    """SRC6: inline constant relation (label, time text) with a sequence number."""
    rows = [(i + 1, name, ts) for i, (name, ts) in enumerate(labels)]
    return (spark.createDataFrame(rows, "seq int, label string, label_text string")
            .withColumn("label_time", parse_iso(F.col("label_text"))).drop("label_text"))


def asof_labels(labels: DataFrame, checkins: DataFrame, tran_col: str = "tran_num",
                time_col: str = "checkin_time", order_col: str = "line_no") -> DataFrame:
    """JN13 + AGG11: for each label, the transaction of the latest check-in at or before the
    label time (ties: the highest transaction), with that transaction's first check-in time.

    ``labels`` is a list built on the driver (SRC6). A check-in first counts for the earliest label
    that is not before it, so each task keeps the latest check-in of every gap between labels; a
    running maximum over the labels does the rest. The log itself is not shuffled. Use
    ``asof_labels_sorted`` for labels that are a table.
    """
    spark = labels.sparkSession
    times = [r[0] for r in labels.select("label_time").where("label_time is not null").distinct()
             .orderBy("label_time").collect()]
    known = F.array(*[F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz") for t in times]).cast("array<timestamp_ntz>")
    hit = F.struct(F.col(time_col).alias("_t"), F.col(tran_col).cast("long").alias("_tran"))
    tops = (checkins.where(F.col(time_col).isNotNull())
            .select(F.size(F.filter(known, lambda x: x < F.col(time_col))).alias("_gap"), hit.alias("_hit"))
            .where(F.col("_gap") < len(times)).groupBy("_gap").agg(F.max("_hit").alias("_hit")))
    gaps = spark.createDataFrame(list(enumerate(times)), "_gap int, _time timestamp_ntz")
    upto = Window.orderBy("_gap").rowsBetween(Window.unboundedPreceding, 0)  # one row per label time
    best = (gaps.join(tops, "_gap", "left").withColumn("_best", F.max("_hit").over(upto))
            .select("_time", F.col("_best._tran").alias("tran_num"), F.col("_best._t").alias("matched_time")))
    matched = stage(labels.join(best, F.col("label_time") == F.col("_time"), "left").drop("_time"))
    found = matched.where(F.col("tran_num").isNotNull()).select(F.col("tran_num").alias("_ft")).distinct()
    firsts = (checkins.join(found, F.col(tran_col) == F.col("_ft"), "left_semi")
              .groupBy(F.col(tran_col).alias("_ft")).agg(F.min_by(time_col, order_col).alias("first_time")))
    return matched.join(firsts, F.col("tran_num") == F.col("_ft"), "left").drop("_ft")


def asof_labels_sorted(labels: DataFrame, checkins: DataFrame, tran_col: str = "tran_num",
                       time_col: str = "checkin_time") -> DataFrame:
    """JN13 for any number of labels: union both sides and carry the latest check-in forward in
    time order (distributed forward fill). No (check-in, label) pairs are formed.

    Check-ins at the same time are ordered by transaction, so the highest one wins.
    """
    events = checkins.select(F.col(time_col).alias("_t"), F.lit(0).alias("_kind"),
                             F.col(tran_col).cast("long").alias("_tran"), F.lit(None).cast("int").alias("seq"))
    marks = labels.select(F.col("label_time").alias("_t"), F.lit(1).alias("_kind"),
                          F.lit(None).cast("long").alias("_tran"), "seq")
    both = events.unionByName(marks).withColumn("_hit", F.when(F.col("_kind") == 0, F.struct("_tran", "_t")))
    filled = forward_fill(both, [], ["_t", "_kind", "_tran"], "_hit", "_last")
    return labels.join(filled.where(F.col("_kind") == 1).select(
        "seq", F.col("_last._tran").alias("tran_num"), F.col("_last._t").alias("matched_time")), "seq", "left")


def promote_set(checkins: DataFrame, initial: DataFrame, ga_time: str, tran_col: str = "tran_num",
                time_col: str = "checkin_time") -> DataFrame:
    """CMP9 + AGG10: transactions whose latest check-in is at or before the GA time,
    plus the initial transaction (a bag, as in the original list). Fails when
    there is no initial transaction (DQ3)."""
    latest = checkins.groupBy(tran_col).agg(F.max(time_col).alias("_last"))
    picked = latest.where(F.col("_last") <= F.lit(ga_time).cast("timestamp_ntz")).select(tran_col)
    # an aggregate without groups has a row even if the input has none
    found = F.array_sort(F.collect_list("initial_tran")).alias("_found")
    checked = initial.agg(found).select(F.explode(
        F.when(F.size("_found") > 0, F.col("_found"))
        .otherwise(F.raise_error(F.lit("Did not find initial transaction.")).cast("array<bigint>"))).alias(tran_col))
    return checked.unionByName(picked)


def required_transaction(log: DataFrame, tran: int, file_col: str) -> DataFrame:
    """DQ3: the log's transaction headers of ``tran`` (file, tran_num); fails if no file has it."""
    hits = log.where(F.col("tran_num") == tran).select(file_col).distinct()
    checked = hits.agg(F.array_sort(F.collect_set(file_col)).alias("_f")).select(F.explode(
        F.when(F.size("_f") > 0, F.col("_f")).otherwise(
            F.raise_error(F.lit(f"Did not find transaction {tran}.")).cast(
                hits.select(F.collect_set(file_col)).schema[0].dataType))).alias(file_col))
    return checked.withColumn("tran_num", F.lit(tran).cast("long"))


XML_HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<transactions>'
XML_TAIL = "</transactions>"


def xml_tran_lines(trans: DataFrame, tran_col: str = "tran_num") -> DataFrame:
    """SNK5 + SRT2: the transaction list document as ordered lines ``(seq, key, line)``.

    Ids sort as text. Writing with ``orderBy('seq', 'key')`` yields the document;
    no single row or task holds the whole list.
    """
    spark = trans.sparkSession
    ids = trans.select(F.lit(1).alias("seq"), F.col(tran_col).cast("string").alias("key"),
                       F.concat(F.lit("<id>"), F.col(tran_col).cast("string"), F.lit("</id>")).alias("line"))
    edge = spark.createDataFrame([(0, None, XML_HEAD), (2, None, XML_TAIL)], "seq int, key string, line string")
    return edge.unionByName(ids)
