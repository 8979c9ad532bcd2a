"""File sources (SRC2, SRC3, SRC4, SRC7): line-oriented text and nested JSON.

Text files are read with ``spark.read.text`` (splittable). A line's number is the start of
its block in the file plus its row number in the task: it rises along the file however the
blocks are dealt to tasks, since a block has at least as many bytes as lines and only a
file's last block shares its task with others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmill.operators.ordered import forward_fill

LEAD_LINE = r"^([^,]*),([^,\n]*)$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) for every line of the text files under ``path``."""
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("file"),
                    (F.col("_metadata.file_block_start") + in_task).alias("line_no"), "value"))


def component_leads(lines: DataFrame, text_col: str = "value", order_col: str = "line_no") -> DataFrame:
    """SRC2: keep lines with exactly one comma; a repeated name keeps its last lead; blank leads
    stay. Lines of several files (column ``file``) count in the order of the file names."""
    ok = lines.where(F.col(text_col).rlike(LEAD_LINE)).select(
        F.regexp_extract(text_col, LEAD_LINE, 1).alias("name"),
        F.regexp_extract(text_col, LEAD_LINE, 2).alias("lead"),
        F.struct(*[F.col(c) for c in ("file", order_col) if c in lines.columns]).alias("_place"))
    return ok.groupBy("name").agg(F.max_by("lead", "_place").alias("lead"))


def read_component_leads(spark: SparkSession, path: str) -> DataFrame:
    return component_leads(read_lines(spark, path))


PROJECT_SCHEMA = "key string, name string, components array<struct<id:string, name:string>>"


def read_project(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: project document(s) -> one row per component (id, name, position)."""
    doc = spark.read.schema(PROJECT_SCHEMA).json(path, multiLine=True)
    return doc.select(F.posexplode("components").alias("pos", "c")).select(
        F.col("c.id").alias("id"), F.col("c.name").alias("name"), "pos")


def project_components(documents: DataFrame, text_col: str = "value",
                       members: dict[str, str] | None = None) -> DataFrame:
    """SRC3 for documents whose members vary: one row per component of every JSON text.

    Texts are parsed to VARIANT, so a member may be missing, extra, or a number in one document
    and a text in the next. Returns the other columns, ``key``, ``pos`` and ``members`` (name ->
    type, default id and name); a member that is missing or does not fit its type is NULL, and
    a component that is not an object has only NULLs. Texts that are no JSON, and documents
    without an array of components, give no row.
    """
    rest = [c for c in documents.columns if c != text_col]
    doc = documents.select(*rest, F.try_parse_json(text_col).alias("_doc"))
    each = doc.select(*rest, F.try_variant_get("_doc", "$.key", "string").alias("key"), F.posexplode(
        F.try_variant_get("_doc", "$.components", "array<variant>")).alias("pos", "_c"))
    wanted = members or {"id": "string", "name": "string"}
    return each.select(*rest, "key", "pos", *[F.try_variant_get("_c", f"$.{m}", t).alias(m) for m, t in wanted.items()])


RECORD_BREAK = "\ntransaction "
RECORD_HEAD = r"^(?:transaction )?(\d+);"


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: (file, at, tran_num, value): one row per transaction of the history listings.

    The listing is split by the start of a header line, so a record is a header with the lines
    that follow it, wherever file blocks end, and the sticky number needs no order and no
    shuffle. A file's first record keeps the word before its number; without a header it holds
    the lines before the first one and has no number. A line that begins like a header but has
    no number opens no transaction: such records take the number of the nearest earlier one,
    which is looked up for them alone. ``at`` rises along a file. A record is one value: use
    ``operators.snapshots.parse_tran_log`` on lines where one transaction can outgrow a task.
    """
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    records = (spark.read.option("lineSep", RECORD_BREAK).text(path)
               .select(F.col("_metadata.file_path").alias("file"),
                       (F.col("_metadata.file_block_start") + in_task).alias("at"), "value"))
    number = F.when(F.col("value").rlike(RECORD_HEAD), F.regexp_extract("value", RECORD_HEAD, 1).cast("long"))
    records = records.withColumn("tran_num", number).select("file", "at", "tran_num", "value")
    places = records.select("file", "at", "tran_num")
    if places.where("tran_num is null and at > 0").isEmpty():
        return records
    heads = forward_fill(places, ["file"], ["at"], "tran_num", "_known").where("tran_num is null").select(
        F.col("file").alias("_f"), F.col("at").alias("_a"), "_known")
    return (records.join(heads, (F.col("file") == F.col("_f")) & (F.col("at") == F.col("_a")), "left")
            .select("file", "at", F.coalesce("tran_num", "_known").alias("tran_num"), "value"))
