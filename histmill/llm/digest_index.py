"""Exact deduplication against a persistent digest index.

The index is two tables below one folder, both bucketed and sorted by digest:

* ``seen``: one row per distinct text, (digest, keep_id, keep_row, n_rows, delivery): the id and
  row of the copy that stays, and the rows equal to it in the delivery that brought it;
* ``again``: (digest, n_rows, delivery): rows of later deliveries equal to a known text.

A delivery is digested, pre-aggregated by digest (a text that a third of all rows share is one
row per map task), and met with ``seen`` in a sort-merge anti-join that reads the index bucket
by bucket without shuffling it; the digests it finds new are appended. Documents themselves are
never shuffled: only (digest, id, row number) rows are.

A delivery that was cut short can be added again under the same name: its own entries do not
count as known, and a table it already reached is not written twice.

Defined results: a null text is the empty text; texts are compared after every run of white
space became one space. Of equal texts in one delivery the smallest doc_id stays, ids that are
null come last, and of rows equal in both the first in storage order stays; a text known from an
earlier delivery stays there, whatever its id. An empty delivery adds nothing. Other columns
pass through ``deduplicate``; columns named like its results are replaced.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histmill.llm.common import drop_folder, ensure_columns, shuffle_partitions, stage
from histmill.session import ensure_checkpoint_dir

SEEN = "digest binary, keep_id bigint, keep_row bigint, n_rows bigint, delivery string"
AGAIN = "digest binary, n_rows bigint, delivery string"


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]++", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """The index below ``path``; created there with ``buckets`` buckets if the folder is empty.

    ``buckets`` defaults to the session's shuffle partitions, so that a delivery grouped by
    digest already lies as the index does. The tables are external: any session that opens the
    same path (with the same number of buckets) sees all deliveries.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets or shuffle_partitions(spark)
        name = f"digest_index_{uuid.uuid4().hex}"
        self.seen, self.again = f"{name}_seen", f"{name}_again"
        for table, columns in ((self.seen, SEEN), (self.again, AGAIN)):
            spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet OPTIONS (compression 'zstd') "
                      f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
                      f"LOCATION '{self.path}/{table.rpartition('_')[2]}'")

    def close(self) -> None:
        """Forget the two table names; the files stay."""
        for table in (self.seen, self.again):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def known(self, but: str) -> DataFrame:
        """Texts known from deliveries other than ``but``."""
        return self.spark.table(self.seen).filter(F.col("delivery") != but)

    def _write(self, rows: DataFrame, table: str, folder: str) -> None:
        (rows.write.mode("append").format("parquet").option("compression", "zstd").bucketBy(self.buckets, "digest")
         .sortBy("digest").option("path", f"{self.path}/{folder}").saveAsTable(table))

    def _append(self, rows: DataFrame, table: str, delivery: str) -> None:
        there = self.spark.table(table)
        if not there.filter(F.col("delivery") == delivery).limit(1).count():
            self._write(rows.withColumn("delivery", F.lit(delivery)).select(there.columns), table,
                        table.rpartition("_")[2])

    def add(self, rows: DataFrame, delivery: str) -> None:
        """Append the texts of ``rows`` (digest, doc_id, row) that no other delivery brought.

        The grouped delivery is first written as the index lies; both joins then merge bucket
        with bucket, and what they append needs no shuffle either."""
        first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("first")
        texts = (rows.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n_rows"))
                 .select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"),
                         "n_rows"))
        if self.buckets != shuffle_partitions(self.spark):
            texts = texts.repartition(self.buckets, "digest")
        arrived = f"{self.seen}_{uuid.uuid4().hex}"
        self._write(texts, arrived, f"arrived-{arrived}")
        texts = self.spark.table(arrived)
        known = self.known(delivery).select("digest").hint("merge")
        self._append(texts.join(known, "digest", "left_anti"), self.seen, delivery)
        self._append(texts.join(known, "digest", "left_semi"), self.again, delivery)
        self.spark.sql(f"DROP TABLE {arrived}")
        drop_folder(self.spark, f"{self.path}/arrived-{arrived}")

    def repeated(self) -> DataFrame:
        """(digest, keep_id, keep_row, group_size) of every text that more than one row has. The
        two tables lie alike, so their join moves nothing."""
        more = self.spark.table(self.again).groupBy("digest").agg(F.sum("n_rows").alias("more"))
        size = F.col("n_rows") + F.coalesce("more", F.lit(0))
        return (self.spark.table(self.seen).hint("merge").join(more, "digest", "left")
                .select("digest", "keep_id", "keep_row", size.alias("group_size")).filter(F.col("group_size") > 1))


def numbered_digests(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, row) of ``docs``, written once, so that the numbers stay what they are."""
    return stage(docs.select(digest(F.col("text")).alias("digest"), F.col("doc_id").cast("long").alias("doc_id"))
                 .withColumn("row", F.monotonically_increasing_id()))


def _verdicts(rows: DataFrame, index: DigestIndex) -> DataFrame:
    # staged, so that both sides of the join are dealt anew and a hot text can be split
    groups = stage(index.repeated()).withColumnRenamed("digest", "__digest")
    return (rows.join(groups, F.col("digest") == F.col("__digest"), "left")
            .withColumn("kept", F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)))
            .withColumn("keep_id", F.when(F.col("__digest").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")))
            .withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
            .drop("__digest", "keep_row"))


def deliveries(rows: DataFrame, parts: int) -> list[DataFrame]:
    """``rows`` cut at quantiles of doc_id, ascending, without doc_id last: all rows, none twice."""
    cuts = rows.select(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 1000)).first()[0] or []
    out, below = [], None
    for cut in sorted(set(cuts)):
        part = F.col("doc_id") <= cut
        out.append(rows.filter(part if below is None else part & (F.col("doc_id") > below)))
        below = cut
    rest = F.lit(True) if below is None else F.col("doc_id").isNull() | (F.col("doc_id") > below)
    return [*out, rows.filter(rest)]


def judge(docs: DataFrame, index: DigestIndex, parts: int = 1) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for every row of ``docs``, which is delivered
    to an empty ``index`` in ``parts`` parts of ascending doc_id: as the index keeps what came
    first, the smallest doc_id of equal texts stays whatever the number of parts."""
    ensure_columns(docs, "doc_id", "text")
    rows = numbered_digests(docs)
    for k, part in enumerate(deliveries(rows, parts) if parts > 1 else [rows]):
        index.add(part, f"part-{k}")
    return _verdicts(rows, index).select("doc_id", "keep_id", "group_size", "kept", "digest")


def deduplicate(docs: DataFrame, index: DigestIndex, delivery: str) -> DataFrame:
    """The rows of ``docs`` whose text no earlier delivery and no smaller id of this one has,
    after their texts were added to ``index`` as ``delivery``."""
    ensure_columns(docs, "doc_id", "text")
    docs = stage(docs.withColumn("__digest", digest(F.col("text")))
                 .withColumn("__row", F.monotonically_increasing_id()))
    index.add(docs.select(F.col("__digest").alias("digest"), F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("__row").alias("row")), delivery)
    stays = (index.spark.table(index.seen).filter(F.col("delivery") == delivery)
             .select(F.col("digest").alias("__d"), F.col("keep_row").alias("__r")))
    return docs.join(stays, (F.col("__digest") == F.col("__d")) & (F.col("__row") == F.col("__r")),
                     "left_semi").drop("__digest", "__row")


def scratch_index(spark: SparkSession) -> DigestIndex:
    """An empty index of its own below the checkpoint folder."""
    return DigestIndex(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/digests-{uuid.uuid4().hex}")


ORACLE = r"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256,
         row_number() over () as rid from documents
)
select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by text_sha256) as group_size,
       row_number() over w = 1 as kept, text_sha256
from d window w as (partition by text_sha256 order by doc_id nulls last, rid)
"""
