"""The registered queries of this folder and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histmill.llm import (byte_bpe, conversation_repair, digest_index, html_extract, line_dedup, minhash_dedup,
                          multiset_hash, phrases, quality_rules, source_mix, suffix_dedup, toxicity, url_filter)
from histmill.llm.common import small_batches, table, word_count

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash_dedup.near_duplicates(docs, width=2, percent=80)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                                    F.xxhash64("text").alias("mark"))
    return source_mix.mix(docs, mark="mark").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiset_hash.edited_against_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                     public_tokenizers.PATTERN, keep_ids=False)


def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.main_text(pages).withColumn("n_chars", F.length("text").cast("long"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                            "n_repeat_words", "base_failed", "kept")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.THRESHOLD, 1).otherwise(0).alias("predicted"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


#: The list that the query applies.
URL_RULES = ("allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/", "block net/fr/")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.parse_rules(URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict")


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


#: The table arrives in so many deliveries of ascending doc_id.
DELIVERIES = 4


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = digest_index.scratch_index(spark)
    verdicts = digest_index.judge(docs, index, DELIVERIES)
    index.close()
    return verdicts.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


OP9_SQL = """
with line as (
  select row_number() over () as rid, doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), each as (
  select rid, doc_id, unnest(parts) as body, unnest(range(len(parts))) as pos from line
), keyed as (
  select *, translate(trim(body, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from each
), common as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 40
  group by k having count(distinct doc_id) >= 5
), judged as (
  select e.*, (c.k is not null and e.doc_id is not null and e.doc_id <> c.keeper) as gone
  from keyed e left join common c on e.k = c.k
)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(body, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by rid
"""

QUERIES: dict[str, QueryFn] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_source_mix": op2_source_mix,
    "op3_multiset_hash": op3_multiset_hash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_html_extract": op5_html_extract,
    "op6_quality_rules": op6_quality_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op6_quality_rules": quality_rules.ORACLE,
    "op9_line_dedup": OP9_SQL,
    "op11_phrase_mining": phrases.ORACLE,
    "op12_exact_dedup": digest_index.ORACLE,
    "op13_conversation_repair": conversation_repair.ORACLE,
}
