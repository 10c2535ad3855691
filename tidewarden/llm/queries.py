"""The operators over the given tables, with production parameters, next to SQL where it can say
the same. Digest columns of a contract are derived here from what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm import sql
from tidewarden.llm.chat import collapse_snapshots
from tidewarden.llm.fingerprints import edited_likeness
from tidewarden.llm.jaccard import jaccard_classes
from tidewarden.llm.merkle import build, document_leaves, verify
from tidewarden.llm.mixing import poisson_mix
from tidewarden.llm.packing import pack
from tidewarden.llm.pii import personal_spans
from tidewarden.llm.quality import held_out, score, train
from tidewarden.llm.repeats import remove_repeats
from tidewarden.llm.rules import rule_verdicts
from tidewarden.llm.spelling import spelling_groups
from tidewarden.llm.urls import rule_table, url_verdicts
from tidewarden.llm.warc import round_trip

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(text: str | None = None) -> Callable[[Query], Query]:
    def put(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if text is not None:
            ORACLES[query.__name__] = text
        return query
    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokeniser_path() -> str:
    """The vocabulary file that the box offers to every Python."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@register()
def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


@register()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@register()
def op3_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links")


@register()
def op4_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_spans(table(spark, sf_dir, "documents"))


@register(sql.CHAT)
def op5_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_snapshots(table(spark, sf_dir, "conversations"))


@register()
def op6_differencing_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokeniser_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


@register(sql.WARC)
def op7_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("long").alias("refers_to"))


@register(sql.RULES)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@register(sql.MIX)
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix(table(spark, sf_dir, "documents"))


#: Fixed by the contract of the query.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/")]


@register(sql.URLS)
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"), rule_table(spark, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict")


def manifest_rows(docs: DataFrame) -> DataFrame:
    """The manifest of documents of which every seventh, by the checksum of its id, is tampered with."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return verify(build(document_leaves(docs, tampered))).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified")


@register(sql.MERKLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_rows(table(spark, sf_dir, "documents"))


@register(sql.SPELLING)
def op12_pivotal_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def repeat_digests(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register(sql.REPEATS)
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))
