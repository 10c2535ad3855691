"""Training data from raw documents: each stage takes what the one before it kept.

``run`` applies the stages to the documents table. Each stage's rows are written below
``spark.checkpoint.dir`` and read again by the next. All stages but the last return the columns of
documents; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm import pii
from tidewarden.llm.common import written
from tidewarden.llm.jaccard import representatives
from tidewarden.llm.mixing import poisson_mix
from tidewarden.llm.packing import pack
from tidewarden.llm.quality import score, train
from tidewarden.llm.queries import tokeniser_path


def with_own_columns(docs: DataFrame, added: tuple[str, ...],
                     step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step`` of the documents, in their own columns; those of the names that the step adds wait
    under others meanwhile."""
    taken = {c.lower() for c in docs.columns}
    waiting = {}
    for name in docs.columns:
        if name.lower() in added:
            spare = f"{name}_own"
            while spare.lower() in taken:
                spare += "_own"
            taken.add(spare.lower())
            waiting[name] = spare
    after = step(docs.withColumnsRenamed(waiting))
    return after.select(*[F.col(waiting.get(c, c)).alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_own_columns(docs, ("score", "predicted"),
                            lambda rows: score(rows, model).filter("predicted = 1"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return representatives(docs)


def redact_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    verdicts = pii.learn(written(pii.candidates(docs), "pii"))
    return pii.redact(docs, verdicts).withColumn(
        "n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text").cast(docs.schema["n_chars"].dataType)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents, so that sources have tempered shares, globally shuffled."""
    return with_own_columns(docs, ("copy", "shuffle_key"), poisson_mix)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences, with their token ids."""
    return pack(docs, tokeniser_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "ids")


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram jaccard join", keep_distinct),
    ("pii", redact_personal),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Training, shingle similarity and tokenising are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
