"""Mixing sources to target weights by Poisson replication.

A source with n documents and target weight w gets the mean repetition rate w * size / n. Each
document draws its number of copies from the Poisson distribution of that mean by inverting it at a
uniform number hashed from a seed and the document's id, so a rerun and a recomputed task draw the
same. A rate above ``STEP`` is a sum of equal independent draws of at most ``STEP`` each, which has
the same distribution and keeps the table of the inverse short. The copies are dealt out by a hash
of seed, id and copy and sorted by it inside each partition: a global shuffle of hot sources too.

A null source is a source of its own; a source without a weight, or with weight 0, gets no copies.
Null ids hash as the text 'null'; repeated rows draw alike, each for itself. Texts, null or long, are
carried along. An empty table gives an empty result. Other columns are kept whatever their names;
the operator adds ``copy`` and ``shuffle_key``, and replaces columns of those names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.common import written

#: Largest mean of one draw, and the counts its inverse distinguishes (the rest weighs under 1e-13).
STEP = 8
COUNTS = 48


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the MD5 of the parts joined by '|'."""
    digest = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13)
    return F.conv(digest, 16, 10).cast("double") / float(2 ** 52)


def tempered(sources: DataFrame, exponent: float) -> DataFrame:
    """Weights in proportion to each source's documents to the power ``exponent``."""
    return sources.select("source", F.pow(F.col("docs").cast("double"), F.lit(exponent))
                          .alias("weight"))


def rates(docs: DataFrame, weights: DataFrame | None = None, exponent: float = 0.5,
          size: float | None = None, source: str = "source") -> DataFrame:
    """Per source: docs, rate (mean copies of a document), draws and the inverse of one draw.

    ``weights`` has columns source and weight, in any scale; without it the sources are tempered.
    ``size`` is the mean number of copies in all, by default the number of documents.
    """
    sources = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("docs"))
    weighted = (tempered(sources, exponent) if weights is None
                else weights.groupBy("source").agg(F.sum("weight").alias("weight"))).alias("w")
    present = sources.alias("s").join(
        weighted, F.col("s.source").eqNullSafe(F.col("w.source")), "left").select(
        "s.source", "s.docs", F.greatest(F.coalesce(F.col("w.weight"), F.lit(0.0)), F.lit(0.0))
        .alias("weight"))
    # One row of two sums.
    all_docs, all_weight = present.agg(F.sum("docs"), F.sum("weight")).first()
    wanted = float(all_docs or 0) if size is None else float(size)
    rated = present.select("source", "docs", (
        F.col("weight") / F.lit(all_weight) * wanted / F.col("docs") if all_weight
        else F.lit(0.0)).alias("rate"))
    drawn = rated.withColumn("draws", F.greatest(F.ceil(F.col("rate") / STEP), F.lit(1)))
    mean = F.col("rate") / F.col("draws")
    terms = [F.when(mean > 0, F.exp(k * F.log(mean) - mean - math.lgamma(k + 1)))
             .otherwise(1.0 if k == 0 else 0.0) for k in range(COUNTS)]
    return drawn.withColumn("pmf", F.array(*terms)).select(
        "source", "docs", "rate", "draws", F.transform(
            F.sequence(F.lit(1), F.lit(COUNTS)), lambda k: F.aggregate(
                F.slice("pmf", F.lit(1), k), F.lit(0.0), lambda total, p: total + p))
        .alias("reach"))


def poisson_mix(docs: DataFrame, weights: DataFrame | None = None, exponent: float = 0.5,
                size: float | None = None, seed: str = "mix", doc_id: str = "doc_id",
                source: str = "source") -> DataFrame:
    """The documents' columns with ``copy`` (from 0) and ``shuffle_key``, a row for each copy."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    kept = [c for c in docs.columns if c.lower() not in ("copy", "shuffle_key")]
    # Written, so that Spark knows how few sources there are and need not shuffle the documents.
    table = written(rates(docs, weights, exponent, size, source), "rates").select(
        F.struct("source", "draws", "reach").alias("__rate"))
    rated = docs.select(*kept).join(
        table, F.col(source).eqNullSafe(F.col("__rate.source")))
    copies = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col("__rate.draws")), F.lit(0),
        lambda total, draw: total + F.size(F.filter(
            "__rate.reach", lambda p: p <= uniform(F.lit(seed), key, draw.cast("string")))))
    numbered = rated.withColumn("__copies", copies).filter("__copies > 0").select(
        *kept, F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("copy"))
    keyed = numbered.withColumn("shuffle_key", F.md5(F.concat_ws(
        "|", F.lit(seed), key, F.lit("copy"), F.col("copy").cast("string"))))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
