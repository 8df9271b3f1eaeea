"""Mixing sources to target weights by Poisson replication.

A document of a source with weight w (the share of the output that the source
should have) is repeated as often as a Poisson variable says whose mean is
w * total / documents of the source. The variable is the Poisson distribution
inverted at a uniform number hashed from (seed, doc_id), so a document's
count doesn't depend on partitions, on other documents or on retries. A mean over ``PART``
is split into equal parts with a hash each (a sum of Poisson variables
is one), so the distribution's table stays short. The rows are then spread over
partitions, and ordered within them, by a hash of (seed, doc_id, copy): a global shuffle.

Counts are a groupBy over all documents; the rates are a row for each source and are
broadcast only up to 10,000 sources. A hot source is just many rows; nothing groups a source's rows.

Defined results: a source without a weight has weight 0 and goes; a null source
is a source of its own (weights may name it None); weights are normalised over the
sources present; a null doc_id hashes as empty text; rows with equal doc_id get equal
counts; null and empty texts are kept like others; all columns are passed on, with ``copy`` (1 ..)
behind them in place of a column of that name (in any case); other columns may have any name. Very long texts are
carried as they are. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.scratch import broadcast_if_small, stored

PART = 32.0
STEPS = 120  # P(Poisson(32) > 120) is below the precision of the hash


def uniform(*values: Column) -> Column:
    """A number in [0, 1) from the first 13 hexadecimal digits of an MD5 hash."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *values)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rates(docs: DataFrame, weights: dict[str | None, float] | None, total: int | None, temperature: float) -> DataFrame:
    """(source, parts, cdf): how many parts a source's mean has, and the Poisson distribution function of one part.

    Without ``weights`` a source's weight is its number of documents to the power of ``temperature``.
    """
    n = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        n = n.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = docs.sparkSession.createDataFrame([(k, float(v)) for k, v in weights.items()], "s string, w double")
        n = n.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("s")), "left").drop("s").fillna(0.0, ["w"])
    n = stored(n, "sources")
    sums = n.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    size = sums.n if total is None else total
    mean = F.col("w") / F.lit(sums.w or 1.0) * F.lit(float(size or 0)) / F.col("n")
    parts = F.greatest(F.ceil(mean / PART), F.lit(1)).cast("int")
    out = n.select("source", mean.alias("mean"), parts.alias("parts")).withColumn("m", F.col("mean") / F.col("parts"))
    # log P(k) = k log m - m - log k!; a short table for each source
    log_factorial = F.array(*(F.lit(math.lgamma(k + 1)) for k in range(STEPS + 1)))
    p = F.transform(log_factorial, lambda x, k: F.when(F.col("m") > 0, F.exp(k * F.log("m") - F.col("m") - x)).otherwise(F.when(k == 0, 1.0).otherwise(0.0)))
    out = out.withColumn("p", p)
    running = F.aggregate("p", F.array().cast("array<double>"), lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0.0)) + x)))
    return out.select("source", "parts", running.alias("cdf"))


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, *, total: int | None = None, temperature: float = 0.5, seed: int = 17) -> DataFrame:
    """``docs`` (doc_id, source and any columns) replicated to the weights, with the column copy, shuffled.

    ``total``: expected number of output rows (as many as documents, if None).
    """
    kept = [c for c in docs.columns if c.lower() != "copy"]  # as Spark compares names
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"))  # so that no name can clash with the operator's own
    rate = broadcast_if_small(stored(rates(docs.select("source"), weights, total, temperature), "rates"), 10_000)
    # each draw is the number of steps of the distribution function at or below its uniform number
    doc_id = F.col("row")["doc_id"].cast("string")
    uniforms = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda i: uniform(F.lit(str(seed)), F.coalesce(doc_id, F.lit("")), i.cast("string")))
    draws = F.transform("u", lambda u: F.size(F.filter("cdf", lambda c: c <= u)))
    rows = packed.join(rate, F.col("row")["source"].eqNullSafe(F.col("source"))).withColumn("u", uniforms)
    rows = rows.withColumn("times", F.aggregate(draws, F.lit(0), lambda a, x: a + x)).filter("times > 0")
    rows = rows.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    place = F.xxhash64(F.lit(seed), doc_id, "copy")
    rows = rows.withColumn("place", place).repartition("place").sortWithinPartitions("place")
    return rows.select(*(F.col("row")[c].alias(c) for c in kept), "copy")
