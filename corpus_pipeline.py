"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller
writes it as Parquet and hands the table to the next one. All but the last
return the columns of documents.

Stages judge rows, not doc_ids: a row with a null doc_id, or one that shares its
doc_id with other rows, stays or goes by its own text. Rows repeated with the same
doc_id and text are near duplicates of each other, so one of them stays. Null and
empty texts have no language and go with the first stage; texts of any length
are judged whole. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, langid, mixing, neardup, wavelet
from vigil.llm.queries import tokenizer_path
from vigil.llm.scratch import broadcast_if_small, scratch_path, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a language (``und``) go; ``lang`` becomes the predicted one."""
    out = langid.identify(docs, docs.filter(~langid.held_out(F.col("doc_id"))))
    return out.filter(F.col("lang_pred") != langid.UNDETERMINED).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one with the smallest doc_id (a null one is the last
    to be chosen), of equal doc_ids one by its place in the table.

    Five-word shingles, similarity of 0.8 or more.
    """
    rows = numbered(docs)
    groups = neardup.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), width=5, percent=80)
    groups = stored(groups.select(F.col("doc_id").alias("_row"), "component_id"), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row")
    first = rows.select("_row", "doc_id").join(groups, "_row").groupBy("component_id").agg(F.min(order)["_row"].alias("_row"), F.count("*").alias("n"))
    first = stored(first.filter("n > 1").select("component_id", F.col("_row").alias("stays")), "first")
    return _without(rows, groups.join(broadcast_if_small(first), "component_id").filter("_row != stays").select("_row"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text shares a window of ten words with a benchmark item go."""
    rows = numbered(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    report = decontaminate.contamination(rows.select(F.col("_row").alias("doc_id"), "text"), items, width=10)
    return _without(rows, report.filter("contaminated").select(F.col("doc_id").alias("_row")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed by the square root of their size: documents are repeated, or go, by their Poisson counts."""
    return mixing.mix(docs, temperature=0.5).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet shards; a row for each document read back from them."""
    path = scratch_path(spark, "tokens")
    wavelet.write_shards(docs, path, tokenizer=tokenizer_path(), end_id=2, added_tokens=True)
    return wavelet.read_documents(spark, path)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a number that is the row's own and stays when the table is read again: a hash of its
    file's path and its place in the file. Two of n rows share one with probability n**2 / 2**65 (6e-6 at 15 million rows)."""
    try:
        address = docs.metadataColumn("_metadata")
        docs.select(address["file_path"], address["row_index"])
    except AnalysisException:  # not read straight from Parquet files
        docs = stored(docs.select(*COLUMNS), "rows")
        address = docs.metadataColumn("_metadata")
    return docs.select(*COLUMNS, F.xxhash64(address["file_path"], address["row_index"]).alias("_row"))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents of ``rows`` whose number isn't in ``gone``; the texts are shuffled only if those are too many to broadcast."""
    gone = stored(gone, "gone")
    return rows.join(broadcast_if_small(gone), "_row", "left_anti").select(*COLUMNS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_output", tokens),
]

#: Trained statistics and tokenizer ids aren't SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
