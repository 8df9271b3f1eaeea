"""File sources and sinks: watchlist JSON landing zone, CSV dimensions.

Watchlist records land as one JSON document per file. They are read as text
(one row per line) and parsed with a fixed schema; fields the schema does not
know are kept as JSON text in ``_rescued_data``. The incremental stream
(``read_watchlist_stream``) tracks processed files in its checkpoint, so
every file is ingested exactly once.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigil.schemas import MERCHANT_SCHEMA, WATCHLIST_COLUMNS, WATCHLIST_FILE_SCHEMA
from vigil.sources.tables import is_missing_path


def rescued_data(value: Column, known: list[str]) -> Column:
    """JSON text of the non-null fields the schema does not know (the schema
    is all text, so a known field always fits). Null when nothing is left. A
    line that is no JSON object is kept whole."""
    raw = F.from_json(value, "map<string,string>")
    known_arr = F.array(*[F.lit(k) for k in known])
    extra = F.map_filter(raw, lambda k, v: ~F.array_contains(known_arr, k) & v.isNotNull())
    return F.when(raw.isNull() & (F.trim(value) != ""), value).when(F.size(extra) > 0, F.to_json(extra))


def parse_watchlist_json(text_df: DataFrame, value_col: str = "value") -> DataFrame:
    """Watchlist columns from JSON text plus ``_rescued_data``; other input
    columns (such as ``file_path``) are kept."""
    value = F.col(value_col)
    parsed = F.from_json(value, WATCHLIST_FILE_SCHEMA)
    others = [c for c in text_df.columns if c != value_col]
    return text_df.select(
        *[parsed.getField(c).alias(c) for c in WATCHLIST_COLUMNS],
        rescued_data(value, WATCHLIST_COLUMNS).alias("_rescued_data"),
        *others)


def read_watchlist_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None):
    """Incremental read of new watchlist files (text lines + file path)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(landing_dir)
    return parse_watchlist_json(raw.select("value", F.col("_metadata.file_path").alias("file_path")))


def read_watchlist_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Batch read of the landing zone (same columns as the stream)."""
    raw = spark.read.format("text").load(landing_dir)
    return parse_watchlist_json(raw.select("value", F.col("_metadata.file_path").alias("file_path")))


def infer_and_store_schema(spark: SparkSession, landing_dir: str, schema_path: str,
                           sampling_ratio: float = 1.0) -> StructType:
    """Infer the JSON schema once (all fields as text is the safe default for
    ids and card numbers), store it next to the checkpoint and reuse it on
    restart, so a restarted stream keeps its schema."""
    try:
        stored = spark.read.text(schema_path)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
    else:
        lines = stored.collect()        # the schema's text
        if lines:
            return StructType.fromJson(json.loads("".join(r.value for r in lines)))
    schema = (spark.read.option("samplingRatio", str(sampling_ratio))
              .option("primitivesAsString", "true").json(landing_dir).schema)
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(schema_path)
    return schema


def spread(records: DataFrame) -> DataFrame:
    """``records`` dealt evenly over the shuffle partitions, however few partitions they come in: for
    writes of a file for each record, whose time is that of making the files."""
    return records.repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def publish_watchlist_files(records: DataFrame, landing_dir: str) -> None:
    """Write one JSON document per file (append), as the feed publishes them."""
    (spread(records.select(*WATCHLIST_COLUMNS)).write.mode("append")
     .option("maxRecordsPerFile", 1).json(landing_dir))


def watchlist_id_number(c: Column | str) -> Column:
    """Numeric part of a ``WL…`` id (case-insensitive prefix), null otherwise."""
    c = F.col(c) if isinstance(c, str) else c
    digits = F.substring(c, 3, 1 << 20)
    return F.when(F.upper(F.substring(c, 1, 2)) == F.lit("WL"),
                  F.when(digits.rlike(r"^[0-9]+$"), digits.cast("long")))


def watchlist_resume(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Source records not yet published: numeric id above the highest id
    already landed. With no valid landed id, everything is published again.

    The high-water mark is one global aggregate (one row), joined back as a
    scalar; no file is opened on the driver.
    """
    hwm = (landed.select(watchlist_id_number("watchlist_id").alias("n"))
           .filter(F.col("n") > 0)
           .agg(F.max("n").alias("hwm")))
    src = source.withColumn("_n", watchlist_id_number("watchlist_id"))
    return (src.join(F.broadcast(hwm), F.col("hwm").isNull() | (F.col("_n") > F.col("hwm")), "inner")
            .drop("_n", "hwm"))


def read_watchlist_csv(spark: SparkSession, path: str) -> DataFrame:
    """Watchlist CSV with every column as text (long card numbers stay exact)."""
    return spark.read.schema(WATCHLIST_FILE_SCHEMA).option("header", True).csv(path)


def read_merchants_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MERCHANT_SCHEMA).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def resume_from_landing(spark: SparkSession, source: DataFrame, landing_dir: str) -> DataFrame:
    """Records of ``source`` not yet published to ``landing_dir``: the
    high-water mark comes from the files already landed (lines that are not
    JSON or have no valid id are skipped); an empty or missing landing zone
    means everything is published."""
    try:
        landed = read_watchlist_files(spark, landing_dir)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        landed = source.limit(0)
    return watchlist_resume(source, landed)
