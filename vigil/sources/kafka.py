"""Kafka source: options, streaming and batch reads, topic profile.

The Kafka connector jar is supplied by the cluster; this module only builds
options and plans. ``kafka_to_bronze`` (in ``vigil.operators.silver``) turns
the source frame into the bronze table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Login module of the open-source Kafka client (not a vendor-shaded name).
PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def kafka_read_options(config: dict, starting_offsets: str = "earliest",
                       max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> dict:
    """Source options for a SASL_SSL / PLAIN cluster from a connection config
    with ``bootstrap_servers``, ``topic``, ``api_key`` and ``api_secret``."""
    jaas = (f'{PLAIN_LOGIN_MODULE} required '
            f'username="{config["api_key"]}" password="{config["api_secret"]}";')
    options = {
        "kafka.bootstrap.servers": config["bootstrap_servers"],
        "subscribe": config["topic"],
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": jaas,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        # bounds the size of each micro-batch
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        # split large topic partitions over more tasks than the topic has partitions
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka_stream(spark: SparkSession, options: dict) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_kafka_batch(spark: SparkSession, options: dict, ending_offsets: str = "latest") -> DataFrame:
    """Everything currently in the topic, as a batch frame."""
    return spark.read.format("kafka").options(**options).option("endingOffsets", ending_offsets).load()


def topic_profile(messages: DataFrame) -> DataFrame:
    """Messages per topic partition with the offset and time range
    (a partial aggregate: one small row per task before the shuffle)."""
    return (messages.groupBy("topic", "partition")
            .agg(F.count(F.lit(1)).alias("message_count"),
                 F.min("offset").alias("first_offset"),
                 F.max("offset").alias("last_offset"),
                 F.min("timestamp").alias("first_timestamp"),
                 F.max("timestamp").alias("last_timestamp")))
