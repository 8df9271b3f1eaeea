"""Outbox sink: notification rows written per micro-batch (foreachBatch).

Each micro-batch's rows go to ``<outbox>/batch_id=<n>`` with overwrite, so a
retried batch replaces its own output (idempotent) and no batch is sent
twice by a restart. Rows are built and written on the executors; nothing is
collected to the driver. Delivery (SMTP or any other channel) is a separate
consumer of the ``PENDING`` rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.notify import fraud_card_notifications, high_value_notifications

BUILDERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "high_value": high_value_notifications,
    "fraud_card": fraud_card_notifications,
}


def outbox_writer(outbox_path: str, kind: str, query_name: str | None = None, query_id: Callable[[], str] | None = None):
    """A ``foreachBatch`` function writing the batch's notifications, below
    ``query=<id>`` where the query's id is given."""
    build = BUILDERS[kind]

    def write(batch_df: DataFrame, batch_id: int) -> None:
        rows = build(batch_df).withColumn("query_name", F.lit(query_name or kind))
        rows.write.mode("overwrite").parquet(f"{outbox_path.rstrip('/')}/{f'query={query_id()}/' if query_id else ''}batch_id={batch_id}")

    return write


def outbox_counts(outbox: DataFrame) -> DataFrame:
    """Rows per batch and delivery status (what the reference printed as
    'sent / failed' per batch)."""
    return (outbox.groupBy("batch_id", "delivery_status")
            .agg(F.count(F.lit(1)).alias("notifications")))
