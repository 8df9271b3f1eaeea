"""Structured Streaming flows: bronze -> silver -> gold, notifications, scoring.

Every flow is one streaming query reading the upstream table folder (Parquet
with the streaming sink's commit log, so reads are exactly-once) and writing
its own folder with its own checkpoint. Flows run continuously
(``processingTime`` trigger) or drain what is available and stop
(``availableNow``), which is how scheduled runs and the tests use them.

Silver transactions and gold alerts are partitioned by ``event_date`` (the
UTC date of the event time), so time-bounded reports read only the days they
need (partition pruning) instead of the whole history.

Static lookups (customers, merchants) are read when a query starts; a file
listing is not refreshed inside a running query, so a new customer snapshot is
picked up by the next run (``availableNow``) or restart, or per micro-batch
with ``gold_high_value_fresh`` (enrichment inside ``foreachBatch``).
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vigil import constants as K
from vigil.operators import alerts as AL
from vigil.operators import quality as Q
from vigil.operators import silver as SV
from vigil.operators.skew import card_salts, card_sketches
from vigil.operators.windows import transaction_counts
from vigil.schemas import KAFKA_SCHEMA
from vigil.session import join_state, rocksdb_state
from vigil.sources.buckets import BucketedSnapshot
from vigil.sources.changes import read_changes
from vigil.sources.evolution import SchemaStore, evolving_writer, read_evolved
from vigil.sources.files import read_watchlist_stream
from vigil.sources.tables import (
    NAMESPACES,
    current_snapshot_path,
    is_missing_path,
    read_snapshot,
    setup_namespaces,
    write_snapshot,
)
from vigil.streaming.commits import read_committed, write_batch
from vigil.streaming.outbox import outbox_writer
from vigil.streaming.progress import late_rows_report, recorded, stream_expectation_report


EVENT_DATE = "event_date"


@dataclass(frozen=True)
class Layout:
    """Folder layout below one shared base folder."""
    base: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{name}"

    def checkpoint(self, flow: str) -> str:
        return f"{self.base.rstrip('/')}/_checkpoints/{flow}"

    def landing(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/source/{name}"


def customers_table(spark: SparkSession, layout: Layout) -> DataFrame:
    """The published silver customers, else the published bronze snapshot cleaned on
    read, else the plain ``silver/customers`` folder."""
    silver = layout.table("silver", "customers")
    current = current_snapshot_path(spark, silver)
    if current:
        return spark.read.parquet(current)
    current = current_snapshot_path(spark, layout.table("bronze", "customers"))
    if current:
        return SV.clean_customers(spark.read.parquet(current))
    return spark.read.parquet(silver)


TABLES = {
    "bronze": ("transactions", "fraud_watchlist"),
    "silver": ("transactions", "transactions_quarantine", "fraud_watchlist"),
    "gold": ("high_value_transactions_alert", "fraud_card_alert", "transaction_count_by_minute",
             "transaction_count_by_minute_sliding_window", "fraud_scores"),
}


def register_tables(spark: SparkSession, layout: Layout, prefix: str = "") -> list[str]:
    """Views by name, ``<prefix><layer>.<table>``, over the tables that exist, for SQL users.

    Each view reads its folder when queried, so it sees what the flows have
    committed by then; customers are the snapshot published now.
    """
    setup_namespaces(spark, layout.base, {f"{prefix}{k}": v for k, v in NAMESPACES.items()})
    paths = {(layer, name): layout.table(layer, name) for layer, names in TABLES.items() for name in names}
    for layer in ("bronze", "silver"):
        current = current_snapshot_path(spark, layout.table(layer, "customers"))
        if current:
            paths[layer, "customers"] = current
    made = []
    for (layer, name), path in paths.items():
        view = f"{prefix}{layer}.{name}"
        try:
            spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM parquet.`{path}`")
        except AnalysisException as e:
            if not is_missing_path(e):
                raise
        else:
            made.append(view)
    return made


class QueryId:
    """Id of a query for its own foreachBatch function, which may run before ``start()`` returns.

    It stays the same over restarts and is new once the checkpoint is: batch ids
    then begin again at 0, and what the query wrote before must stay.
    """

    def __init__(self) -> None:
        self._known, self._id = threading.Event(), ""

    def started(self, query: StreamingQuery) -> StreamingQuery:
        self._id = str(query.id)
        self._known.set()
        return query

    def __call__(self) -> str:
        self._known.wait()
        return self._id


def trigger_args(mode: str = "available_now", interval: str = "10 seconds") -> dict:
    if mode == "available_now":
        return {"availableNow": True}
    if mode == "continuous":
        return {"processingTime": interval}
    raise ValueError(mode)


def start_sink(df: DataFrame, path: str, checkpoint: str, trigger: dict, query_name: str,
               output_mode: str = "append", partition_by: list[str] | None = None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", checkpoint).option("path", path).queryName(query_name))
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.trigger(**trigger).start()


def schema_after(spark: SparkSession, source_schema: StructType, fn) -> StructType:
    """Output schema of ``fn`` applied to an empty frame of ``source_schema``."""
    return fn(spark.createDataFrame([], source_schema)).schema


@dataclass
class Pipeline:
    spark: SparkSession
    layout: Layout
    mode: str = "available_now"
    interval: str = "10 seconds"            # trigger interval in continuous mode
    alert_time: str | None = None          # None: processing time; or a transaction column
    max_files_per_trigger: int | None = None
    partition_by_date: bool = True          # silver/gold tables partitioned by event_date
    dedupe: bool = False                    # drop re-delivered transaction ids (within the watermark)
    queries: list[StreamingQuery] = field(default_factory=list)
    _pending: list[StreamingQuery] | None = None

    # -- helpers
    def _trigger(self) -> dict:
        return trigger_args(self.mode, self.interval)

    def _read(self, layer: str, name: str, schema: StructType) -> DataFrame:
        r = self.spark.readStream.schema(schema)
        if self.max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(self.max_files_per_trigger))
        return r.parquet(self.layout.table(layer, name))

    def _start(self, df: DataFrame, layer: str, name: str, date_from: str | None = None) -> StreamingQuery:
        partition_by = None
        if date_from and self.partition_by_date:
            df = df.withColumn(EVENT_DATE, F.to_date(date_from))
            partition_by = [EVENT_DATE]
        q = start_sink(df, self.layout.table(layer, name), self.layout.checkpoint(f"{layer}_{name}"),
                       self._trigger(), f"{layer}_{name}", partition_by=partition_by)
        self.queries.append(q)
        return q

    def _finish(self, q: StreamingQuery) -> StreamingQuery:
        if self.mode == "available_now":
            if self._pending is not None:
                self._pending.append(q)
            else:
                q.awaitTermination()
        return q

    @contextmanager
    def concurrently(self):
        """Start the flows of the block together and wait for all at the end
        (for flows that do not read each other's output)."""
        self._pending = []
        try:
            yield self
        finally:
            pending, self._pending = self._pending, None
            for q in pending:
                q.awaitTermination()

    # -- schemas of the layers
    def bronze_schema(self) -> StructType:
        return schema_after(self.spark, KAFKA_SCHEMA, SV.kafka_to_bronze)

    def silver_schema(self) -> StructType:
        schema = schema_after(self.spark, self.bronze_schema(), SV.parse_transactions)
        return schema.add(EVENT_DATE, "date") if self.partition_by_date else schema

    def bronze_watchlist_schema(self) -> StructType:
        from vigil.sources.files import parse_watchlist_json
        text = StructType.fromJson({"type": "struct", "fields": [
            {"name": "value", "type": "string", "nullable": True, "metadata": {}},
            {"name": "file_path", "type": "string", "nullable": True, "metadata": {}}]})
        return schema_after(self.spark, text, lambda d: SV.watchlist_to_bronze(parse_watchlist_json(d)))

    def silver_watchlist_schema(self) -> StructType:
        return schema_after(self.spark, self.bronze_watchlist_schema(), SV.clean_watchlist)

    def gold_schema(self, kind: str) -> StructType:
        """Schema of a gold alert table, derived from the alert function (so a
        reader can start before the first alert is written)."""
        empty_tx = self.spark.createDataFrame([], self.silver_schema())
        customers = self.customers()
        if kind == "high_value":
            out = AL.high_value_alerts(empty_tx, customers, alert_time=self.alert_time)
        else:
            empty_wl = self.spark.createDataFrame([], self.silver_watchlist_schema())
            out = AL.fraud_card_alerts(empty_tx, empty_wl, customers, alert_time=self.alert_time)
        schema = out.schema
        return schema.add(EVENT_DATE, "date") if self.partition_by_date else schema

    # -- flows
    def bronze_transactions(self, source: DataFrame) -> StreamingQuery:
        """Kafka-shaped stream -> bronze.transactions."""
        return self._finish(self._start(SV.kafka_to_bronze(source), "bronze", "transactions"))

    def silver_transactions(self) -> StreamingQuery:
        """bronze -> parsed, drop expectations applied (counts in the progress
        under observedMetrics['silver_transactions']); failing messages go to
        silver.transactions_quarantine as received (raw text, offsets, failed
        rule names) so they can be replayed."""
        bronze = self._read("bronze", "transactions", self.bronze_schema())
        kept, _ = Q.expect(SV.parse_transactions(bronze), "silver_transactions")
        if self.dedupe:
            kept = SV.drop_duplicate_transactions(kept)
        q = self._start(kept, "silver", "transactions", date_from="transaction_timestamp")
        quarantine = self._start(Q.quarantine_messages(bronze), "silver", "transactions_quarantine")
        self._finish(q)
        self._finish(quarantine)
        return q

    def silver_transactions_once(self) -> StreamingQuery:
        """bronze -> silver and quarantine with one scan and one parse: each micro-batch is parsed once, kept and
        failing messages are written and committed together (``streaming.commits``); read them with ``committed``."""
        bronze = self._read("bronze", "transactions", self.bronze_schema())
        path, query_id = self.layout.table("silver", "committed"), QueryId()
        rules = Q._drop_rules(Q.TRANSACTION_EXPECTATIONS)

        def split(batch_df: DataFrame, batch_id: int) -> None:
            raw = ["key", "value", "topic", "partition", "offset", "timestamp"]
            message = batch_df.withColumn("_raw", F.struct(*raw))
            # parse_transactions names what it returns; the raw message goes along for the quarantine
            parsed = SV.parse_transactions(message, carry=("_raw",))
            both = Q.failed_rules(parsed, rules).persist()
            try:
                kept = both.filter("size(failed_expectations) = 0").drop("_raw", "failed_expectations")
                failed = both.filter("size(failed_expectations) > 0").select("_raw.*", "failed_expectations")
                write_batch(path, query_id(), batch_id, {"transactions": kept, "transactions_quarantine": failed})
            finally:
                both.unpersist()

        q = query_id.started(bronze.writeStream.foreachBatch(split)
             .option("checkpointLocation", self.layout.checkpoint("silver_transactions_once"))
             .queryName("silver_transactions_once").trigger(**self._trigger()).start())
        self.queries.append(q)
        return self._finish(q)

    def committed(self, name: str) -> DataFrame:
        return read_committed(self.spark, self.layout.table("silver", "committed"), name)

    def bronze_watchlist(self, landing_dir: str) -> StreamingQuery:
        files = read_watchlist_stream(self.spark, landing_dir, self.max_files_per_trigger)
        return self._finish(self._start(SV.watchlist_to_bronze(files), "bronze", "fraud_watchlist"))

    def bronze_watchlist_evolving(self, landing_dir: str) -> StreamingQuery:
        """Watchlist records with inferred types into ``bronze/fraud_watchlist_typed``: new and wider
        columns are taken up while the flow runs (``sources.evolution``)."""
        lines = self.spark.readStream.format("text")
        if self.max_files_per_trigger:
            lines = lines.option("maxFilesPerTrigger", str(self.max_files_per_trigger))
        lines = lines.load(landing_dir).select("value", F.col("_metadata.file_path").alias("_source_file"))
        query_id = QueryId()
        writer = evolving_writer(self.layout.table("bronze", "fraud_watchlist_typed"), self.schema_store(), query_id)
        q = query_id.started(lines.writeStream.foreachBatch(writer)
             .option("checkpointLocation", self.layout.checkpoint("bronze_fraud_watchlist_typed"))
             .queryName("bronze_fraud_watchlist_typed").trigger(**self._trigger()).start())
        self.queries.append(q)
        return self._finish(q)

    def schema_store(self) -> SchemaStore:
        return SchemaStore(self.spark, self.layout.table("_schemas", "fraud_watchlist"))

    def watchlist_typed(self) -> DataFrame:
        return read_evolved(self.spark, self.layout.table("bronze", "fraud_watchlist_typed"), self.schema_store())

    def silver_watchlist(self) -> StreamingQuery:
        """bronze -> cleaned; its rules only warn (counts under observedMetrics['silver_fraud_watchlist'])."""
        bronze = self._read("bronze", "fraud_watchlist", self.bronze_watchlist_schema())
        cleaned, _ = Q.expect(SV.clean_watchlist(bronze), "silver_fraud_watchlist", Q.WATCHLIST_EXPECTATIONS)
        return self._finish(self._start(cleaned, "silver", "fraud_watchlist"))

    def recorded(self):
        """Within the block, the progress of all queries is appended to the table ``_progress`` (``streaming.progress``)."""
        return recorded(self.spark, self.layout.table("_progress", "batches"), self.queries)

    def late_rows(self) -> DataFrame:
        return late_rows_report(self.spark, self.layout.table("_progress", "batches"))

    def expectation_counts(self, name: str = "silver_transactions", expectations=Q.TRANSACTION_EXPECTATIONS) -> DataFrame:
        return stream_expectation_report(self.spark, self.layout.table("_progress", "batches"), name, expectations)

    def customers(self) -> DataFrame:
        """Customer lookup for the gold flows: the published silver snapshot,
        else the published bronze snapshot (as kept by ``customers_upsert``)
        cleaned on read, else the plain ``silver/customers`` folder."""
        return customers_table(self.spark, self.layout)

    def silver_customers(self) -> str:
        """The newest bronze customer snapshot, with the drop expectations applied and
        cleaned, published as the silver snapshot; returns its folder."""
        rows = read_snapshot(self.spark, self.layout.table("bronze", "customers"))
        clean = SV.clean_customers(Q.keep_valid(rows, Q.CUSTOMER_EXPECTATIONS))
        return write_snapshot(clean, self.layout.table("silver", "customers"))

    def gold_high_value(self) -> StreamingQuery:
        tx = self._read("silver", "transactions", self.silver_schema())
        out = AL.high_value_alerts(tx, self.customers(), alert_time=self.alert_time)
        return self._finish(self._start(out, "gold", "high_value_transactions_alert", "transaction_timestamp"))

    def _per_batch(self, name: str, alerts_of) -> StreamingQuery:
        """``alerts_of`` each micro-batch of silver transactions into ``gold/<name>/query=id/batch_id=n``
        (overwrite: a retried batch replaces its own output). What it looks up is read anew for each batch."""
        out_path, query_id = self.layout.table("gold", name), QueryId()

        def write(batch_df: DataFrame, batch_id: int) -> None:
            alerts_of(batch_df).write.mode("overwrite").parquet(f"{out_path}/query={query_id()}/batch_id={batch_id}")

        tx = self._read("silver", "transactions", self.silver_schema())
        q = query_id.started(tx.writeStream.foreachBatch(write)
             .option("checkpointLocation", self.layout.checkpoint(f"gold_{name}"))
             .queryName(f"gold_{name}").trigger(**self._trigger()).start())
        self.queries.append(q)
        return self._finish(q)

    def gold_high_value_fresh(self, customers_snapshot: str | None = None) -> StreamingQuery:
        """High-value alerts enriched per micro-batch with the newest published
        customer snapshot (``sources.tables``; by default the lookup of
        ``customers()``): changes to limits or new customers apply from the
        next batch on, without restarting the query."""
        def alerts_of(batch: DataFrame) -> DataFrame:
            customers = read_snapshot(self.spark, customers_snapshot) if customers_snapshot else self.customers()
            return AL.high_value_alerts(batch, customers, alert_time=self.alert_time)

        return self._per_batch("high_value_transactions_alert_fresh", alerts_of)

    def publish_watchlist(self) -> str:
        """The latest record of each watchlist entry, published as a snapshot for ``gold_fraud_card_fresh``."""
        listing = AL.watchlist_snapshot(self.read_table("silver", "fraud_watchlist"))
        return write_snapshot(listing, self.layout.table("silver", "fraud_watchlist_current"))

    def gold_fraud_card_fresh(self) -> StreamingQuery:
        """Watchlist alerts of each micro-batch against the newest published listing and customers:
        no join state, nothing aggregated per batch, and a new listing applies from the next batch on."""
        def alerts_of(batch: DataFrame) -> DataFrame:
            listing = read_snapshot(self.spark, self.layout.table("silver", "fraud_watchlist_current"))
            return AL.fraud_card_alerts_snapshot(batch, listing, self.customers(), alert_time=self.alert_time, listed_once=True)

        return self._per_batch("fraud_card_alert_fresh", alerts_of)

    def card_salts(self, spread: int = 1000) -> DataFrame:
        """Salts of heavy cards for the watchlist stream join, from sketches of the transactions there are when the
        flow first starts. They are kept beside its checkpoint, as join state is laid out by them: other salts need a
        new checkpoint."""
        path = self.layout.table("_salts", "gold_fraud_card")
        if current_snapshot_path(self.spark, path) is None:
            sketches = card_sketches(self.spark.read.schema(self.silver_schema()).parquet(self.layout.table("silver", "transactions"))
                                     .withColumn("_day", F.to_date("transaction_timestamp")), "_day")
            write_snapshot(card_salts(sketches, spread), path)
        return read_snapshot(self.spark, path)

    def gold_fraud_card(self, lookback: str | None = None, snapshot: bool = False, salt: int | DataFrame = 1) -> StreamingQuery:
        """Watchlist alerts. Without ``lookback`` the join has no time condition
        (state is kept for ever); with it, transactions match entries from
        ``effective_from`` to ``effective_from + lookback``, the join state
        older than the watermarks is evicted, and what is held lies on disk
        (``session.join_state``). ``snapshot=True`` joins the
        transaction stream with the latest active watchlist entries read when
        the run starts (stateless). ``salt`` > 1 spreads each card over that
        many join (state) partitions; ``salt=self.card_salts()`` only the cards with
        very many transactions."""
        tx = self._read("silver", "transactions", self.silver_schema())
        if snapshot:
            wl_static = self.spark.read.parquet(self.layout.table("silver", "fraud_watchlist"))
            out = AL.fraud_card_alerts_snapshot(tx, wl_static, self.customers(), alert_time=self.alert_time)
            return self._finish(self._start(out, "gold", "fraud_card_alert_snapshot", "transaction_timestamp"))
        wl = self._read("silver", "fraud_watchlist", self.silver_watchlist_schema())
        if lookback:
            out = AL.fraud_card_alerts_bounded(tx, wl, self.customers(), lookback=lookback,
                                               alert_time=self.alert_time, salt=salt)
            with join_state(self.spark):
                q = self._start(out, "gold", "fraud_card_alert", "transaction_timestamp")
            return self._finish(q)
        out = AL.fraud_card_alerts(tx, wl, self.customers(), alert_time=self.alert_time, salt=salt)
        return self._finish(self._start(out, "gold", "fraud_card_alert", "transaction_timestamp"))

    def gold_counts(self, window: str = K.TUMBLING_WINDOW, slide: str | None = None,
                    name: str = "transaction_count_by_minute") -> StreamingQuery:
        tx = self._read("silver", "transactions", self.silver_schema())
        return self._finish(self._start(transaction_counts(tx, window, slide), "gold", name))

    def notify(self, kind: str) -> StreamingQuery:
        """gold alerts -> outbox/<kind> through foreachBatch."""
        source = {"high_value": "high_value_transactions_alert", "fraud_card": "fraud_card_alert"}[kind]
        alerts = self._read("gold", source, self.gold_schema(kind))
        query_id = QueryId()
        q = query_id.started(alerts.writeStream.foreachBatch(outbox_writer(self.layout.table("outbox", kind), kind, query_id=query_id))
             .option("checkpointLocation", self.layout.checkpoint(f"outbox_{kind}"))
             .queryName(f"outbox_{kind}").trigger(**self._trigger()).start())
        self.queries.append(q)
        return self._finish(q)

    def fraud_scores(self, merchants: DataFrame, cfg=None, method: str = "state", watermark: str = K.WATERMARK_DELAY,
                     state_partitions: int | None = None) -> StreamingQuery:
        """Fraud scores of the silver stream into gold.fraud_scores.

        ``method="state"``: history by shard of customers (``applyInPandasWithState``),
        rows evaluated in arrival order. ``method="tail"``: each micro-batch
        scored with the batch plan against the tail of earlier events
        (``foreachBatch``, JVM only, hot customers split over tasks); output
        folders per batch id. ``method="corrected"``: state per shard of customers and time
        bucket; rows whose history changes by a late one are emitted again into
        gold.fraud_scores_corrected (``corrected.latest_scores`` reads the last ones);
        ``state_partitions`` is the number of its state's partitions, fixed for the life of its checkpoint."""
        from vigil.operators.rules import DEFAULT_RULES
        from vigil.streaming.stateful import stream_scores, tail_scoring_writer
        cfg = cfg or DEFAULT_RULES
        tx = self._read("silver", "transactions", self.silver_schema())
        if method == "corrected":
            from vigil.streaming.corrected import corrected_scores
            out = corrected_scores(tx, self.customers(), merchants, cfg, watermark)
            with rocksdb_state(self.spark, state_partitions):      # the only store that holds list state and timers
                q = self._start(out, "gold", "fraud_scores_corrected")
            return self._finish(q)
        if method == "state":
            out = stream_scores(tx, self.customers(), merchants, cfg)
            return self._finish(self._start(out, "gold", "fraud_scores"))
        query_id = QueryId()
        writer = tail_scoring_writer(self.layout.table("gold", "fraud_scores"),
                                     self.layout.table("_state", "fraud_scores_tail"),
                                     self.customers, merchants, cfg, query_id=query_id)     # customers as of each batch
        q = query_id.started(tx.writeStream.foreachBatch(writer)
             .option("checkpointLocation", self.layout.checkpoint("gold_fraud_scores_tail"))
             .queryName("gold_fraud_scores_tail").trigger(**self._trigger()).start())
        self.queries.append(q)
        return self._finish(q)

    def customers_upsert(self, changes: DataFrame, snapshot_path: str | None = None) -> StreamingQuery:
        """Customer change rows (a stream) merged into the customer snapshot:
        per micro-batch the latest row per customer wins (``apply_changes``),
        the result is written as a new snapshot version named after the batch
        and published with a new marker. A retried batch rewrites its
        own, not yet published version; a published one is left as it is."""
        path = snapshot_path or self.layout.table("bronze", "customers")
        spark, query_id = self.spark, QueryId()

        def merge(batch_df: DataFrame, batch_id: int) -> None:
            version = f"query_{query_id()}_batch_{batch_id:012d}"
            batch_df = Q.keep_valid(batch_df, Q.CUSTOMER_EXPECTATIONS)
            current = current_snapshot_path(spark, path)
            if current is None:
                merged = SV.latest_per_key(batch_df, "customer_id", "update_timestamp")
            elif current.endswith("/" + version):
                return                       # this batch was published before a restart
            else:
                merged = SV.apply_changes(spark.read.parquet(current), batch_df).drop("change_type")
            write_snapshot(merged, path, version, replace_version=True)

        q = query_id.started(changes.writeStream.foreachBatch(merge)
             .option("checkpointLocation", self.layout.checkpoint("customers_upsert"))
             .queryName("customers_upsert").trigger(**self._trigger()).start())
        self.queries.append(q)
        return self._finish(q)

    def customers_upsert_buckets(self, changes: DataFrame, snapshot: BucketedSnapshot) -> StreamingQuery:
        """Customer change rows (a stream) merged into a bucketed snapshot: each micro-batch
        rewrites only the buckets that it touches. A retried batch is told by its label."""
        query_id = QueryId()

        def merge(batch_df: DataFrame, batch_id: int) -> None:
            snapshot.merge(Q.keep_valid(batch_df, Q.CUSTOMER_EXPECTATIONS), label=f"{query_id()}/{batch_id}")

        q = query_id.started(changes.writeStream.foreachBatch(merge)
             .option("checkpointLocation", self.layout.checkpoint("customers_upsert_buckets"))
             .queryName("customers_upsert_buckets").trigger(**self._trigger()).start())
        self.queries.append(q)
        return self._finish(q)

    def customers_incremental(self, table_path: str, schema: StructType, overlap_seconds: int = 3600) -> StreamingQuery:
        """Changed rows of the customer table (``sources.changes``) -> bronze.customer_changes,
        each (customer, update time) once; ``customers_upsert`` reads on from there."""
        changes = read_changes(self.spark, table_path, schema, overlap_seconds=overlap_seconds)
        return self._finish(self._start(changes, "bronze", "customer_changes"))

    def read_table(self, layer: str, name: str) -> DataFrame:
        """A flow's output as a batch frame (through the sink's commit log, so
        only committed files); empty with no columns if nothing was written yet."""
        try:
            return self.spark.read.parquet(self.layout.table(layer, name))
        except Exception as e:  # noqa: BLE001 - an empty sink has no file to infer from
            if any(m in str(e) for m in ("UNABLE_TO_INFER_SCHEMA", "Unable to infer schema", "PATH_NOT_FOUND")):
                return self.spark.createDataFrame([], "value string").limit(0).drop("value")
            raise

    def stop(self) -> None:
        for q in self.queries:
            if q.isActive:
                q.stop()


def state_rows(query: StreamingQuery) -> int:
    """Rows held in the query's state stores after its last micro-batch."""
    p = query.lastProgress or {}
    return sum(int(op.get("numRowsTotal", 0) or 0) for op in p.get("stateOperators", []))


def late_rows_dropped(query: StreamingQuery) -> int:
    """Input rows dropped by the watermark over the query's recent progress: as many batches
    as ``spark.sql.streaming.numRecentProgressUpdates`` keeps; ``Pipeline.recorded`` keeps all."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            d = op if isinstance(op, dict) else op.__dict__
            total += int(d.get("numRowsDroppedByWatermark", 0) or 0)
    return total


def progress_report(spark: SparkSession, queries: list[StreamingQuery]) -> DataFrame:
    """One row per streaming query from its recent progress (as many batches as
    ``spark.sql.streaming.numRecentProgressUpdates`` keeps, 100 by default): micro-batches,
    input rows, rows dropped as late by the watermark, rows held in state
    after the last batch. (Progress is query metadata kept by the driver,
    a few rows; no data passes through it.)"""
    rows = []
    for q in queries:
        progress = [p for p in q.recentProgress]
        dropped = sum(int(op.get("numRowsDroppedByWatermark", 0) or 0)
                      for p in progress for op in p.get("stateOperators", []))
        rows.append((q.name, len(progress), sum(int(p.get("numInputRows", 0)) for p in progress), dropped,
                     state_rows(q)))
    return spark.createDataFrame(rows, "query_name string, batches long, input_rows long, "
                                       "rows_dropped_by_watermark long, state_rows long")
