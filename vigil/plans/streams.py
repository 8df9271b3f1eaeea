"""Registered streaming and I/O queries.

Each query writes its inputs (derived from the supplied tables) to a fresh
folder below the shared folder (``spark.checkpoint.dir``), runs the streaming
flows with ``availableNow`` until the input is drained, and returns the sink
read back as a batch frame. Inputs are written as one micro-batch, so every
row is processed and windowed results are those closed by the final
watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigil.plans.catalog import Domain, _test_rules, register
from vigil.schemas import KAFKA_SCHEMA
from vigil.session import fresh_dir
from vigil.sources import adapter as A
from vigil.streaming.flows import Layout, Pipeline



def _env(spark: SparkSession, sf_dir: str, name: str, dirty: bool = False, watchlist: bool = False):
    layout = Layout(fresh_dir(spark, name))
    # messages landed as Parquet files with the Kafka source schema (the JSON
    # file form of the same frames is exercised by tests/test_streaming.py)
    A.kafka_messages(spark, sf_dir, dirty=dirty).write.parquet(layout.landing("transactions"))
    Domain(spark, sf_dir).customers().write.parquet(layout.table("silver", "customers"))
    if watchlist:
        # JSON lines, as many files as the frame has partitions (one record per
        # file, the feed's own format, is covered by bronze_watchlist)
        A.watchlist_messages(spark, sf_dir).select("value").write.text(layout.landing("fraud_watchlist"))
    # one backfill micro-batch spanning 30 days: unpartitioned sinks (partitioned
    # by date, each task would write a file into every day)
    p = Pipeline(spark, layout, alert_time="transaction_timestamp", partition_by_date=False)
    source = spark.readStream.schema(KAFKA_SCHEMA).parquet(layout.landing("transactions"))
    with p.concurrently():                      # the two chains do not read each other
        p.bronze_transactions(source)
        if watchlist:
            p.bronze_watchlist(layout.landing("fraud_watchlist"))
    with p.concurrently():
        p.silver_transactions()
        if watchlist:
            p.silver_watchlist()
    return layout, p


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A sink read back as a batch frame, without the event_date partition column."""
    return spark.read.parquet(path).drop("event_date")


@register("stream_high_value_alerts")
def q_stream_high_value_alerts(spark, sf_dir):
    """J1 as a stream-static join: Kafka-shaped files -> bronze -> silver -> gold."""
    layout, p = _env(spark, sf_dir, "stream_high_value")
    p.gold_high_value()
    return _read(spark, layout.table("gold", "high_value_transactions_alert"))


@register("stream_fraud_card_alerts")
def q_stream_fraud_card_alerts(spark, sf_dir):
    """J2 as a stream-stream join (transactions x watchlist files), then customers."""
    layout, p = _env(spark, sf_dir, "stream_fraud_card", watchlist=True)
    p.gold_fraud_card()
    return _read(spark, layout.table("gold", "fraud_card_alert"))


@register("stream_tx_count_tumbling")
def q_stream_tx_count_tumbling(spark, sf_dir):
    """A1 on a stream (append mode): windows closed by the final watermark."""
    layout, p = _env(spark, sf_dir, "stream_tumbling")
    p.gold_counts()
    return _read(spark, layout.table("gold", "transaction_count_by_minute"))


@register("stream_tx_count_sliding")
def q_stream_tx_count_sliding(spark, sf_dir):
    """A2 on a stream (append mode): windows closed by the final watermark."""
    layout, p = _env(spark, sf_dir, "stream_sliding")
    p.gold_counts("5 minutes", "1 minute", "transaction_count_by_minute_sliding_window")
    return _read(spark, layout.table("gold", "transaction_count_by_minute_sliding_window"))


@register("stream_fraud_scores")
def q_stream_fraud_scores(spark, sf_dir):
    """Stateful per-customer scoring on the silver stream."""
    layout, p = _env(spark, sf_dir, "stream_scores")
    p.fraud_scores(A.merchants(spark, sf_dir), _test_rules())
    return _read(spark, layout.table("gold", "fraud_scores")).select(
        "transaction_id", "customer_id", "fraud_score", "fraud_reason")


@register("stream_outbox")
def q_stream_outbox(spark, sf_dir):
    """Gold high-value alerts -> foreachBatch outbox (idempotent per batch)."""
    layout, p = _env(spark, sf_dir, "stream_outbox")
    p.gold_high_value()
    p.notify("high_value")
    return _read(spark, layout.table("outbox", "high_value")).select(
        "alert_id", "alert_type", "recipient", "subject", "body", "delivery_status")


@register("bronze_watchlist")
def q_bronze_watchlist(spark, sf_dir):
    """Incremental ingestion of one-record JSON files with rescued data and source file."""
    from vigil.sources.files import spread
    layout = Layout(fresh_dir(spark, "bronze_watchlist"))
    spread(A.watchlist_messages(spark, sf_dir).select("value")).write.option("maxRecordsPerFile", 1) \
        .text(layout.landing("fraud_watchlist"))
    p = Pipeline(spark, layout)
    p.bronze_watchlist(layout.landing("fraud_watchlist"))
    b = _read(spark, layout.table("bronze", "fraud_watchlist"))
    return b.drop("ingestion_timestamp").withColumn("source_file", F.col("source_file").isNotNull()) \
        .withColumnRenamed("source_file", "has_source_file")


@register("publish_watchlist_files")
def q_publish_watchlist_files(spark, sf_dir):
    """One JSON document per file; read back with the record count per file."""
    from vigil.sources.files import publish_watchlist_files, read_watchlist_files
    landing = fresh_dir(spark, "publish_watchlist") + "/landing"
    publish_watchlist_files(A.watchlist_records(spark, sf_dir), landing)
    back = read_watchlist_files(spark, landing)
    per_file = Window.partitionBy("file_path")
    return back.withColumn("file_records", F.count(F.lit(1)).over(per_file)).drop("file_path", "_rescued_data")


@register("load_customers_initial")
def q_load_customers_initial(spark, sf_dir):
    """Initial customer load as a versioned bronze snapshot."""
    from vigil.sources.tables import read_snapshot, write_snapshot
    path = fresh_dir(spark, "customers_initial") + "/bronze/customers"
    write_snapshot(A.customers_source(spark, sf_dir), path)
    return read_snapshot(spark, path)


@register("write_snapshot")
def q_write_snapshot(spark, sf_dir):
    """A second full snapshot (latest row per customer) replaces the first for readers."""
    from vigil.operators.silver import latest_per_key
    from vigil.sources.tables import read_snapshot, write_snapshot
    path = fresh_dir(spark, "customers_snapshot") + "/bronze/customers"
    first = A.customers_source(spark, sf_dir)
    write_snapshot(first, path, "v1")
    log = first.unionByName(A.customer_changes(spark, sf_dir))
    write_snapshot(latest_per_key(log, "customer_id", "update_timestamp"), path, "v2")
    return read_snapshot(spark, path)


@register("run_available_now")
def q_run_available_now(spark, sf_dir):
    """Drain-and-stop run of the chain on dirty input; rows per table."""
    layout, p = _env(spark, sf_dir, "available_now", dirty=True, watchlist=True)
    p.gold_high_value()
    p.gold_fraud_card()
    tables = [("bronze", "transactions"), ("silver", "transactions"), ("silver", "transactions_quarantine"),
              ("gold", "high_value_transactions_alert"), ("gold", "fraud_card_alert")]
    frames = [_read(spark, layout.table(layer, name)).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(f"{layer}.{name}").alias("table_name"), "row_count") for layer, name in tables]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("stream_customers_upsert")
def q_stream_customers_upsert(spark, sf_dir):
    """A8/S24 on a stream: change rows merged per micro-batch into versioned snapshots."""
    from vigil.sources.tables import read_snapshot, write_snapshot
    layout = Layout(fresh_dir(spark, "customers_upsert"))
    snapshot = layout.table("bronze", "customers")
    write_snapshot(A.customers_source(spark, sf_dir), snapshot, "initial")
    A.customer_changes(spark, sf_dir).write.parquet(layout.landing("customer_changes"))
    schema = A.customer_changes(spark, sf_dir).schema
    changes = spark.readStream.schema(schema).parquet(layout.landing("customer_changes"))
    Pipeline(spark, layout).customers_upsert(changes, snapshot)
    return read_snapshot(spark, snapshot)


@register("stream_customers_incremental")
def q_stream_customers_incremental(spark, sf_dir):
    """The customer table read incrementally by (update time, id) in three runs: the first
    load, changed customers, and new customers committed late, half an hour below the mark."""
    layout = Layout(fresh_dir(spark, "customers_incremental"))
    table = layout.table("source", "customers")
    changes = A.customer_changes(spark, sf_dir)
    late = changes.filter("customer_segment = 'MACHINERY'").withColumn("update_timestamp", F.expr("update_timestamp - INTERVAL 30 MINUTES"))
    p = Pipeline(spark, layout)
    for committed in (A.customers_source(spark, sf_dir), changes.filter("customer_segment != 'MACHINERY'"), late):
        committed.write.mode("append").parquet(table)
        p.customers_incremental(table, changes.schema)
    return _read(spark, layout.table("bronze", "customer_changes"))


@register("watchlist_csv")
def q_watchlist_csv(spark, sf_dir):
    """Watchlist as CSV, read back with every column as text (card numbers exact)."""
    from vigil.sources.files import read_watchlist_csv, write_csv
    path = fresh_dir(spark, "watchlist_csv") + "/watchlist"
    write_csv(A.watchlist_records(spark, sf_dir), path)
    return read_watchlist_csv(spark, path)


@register("merchants_csv")
def q_merchants_csv(spark, sf_dir):
    """Merchant dimension written as CSV and read back with its schema."""
    from vigil.sources.files import read_merchants_csv, write_csv
    path = fresh_dir(spark, "merchants_csv") + "/merchants"
    write_csv(A.merchants(spark, sf_dir), path)
    return read_merchants_csv(spark, path)


@register("watchlist_inferred_schema")
def q_watchlist_inferred_schema(spark, sf_dir):
    """Schema inferred once from the landing zone, stored, then used to read it."""
    from vigil.sources.files import infer_and_store_schema
    base = fresh_dir(spark, "inferred_schema")
    landing = base + "/landing"
    A.watchlist_messages(spark, sf_dir).select("value").write.text(landing)
    schema = infer_and_store_schema(spark, landing, base + "/_schema")
    return spark.read.schema(schema).json(landing)


@register("stream_fraud_scores_tail")
def q_stream_fraud_scores_tail(spark, sf_dir):
    """R12 without Python: each micro-batch scored with the batch plan against the tail of earlier events."""
    layout, p = _env(spark, sf_dir, "stream_scores_tail")
    p.fraud_scores(A.merchants(spark, sf_dir), _test_rules(), method="tail")
    return _read(spark, layout.table("gold", "fraud_scores")).select(
        "transaction_id", "customer_id", "fraud_score", "fraud_reason")


@register("stream_fraud_scores_corrected")
def q_stream_fraud_scores_corrected(spark, sf_dir):
    """R12 with corrections, over five micro-batches: every eleventh message is delivered one batch
    late, after later ones of its customer; the last revision of each row equals batch scoring."""
    from vigil.streaming.corrected import latest_scores
    layout = Layout(fresh_dir(spark, "stream_scores_corrected"))
    Domain(spark, sf_dir).customers().write.parquet(layout.table("silver", "customers"))
    p = Pipeline(spark, layout, partition_by_date=False)
    tx = A.transactions(spark, sf_dir, ltz=True, with_event_id=True)
    first, last = tx.agg(F.unix_micros(F.min("transaction_timestamp")), F.unix_micros(F.max("transaction_timestamp"))).first()
    fifth = ((last or 0) - (first or 0)) // 5 + 1
    turn = F.least(F.lit(4), F.floor((F.unix_micros("transaction_timestamp") - F.lit(first or 0)) / fifth) + F.when(F.col("_eid") % 11 == 0, 1).otherwise(0))
    tx = tx.withColumn("_turn", F.coalesce(turn, F.lit(0)))
    for i in range(5):
        tx.filter(F.col("_turn") == i).drop("_eid", "_turn").write.mode("append").parquet(layout.table("silver", "transactions"))
        p.fraud_scores(A.merchants(spark, sf_dir), _test_rules(), method="corrected", watermark=f"{2 * fifth // 1_000_000 + 1} seconds", state_partitions=8)
    return latest_scores(_read(spark, layout.table("gold", "fraud_scores_corrected"))).select(
        "transaction_id", "customer_id", "fraud_score", "fraud_reason")


def _land_in_turns(spark, sf_dir, name: str, turn, dirty: bool = False, **kw):
    """Messages landed by ``turn`` (0, 1, ..), each turn run through bronze and silver with its progress recorded."""
    layout = Layout(fresh_dir(spark, name))
    p = Pipeline(spark, layout, partition_by_date=False, **kw)
    messages = A.kafka_messages(spark, sf_dir, dirty=dirty).withColumn("_turn", turn)
    with p.recorded():
        for i in range(2):
            messages.filter(F.col("_turn") == i).drop("_turn").write.mode("append").parquet(layout.landing("transactions"))
            p.bronze_transactions(spark.readStream.schema(KAFKA_SCHEMA).parquet(layout.landing("transactions")))
            p.silver_transactions()
    return p


@register("late_rows_report")
def q_late_rows_report(spark, sf_dir):
    """T-late: input rows, and rows that came behind the watermark, of every query of a run in two
    turns, from the stored progress: every eleventh message of the first half comes in the second."""
    late = (F.col("offset") % 11 == 0) | (F.col("timestamp") >= F.lit(A.HALF_TIME).cast("timestamp"))
    p = _land_in_turns(spark, sf_dir, "late_rows", F.when(late, 1).otherwise(0), dedupe=True)
    return p.late_rows().select("query_name", "input_rows", "rows_dropped_by_watermark")


@register("stream_expectation_report")
def q_stream_expectation_report(spark, sf_dir):
    """P5 on a stream: rule counts over all batches of a run on dirty input, from the stored progress."""
    p = _land_in_turns(spark, sf_dir, "stream_expectations", (F.col("offset") % 2).cast("int"), dirty=True)
    return p.expectation_counts()


@register("stream_customers_upsert_buckets")
def q_stream_customers_upsert_buckets(spark, sf_dir):
    """Change rows merged into a snapshot of 16 buckets, of which only touched ones are rewritten."""
    from vigil.sources.buckets import BucketedSnapshot
    layout = Layout(fresh_dir(spark, "customers_buckets"))
    snapshot = BucketedSnapshot(spark, layout.table("bronze", "customers"), "customer_id", "update_timestamp")
    snapshot.create(A.customers_source(spark, sf_dir), buckets=16)
    changes = A.customer_changes(spark, sf_dir)
    p = Pipeline(spark, layout)
    for segment in ("BUILDING", "MACHINERY"):
        changes.filter(F.col("customer_segment") == segment).write.mode("append").parquet(layout.landing("customer_changes"))
        p.customers_upsert_buckets(spark.readStream.schema(changes.schema).parquet(layout.landing("customer_changes")), snapshot)
    return snapshot.read()


@register("watchlist_schema_evolution")
def q_watchlist_schema_evolution(spark, sf_dir):
    """Watchlist records in two batches under an inferred, growing schema: in the second one ``note`` appears,
    ``exposure`` changes from whole numbers to decimals and ``ticket`` from numbers to text."""
    layout = Layout(fresh_dir(spark, "watchlist_evolution"))
    w = A.watchlist_records(spark, sf_dir)
    k = F.regexp_extract("watchlist_id", r"(\d+)$", 1).cast("long")
    first = w.filter("status = 'active'").withColumns({"exposure": k, "ticket": k})
    second = w.filter("status != 'active'").withColumns({
        "exposure": k.cast("double") + F.lit(0.25), "ticket": F.concat(F.lit("T-"), k), "note": F.concat(F.lit("checked "), F.col("reported_by"))})
    p = Pipeline(spark, layout)
    for records in (first, second):
        records.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("append").text(layout.landing("fraud_watchlist"))
        p.bronze_watchlist_evolving(layout.landing("fraud_watchlist"))
    return p.watchlist_typed().drop("_record", "_source_file")


@register("stream_fraud_card_alerts_bounded")
def q_stream_fraud_card_alerts_bounded(spark, sf_dir):
    """J4 as a stream-stream join with a time range (state is evicted), heavy cards salted."""
    layout, p = _env(spark, sf_dir, "stream_fraud_bounded", watchlist=True)
    p.gold_fraud_card(lookback="7 days", salt=p.card_salts())
    return _read(spark, layout.table("gold", "fraud_card_alert"))


@register("stream_fraud_card_alerts_fresh")
def q_stream_fraud_card_alerts_fresh(spark, sf_dir):
    """Each micro-batch against the newest published watchlist and customers, no join state."""
    layout, p = _env(spark, sf_dir, "stream_fraud_fresh", watchlist=True)
    p.publish_watchlist()
    p.gold_fraud_card_fresh()
    return _read(spark, layout.table("gold", "fraud_card_alert_fresh")).drop("query", "batch_id")


@register("stream_quarantine")
def q_stream_quarantine(spark, sf_dir):
    """P4 on a stream: dirty messages split by one scan and one parse into silver and quarantine, committed together."""
    layout = Layout(fresh_dir(spark, "stream_quarantine"))
    p = Pipeline(spark, layout, partition_by_date=False)
    A.kafka_messages(spark, sf_dir, dirty=True).write.parquet(layout.landing("transactions"))
    p.bronze_transactions(spark.readStream.schema(KAFKA_SCHEMA).parquet(layout.landing("transactions")))
    p.silver_transactions_once()
    kept = p.committed("transactions").select("kafka_offset", F.lit("").alias("failed_expectations"))
    failed = p.committed("transactions_quarantine").select(F.col("offset").alias("kafka_offset"), F.concat_ws(",", "failed_expectations").alias("failed_expectations"))
    return kept.unionByName(failed)


@register("compact_bronze_watchlist")
def q_compact_bronze_watchlist(spark, sf_dir):
    """Bronze watchlist in many small files, packed while it grows; the rows stay the same."""
    from vigil.sources.compaction import compact, read_compacted
    layout = Layout(fresh_dir(spark, "compact_watchlist"))
    p = Pipeline(spark, layout)
    records = A.watchlist_messages(spark, sf_dir).withColumn("_turn", F.get_json_object("value", "$.watchlist_id"))
    for turn in range(3):
        mine = records.filter(F.pmod(F.crc32(F.col("_turn").cast("binary")), F.lit(3)) == turn)
        mine.select("value").repartition(6).write.mode("append").text(layout.landing("fraud_watchlist"))
        p.bronze_watchlist(layout.landing("fraud_watchlist"))
        if turn < 2:
            compact(spark, layout.table("bronze", "fraud_watchlist"))
        p.silver_watchlist()
    rows = read_compacted(spark, layout.table("bronze", "fraud_watchlist"))
    return rows.drop("ingestion_timestamp").withColumn("source_file", F.col("source_file").isNotNull()).withColumnRenamed("source_file", "has_source_file")


@register("outbox_delivery")
def q_outbox_delivery(spark, sf_dir):
    """The high-value outbox delivered in two runs; what ends in 7 fails the first time and is tried again after its pause."""
    import datetime as dt

    from vigil.operators.notify import high_value_notifications
    from vigil.streaming.delivery import deliver, delivery_report, read_ledger
    path = fresh_dir(spark, "outbox_delivery")
    high_value_notifications(Domain(spark, sf_dir).hv_alerts()).write.parquet(f"{path}/outbox")
    outbox = spark.read.parquet(f"{path}/outbox")

    def send(row):
        if row["alert_id"].endswith("7") and row["attempt"] == 1:
            raise ConnectionError("refused")

    now = dt.datetime(2024, 2, 1)
    for i in range(3):                       # the second run comes too early for a second try
        deliver(outbox, f"{path}/ledger", f"run{i}", send, now + dt.timedelta(seconds=45 * i))
    return delivery_report(outbox, read_ledger(spark, f"{path}/ledger"))
