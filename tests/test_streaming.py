"""Streaming flows on file inputs: parity with batch, late data, restart, idempotent outbox."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.operators.rules import RuleConfig, score_transactions
from vigil.plans.catalog import Domain
from vigil.schemas import KAFKA_SCHEMA
from vigil.sources import adapter as A
from vigil.streaming.flows import Layout, Pipeline, late_rows_dropped
from vigil.streaming.outbox import outbox_writer

JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
RULES = RuleConfig(high_value_amount=300.0, travel_max_minutes=1440.0, velocity_seconds=2 * 86400,
                   card_test_seconds=86400)


def write_messages(df, path):
    df.coalesce(1).write.mode("append").option("timestampFormat", JSON_TS).json(path)


def messages_between(spark, start, end, dirty=False):
    m = A.kafka_messages(spark, SF_SMALL, dirty=dirty)
    return m.filter((F.col("timestamp") >= F.lit(start).cast("timestamp")) &
                    (F.col("timestamp") < F.lit(end).cast("timestamp")))


def pipeline(spark, layout, **kw):
    return Pipeline(spark, layout, alert_time="transaction_timestamp", max_files_per_trigger=1, **kw)


def kafka_stream(spark, layout):
    return (spark.readStream.schema(KAFKA_SCHEMA).option("maxFilesPerTrigger", 1)
            .json(layout.landing("transactions")))


def test_stateful_scoring_over_micro_batches_equals_batch(spark, workdir):
    layout = Layout(workdir)
    for start, end in [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]:
        write_messages(messages_between(spark, start, end), layout.landing("transactions"))
    d = Domain(spark, SF_SMALL)
    d.customers().write.parquet(layout.table("silver", "customers"))
    # unpartitioned tables: one file per micro-batch, read back one file per batch in order
    p = pipeline(spark, layout, partition_by_date=False)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    q = p.fraud_scores(d.merchants(), RULES)
    assert len([x for x in q.recentProgress if x["numInputRows"] > 0]) == 3
    got = {r.transaction_id: (r.fraud_score, r.fraud_reason, r.dominant_reason)
           for r in spark.read.parquet(layout.table("gold", "fraud_scores")).collect()}
    want = {r.transaction_id: (r.fraud_score, r.fraud_reason, r.dominant_reason)
            for r in score_transactions(d.transactions(), d.customers(), d.merchants(), RULES).collect()}
    assert got == want and len(got) > 500


def test_late_rows_are_dropped_by_closed_windows(spark, workdir):
    layout = Layout(workdir)
    write_messages(messages_between(spark, "2024-01-01", "2024-01-15"), layout.landing("transactions"))
    p = pipeline(spark, layout)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    p.gold_counts()
    before = spark.read.parquet(layout.table("gold", "transaction_count_by_minute")).count()
    # a second file with rows from the first day only: older than the watermark
    write_messages(messages_between(spark, "2024-01-01", "2024-01-02"), layout.landing("transactions"))
    p2 = pipeline(spark, layout)
    p2.bronze_transactions(kafka_stream(spark, layout))
    p2.silver_transactions()
    q = p2.gold_counts()
    after = spark.read.parquet(layout.table("gold", "transaction_count_by_minute")).count()
    assert after == before
    assert late_rows_dropped(q) > 0
    from vigil.streaming.flows import progress_report
    report = {r.query_name: r for r in progress_report(spark, p2.queries).collect()}
    assert report["gold_transaction_count_by_minute"].rows_dropped_by_watermark == late_rows_dropped(q)
    assert report["bronze_transactions"].input_rows > 0


def test_restart_processes_only_new_files(spark, workdir):
    layout = Layout(workdir)
    first = messages_between(spark, "2024-01-01", "2024-01-10")
    write_messages(first, layout.landing("transactions"))
    pipeline(spark, layout).bronze_transactions(kafka_stream(spark, layout))
    n1 = spark.read.parquet(layout.table("bronze", "transactions")).count()
    assert n1 == first.count()
    second = messages_between(spark, "2024-01-10", "2024-02-01")
    write_messages(second, layout.landing("transactions"))
    pipeline(spark, layout).bronze_transactions(kafka_stream(spark, layout))
    bronze = spark.read.parquet(layout.table("bronze", "transactions"))
    assert bronze.count() == n1 + second.count()
    assert bronze.select("offset").distinct().count() == bronze.count()


def test_silver_expectations_are_observed_per_batch(spark, workdir):
    layout = Layout(workdir)
    write_messages(A.kafka_messages(spark, SF_SMALL, dirty=True), layout.landing("transactions"))
    p = pipeline(spark, layout)
    p.bronze_transactions(kafka_stream(spark, layout))
    q = p.silver_transactions()
    metrics = [x["observedMetrics"]["silver_transactions"] for x in q.recentProgress
               if x.get("observedMetrics")]
    failed = sum(m["valid_customer_id"] for m in metrics)
    assert failed > 0
    kept = spark.read.parquet(layout.table("silver", "transactions")).count()
    quarantined = spark.read.parquet(layout.table("silver", "transactions_quarantine")).count()
    assert kept + quarantined == sum(m["total_records"] for m in metrics)


def test_watchlist_arriving_later_still_alerts_on_past_transactions(spark, workdir):
    layout = Layout(workdir)
    write_messages(A.kafka_messages(spark, SF_SMALL), layout.landing("transactions"))
    Domain(spark, SF_SMALL).customers().write.parquet(layout.table("silver", "customers"))
    wl_landing = layout.landing("fraud_watchlist")
    # an empty watchlist stream first
    spark.createDataFrame([], "value string").write.text(wl_landing)
    p = pipeline(spark, layout)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    p.bronze_watchlist(wl_landing)
    p.silver_watchlist()
    p.gold_fraud_card()
    assert p.read_table("gold", "fraud_card_alert").count() == 0
    A.watchlist_messages(spark, SF_SMALL).select("value").write.mode("append").text(wl_landing)
    p2 = Pipeline(spark, layout, alert_time="transaction_timestamp")
    p2.bronze_watchlist(wl_landing)
    p2.silver_watchlist()
    p2.gold_fraud_card()
    n = spark.read.parquet(layout.table("gold", "fraud_card_alert")).count()
    assert n == Domain(spark, SF_SMALL).fraud_alerts().count() and n > 0


def test_outbox_batch_is_idempotent(spark, workdir):
    alerts = Domain(spark, SF_SMALL).hv_alerts()
    write = outbox_writer(f"{workdir}/outbox", "high_value")
    write(alerts, 0)
    write(alerts, 0)            # a retried batch replaces its own output
    write(alerts.limit(3), 1)
    out = spark.read.parquet(f"{workdir}/outbox")
    assert out.filter("batch_id = 0").count() == alerts.count()
    assert out.filter("batch_id = 1").count() == 3
    assert set(out.columns) >= {"alert_id", "recipient", "subject", "body", "delivery_status"}
    from vigil.streaming.outbox import outbox_counts
    counts = {(r.batch_id, r.delivery_status): r.notifications for r in outbox_counts(out).collect()}
    assert sum(v for (b, _), v in counts.items() if b == 0) == alerts.count()
    assert counts.get((1, "PENDING"), 0) + counts.get((1, "INVALID"), 0) == 3


def test_redelivered_messages_are_dropped_within_the_watermark(spark, workdir):
    layout = Layout(workdir)
    msgs = messages_between(spark, "2024-01-01", "2024-01-05")
    write_messages(msgs, layout.landing("transactions"))
    write_messages(msgs.withColumn("offset", F.col("offset") + 10**9), layout.landing("transactions"))
    p = Pipeline(spark, layout, alert_time="transaction_timestamp", dedupe=True)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    silver = spark.read.parquet(layout.table("silver", "transactions"))
    assert spark.read.parquet(layout.table("bronze", "transactions")).count() == 2 * msgs.count()
    assert silver.count() == msgs.count() == silver.select("transaction_id").distinct().count()


def test_continuous_mode_picks_up_new_files(spark, workdir):
    layout = Layout(workdir)
    first = messages_between(spark, "2024-01-01", "2024-01-03")
    write_messages(first, layout.landing("transactions"))
    p = Pipeline(spark, layout, mode="continuous", interval="1 second")
    q = p.bronze_transactions(kafka_stream(spark, layout))
    try:
        assert q.isActive
        q.processAllAvailable()
        assert spark.read.parquet(layout.table("bronze", "transactions")).count() == first.count()
        second = messages_between(spark, "2024-01-03", "2024-01-05")
        write_messages(second, layout.landing("transactions"))
        q.processAllAvailable()
        assert spark.read.parquet(layout.table("bronze", "transactions")).count() == first.count() + second.count()
    finally:
        p.stop()
    assert not q.isActive


def test_customer_changes_stream_into_versioned_snapshots(spark, workdir):
    from datetime import datetime

    from vigil.sources.tables import current_snapshot_path, read_snapshot, write_snapshot
    layout = Layout(workdir)
    snap = f"{workdir}/customers"
    schema = "customer_id string, transaction_limit double, update_timestamp timestamp"
    write_snapshot(spark.createDataFrame([("C1", 1.0, datetime(2024, 1, 1)), ("C2", 2.0, datetime(2024, 1, 1))],
                                         schema), snap, "initial")
    landing = layout.landing("customer_changes")
    spark.createDataFrame([("C1", 10.0, datetime(2024, 2, 1))], schema).coalesce(1).write.mode("append").parquet(landing)
    spark.createDataFrame([("C3", 3.0, datetime(2024, 2, 2)), ("C1", 11.0, datetime(2024, 2, 3)),
                           (None, 9.0, datetime(2024, 2, 3))],
                          schema).coalesce(1).write.mode("append").parquet(landing)
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    Pipeline(spark, layout).customers_upsert(changes, snap)
    got = {r.customer_id: r.transaction_limit for r in read_snapshot(spark, snap).collect()}
    assert got == {"C1": 11.0, "C2": 2.0, "C3": 3.0}
    assert current_snapshot_path(spark, snap).endswith("batch_000000000001")


def test_bounded_watchlist_join_evicts_state(spark, workdir):
    from vigil.streaming.flows import state_rows
    layout = Layout(workdir)
    for start, end in [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]:
        write_messages(messages_between(spark, start, end), layout.landing("transactions"))
    Domain(spark, SF_SMALL).customers().write.parquet(layout.table("silver", "customers"))
    A.watchlist_messages(spark, SF_SMALL).select("value").coalesce(1).write.text(layout.landing("fraud_watchlist"))
    p = Pipeline(spark, layout, alert_time="transaction_timestamp", max_files_per_trigger=1, partition_by_date=False)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    p.bronze_watchlist(layout.landing("fraud_watchlist"))
    p.silver_watchlist()
    unbounded = p.gold_fraud_card()
    layout2 = Layout(workdir + "/bounded")
    p2 = Pipeline(spark, layout2, alert_time="transaction_timestamp", max_files_per_trigger=1,
                  partition_by_date=False)
    # the bounded flow reads the same silver tables
    p2._read = p._read
    p2.customers = p.customers
    bounded = p2.gold_fraud_card(lookback="7 days")
    n_unbounded, n_bounded = state_rows(unbounded), state_rows(bounded)
    assert 0 <= n_bounded < n_unbounded
    got = p2.read_table("gold", "fraud_card_alert").count()
    assert got == Domain(spark, SF_SMALL).fraud_alerts().filter(
        "transaction_timestamp >= watchlist_effective_from AND "
        "transaction_timestamp <= watchlist_effective_from + INTERVAL 7 DAYS").count()


def test_notify_on_partitioned_gold_and_before_any_alert(spark, workdir):
    layout = Layout(workdir)
    write_messages(messages_between(spark, "2024-01-01", "2024-01-04"), layout.landing("transactions"))
    no_alerts = Layout(workdir + "/quiet")
    d = Domain(spark, SF_SMALL)
    d.customers().write.parquet(layout.table("silver", "customers"))
    d.customers().withColumn("transaction_limit", F.lit(1e12)).write.parquet(no_alerts.table("silver", "customers"))
    for lay in (layout, no_alerts):
        p = Pipeline(spark, lay, alert_time="transaction_timestamp")
        p.bronze_transactions(spark.readStream.schema(KAFKA_SCHEMA).json(layout.landing("transactions")))
        p.silver_transactions()
        p.gold_high_value()
        p.notify("high_value")
    gold = spark.read.parquet(layout.table("gold", "high_value_transactions_alert"))
    outbox = spark.read.parquet(layout.table("outbox", "high_value"))
    assert "event_date" in gold.columns and gold.count() == outbox.count() > 0
    assert Pipeline(spark, no_alerts).read_table("outbox", "high_value").count() == 0


def test_fresh_enrichment_sees_customer_changes_without_restart(spark, workdir):
    from vigil.sources.tables import read_snapshot, write_snapshot
    layout = Layout(workdir)
    d = Domain(spark, SF_SMALL)
    snap = f"{workdir}/customers"
    write_snapshot(d.customers().withColumn("transaction_limit", F.lit(1e12)), snap, "v1")   # nobody alerts
    write_messages(messages_between(spark, "2024-01-01", "2024-01-10"), layout.landing("transactions"))
    p = Pipeline(spark, layout, mode="continuous", interval="1 second", alert_time="transaction_timestamp",
                 partition_by_date=False)
    bronze = p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    gold = p.gold_high_value_fresh(snap)
    try:
        for q in p.queries:
            q.processAllAvailable()
        assert p.read_table("gold", "high_value_transactions_alert_fresh").count() == 0
        write_snapshot(d.customers(), snap, "v2")                       # real limits from now on
        second = messages_between(spark, "2024-01-10", "2024-01-20")
        write_messages(second, layout.landing("transactions"))
        for q in [bronze] + p.queries[1:]:
            q.processAllAvailable()
        got = p.read_table("gold", "high_value_transactions_alert_fresh")
        want = alerts_for(spark, second, read_snapshot(spark, snap))
        assert got.count() == want > 0
    finally:
        p.stop()
    assert not gold.isActive


def test_late_rows_look_only_at_earlier_ones():
    """Rows arriving out of order within the watermark: flags as in event order, whatever the counts."""
    import pandas as pd
    from vigil.operators.rules import RuleConfig
    from vigil.streaming.stateful import _PASS, history_processor

    class State:
        exists, hasTimedOut, get = False, False, None

        def update(self, x):
            self.exists, self.get = True, x

        def setTimeoutTimestamp(self, _):
            pass

        def getCurrentWatermarkMs(self):
            return 0

    def run(cfg, batches):
        state, out = State(), {}
        process = history_processor(cfg, 300)
        for batch in batches:
            rows = [{c: False for c in _PASS} | {"transaction_id": f"T{t:04d}", "customer_id": "C", "amount": 1.0, "city": "X", "_ts_us": t * 1_000_000} for t in batch]
            for pdf in process(("C",), iter([pd.DataFrame(rows)]), state):
                out |= dict(zip(pdf["transaction_id"], pdf["rule_velocity"]))
        return out

    cfg = RuleConfig(velocity_count=5, velocity_seconds=30)
    got = run(cfg, [[200], [100], [201], [202], [203], [204], [205]])
    assert {k for k, v in got.items() if v} == {"T0205"}          # five earlier rows within 30 s
    many = run(RuleConfig(velocity_count=60, velocity_seconds=600), [list(range(1000, 1035)), list(range(1035, 1070))])
    assert sum(many.values()) == 10


def test_customers_that_share_a_state_key_do_not_see_each_other(spark, workdir):
    """Before, each customer was a state key of its own, and a call for each cost most of the time."""
    from datetime import timedelta

    from test_rules import T0
    from vigil.streaming import stateful
    from vigil.streaming.flows import state_rows

    cfg = RuleConfig(velocity_count=2, velocity_seconds=600)
    columns = ("transaction_id string, customer_id string, merchant_id string, amount double, device_id string, city string, "
               "transaction_timestamp timestamp, is_international boolean")
    rows = [(f"T{i:05d}{n}", None if i == 7 else f"N{i}", "M0", 5.0, "DEV1", cfg.travel_from if n == 0 else cfg.travel_to, T0 + timedelta(minutes=n, seconds=i % 40), False)
            for i in range(2000) for n in range(1 + i % 4)]
    df = spark.createDataFrame(rows, columns)
    for part in (0, 1):
        df.filter(F.unix_timestamp("transaction_timestamp") % 2 == part).coalesce(1).write.mode("append").parquet(f"{workdir}/in")
    customers = spark.createDataFrame([("N1", "DEV1")], "customer_id string, trusted_device_id string")
    merchants = spark.createDataFrame([("M0", "HIGH", False)], "merchant_id string, merchant_risk string, is_blacklisted boolean")
    q = (stateful.stream_scores(spark.readStream.schema(df.schema).parquet(f"{workdir}/in"), customers, merchants, cfg).writeStream.format("parquet")
         .option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    columns = ["transaction_id", "fraud_score", "fraud_reason", "rule_velocity", "rule_impossible_travel"]
    got = sorted(spark.read.parquet(f"{workdir}/out").select(*columns).collect())
    assert got == sorted(score_transactions(df, customers, merchants, cfg).select(*columns).collect()) and any(r.rule_velocity for r in got)
    assert 0 < state_rows(q) <= stateful.SHARDS


def alerts_for(spark, messages, customers):
    from vigil.operators.alerts import high_value_alerts
    from vigil.operators.silver import kafka_to_bronze, parse_transactions
    return high_value_alerts(parse_transactions(kafka_to_bronze(messages)), customers).count()


def test_tail_scoring_over_micro_batches_equals_batch_and_retries_are_idempotent(spark, workdir):
    from vigil.streaming.stateful import tail_scoring_writer
    layout = Layout(workdir)
    for start, end in [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]:
        write_messages(messages_between(spark, start, end), layout.landing("transactions"))
    d = Domain(spark, SF_SMALL)
    d.customers().write.parquet(layout.table("silver", "customers"))
    p = pipeline(spark, layout, partition_by_date=False)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    q = p.fraud_scores(d.merchants(), RULES, method="tail")
    assert len([x for x in q.recentProgress if x["numInputRows"] > 0]) == 3
    out = spark.read.parquet(layout.table("gold", "fraud_scores"))
    want = {r.transaction_id: (r.fraud_score, r.fraud_reason, r.dominant_reason)
            for r in score_transactions(d.transactions(), d.customers(), d.merchants(), RULES).collect()}
    got = {r.transaction_id: (r.fraud_score, r.fraud_reason, r.dominant_reason) for r in out.collect()}
    assert got == want and len(got) > 500
    # a retried batch 1 reads the tail published before it and replaces its own output
    batch1 = out.filter("batch_id = 1").drop("batch_id", "query")
    silver = spark.read.parquet(layout.table("silver", "transactions"))
    replay = silver.join(batch1.select("transaction_id"), "transaction_id", "left_semi")
    writer = tail_scoring_writer(layout.table("gold", "fraud_scores"), layout.table("_state", "fraud_scores_tail"),
                                 p.customers(), d.merchants(), RULES, columns=[c for c in silver.columns], query_id=lambda: str(q.id))
    writer(replay, 1)
    again = spark.read.parquet(layout.table("gold", "fraud_scores"))
    assert again.count() == len(want)
    assert {r.transaction_id: (r.fraud_score, r.fraud_reason, r.dominant_reason)
            for r in again.collect()} == want


def test_one_record_files_are_packed_into_few_bronze_files(spark, workdir):
    import glob
    from vigil.sources.files import publish_watchlist_files
    layout = Layout(workdir)
    landing = layout.landing("fraud_watchlist")
    publish_watchlist_files(A.watchlist_records(spark, SF_SMALL), landing)
    n_in = len(glob.glob(landing.replace("file:", "") + "/*.json"))
    p = Pipeline(spark, layout)
    p.bronze_watchlist(landing)
    n_out = len(glob.glob(layout.table("bronze", "fraud_watchlist").replace("file:", "") + "/*.parquet"))
    assert n_in >= 10 and 0 < n_out < n_in and n_out <= 8
    assert spark.read.parquet(layout.table("bronze", "fraud_watchlist")).count() == n_in


def test_state_scorer_keeps_rows_without_event_time(spark, workdir):
    layout = Layout(workdir)
    msgs = messages_between(spark, "2024-01-01", "2024-01-03")
    broken = msgs.limit(3).withColumn("value", F.regexp_replace("value", r'"transaction_timestamp":"[^"]*",', ""))
    write_messages(msgs.unionByName(broken.withColumn("offset", F.col("offset") + 10**9)), layout.landing("transactions"))
    d = Domain(spark, SF_SMALL)
    d.customers().write.parquet(layout.table("silver", "customers"))
    p = Pipeline(spark, layout, partition_by_date=False)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    p.fraud_scores(d.merchants(), RULES)
    out = spark.read.parquet(layout.table("gold", "fraud_scores"))
    missing = out.filter(F.col("transaction_timestamp").isNull()).collect()
    assert len(missing) == 3
    assert not any(r.rule_velocity or r.rule_card_testing or r.rule_impossible_travel for r in missing)
    assert out.count() == msgs.count() + 3


def test_dashboard_over_pipeline_tables_matches_registry_reports(spark, workdir):
    from __spark_entry__ import queries
    from vigil.plans.reports import dashboard
    layout = Layout(workdir)
    write_messages(A.kafka_messages(spark, SF_SMALL), layout.landing("transactions"))
    Domain(spark, SF_SMALL).customers().write.parquet(layout.table("silver", "customers"))
    A.watchlist_messages(spark, SF_SMALL).select("value").write.text(layout.landing("fraud_watchlist"))
    p = Pipeline(spark, layout, alert_time="transaction_timestamp")
    p.bronze_transactions(spark.readStream.schema(KAFKA_SCHEMA).json(layout.landing("transactions")))
    p.silver_transactions()
    p.bronze_watchlist(layout.landing("fraud_watchlist"))
    p.silver_watchlist()
    p.gold_high_value()
    p.gold_fraud_card()
    reports = dashboard(spark, layout, A.AS_OF)
    assert len(reports) == 15
    qs = queries()
    for name, key in [("top_customers_by_alerts", "rpt_top_customers"), ("alert_trends", "rpt_alert_trends"),
                      ("transactions_by_country", "rpt_by_country"), ("risk_level_distribution", "rpt_watchlist_risk"),
                      ("avg_transaction_amount", "rpt_avg_amount_today")]:
        got = sorted(tuple(r) for r in reports[name].select(*sorted(reports[name].columns)).collect())
        want_df = qs[key](spark, SF_SMALL)
        want = sorted(tuple(r) for r in want_df.select(*sorted(want_df.columns)).collect())
        assert got == want, name


def test_sliding_counts_over_micro_batches_equal_closed_batch_windows(spark, workdir):
    from vigil.operators.windows import transaction_counts
    layout = Layout(workdir)
    for start, end in [("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")]:
        write_messages(messages_between(spark, start, end), layout.landing("transactions"))
    p = pipeline(spark, layout, partition_by_date=False)
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    q = p.gold_counts("5 minutes", "1 minute", "sliding")
    assert len([x for x in q.recentProgress if x["numInputRows"] > 0]) == 3
    got = sorted(tuple(r) for r in spark.read.parquet(layout.table("gold", "sliding"))
                 .select("window_start", "window_end", "transaction_count").collect())
    tx = Domain(spark, SF_SMALL).transactions()
    last = tx.agg(F.max("transaction_timestamp")).first()[0]
    closed = (transaction_counts(tx, "5 minutes", "1 minute")
              .filter(F.col("window_end") <= F.lit(last) - F.expr("INTERVAL 5 MINUTES")))
    want = sorted(tuple(r) for r in closed.select("window_start", "window_end", "transaction_count").collect())
    assert got == want and len(got) > 1000


def test_snapshot_watchlist_flow_is_stateless_and_matches_batch(spark, workdir):
    layout = Layout(workdir)
    write_messages(A.kafka_messages(spark, SF_SMALL), layout.landing("transactions"))
    d = Domain(spark, SF_SMALL)
    d.customers().write.parquet(layout.table("silver", "customers"))
    A.watchlist_messages(spark, SF_SMALL).select("value").write.text(layout.landing("fraud_watchlist"))
    p = Pipeline(spark, layout, alert_time="transaction_timestamp", partition_by_date=False)
    p.bronze_transactions(spark.readStream.schema(KAFKA_SCHEMA).json(layout.landing("transactions")))
    p.silver_transactions()
    p.bronze_watchlist(layout.landing("fraud_watchlist"))
    p.silver_watchlist()
    q = p.gold_fraud_card(snapshot=True)
    assert all(not x.get("stateOperators") for x in q.recentProgress)
    from vigil.operators.alerts import fraud_card_alerts_snapshot
    got = p.read_table("gold", "fraud_card_alert_snapshot").count()
    want = fraud_card_alerts_snapshot(d.transactions(), d.watchlist(), d.customers()).count()
    assert got == want > 0


def test_gold_flows_use_the_customer_snapshot_kept_by_the_upsert_flow(spark, workdir):
    layout = Layout(workdir)
    write_messages(messages_between(spark, "2024-01-01", "2024-01-05"), layout.landing("transactions"))
    landing = layout.landing("customer_changes")
    A.customers_source(spark, SF_SMALL).write.parquet(landing)
    p = Pipeline(spark, layout, alert_time="transaction_timestamp", partition_by_date=False)
    schema = A.customers_source(spark, SF_SMALL).schema
    p.customers_upsert(spark.readStream.schema(schema).parquet(landing))      # -> bronze/customers snapshot
    p.bronze_transactions(kafka_stream(spark, layout))
    p.silver_transactions()
    p.gold_high_value()
    got = p.read_table("gold", "high_value_transactions_alert").count()
    tx = messages_between(spark, "2024-01-01", "2024-01-05")
    assert got == alerts_for(spark, tx, Domain(spark, SF_SMALL).customers()) > 0


def test_salted_watchlist_stream_join_gives_the_same_alerts(spark, workdir):
    from vigil.streaming.flows import state_rows
    layout = Layout(workdir)
    write_messages(A.kafka_messages(spark, SF_SMALL), layout.landing("transactions"))
    d = Domain(spark, SF_SMALL)
    d.customers().write.parquet(layout.table("silver", "customers"))
    A.watchlist_messages(spark, SF_SMALL).select("value").write.text(layout.landing("fraud_watchlist"))
    p = Pipeline(spark, layout, alert_time="transaction_timestamp", partition_by_date=False)
    p.bronze_transactions(spark.readStream.schema(KAFKA_SCHEMA).json(layout.landing("transactions")))
    p.silver_transactions()
    p.bronze_watchlist(layout.landing("fraud_watchlist"))
    p.silver_watchlist()
    q = p.gold_fraud_card(salt=4)
    got = sorted(r.alert_id for r in p.read_table("gold", "fraud_card_alert").collect())
    want = sorted(r.alert_id for r in d.fraud_alerts().collect())
    assert got == want and len(got) > 0
    n_tx = spark.read.parquet(layout.table("silver", "transactions")).count()
    n_wl = spark.read.parquet(layout.table("silver", "fraud_watchlist")).count()
    assert state_rows(q) == n_tx + 4 * n_wl          # watchlist entries copied to each of the 4 sub-keys


def test_tables_by_name_and_silver_customers(spark, workdir):
    from vigil.plans.reports import rpt_high_risk_customers
    from vigil.sources.tables import write_snapshot
    from vigil.streaming.flows import customers_table, register_tables
    layout = Layout(workdir)
    write_snapshot(A.customers_source(spark, SF_SMALL), layout.table("bronze", "customers"))
    before = customers_table(spark, layout)                      # bronze, cleaned on read
    p = Pipeline(spark, layout)
    p.silver_customers()
    after = customers_table(spark, layout)
    assert after.columns == before.columns and after.count() == before.count() > 0
    messages_between(spark, "2024-01-01", "2024-01-03").write.parquet(layout.table("bronze", "transactions"))
    made = register_tables(spark, layout, prefix="vigil_t_")
    assert set(made) == {"vigil_t_bronze.transactions", "vigil_t_bronze.customers", "vigil_t_silver.customers"}
    assert spark.table("vigil_t_silver.customers").count() == after.count()
    assert rpt_high_risk_customers(spark.table("vigil_t_silver.customers")).first() == rpt_high_risk_customers(after).first()
