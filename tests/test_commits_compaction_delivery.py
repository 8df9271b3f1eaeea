"""Batches committed over several tables, packed files, and the ledger of deliveries."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vigil.schemas import KAFKA_SCHEMA
from vigil.sources import adapter as A
from vigil.sources import compaction
from vigil.streaming import commits, delivery, flows
from vigil.streaming.flows import Layout, Pipeline

NOW = datetime(2024, 5, 1, 12)


# commits
def test_readers_see_whole_batches_only(spark, workdir):
    a, b = spark.createDataFrame([(1,), (2,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert commits.write_batch(workdir, "one", 0, {"a": a, "b": b}) and not commits.write_batch(workdir, "one", 0, {"a": a, "b": b})
    a.write.parquet(f"{workdir}/a/query=one/batch_id=1")                                # a driver that died after the first write
    assert commits.read_committed(spark, workdir, "a").count() == 2 and commits.read_committed(spark, workdir, "b").count() == 1
    assert commits.write_batch(workdir, "one", 1, {"a": a.limit(1), "b": b})            # the batch again, with other rows
    assert commits.write_batch(workdir, "two", 1, {"a": a, "b": b.limit(0)})            # another query's batch of that number
    assert commits.read_committed(spark, workdir, "a").count() == 5 and commits.read_committed(spark, workdir, "b").count() == 2


def test_a_kill_between_two_writes_loses_and_doubles_nothing(spark, workdir, monkeypatch):
    layout = Layout(workdir)
    p = Pipeline(spark, layout)
    A.kafka_messages(spark, SF_SMALL, dirty=True).write.parquet(layout.landing("transactions"))
    p.bronze_transactions(spark.readStream.schema(KAFKA_SCHEMA).parquet(layout.landing("transactions")))
    whole = commits.write_batch

    def killed(path, query, batch_id, tables):
        first = next(iter(tables))
        tables[first].write.mode("overwrite").parquet(f"{path}/{first}/query={query}/batch_id={batch_id}")
        raise RuntimeError("killed")

    monkeypatch.setattr(flows, "write_batch", killed)
    with pytest.raises(Exception, match="killed"):
        p.silver_transactions_once()
    monkeypatch.setattr(flows, "write_batch", whole)
    p.silver_transactions_once()
    n = A.kafka_messages(spark, SF_SMALL, dirty=True).count()
    kept, failed = p.committed("transactions"), p.committed("transactions_quarantine")
    assert kept.count() + failed.count() == n == kept.select("kafka_offset").union(failed.select("offset")).distinct().count()
    p.silver_transactions()                                                            # the two-query form gives the same
    assert p.read_table("silver", "transactions").count() == kept.count()
    assert p.read_table("silver", "transactions_quarantine").exceptAll(failed).isEmpty()
    assert "silver_ingestion_timestamp" in kept.columns and failed.columns == ["key", "value", "topic", "partition", "offset", "timestamp", "failed_expectations"]


# compaction
def files(df):
    return {r.file: r["size"] for r in compaction.file_sizes(df).collect()}


def test_small_files_are_packed_while_a_stream_reads(spark, workdir):
    table, schema = f"{workdir}/t", "id long, day string"

    def grow(first):
        spark.range(first, first + 4000).selectExpr("id", "concat('d ', id % 3) AS day").repartition(10).write.mode("append").partitionBy("day").parquet(table)

    def stream():
        (spark.readStream.schema(schema).parquet(table).writeStream.format("parquet").option("path", f"{workdir}/copy").option("checkpointLocation", f"{workdir}/c")
         .trigger(availableNow=True).start().awaitTermination())

    grow(0)
    stream()
    sizes = files(spark.read.parquet(table))
    target = max(sizes.values()) * 4
    assert compaction.compact(spark, table, target) == len(sizes) == 30
    grow(4000)
    packed = compaction.read_compacted(spark, table)
    assert packed.count() == 8000 and packed.select("id").distinct().count() == 8000 and set(packed.columns) == {"id", "day"}
    inside = [f for f in packed.inputFiles() if "_compacted" in f]
    assert len(inside) <= sum(sizes.values()) / target + 1 and len(packed.inputFiles()) == len(inside) + 30
    assert compaction.compact(spark, table, target) == 30 and compaction.compact(spark, table, target) == 0
    stream()
    assert spark.read.parquet(f"{workdir}/copy").count() == 8000                       # the stream went on undisturbed
    assert compaction.read_compacted(spark, table).exceptAll(spark.read.parquet(table)).isEmpty()
    assert compaction.expired_files(spark, table, datetime(2020, 1, 1)).count() == 0
    assert compaction.expired_files(spark, table, datetime(2100, 1, 1)).count() == 60


def test_large_files_stay_and_two_compactions_collide(spark, workdir, monkeypatch):
    for i in range(3):
        spark.range(i, i + 1).write.mode("append").parquet(f"{workdir}/t")
    assert compaction.compact(spark, f"{workdir}/t", target_bytes=1) == 0
    assert compaction.read_compacted(spark, f"{workdir}/t").count() == 3
    before = compaction._manifests(spark, f"{workdir}/t")
    assert compaction.compact(spark, f"{workdir}/t") == 3
    monkeypatch.setattr(compaction, "_manifests", lambda *_: before)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        compaction.compact(spark, f"{workdir}/t")


def test_bins_hold_about_the_target(spark):
    sizes = spark.createDataFrame([(f"f{i}", s) for i, s in enumerate([5, 90, 40, 60, 1, 1, 1, 100])], "file string, size long")
    packed = compaction.bins(sizes, 100).join(sizes, "file").groupBy("bin").agg(F.sum("size").alias("n"))
    got = {r.bin: r.n for r in packed.collect()}
    assert sum(got.values()) == 298 and len(got) <= 298 / 100 + 1 and max(got.values()) < 200


# delivery
def outbox(spark, n=12):
    rows = [("HIGH", f"A{i}", f"{i}@mail", "s", "b", "PENDING" if i % 4 else "INVALID") for i in range(n)] + [("HIGH", "A1", "1@mail", "s", "b", "PENDING"), ("OTHER", "A1", "1@mail", "s", "b", "PENDING")]
    return spark.createDataFrame(rows, "alert_type string, alert_id string, recipient string, subject string, body string, delivery_status string").repartition(3)


def test_failed_ones_are_tried_again_after_a_growing_pause(spark, workdir):
    def send(row):
        if row["alert_id"] == "A2" and row["attempt"] < 3 or row["alert_id"] == "A3":
            raise ValueError(f"no {row['attempt']}")

    box, tried = outbox(spark), []
    for i, after in enumerate([0, 30, 60, 150, 181, 10_000, 20_000]):
        got = delivery.deliver(box, f"{workdir}/ledger", f"r{i}", send, NOW + timedelta(seconds=after), most_attempts=4)
        tried.append(sorted((r.alert_id, r.attempt, r.sent) for r in got.filter("alert_id IN ('A2', 'A3')").collect()))
    assert tried == [[("A2", 1, False), ("A3", 1, False)], [], [("A2", 2, False), ("A3", 2, False)], [], [("A2", 3, True), ("A3", 3, False)], [("A3", 4, False)], []]
    ledger = delivery.read_ledger(spark, f"{workdir}/ledger")
    report = {(r.alert_type, r.alert_id): (r.state, r.attempts, r.last_error) for r in delivery.delivery_report(box, ledger).collect()}
    assert len(report) == 13 and report["HIGH", "A3"] == ("WAITING", 4, "ValueError: no 4") and report["HIGH", "A2"][:2] == ("SENT", 3)
    assert report["HIGH", "A4"] == ("INVALID", 0, None) and report["HIGH", "A1"] == report["OTHER", "A1"] == ("SENT", 1, None)
    assert ledger.count() == 10 + 2 + 2 + 1


def test_a_repeated_run_replaces_its_attempts(spark, workdir):
    def send(row):
        if row["alert_id"] == "A5":
            raise OSError("down")

    for _ in range(2):
        assert delivery.deliver(outbox(spark), f"{workdir}/ledger", "night", send, NOW).count() == 10
    ledger = delivery.read_ledger(spark, f"{workdir}/ledger")
    assert ledger.count() == 10 and {r.attempts for r in delivery.attempts(ledger).collect()} == {1}
    assert delivery.due(outbox(spark), ledger, NOW).count() == 0 and delivery.due(outbox(spark), ledger, NOW + timedelta(seconds=60)).count() == 1
    assert delivery.deliver(outbox(spark).limit(0), f"{workdir}/ledger", "empty", send, NOW).count() == 0
