"""Stored progress: more batches than a query remembers, restarts, rule counts."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vigil.operators.quality import Expectation, expect
from vigil.streaming.flows import Layout, Pipeline, late_rows_dropped
from vigil.streaming.progress import batches, late_rows_report, recorded, stream_expectation_report

RULES = (Expectation("positive", "v > 0"), Expectation("small", "v < 100", "warn"))
T0 = datetime(2024, 1, 1)


def land(spark, folder, files, first=0):
    """One file for each number: a row on time, and for every third a row two hours late."""
    rows = [(i, T0 + timedelta(minutes=i), i - 3) for i in range(first, first + files)]
    rows += [(i, T0 + timedelta(minutes=i - 120), 500) for i in range(first, first + files) if i % 3 == 2]
    df = spark.createDataFrame(rows, "n int, ts timestamp, v int")
    df.repartition(files, "n").write.partitionBy("n").mode("append").parquet(folder)
    return df


def run(spark, workdir, schema):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{workdir}/in")
    kept, _ = expect(stream, "rules", RULES)
    return (kept.withWatermark("ts", "10 minutes").dropDuplicatesWithinWatermark(["ts", "v"]).writeStream.queryName("dedupe").format("parquet")
            .option("path", f"{workdir}/out").option("checkpointLocation", f"{workdir}/checkpoint").trigger(availableNow=True).start())


def test_reports_hold_over_150_batches_and_a_restart(spark, workdir):
    schema = land(spark, f"{workdir}/in", 110).schema
    queries = []
    for first in (110, None):
        with recorded(spark, f"{workdir}/progress", queries):
            queries.append(run(spark, workdir, schema))
            queries[-1].awaitTermination()
        if first:
            land(spark, f"{workdir}/in", 40, first)
    read = spark.read.parquet(f"{workdir}/in")
    assert read.count() == 200
    [report] = late_rows_report(spark, f"{workdir}/progress").collect()
    kept = spark.read.parquet(f"{workdir}/out").count()
    assert report.batches == 150 and report.input_rows == 200 and report.query_name == "dedupe"
    assert kept + report.rows_dropped_by_watermark == read.filter("v > 0").count() and report.rows_dropped_by_watermark > 40
    assert sum(late_rows_dropped(q) for q in queries) < report.rows_dropped_by_watermark      # a query forgets
    counts = {r.expectation: (r.action, r.failed_records, r.total_records) for r in stream_expectation_report(spark, f"{workdir}/progress", "rules", RULES).collect()}
    assert counts == {"positive": ("drop", 4, 200), "small": ("warn", read.filter("v >= 100").count(), 200)}


def test_a_batch_reported_twice_counts_once_and_nothing_recorded_is_empty(spark, workdir):
    assert late_rows_report(spark, f"{workdir}/none").collect() == []
    row = ("q", "id", "run", 0, "2024-01-01T00:00:00Z", 5, 2, 3, {"rules": {"positive": 1, "total_records": 5}})
    idle = row[:5] + (0, 0, 3, {})
    from vigil.streaming.progress import SCHEMA
    spark.createDataFrame([row, idle, row[:3] + (1,) + row[4:]], SCHEMA).write.json(f"{workdir}/progress")
    assert batches(spark, f"{workdir}/progress").count() == 2
    [r] = late_rows_report(spark, f"{workdir}/progress").collect()
    assert (r.batches, r.input_rows, r.rows_dropped_by_watermark) == (2, 10, 4)
    [r] = stream_expectation_report(spark, f"{workdir}/progress", "rules", RULES[:1]).collect()
    assert (r.failed_records, r.total_records) == (2, 10)


def test_watchlist_rules_are_counted(spark, workdir):
    layout = Layout(workdir)
    lines = ['{"watchlist_id":"w1","entity_id":"4","risk_level":"high","effective_from":"01-Jan-2024 00:00:00"}',
             '{"watchlist_id":"w2","entity_id":null,"risk_level":"odd","effective_from":"2024-01-01"}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(layout.landing("fraud_watchlist"))
    p = Pipeline(spark, layout)
    with p.recorded():
        p.bronze_watchlist(layout.landing("fraud_watchlist"))
        p.silver_watchlist()
    from vigil.operators.quality import WATCHLIST_EXPECTATIONS
    got = {r.expectation: r.failed_records for r in p.expectation_counts("silver_fraud_watchlist", WATCHLIST_EXPECTATIONS).collect()}
    assert got == {"valid_watchlist_id": 0, "valid_entity_id": 1, "valid_effective_from": 1, "known_risk_level": 1}
    assert spark.read.parquet(layout.table("silver", "fraud_watchlist")).count() == 2
