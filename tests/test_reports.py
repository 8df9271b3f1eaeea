from datetime import datetime

from pyspark.sql import functions as F

from vigil.plans import reports as R

AS_OF = "2024-01-30 00:00:00"


def tx(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, transaction_timestamp timestamp, "
                                       "is_international boolean, amount double, merchant_name string")


def test_intl_vs_domestic_groups_by_flag(spark):
    rows = [("T1", datetime(2024, 1, 29), True, 1.0, "A"), ("T2", datetime(2024, 1, 29), False, 1.0, "A"),
            ("T3", datetime(2024, 1, 29), None, 1.0, "A"), ("T4", datetime(2024, 1, 1), True, 1.0, "A")]
    out = sorted((r.transaction_type, r.transaction_count) for r in R.rpt_intl_vs_domestic(tx(spark, rows), AS_OF)
                 .collect())
    assert out == [("Domestic", 1), ("Domestic", 1), ("International", 1)]


def test_money_sums_are_exact(spark):
    rows = [(f"T{i}", datetime(2024, 1, 29), False, 0.1, "A") for i in range(10)]
    r = R.rpt_avg_amount_today(tx(spark, rows), "2024-01-29 12:00:00").first()
    assert r.avg_amount == 0.1
    assert R.rpt_by_country(tx(spark, rows).withColumn("country", F.lit("X")), AS_OF).first().total_amount == 1.0


def test_top_merchants_breaks_ties_by_name(spark):
    rows = [(f"T{i}", datetime(2024, 1, 29), False, 1.0, name) for i, name in enumerate("CBAZYXWVUTSRQ")]
    names = [r.merchant_name for r in R.rpt_top_merchants(tx(spark, rows), AS_OF).collect()]
    assert names == sorted(names) and len(names) == 10 and names[0] == "A"


def test_reports_prune_date_partitions(spark, workdir):
    rows = [(f"T{i}", datetime(2024, 1, 1 + i % 29, 12), False, 1.0, "A") for i in range(290)]
    path = f"{workdir}/silver_tx"
    tx(spark, rows).withColumn("event_date", F.to_date("transaction_timestamp")) \
        .write.partitionBy("event_date").parquet(path)
    silver = spark.read.parquet(path)
    report = R.rpt_top_merchants(silver, AS_OF)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan
    assert report.first().transaction_count == 70      # days 23..29 at 12:00, 10 rows each
    assert R.rpt_transactions_today(silver, "2024-01-29 08:00:00").first().transaction_count == 0   # nothing before 08:00
    day = R.rpt_transactions_today(silver, "2024-01-29 20:00:00")
    assert day.first().transaction_count == 10


def test_report_scan_reads_only_used_columns_and_pushes_the_time_filter(spark, workdir):
    rows = [(f"T{i}", datetime(2024, 1, 1 + i % 29, 12), False, float(i), "A") for i in range(100)]
    path = f"{workdir}/silver_plain"
    tx(spark, rows).withColumn("merchant_category", F.lit("grocery")).withColumn("notes", F.lit("x" * 50)) \
        .write.parquet(path)
    report = R.rpt_amount_by_category(spark.read.parquet(path), AS_OF)
    plan = report._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "GreaterThanOrEqual(transaction_timestamp" in scan
    read_schema = scan.split("ReadSchema: ")[1]
    assert "notes" not in read_schema and "merchant_name" not in read_schema
    assert "amount" in read_schema and "merchant_category" in read_schema


def test_alert_reports_go_by_alert_time(spark):
    """Alerts raised today on older transactions count today, whatever date their table partition has."""
    rows = [(f"A{i}", "X", datetime(2024, 1, 30, 9 + i), "n", "APPROVED", datetime(2024, 1, d)) for i, d in enumerate((30, 12, 29))]
    alerts = spark.createDataFrame(rows, "alert_id string, alert_type string, alert_timestamp timestamp, customer_name string, status string, event_date timestamp") \
        .withColumn("event_date", F.to_date("event_date"))
    assert R.rpt_alerts_today(alerts, "2024-01-30 12:00:00").first().alert_count == 3
    assert R.rpt_alerts_today(alerts, "2024-01-30 10:30:00").first().alert_count == 2
    assert R.rpt_alert_status(alerts, "2024-01-30 12:00:00").first().alert_count == 3


def test_a_huge_amount_does_not_stop_the_report(spark):
    rows = [("T1", datetime(2024, 1, 29, 12), False, 1e40, "A"), ("T2", datetime(2024, 1, 29, 12), False, 2.125, "A")]
    out = R.rpt_by_country(tx(spark, rows).withColumn("country", F.lit("X")), "2024-01-30 00:00:00").first()
    assert (out.transaction_count, out.total_amount) == (2, 2.125)
