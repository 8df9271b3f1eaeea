"""Monitoring reports over silver and gold tables.

Each report takes an explicit ``as_of`` instant (text ``yyyy-MM-dd HH:mm:ss``
or a column) instead of the processing clock, so a report can be replayed.
Time filters are written as ranges on the raw event-time column, which the
Parquet scan can use for row-group skipping (``DATE(ts) = d`` cannot).

A report covers what happened before ``as_of``; rows dated later are left out.

Sums and averages of amounts are computed in decimal(28,8): money adds up
exactly and the result does not depend on how rows are split over tasks.
Amounts that don't fit (20 digits before the point) are left out of both.
Top-k reports order by count, then by name (a tie-breaker that makes the ten
rows deterministic).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil import constants as K
from vigil.functions.columns import floor_to, is_ntz


def _instant(df: DataFrame, col: str, as_of: str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp_ntz" if is_ntz(df, col) else "timestamp")


def _since(df: DataFrame, col: str, as_of, seconds: int) -> DataFrame:
    end = _instant(df, col, as_of)
    start = end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))
    out = df.filter((F.col(col) >= start) & (F.col(col) < end))
    if PARTITION_DATE in df.columns and col == PARTITION_SOURCE:   # pruning on date-partitioned tables
        out = out.filter((F.col(PARTITION_DATE) >= F.to_date(start)) & (F.col(PARTITION_DATE) <= F.to_date(end)))
    return out


def _on_day(df: DataFrame, col: str, as_of) -> DataFrame:
    end = _instant(df, col, as_of)
    day = F.to_date(end)
    out = df.filter((F.col(col) >= day.cast("timestamp_ntz" if is_ntz(df, col) else "timestamp")) & (F.col(col) < end))
    if PARTITION_DATE in df.columns and col == PARTITION_SOURCE:
        out = out.filter(F.col(PARTITION_DATE) == day)
    return out


def money(c: str) -> Column:
    """An amount as decimal(28,8); what doesn't fit is null instead of an error that stops the report."""
    return F.col(c).try_cast("decimal(28,8)")


def money_sum(c: str) -> Column:
    return F.sum(money(c)).cast("double")


def money_avg(c: str) -> Column:
    return F.sum(money(c)).cast("double") / F.nullif(F.count(money(c)), F.lit(0))


DAY, WEEK = 86400, 7 * 86400
PARTITION_DATE = "event_date"
PARTITION_SOURCE = "transaction_timestamp"   # the column whose date event_date is


def alerts_union(fraud_alerts: DataFrame, high_value_alerts: DataFrame) -> DataFrame:
    """Both alert tables in one frame: alert_id, alert_type, alert_timestamp,
    customer_name, status (``transaction_status`` of watchlist alerts)."""
    cols = ["alert_id", "alert_type", "alert_timestamp", "customer_name", "status"]
    if PARTITION_DATE in fraud_alerts.columns and PARTITION_DATE in high_value_alerts.columns:
        cols.append(PARTITION_DATE)
    f = fraud_alerts.withColumnRenamed("transaction_status", "status").select(*cols)
    return f.unionByName(high_value_alerts.select(*cols))


# D1
def rpt_high_risk_customers(customers: DataFrame, threshold: int = 70) -> DataFrame:
    return customers.filter(F.col("risk_score") > threshold).agg(F.count(F.lit(1)).alias("high_risk_count"))


# D2
def rpt_transactions_today(tx: DataFrame, as_of) -> DataFrame:
    return _on_day(tx, "transaction_timestamp", as_of).agg(F.count(F.lit(1)).alias("transaction_count"))


# D3
def rpt_avg_amount_today(tx: DataFrame, as_of) -> DataFrame:
    return _on_day(tx, "transaction_timestamp", as_of).agg(money_avg("amount").alias("avg_amount"))


# D4
def rpt_alerts_today(alerts: DataFrame, as_of) -> DataFrame:
    return _on_day(alerts, "alert_timestamp", as_of).agg(F.count(F.lit(1)).alias("alert_count"))


# D5
def rpt_alert_status(alerts: DataFrame, as_of) -> DataFrame:
    return (_since(alerts, "alert_timestamp", as_of, WEEK)
            .groupBy("status").agg(F.count(F.lit(1)).alias("alert_count")))


# D6
def rpt_top_customers(alerts: DataFrame, as_of, k: int = K.TOP_K) -> DataFrame:
    return (_since(alerts, "alert_timestamp", as_of, WEEK)
            .groupBy("customer_name").agg(F.count(F.lit(1)).alias("alert_count"))
            .orderBy(F.col("alert_count").desc(), F.col("customer_name").asc_nulls_last())
            .limit(k))


# D7
def rpt_alert_trends(alerts: DataFrame, as_of) -> DataFrame:
    ntz = is_ntz(alerts, "alert_timestamp")
    return (_since(alerts, "alert_timestamp", as_of, DAY)
            .groupBy(floor_to("alert_timestamp", "hour", ntz).alias("alert_hour"))
            .agg(F.count(F.lit(1)).alias("alert_count"))
            .orderBy("alert_hour"))


# D8
def rpt_alert_types(alerts: DataFrame, as_of) -> DataFrame:
    return (_since(alerts, "alert_timestamp", as_of, DAY)
            .groupBy("alert_type").agg(F.count(F.lit(1)).alias("alert_count")))


# D9
def rpt_volume_by_minute(tx: DataFrame, as_of) -> DataFrame:
    ntz = is_ntz(tx, "transaction_timestamp")
    return (_since(tx, "transaction_timestamp", as_of, DAY)
            .groupBy(floor_to("transaction_timestamp", "minute", ntz).alias("transaction_minute"))
            .agg(F.count(F.lit(1)).alias("transaction_count"))
            .orderBy("transaction_minute"))


# Grouped by the flag itself, so a null flag is a second "Domestic" row
def rpt_intl_vs_domestic(tx: DataFrame, as_of) -> DataFrame:
    return (_since(tx, "transaction_timestamp", as_of, WEEK)
            .groupBy("is_international").agg(F.count(F.lit(1)).alias("transaction_count"))
            .select(F.when(F.col("is_international") == F.lit(True), F.lit("International"))
                    .otherwise(F.lit("Domestic")).alias("transaction_type"),
                    "transaction_count"))


# D11
def rpt_top_merchants(tx: DataFrame, as_of, k: int = K.TOP_K) -> DataFrame:
    return (_since(tx, "transaction_timestamp", as_of, WEEK)
            .groupBy("merchant_name").agg(F.count(F.lit(1)).alias("transaction_count"))
            .orderBy(F.col("transaction_count").desc(), F.col("merchant_name").asc_nulls_last())
            .limit(k))


# D12
def rpt_amount_by_category(tx: DataFrame, as_of) -> DataFrame:
    return (_since(tx, "transaction_timestamp", as_of, WEEK)
            .groupBy("merchant_category").agg(money_sum("amount").alias("total_amount"))
            .orderBy(F.col("total_amount").desc_nulls_last()))


# D13
def rpt_payment_channels(tx: DataFrame, as_of) -> DataFrame:
    return (_since(tx, "transaction_timestamp", as_of, WEEK)
            .groupBy("payment_channel").agg(F.count(F.lit(1)).alias("transaction_count"))
            .orderBy(F.col("transaction_count").desc()))


# D14
def rpt_by_country(tx: DataFrame, as_of) -> DataFrame:
    return (_since(tx, "transaction_timestamp", as_of, WEEK)
            .groupBy("country").agg(F.count(F.lit(1)).alias("transaction_count"),
                                    money_sum("amount").alias("total_amount"))
            .orderBy(F.col("transaction_count").desc()))


# Status compared case-insensitively (sources write ACTIVE or active)
def rpt_watchlist_risk(watchlist: DataFrame) -> DataFrame:
    return (watchlist.filter(F.lower("status") == K.ACTIVE_WATCHLIST_STATUS)
            .groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("risk_level"))


def duplicate_transaction_ids(tx: DataFrame) -> DataFrame:
    """Transaction ids seen more than once (alert ids are then not unique)."""
    return (tx.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def dashboard(spark, layout, as_of: str) -> dict[str, DataFrame]:
    """All fifteen reports over a pipeline's tables (``streaming.flows.Layout``):
    silver transactions / customers / watchlist and the two gold alert tables.
    Date-partitioned tables are pruned by the reports' time filters."""
    def table(layer: str, name: str) -> DataFrame:
        return spark.read.parquet(layout.table(layer, name))

    tx = table("silver", "transactions")
    alerts = alerts_union(table("gold", "fraud_card_alert"), table("gold", "high_value_transactions_alert"))
    from vigil.streaming.flows import customers_table
    customers, watchlist = customers_table(spark, layout), table("silver", "fraud_watchlist")
    return {
        "high_risk_customers": rpt_high_risk_customers(customers),
        "total_transactions_today": rpt_transactions_today(tx, as_of),
        "avg_transaction_amount": rpt_avg_amount_today(tx, as_of),
        "total_alerts_today": rpt_alerts_today(alerts, as_of),
        "alert_status_distribution": rpt_alert_status(alerts, as_of),
        "top_customers_by_alerts": rpt_top_customers(alerts, as_of),
        "alert_trends": rpt_alert_trends(alerts, as_of),
        "alert_type_breakdown": rpt_alert_types(alerts, as_of),
        "transaction_volume_by_minute": rpt_volume_by_minute(tx, as_of),
        "intl_vs_domestic": rpt_intl_vs_domestic(tx, as_of),
        "top_merchants": rpt_top_merchants(tx, as_of),
        "transaction_by_merchant_category": rpt_amount_by_category(tx, as_of),
        "payment_channel_distribution": rpt_payment_channels(tx, as_of),
        "transactions_by_country": rpt_by_country(tx, as_of),
        "risk_level_distribution": rpt_watchlist_risk(watchlist),
    }
