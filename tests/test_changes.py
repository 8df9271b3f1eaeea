"""The change table as a streaming source: marks, overlap, late commits, restarts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from vigil.sources.changes import ChangeReader, read_changes
from vigil.sources.tables import read_snapshot
from vigil.streaming.flows import Layout, Pipeline

def schema_with(kind):
    return StructType([StructField("customer_id", StringType()), StructField("v", IntegerType()), StructField("update_timestamp", kind)])


SCHEMA = schema_with(TimestampNTZType())


@pytest.fixture()
def change_table(spark, workdir):
    def commit(rows, kind="timestamp_ntz"):
        df = spark.createDataFrame(rows, "customer_id string, v int, update_timestamp string")
        df.withColumn("update_timestamp", F.col("update_timestamp").cast(kind)).repartition(3).write.mode("append").parquet(f"{workdir}/t")

    return commit


def drain(spark, workdir, schema=SCHEMA, **kw):
    q = (read_changes(spark, f"{workdir}/t", schema, **kw).writeStream.format("parquet").option("path", f"{workdir}/out")
         .option("checkpointLocation", f"{workdir}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return sum(p["numInputRows"] for p in q.recentProgress), sorted(map(tuple, spark.read.parquet(f"{workdir}/out").select("customer_id", "v").collect()), key=repr)


def test_each_change_is_read_once(spark, workdir, change_table):
    first = [(f"C{i:02}", i, "2024-01-01 00:00:00") for i in range(60)]
    change_table(first)
    assert drain(spark, workdir) == (60, sorted((r[:2] for r in first), key=repr))
    assert drain(spark, workdir)[0] == 0                                   # a restart reads nothing again
    change_table([("C01", 100, "2024-01-02 00:00:00"), ("C02", 100, "2024-01-02 00:00:00.000001")])
    read, rows = drain(spark, workdir)
    assert read == 62 and len(rows) == 62                                  # the first load stands within the overlap: removed
    # committed late: within the overlap it is read, the rows read before are removed; beyond it is not seen
    change_table([("C03", 100, "2024-01-01 23:30:00"), ("C04", 100, "2024-01-01 22:00:00")])
    read, rows = drain(spark, workdir)
    assert read == 3 and len(rows) == 63 and ("C03", 100) in rows and ("C04", 100) not in rows
    change_table([("C05", 7, "2024-01-02 00:00:00"), ("C01", 100, "2024-01-02 00:00:00"), (None, 1, "2024-01-02 00:00:01"), ("no time", 1, None)])
    read, rows = drain(spark, workdir)                                     # same mark time, a repeated row, no key, no time
    assert len(rows) == 65 and ("C05", 7) in rows and (None, 1) in rows and ("no time", 1) not in rows
    assert drain(spark, workdir)[0] == 0


def test_empty_table_and_zoned_times(spark, workdir, change_table):
    schema = schema_with(TimestampType())
    change_table([], "timestamp")
    q = read_changes(spark, f"{workdir}/t", schema)
    assert q.isStreaming and q.columns == schema.names
    change_table([("a", 1, "2024-01-01 00:00:00")], "timestamp")
    assert drain(spark, workdir, schema) == (1, [("a", 1)])


def test_splits_are_row_groups_that_can_hold_wanted_rows(spark, workdir, change_table):
    for day in range(1, 6):
        change_table([(f"C{i}", day, f"2024-01-0{day} 00:00:00") for i in range(9)])
    options = {"path": f"{workdir}/t", "timecolumn": "update_timestamp", "keycolumn": "customer_id", "partitions": "2"}
    reader = ChangeReader(SCHEMA, options)
    end = reader.latestOffset()
    assert end["key"] == "C8" and end["recent"] == 9
    day4 = {"time": str(int(end["time"]) - 86_400_000_000), "key": "C8", "recent": 9}
    some, whole = reader.partitions(day4, end), reader.partitions(reader.initialOffset(), end)
    assert len(some) < len(whole) and sum(b.num_rows for s in some for b in reader.read(s)) == 18   # day 4 again, day 5
    assert reader.partitions(end, end) == []


def test_changes_flow_into_the_snapshot(spark, workdir, change_table):
    layout = Layout(workdir)
    p = Pipeline(spark, layout)
    schema = SCHEMA

    def run():
        p.customers_incremental(f"{workdir}/t", schema)
        p.customers_upsert(spark.readStream.schema(schema).parquet(layout.table("bronze", "customer_changes")))
        return {r.customer_id: r.v for r in read_snapshot(spark, layout.table("bronze", "customers")).collect()}

    change_table([("a", 1, "2024-01-01 00:00:00"), ("b", 1, "2024-01-01 00:00:00")])
    assert run() == {"a": 1, "b": 1}
    change_table([("b", 2, "2024-01-03 00:00:00")])
    assert run() == {"a": 1, "b": 2}
    change_table([("a", 3, "2024-01-02 23:30:00"), ("b", 0, "2024-01-02 23:30:00")])     # late: b's row is older than b's
    assert run() == {"a": 3, "b": 2}
