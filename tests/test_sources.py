import glob
import json
import os
from datetime import datetime

import pytest

from vigil.schemas import WATCHLIST_COLUMNS
from vigil.sources import files as FS
from vigil.sources import jdbc, tables
from vigil.sources.kafka import topic_profile


def wl(spark, ids):
    rows = [tuple([i] + [None] * (len(WATCHLIST_COLUMNS) - 1)) for i in ids]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in WATCHLIST_COLUMNS))


def ids(df):
    return sorted(r.watchlist_id for r in df.collect())


def test_resume_after_highest_landed_id(spark):
    source = wl(spark, ["wl000001", "wl000002", "wl000003", "wl000010"])
    landed = wl(spark, ["WL000002", "junk", "wlxyz", None])
    assert ids(FS.watchlist_resume(source, landed)) == ["wl000003", "wl000010"]


def test_resume_without_valid_landed_id_starts_from_beginning(spark):
    source = wl(spark, ["wl000001", "wl000002"])
    assert ids(FS.watchlist_resume(source, wl(spark, ["junk"]))) == ["wl000001", "wl000002"]
    assert ids(FS.watchlist_resume(source, wl(spark, []))) == ["wl000001", "wl000002"]


def test_parse_watchlist_json_rescues_unknown_fields(spark):
    good = {"watchlist_id": "wl1", "entity_id": "5008514036965665", "risk_level": "high"}
    extra = dict(good, note="checked", score=7)
    df = spark.createDataFrame([(json.dumps(good), "f1"), (json.dumps(extra), "f2")], "value string, file_path string")
    rows = {r.file_path: r for r in FS.parse_watchlist_json(df).collect()}
    assert rows["f1"]._rescued_data is None
    assert json.loads(rows["f2"]._rescued_data) == {"note": "checked", "score": "7"}
    assert rows["f2"].entity_id == "5008514036965665"


def test_watchlist_csv_keeps_long_card_numbers_exact(spark, workdir):
    path = f"{workdir}/watchlist.csv"
    with open(path.replace("file:", ""), "w") as f:
        f.write(",".join(WATCHLIST_COLUMNS) + "\n")
        f.write("wl000001,CARD,5008514036965665,high,add,PH,x,ACTIVE,18-Jun-2026 09:00:00,SOC,Manual,India,Pune\n")
    row = FS.read_watchlist_csv(spark, path).collect()[0]
    assert row.entity_id == "5008514036965665" and row.effective_from == "18-Jun-2026 09:00:00"


def test_merchants_csv_round_trip(spark, workdir):
    df = spark.createDataFrame([("MER0001", "Shop", "grocery", "Pune", "India", "HIGH", True)],
                               "merchant_id string, merchant_name string, merchant_category string, city string, "
                               "country string, merchant_risk string, is_blacklisted boolean")
    FS.write_csv(df, f"{workdir}/merchants")
    back = FS.read_merchants_csv(spark, f"{workdir}/merchants").collect()[0]
    assert back.is_blacklisted is True and back.merchant_risk == "HIGH"


def test_publish_one_record_per_file_and_read_back(spark, workdir):
    landing = f"{workdir}/landing"
    FS.publish_watchlist_files(wl(spark, ["wl1", "wl2", "wl3"]), landing)
    back = FS.read_watchlist_files(spark, landing)
    assert back.select("file_path").distinct().count() == 3
    assert ids(back) == ["wl1", "wl2", "wl3"]


def tasks_of(landing):
    """Numbers of the tasks that wrote the files."""
    return {os.path.basename(f).split("-")[1] for f in glob.glob(landing.replace("file:", "") + "/part-*")}


def test_one_record_files_are_written_by_many_tasks(spark, workdir):
    """Before, by as few as the records had partitions: one for a small table."""
    names = [f"wl{i}" for i in range(40)]
    FS.publish_watchlist_files(wl(spark, names).coalesce(1), f"{workdir}/landing")
    assert ids(FS.read_watchlist_files(spark, f"{workdir}/landing")) == sorted(names)
    assert len(glob.glob(workdir.replace("file:", "") + "/landing/part-*")) == 40 and len(tasks_of(f"{workdir}/landing")) > 4


def test_infer_and_store_schema_is_reused(spark, workdir):
    landing = f"{workdir}/landing"
    FS.publish_watchlist_files(wl(spark, ["wl1"]), landing)
    schema_path = f"{workdir}/_schema"
    first = FS.infer_and_store_schema(spark, landing, schema_path)
    assert "watchlist_id" in first.fieldNames()
    FS.publish_watchlist_files(wl(spark, ["wl2"]).selectExpr("*", "'x' AS extra"), landing + "2")
    again = FS.infer_and_store_schema(spark, landing + "2", schema_path)
    assert again == first


def test_setup_namespaces(spark, workdir):
    created = tables.setup_namespaces(spark, workdir, {"vigil_bronze_t": "raw", "vigil_gold_t": "alerts"})
    assert created == ["vigil_bronze_t", "vigil_gold_t"]
    names = {d.name for d in spark.catalog.listDatabases()}
    assert {"vigil_bronze_t", "vigil_gold_t"} <= names


def test_snapshot_versions_switch_atomically(spark, workdir):
    path = f"{workdir}/customers"
    tables.write_snapshot(spark.createDataFrame([("C1", 1.0)], "customer_id string, x double"), path, "v1")
    assert tables.read_snapshot(spark, path).count() == 1
    tables.write_snapshot(spark.createDataFrame([("C1", 1.0), ("C2", 2.0)], "customer_id string, x double"),
                          path, "v2")
    assert tables.read_snapshot(spark, path).count() == 2
    assert tables.current_snapshot_path(spark, path).endswith("/v2")
    assert tables.current_snapshot_path(spark, f"{workdir}/nothing") is None
    with pytest.raises(Exception):
        tables.write_snapshot(spark.createDataFrame([("C3", 3.0)], "customer_id string, x double"), path, "v2")


def test_jdbc_options_partitioned_and_incremental():
    opts = jdbc.jdbc_options("jdbc:postgresql://db/x", "customers", user="u", password="p",
                             partition_column="id_num", lower_bound=0, upper_bound=1000, num_partitions=8)
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id_num" and opts["dbtable"] == "customers"
    q = jdbc.incremental_query("customers", "2024-01-01 00:00:00")
    assert "update_timestamp > TIMESTAMP '2024-01-01 00:00:00'" in q
    inc = jdbc.jdbc_options("jdbc:postgresql://db/x", "customers", query=q)
    assert inc["dbtable"].startswith("(SELECT") and inc["dbtable"].endswith("AS src")
    with pytest.raises(ValueError):
        jdbc.jdbc_options("u", "t", partition_column="id")


def test_topic_profile(spark):
    msgs = spark.createDataFrame([("t", 0, 5, datetime(2024, 1, 1)), ("t", 0, 9, datetime(2024, 1, 2)),
                                  ("t", 1, 3, datetime(2024, 1, 3))],
                                 "topic string, partition int, offset long, timestamp timestamp")
    prof = {r.partition: (r.message_count, r.first_offset, r.last_offset) for r in topic_profile(msgs).collect()}
    assert prof == {0: (2, 5, 9), 1: (1, 3, 3)}


def test_incremental_publish_resumes_from_the_landing_zone(spark, workdir):
    from conftest import SF_SMALL
    from vigil.sources import adapter as A
    landing = f"{workdir}/landing"
    source = A.watchlist_records(spark, SF_SMALL)
    total = source.count()
    assert FS.resume_from_landing(spark, source, landing).count() == total          # nothing landed yet
    first = source.orderBy("watchlist_id").limit(5)
    FS.publish_watchlist_files(first, landing)
    with open(landing.replace("file:", "") + "/junk.json", "w") as f:
        f.write("not json\n")
    rest = FS.resume_from_landing(spark, source, landing)
    assert rest.count() == total - 5
    FS.publish_watchlist_files(rest, landing)
    assert FS.resume_from_landing(spark, source, landing).count() == 0
    assert FS.read_watchlist_files(spark, landing).filter("watchlist_id IS NOT NULL").count() == total


def test_ship_package_once_per_application(spark):
    import glob
    import zipfile

    from vigil import session
    session._SHIPPED.discard(spark.sparkContext.applicationId)
    base = session.shared_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{base}/vigil/pyfiles-*/vigil.zip"))
    session.ship_package(spark)
    session.ship_package(spark)                       # second call: nothing new
    new = set(glob.glob(f"{base}/vigil/pyfiles-*/vigil.zip")) - before
    assert len(new) == 1
    names = zipfile.ZipFile(new.pop()).namelist()
    assert "vigil/streaming/stateful.py" in names and "vigil/__init__.py" in names


def test_bronze_watchlist_query_lands_its_files_by_many_tasks(spark):
    from vigil.plans.catalog import QUERIES
    from vigil.session import shared_dir

    base = shared_dir(spark).replace("file:", "") + "/vigil"
    before = set(glob.glob(f"{base}/bronze_watchlist-*"))
    rows = QUERIES["bronze_watchlist"](spark, "/root/testdata/sf0.01").count()
    (made,) = set(glob.glob(f"{base}/bronze_watchlist-*")) - before
    assert len(glob.glob(f"{made}/source/fraud_watchlist/part-*")) == rows and len(tasks_of(f"{made}/source/fraud_watchlist")) > 4
