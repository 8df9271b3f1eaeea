"""The bucketed snapshot: touched buckets only, retries, two writers, readers of older manifests."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vigil.sources.buckets import BucketedSnapshot


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, v int, update_timestamp string").withColumn("update_timestamp", F.to_timestamp("update_timestamp"))


@pytest.fixture()
def snapshot(spark, workdir):
    s = BucketedSnapshot(spark, f"{workdir}/customers", "customer_id", "update_timestamp")
    s.create(customers(spark, [(f"C{i}", 0, "2024-01-01") for i in range(200)] + [("C1", -1, "2023-12-31"), (None, 0, "2024-01-01")]), buckets=16)
    return s


def contents(df):
    return sorted(((r.customer_id, r.v) for r in df.collect()), key=repr)


def test_only_touched_buckets_are_rewritten(spark, snapshot):
    first = snapshot.manifest()
    assert len(first.folders) == 16 and snapshot.read().count() == 201
    older = snapshot.read(first)
    changes = customers(spark, [("C1", 1, "2024-01-02"), ("C1", 2, "2024-01-03"), ("new", 9, "2024-01-02"), ("C2", 5, "2023-01-01"), ("C3", 7, "2024-01-01"), (None, 4, "2024-02-01")])
    touched = snapshot.merge(changes)
    second = snapshot.manifest()
    assert second.number == 1 and 1 <= len(touched) <= 5
    assert {b for b in range(16) if first.folders[b] != second.folders[b]} == set(touched)
    want = {f"C{i}": 0 for i in range(200)} | {"C1": 2, "new": 9, "C3": 7, None: 4}      # C2's change is older; C3's has the same time
    assert contents(snapshot.read()) == sorted(want.items(), key=repr)
    assert older.count() == 201 and contents(snapshot.read(first))[0] == ("C0", 0)
    # a file for each touched bucket
    assert len([f for f in snapshot.read().inputFiles() if any(f"/{x.split('/')[-2]}/" in f for x in (second.folders[b] for b in touched))]) == len(touched)


def test_a_labelled_merge_is_done_once_and_empty_changes_touch_nothing(spark, snapshot):
    changes = customers(spark, [("C1", 1, "2024-01-02")])
    assert snapshot.merge(changes, "query/0") and snapshot.merge(changes, "query/0") == []
    assert snapshot.manifest().number == 1
    before = snapshot.manifest().folders
    assert snapshot.merge(changes.limit(0), "query/1") == [] and snapshot.manifest().folders == before
    assert snapshot.read().count() == 201


def test_the_second_of_two_writers_fails(spark, snapshot):
    other = BucketedSnapshot(spark, snapshot.path, "customer_id", "update_timestamp")
    stale = other.manifest()
    snapshot.merge(customers(spark, [("C1", 1, "2024-01-02")]))
    other.manifest = lambda: stale
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        other.merge(customers(spark, [("C1", 8, "2024-01-04")]))
    assert dict(contents(snapshot.read()))["C1"] == 1


def test_nothing_published(spark, workdir):
    s = BucketedSnapshot(spark, f"{workdir}/none", "customer_id", "update_timestamp")
    assert s.manifest() is None
    with pytest.raises(FileNotFoundError):
        s.read()
