"""Typed inference over the lattice of kinds, the schema store, and records read under a grown schema."""

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from vigil.sources.evolution import BIT, KINDS, SchemaStore, evolving_writer, infer, join_of, read_evolved
from vigil.streaming.flows import Layout, Pipeline


def lines(spark, *records):
    return spark.createDataFrame([(r if r is None or isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def kinds(df):
    return {r.name: {k for k in KINDS if r.kinds & BIT[k]} for r in infer(df).collect()}


def test_join_is_a_join():
    masks = range(1 << len(KINDS))
    order = {"string": 9}
    assert join_of(0) == join_of(BIT["null"]) == "string"
    assert join_of(BIT["long"] | BIT["double"] | BIT["null"]) == "double"
    assert join_of(BIT["long"] | BIT["boolean"]) == join_of(BIT["timestamp"] | BIT["long"]) == "string"
    for a in masks:
        for b in masks:       # never narrower than either side
            wide, one = join_of(a | b), join_of(a)
            assert wide == one or order.get(wide) or (one, wide) == ("long", "double") or not a & ~BIT["null"]


def test_kinds_of_fields(spark):
    df = lines(spark, {"a": 1, "b": "4000000000000001", "c": None, "D": True, "t": "01-Jan-2024 10:00:00"},
               {"a": 2.5, "b": "x", "c": {"x": 1}, "d": False, "t": "2024-01-02T03:04:05Z", "big": 10 ** 30, "f": 1e300, "o'k": 1},
               "not json", "[1, 2]", "7", "", None, '{"a": 1, "a": 2}', {})
    assert kinds(df) == {"a": {"long", "double"}, "b": {"string"}, "c": {"null", "string"}, "d": {"boolean"}, "t": {"timestamp"},
                         "big": {"string"}, "f": {"double"}, "o'k": {"long"}}
    spelled = {r.name: r.spellings for r in infer(df).collect()}
    assert spelled["d"] == ["D", "d"] and kinds(df.limit(0)) == {}


def evolve(spark, workdir, *batches, first=0):
    store = SchemaStore(spark, f"{workdir}/schemas")
    write = evolving_writer(f"{workdir}/out", store, lambda: "q")
    for i, records in enumerate(batches, first):
        write(lines(spark, *records), i)
    return store


def test_records_are_read_under_the_newest_schema(spark, workdir):
    store = evolve(spark, workdir, [{"id": 1, "n": 1, "s": 1.50, "x": None}, {"id": 2, "n": None, "s": 2}],
                   [{"id": 3, "n": 2.5, "s": "three", "new": "2024-01-01 00:00:00"}, "broken {"],
                   [{"ID": 4, "x": {"deep": [1, "é"]}, "new": "2024-01-02 00:00:00"}])
    df = read_evolved(spark, f"{workdir}/out", store)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema if not f.name.startswith("_")] == [
        ("id", "bigint"), ("n", "double"), ("new", "timestamp"), ("s", "string"), ("x", "string")]
    got = {r.id: tuple(r)[1:5] for r in df.collect()}
    day = lambda d: datetime(2024, 1, d)
    assert got == {1: (1.0, None, "1.5", None), 2: (None, None, "2", None), 3: (2.5, day(1), "three", None),
                   4: (None, day(2), None, '{"deep":[1,"é"]}'), None: (None, None, None, None)}
    assert {r._record for r in df.filter("id IS NULL").collect()} == {"broken {"}
    assert sorted(store.versions()) == [1, 2, 3] and store.newest()[0] == 3


def test_a_retried_batch_and_known_fields_make_no_version(spark, workdir):
    store = evolve(spark, workdir, [{"a": 1}], [{"a": 2}], [])
    assert list(store.versions()) == [1]
    evolve(spark, workdir, [{"a": 2}], first=1)                        # batch 1 again
    assert sorted(r.a for r in read_evolved(spark, f"{workdir}/out", store).collect()) == [1, 2]
    evolve(spark, workdir, [{"a": 0.5}], first=2)                      # the empty batch 2 comes again, wider
    evolve(spark, workdir, [{"a": 2}], first=1)                        # batch 1 a third time, now under version 2
    df = read_evolved(spark, f"{workdir}/out", store)
    assert sorted(r.a for r in df.collect()) == [0.5, 1.0, 2.0]


def test_store_versions_are_written_once_and_bounded(spark, workdir):
    evolve(spark, workdir, [{"a": 1}])
    store = SchemaStore(spark, f"{workdir}/schemas")
    store.newest = lambda: (0, [])                                     # a writer that hasn't seen version 1
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        store.merge(infer(lines(spark, {"b": 1})))
    with pytest.raises(ValueError, match="fields"):
        SchemaStore(spark, f"{workdir}/schemas", most_fields=3).merge(infer(lines(spark, {f"k{i}": 1 for i in range(5)})))


def test_a_running_flow_takes_up_new_columns(spark, workdir):
    layout = Layout(workdir)
    p = Pipeline(spark, layout, max_files_per_trigger=1)
    for i, record in enumerate([{"id": 1}, {"id": 2, "note": "seen"}, {"id": 2.5}]):
        lines(spark, record).coalesce(1).write.mode("append").text(layout.landing("watchlist"))
    q = p.bronze_watchlist_evolving(layout.landing("watchlist"))
    assert len([x for x in q.recentProgress if x["numInputRows"]]) == 3
    got = p.watchlist_typed()
    assert sorted(((r.id, r.note) for r in got.collect()), key=repr) == [(1.0, None), (2.0, "seen"), (2.5, None)]
    assert got.filter("_source_file IS NULL").isEmpty()
