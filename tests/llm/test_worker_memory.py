"""What Python workers keep between tasks, and what is sent to them."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from vigil.llm import langid
from vigil.llm.scratch import giving_back


def resident_mb():
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


def test_a_worker_gives_back_what_its_task_took():
    last = []

    def run(batches):
        for batch in batches:
            held = [np.ones(60_000, np.uint8) for _ in range(4_000)]  # 240 MB in parts that malloc takes from its heap
            last.append(held[-1])  # what lives on at the heap's end keeps it from shrinking by itself
            del held
            yield batch

    before = resident_mb()
    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["x"])
    assert [b.num_rows for b in run(iter([batch]))] == [1]
    kept = resident_mb() - before
    assert [b.num_rows for b in giving_back(run)(iter([batch, batch]))] == [1, 1]
    assert kept > 150 and resident_mb() - before < 50


def test_language_stage_sends_a_text_once(spark):
    docs = spark.createDataFrame([(1, "the house", "en"), (2, "das haus", "de"), (3, None, None)], "doc_id long, text string, lang string")
    for carry, times in ((None, 1), (["doc_id"], 1), (["text", "doc_id"], 1)):
        out = langid.identify(docs, docs, carry=carry)
        sent = out._jdf.queryExecution().analyzed().toString().split("MapInArrow")[1]
        assert len(re.findall(r"\btext#\d+L? AS ", sent.split("\n")[1])) == times
        assert out.agg(F.count("*")).first()[0] == 3
