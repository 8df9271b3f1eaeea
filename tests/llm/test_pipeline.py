"""The pipeline against its stages' plain versions, and the SQL of the registered queries."""

import duckdb
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from llm import brute
from llm.test_operators import rows, tokenizer
from vigil.llm.queries import ORACLE, QUERIES


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    left = [tuple(r) for r in docs if r.text is not None and any(c.isalpha() for c in r.text)]
    kept = brute.near_duplicates([r[:2] for r in left], 5, 80)
    left = [r for i, r in enumerate(left) if kept[i][2]]
    hit = {r[0] for r in brute.contamination([r[:2] for r in left], items, 10) if r[-1]}
    left = [r for r in left if r[0] not in hit]
    assert 0 < len(hit) and len(left) < len(docs)
    copies = brute.poisson_copies([(r[0], r[2]) for r in left])
    mixed = [r[:2] for r, n in zip(left, copies) for _ in range(n)]
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert rows(got) == sorted(brute.token_rows(mixed, tokenizer(), 2), key=repr)


def test_rows_are_judged_by_their_own_text(spark, tmp_path):
    """Null and repeated doc_ids, against the plain versions by row."""
    item = "what is the name of the river that runs through the old town of basel today"
    clean = [f"{w} told me about the " + " ".join(f"{w}{i}" for i in range(20)) for w in ("anna", "bert", "carl", "dora", "emil", "fred")]
    dirty = ["someone asked " + item + " and left", "again somebody asked " + item + " but he stayed with us"]
    data = [(7, clean[0]), (7, dirty[0]), (None, clean[1]), (None, dirty[1]), (3, clean[2]), (3, clean[2]), (2, clean[2] + " end"), (None, clean[2]),
            (9, clean[3]), (9, clean[4]), (9, clean[3] + " end"), (None, clean[5]), (None, clean[5]), (11, None), (12, ""), (13, "12 ?")]
    rows_ = [(i, t, "en", "s", len(t or "")) for i, t in data]
    spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")

    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    groups = brute.near_duplicates([(i, t) for i, (_, t) in enumerate(data)], 5, 80)
    best = {}
    for i, (doc, _) in enumerate(data):
        c = groups[i][1]
        best[c] = min(best.get(c, (True, 0, i)), (doc is None, doc or 0, i))
    want = [data[i] for _, _, i in best.values()]
    assert sorted((i for i, _ in got), key=repr) == sorted((i for i, _ in want), key=repr) and set(got) <= set(data) and (2, clean[2] + " end") in got
    assert len({t.removesuffix(" end") if t else t for _, t in got}) == len({t.removesuffix(" end") if t else t for _, t in data}) and len(got) < len(data)
    again = corpus_pipeline.near_duplicates(spark, docs.limit(100).select("*", F.lit(1).alias("_row")), str(tmp_path)).select("doc_id", "text")
    assert [i for i, _ in rows(again)] == [i for i, _ in got]                    # not read straight from files

    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert rows(left.select("doc_id", "text")) == sorted((r for r in data if r[1] not in dirty), key=repr)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_SMALL).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0


def test_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, SF_SMALL)
        want = con.execute(sql)
        assert got.columns == [d[0] for d in want.description]
        assert rows(got) == sorted(want.fetchall(), key=repr), name
