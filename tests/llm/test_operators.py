"""Each operator against a plain version on small inputs with nulls, empty and long texts, ties, repeats and clashing columns."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm import brute
from vigil.llm import balltree, components, decontaminate, html_text, langid, mixing, neardup, pseudo_lm, scratch, substring, textops, toxicity, wavelet
from vigil.llm.queries import tokenizer_path

rng = random.Random(3)
VOCABULARY = ["the", "a", "Of", "to", "and", "in", "é", "x1", "run", "Sea"]


def prose(n, words=VOCABULARY):
    return " ".join(rng.choice(words) for _ in range(n))


WIDE = [f"w{i}" for i in range(400)]
BASE = prose(60, WIDE)
EDITED = " ".join(w if i % 25 else "new" for i, w in enumerate(BASE.split()))
LONG = prose(20_000, WIDE)
EDGE = [
    (1, BASE), (2, BASE), (3, EDITED), (4, None), (5, ""), (6, " \t\n "), (7, "one two"), (8, "One TWO"), (9, "***"),
    (10, LONG), (11, LONG + " tail"), (12, prose(30)), (12, prose(30)), (13, BASE), (13, BASE), (None, BASE), (None, None),
    (14, BASE.replace(" ", "\n")), (15, BASE + " " + prose(80, WIDE)), (16, "zz " * 300), (17, "zz " * 200),
]


def frame(spark, rows, columns="doc_id long, text string"):
    """With columns whose names an operator might use itself."""
    extra = ["key", "h", "n", "score", "lang_pred", "component_id", "_text", "c0", "rep", "f", "blob", "start", "copy"]
    df = spark.createDataFrame(rows, columns)
    return df.select("*", *(F.lit("own").alias(c) for c in extra if c not in df.columns)).repartition(3)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 1), (7, 7), (9, 8), (8, 20), (20, 11), (None, 4), (5, None)] + [(100, 100 + i) for i in range(50)] + [(200 + i, 201 + i) for i in range(30)]
    got = dict(rows(components.components(spark.createDataFrame(links, "a long, b long"))))
    want = {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 20: 8, 11: 8} | {100 + i: 100 for i in range(50)} | {200 + i: 200 for i in range(31)}
    assert got == want
    assert rows(components.components(spark.createDataFrame([], "a long, b long"))) == []


def test_word_hashes_are_equal_where_words_are():
    texts = ["a bb  a", "", None, " bb\ta ", "é a", "A"]
    data, at = textops.column_bytes(pa.array(texts))
    h, first = textops.word_hashes(data, at, lower=True)
    words = [w for t in texts for w in (t or "").lower().split()]
    assert list(np.diff(first)) == [3, 0, 0, 2, 2, 1]
    assert all((h[i] == h[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(len(words)))
    v = np.random.default_rng(0).integers(0, 50, 200).astype(np.uint64)
    assert all((textops.sliding_min(v, k) == [v[i: i + k].min() for i in range(201 - k)]).all() for k in (1, 2, 3, 7, 16, 26))


# 1
def mixing_rows():
    return [(i, ["a", "b", None, "c"][min(3, i % 7)], f"t{i}" if i % 5 else None) for i in range(200)] + [(None, "a", ""), (3, "c", "again"), (3, "c", "again")]


@pytest.mark.parametrize("weights, total", [(None, None), ({"a": 3, None: 1}, 500), ({"c": 1.0}, 20_000)])
def test_mixing(spark, weights, total):
    data = mixing_rows()
    out = mixing.mix(frame(spark, data, "doc_id long, source string, text string"), weights, total=total)
    assert out.columns[:3] == ["doc_id", "source", "text"] and out.columns[-1] == "copy"
    want = [(*r, c) for r, n in zip(data, brute.poisson_copies(data, weights, total)) for c in range(1, n + 1)]
    assert rows(out.select("doc_id", "source", "text", "copy")) == sorted(want, key=repr)


def test_mixing_keeps_columns_of_any_name(spark):
    data = mixing_rows()
    names = ["_source", "_cdf", "_u", "_count", "_order", "row", "u", "times", "place", "parts", "cdf", "a.b", "COPY"]
    df = spark.createDataFrame(data, "doc_id long, source string, text string").select("*", *(F.lit(f"own {c}").alias(c) for c in names))
    out = mixing.mix(df)
    assert out.columns == ["doc_id", "source", "text", *names[:-1], "copy"]
    want = sum(brute.poisson_copies(data))
    got = out.collect()
    assert len(got) == want and all([r[c] for c in names[:-1]] == [f"own {c}" for c in names[:-1]] for r in got)


def test_near_duplicates_link_every_text_of_a_doc_id(spark):
    a, b, c = prose(40, WIDE), prose(40, WIDE), prose(40, WIDE)
    data = [(2, a), (3, b), (4, c), (5, a), (5, b), (5, c), (6, c), (8, prose(40, WIDE)), (8, prose(40, WIDE))]
    out = rows(neardup.near_duplicates(frame(spark, data), width=4, percent=80).select("doc_id", "component_id", "kept"))
    assert out == [(2, 2, True), (3, 2, False), (4, 2, False), (5, 2, False), (5, 2, False), (5, 2, False), (6, 2, False), (8, 8, True), (8, 8, True)]


def test_toxicity_sample_is_bounded_on_repeated_ids(spark):
    docs = spark.range(2000).selectExpr("id % 2 AS doc_id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int")
    n = toxicity.sampled_features(docs, labels, 10).count()
    assert 1 <= n <= 40
    assert toxicity.sampled_features(docs.selectExpr("doc_id", "'same' AS text"), labels, 10).count() == 2


def test_mixing_rate_and_empty(spark):
    out = mixing.mix(spark.range(20_000).selectExpr("id AS doc_id", "if(id % 10 = 0, 'x', 'y') AS source"), {"x": 0.5, "y": 0.5})
    n = dict(out.groupBy("source").count().collect())
    assert abs(n["x"] - 10_000) < 500 and abs(n["y"] - 10_000) < 500
    assert rows(mixing.mix(spark.createDataFrame([], "doc_id long, source string, text string"))) == []


# 2
PAGES = [
    ("<p>Hello <b>wor</b>ld &amp; x &lt;b&gt; &#233;&nbsp;y</p>", "Hello world & x <b> é y"),
    ("<nav><a href=x>menu</a></nav><article><h1>T</h1><p>a<p>b <a href=x>l</a><div class='sidebar'>no</div><p>c<form><input>q</form><section id=comments><p>bad</section></article><footer>f</footer>", "T\n\na\n\nb l\n\nc"),
    ("<article><p>x < y and <3 </p></article><p>out</p>", "x < y and <3"),
    ("<form><article><p>in</p></article></form>", "in"),
    ("<article><p>one\n two<br>three<!-- <p>no</p> --><script>var t='</p>';</script><style>p{}</style></p><aside>no</aside></article>", "one two three"),
    ("<article><p>cut &am", "cut &am"), ("<article><p>cut <a hre", "cut"), ("<article></article><p>out", ""), ("", ""), (None, ""),
    ("<div class='cookie-notice'>no</div><div>" + "the man and the dog are in a house of the king. " * 6 + "</div><div>short one</div><div><a href=x>a link list</a></div>",
     ("the man and the dog are in a house of the king. " * 6).strip() + "\n\nshort one"),
]


def test_html(spark):
    data = [(i, None if i % 2 else "u", h) for i, (h, _) in enumerate(PAGES)] * 2 + [(None, None, None)]
    got = html_text.extract(frame(spark, data, "page_id long, url string, html string"))
    want = [(i, u, PAGES[i][1], len(PAGES[i][1])) if i is not None else (None, None, "", 0) for i, u, _ in data]
    assert rows(got) == sorted(want, key=repr)
    assert rows(html_text.extract(spark.createDataFrame([], "page_id int, url string, html string"))) == []


def test_html_second_pass():
    assert html_text.second_pass([True, None, None, None, False], [0] * 5, False) == [True, True, True, False, False]
    assert html_text.second_pass([None, None], [0, 0], False) == [True, True]


# 3
@pytest.mark.parametrize("width", [10, 4])
def test_decontamination(spark, width):
    items = [(1, prose(14, WIDE)), (2, prose(3)), (3, "Solo"), (4, None), (5, "..."), (1, BASE[:90]), (None, BASE[30:150]), (6, prose(11)), (7, LONG[-200:])]
    docs = EDGE + [(30 + i, prose(rng.randint(1, 60))) for i in range(25)] + [(60, f"x {items[0][1].upper()}, y solo"), (61, "SOLO"), (62, "zé" + items[1][1])]
    got = decontaminate.contamination(frame(spark, docs), frame(spark, items, "item_id long, text string"), width=width)
    assert rows(got) == sorted(brute.contamination(docs, items, width), key=repr)


def test_decontamination_beyond_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_BROADCAST", 0)
    items = [(1, BASE[10:160]), (2, prose(12))]
    got = decontaminate.contamination(frame(spark, EDGE), frame(spark, items, "item_id long, text string"))
    assert rows(got) == sorted(brute.contamination(EDGE, items, 10), key=repr)


def test_decontamination_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r[2] for r in rows(decontaminate.contamination(frame(spark, EDGE), none))] == [0] * len(EDGE)
    assert rows(decontaminate.contamination(frame(spark, EDGE).limit(0), frame(spark, [(1, "a")], "item_id long, text string"))) == []


# 4
def toxic_rows():
    docs = [(i, prose(rng.randint(5, 80), WIDE) + (" " + " ".join(rng.sample(["idiot", "scum", "moron"], 1 + i % 3)) if i % 5 == 0 else "")) for i in range(300)]
    return docs, [(i, 1 if i % 5 == 0 else 0) for i in range(0, 300, 2)] + [(1, None), (None, 1), (999, 1)]


def test_toxicity(spark):
    docs, labels = toxic_rows()
    out = toxicity.severity(frame(spark, docs + [(400, None), (401, ""), (402, "..."), (403, "You IDIOT, scum!"), (None, "scum")]), frame(spark, labels, "doc_id long, toxic int"))
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].toxic == (i % 5 == 0) for i in range(300))
    assert (got[400].severity, got[400].p_toxic, got[400].grade, got[400].toxic) == (0, 0, 0, False) == (got[401].severity, got[401].p_toxic, got[401].grade, got[401].toxic)
    assert not got[402].toxic and got[403].toxic and got[None].toxic
    assert got[0].severity > got[1].severity >= 0 and got[403].severity > got[None].severity


def test_toxicity_without_labels(spark):
    docs = frame(spark, EDGE)
    for labels in ([], [(1, 0), (3, 0)]):
        out = toxicity.severity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert {(r.severity, r.toxic) for r in out.collect()} == {(0.0, False)}
    assert toxicity.severity(docs.limit(0), spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_ordinal_fit_orders_grades():
    """The gradient of the cumulative-link likelihood finds shared weights whose scores order the grades."""
    r = np.random.default_rng(0)
    x = r.random((600, 3)) < 0.5
    grade = np.clip((x @ [2, 1, 0]) - (r.random(600) < 0.05), 0, 3).astype(int)
    row, feature = np.nonzero(x)
    w, theta = toxicity.fit(grade, row, feature, 3)
    assert w[0] > w[1] > abs(w[2]) and (np.diff(theta) > 0).all() and len(theta) == 3


# 5
def test_code_lengths_match_the_definition():
    samples = {"x": [("abracadabra " * 5).encode()], "y": [("the rain in spain é " * 4).encode()]}
    texts = ["abra the rain", "", "é qqq", "spain", "a", "zzz abracadabra in"]
    model = langid.train(samples, order=3, min_count=1)
    data, at = textops.column_bytes(pa.array(texts))
    got = langid.code_lengths(model, data, at)
    want = [[brute.code_length(samples[x][0], 3, t.encode()) for x in ("x", "y")] for t in texts]
    assert np.allclose(got, want, rtol=1e-5)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify(docs, docs.filter(~langid.held_out(F.col("doc_id"))), carry=["doc_id", "lang"]).filter(langid.held_out(F.col("doc_id")))
    right, n = out.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right / n > 0.97


def test_language_edges(spark):
    labelled = spark.createDataFrame([(1, "the house is the one", "en"), (2, "das haus ist das eine", "de"), (3, None, "en"), (4, "x", None)], "doc_id long, text string, lang string")
    out = langid.identify(frame(spark, EDGE + [(70, "the house"), (71, "das haus"), (72, "123 ---"), (73, "日本")]), labelled)
    assert out.columns[:2] == ["doc_id", "text"] and out.columns.count("score") == 1
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in out.collect()}
    assert got[70, "the house"][0] == "en" and got[71, "das haus"][0] == "de"
    assert all(got[k] == ("und", 0.0) for k in ((4, None), (5, ""), (9, "***"), (72, "123 ---"), (None, None)))
    assert got[73, "日本"][0] in ("de", "en") and all(0 <= s <= 1 for _, s in got.values())
    none = langid.identify(frame(spark, EDGE), labelled.limit(0))
    assert {r.lang_pred for r in none.collect()} == {"und"} and none.count() == len(EDGE)
    assert langid.identify(frame(spark, EDGE).limit(0), labelled).count() == 0


# 6
@pytest.mark.parametrize("width, percent", [(4, 80), (5, 80)])
def test_near_duplicates(spark, width, percent):
    family = prose(40, WIDE).split()
    docs = EDGE + [(100 + i, " ".join(w if rng.random() > 0.02 else "edit" for w in family)) for i in range(30)] + [(200 + i, prose(rng.randint(1, 6))) for i in range(30)]
    got = neardup.near_duplicates(frame(spark, docs), width=width, percent=percent)
    want = [(docs[i][0], *v) for i, v in brute.near_duplicates(docs, width, percent).items()]
    assert rows(got) == sorted(want, key=repr)


def test_near_duplicates_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    monkeypatch.setattr(scratch.broadcast_if_small, "__defaults__", (0,))
    family = prose(30, WIDE).split()
    docs = [(i, " ".join(w if rng.random() > 0.06 else "edit" for w in family)) for i in range(60)]
    got = neardup.near_duplicates(frame(spark, docs), width=4, percent=80)
    assert rows(got) == sorted(((docs[i][0], *v) for i, v in brute.near_duplicates(docs, 4, 80).items()), key=repr)


def test_near_duplicates_empty(spark):
    assert rows(neardup.near_duplicates(frame(spark, EDGE).limit(0))) == []
    assert rows(neardup.near_duplicates(frame(spark, [(1, None), (2, "")]))) == [(1, 0, 1, True), (2, 0, 2, True)]


# 7
def search_by_hand(data, k, scale):
    whole = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in data if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if i % 3 == 0:
            asked[i] = min(asked.get(i, (len(v), v)), (len(v), v))
    out = []
    for i, (n, q) in asked.items():
        clipped = ((max(min(sum(a * b for a, b in zip(q, v)), 2 ** 63 - 1), -2 ** 63), j) for j, v in whole if j != i and len(v) == n)
        out += [(i, r, j, s) for r, (s, j) in enumerate(sorted(clipped, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("big", [False, True])
def test_topk(spark, monkeypatch, big):
    monkeypatch.setattr(balltree, "SHARD_ROWS", 60)
    monkeypatch.setattr(balltree, "LEAF_ROWS", 8)
    monkeypatch.setattr(balltree, "QUERY_ROWS", 16)
    monkeypatch.setattr(balltree, "BLOCKS_A_TASK", 2)
    r = np.random.default_rng(1)
    centres = r.normal(0, 1, (5, 6))
    data = [(i, [float(x) for x in np.float32(centres[i % 5] + r.normal(0, 0.3, 6))]) for i in range(200)]
    data += [(200 + i, [0.5] * 6) for i in range(60)] + [(3, data[4][1]), (3, data[4][1]), (300, None), (301, [1.0, None]), (303, [float("nan")] * 6), (306, [float("inf")] * 6), (None, [1.0] * 6), (309, [1.0, 2.0]), (310, [2.0, 1.0]), (312, [])]
    data += [(315, [1e30, 1.0, 0.0, 0.0, 0.0, -1e30])] if big else []
    data = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in data]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").select("*", F.lit(1).alias("shard"), F.lit(2).alias("v")).repartition(4)
    got = balltree.nearest(df, F.col("vec_id") % 3 == 0, k=7, scale=64.0)
    assert rows(got) == search_by_hand(data, 7, 64.0)


def test_topk_empty_and_few(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert rows(balltree.nearest(none, F.col("vec_id") % 3 == 0, k=7, scale=64.0)) == []
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert rows(balltree.nearest(few, F.col("vec_id") == 0, k=7, scale=1.0)) == [(0, 1, 1, 2)]


# 8
def test_pseudo_likelihood(spark):
    docs = EDGE + [(80, "Mixed 12 w1, THE")]
    df = frame(spark, docs)
    scratch.ship_by_value()
    class_of = pseudo_lm.vocabulary(df)
    counts = pseudo_lm.triples(df, class_of)
    words = sum(len(brute.WORDS.findall(t or "")) for _, t in docs)
    assert counts.sum() == words
    log_p = pseudo_lm.train(counts)
    assert np.allclose(np.exp(log_p.astype(np.float64)).sum(1), 1, atol=1e-4)
    want = []
    for doc, text in docs:
        w = [t.translate(brute.LOWER) for t in brute.WORDS.findall(text or "")]
        data, at = textops.column_bytes(pa.array([x for x in brute.WORDS.findall(text or "")] or [""]))
        token = []
        for one in brute.WORDS.findall(text or ""):  # each word on its own
            _, t, _, _ = pseudo_lm.token_classes(*textops.column_bytes(pa.array([one])), class_of)
            token.append(int(t[0]))
        padded = [0, *token, 0]
        total = sum(float(log_p[padded[i] * pseudo_lm.VOCABULARY + padded[i + 2], padded[i + 1]]) for i in range(len(w)))
        want.append((doc, len(w), round(total, 2), len(w) == 0))
    got = [(r.doc_id, r.n_tokens, round(r.log_prob, 2), r.mean_log_prob is None) for r in pseudo_lm.score(df).collect()]
    assert len(got) == len(want)
    for g, e in zip(sorted(got, key=repr), sorted(want, key=repr)):
        assert g[:2] == e[:2] and g[3] == e[3] and abs(g[2] - e[2]) <= 0.02 + 1e-4 * abs(e[2])
    assert pseudo_lm.score(df.limit(0)).count() == 0


def test_network_prefers_what_the_corpus_holds():
    counts = np.zeros((6, 6, 6), np.int64)
    counts[1, 2, 3], counts[1, 4, 5], counts[2, 3, 1] = 900, 900, 100
    p = np.exp(pseudo_lm.train(counts))
    assert p[1 * 6 + 3, 2] > 0.8 and p[1 * 6 + 5, 4] > 0.8


# 9
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


ODD = ["", "a", " a", "a ", "a  b", " ", " \n x", "a\xa0b  c", "x 　y", "it's  don't 'tis", "\n\n a\n b", "tab\t x", "é è  ñ", "<|endoftext|> hi <|endoftext|>", "a\r\n b",
       None, " 123 45a6 ... !! ", "\x1c x \x1fy", "😀 😀😀 x", "a   b", "a \x85b", "a​ b"]


def test_encoder_matches_the_library():
    t, e = tokenizer(), wavelet.Encoder(tokenizer_path(), 2)
    r = random.Random(5)
    texts = ODD + ["".join(r.choice(" \n\ta1.'é\xa0　Ġ,") for _ in range(r.randint(0, 40))) for _ in range(1500)]
    got = []
    for ids, n in e.encode(pa.array(texts)):
        ends = np.cumsum(n)
        got += [ids[b - k: b].tolist() for b, k in zip(ends, n)]
    assert got == [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_wavelet_matrix():
    v = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    m = wavelet.WaveletMatrix.from_bytes(memoryview(wavelet.WaveletMatrix.build(v, 9).to_bytes()))
    assert (m.decode() == v).all()
    assert all(m.access(i) == v[i] for i in range(0, 5000, 37))
    for x in range(0, 320, 11):
        where = np.flatnonzero(v == x)
        assert m.count(x) == len(where) and m.count(x, 100, 4000) == ((where >= 100) & (where < 4000)).sum()
        assert [m.select(x, k) for k in (0, 3, 12, 40)] == [where[k] if k < len(where) else -1 for k in (0, 3, 12, 40)]
    empty = wavelet.WaveletMatrix.from_bytes(memoryview(wavelet.WaveletMatrix.build(v[:0], 9).to_bytes()))
    assert len(empty.decode()) == 0 and empty.count(3) == 0 and empty.select(3, 0) == -1


@pytest.mark.parametrize("shard_tokens", [1 << 20, 300])
def test_token_output(spark, workdir, shard_tokens):
    docs = EDGE + [(500 + i, t) for i, t in enumerate(ODD)]
    path = f"{workdir}/shards"
    wavelet.write_shards(frame(spark, docs), path, tokenizer=tokenizer_path(), end_id=2, shard_tokens=shard_tokens)
    assert rows(wavelet.read_documents(spark, path)) == sorted(brute.token_rows(docs, tokenizer(), 2), key=repr)
    shards = spark.read.parquet(path).collect()
    assert shard_tokens != 300 or max(r.seq for r in shards) >= 3


def test_token_output_empty(spark, workdir):
    wavelet.write_shards(frame(spark, EDGE).limit(0), f"{workdir}/none", tokenizer=tokenizer_path(), end_id=2)
    assert rows(wavelet.read_documents(spark, f"{workdir}/none")) == []


# 10
@pytest.mark.parametrize("window", [50, 8, 3])
def test_substring_dedup(spark, window):
    docs = EDGE + [(100 + i, prose(rng.randint(1, 60))) for i in range(25)] + [(0, prose(5, WIDE) + " " + LONG[200:900])]
    got = substring.remove_repeats(frame(spark, docs), window=window)
    assert rows(got) == sorted(brute.remove_repeats(docs, window), key=repr)


def test_substring_dedup_full_filter_and_no_broadcast(spark, monkeypatch):
    """With a filter that lets everything through, and all joins shuffled, the result is the same."""
    monkeypatch.setattr(substring, "BITS_PER_HASH", 0)
    monkeypatch.setattr(scratch.broadcast_if_small, "__defaults__", (0,))
    got = substring.remove_repeats(frame(spark, EDGE), window=20)
    assert rows(got) == sorted(brute.remove_repeats(EDGE, 20), key=repr)


def test_substring_dedup_without_repeats(spark):
    docs = [(1, LONG), (2, prose(100, WIDE)), (3, None)]
    assert rows(substring.remove_repeats(frame(spark, docs))) == sorted(brute.remove_repeats(docs, 50), key=repr)
    assert rows(substring.remove_repeats(frame(spark, docs).limit(0))) == []
