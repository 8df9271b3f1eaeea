"""Token output against an untouched tokenizer: strings of added tokens in a text get their ids."""

import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from llm import brute
from llm.test_operators import EDGE, ODD, frame, rows
from vigil.llm import wavelet
from vigil.llm.queries import QUERIES, tokenizer_path

END = "<|endoftext|>"
TEXTS = [f"a {END} b", END, END + END, f" {END} {END}", f"a  {END}  b", f"{END}\n x", f"x\n{END}\ny", f"a1{END}2b.{END}.", f" \n{END} ", "<|endof", "text|> x", f"<|{END}|>", END[:-1], f" {END}"]


def test_encoder_matches_the_untouched_library():
    t, e = Tokenizer.from_file(tokenizer_path()), wavelet.Encoder(tokenizer_path(), 2, added_tokens=True)
    r = random.Random(7)
    some = [END, END, " ", " ", "\n", "a", "B1", ".", "é", "\xa0", "<|endof", "text|>", " \n"]
    texts = ODD + TEXTS + ["".join(r.choices(some, k=r.randint(0, 14))) for _ in range(3000)]
    got = []
    for ids, n in e.encode(pa.array(texts)):
        ends = np.cumsum(n)
        got += [ids[b - k: b].tolist() for b, k in zip(ends, n)]
    assert got == [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_registered_token_outputs(spark, workdir):
    docs = EDGE + [(500 + i, t) for i, t in enumerate(TEXTS)]
    frame(spark, docs).write.parquet(f"{workdir}/documents.parquet")
    want = sorted(brute.token_rows(docs, Tokenizer.from_file(tokenizer_path()), 2), key=repr)
    assert rows(QUERIES["op9_token_output"](spark, str(workdir))) == want
    assert rows(corpus_pipeline.tokens(spark, frame(spark, docs), str(workdir))) == want
