"""Words that the encoder gives to the model by themselves, against the library."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import AddedToken, Tokenizer, normalizers, pre_tokenizers

from vigil.llm import wavelet
from vigil.llm.queries import tokenizer_path


def same_as_library(path, texts, added=True):
    t, e = Tokenizer.from_file(str(path)), wavelet.Encoder(str(path), 2, added_tokens=added)
    got, words = [], []
    some = e._ids
    e._ids = lambda x, *of: (words.extend(x) if of and of[0] is not None else None, some(x, *of))[1]
    for ids, n in e.encode(pa.array(texts)):
        got += [ids[b - k: b].tolist() for b, k in zip(np.cumsum(n), n)]
    assert got == [[*t.encode(x, add_special_tokens=False).ids, 2] for x in texts]
    return [w for x in words for w in x.split(" ")]


def test_plain_words_go_to_the_model_once_each():
    r = random.Random(3)
    made = ["".join(r.choices("etaoinshrdluETA", k=r.randint(1, 14))) for _ in range(3000)]
    texts = [" ".join(r.choices(made, k=60)) + r.choice([".", " é x", " don't we're 'tis", "\n", " naïve Ġx", " x1 y"]) for _ in range(200)]
    words = same_as_library(tokenizer_path(), texts)
    assert len(words) == len(set(words)) > 2500 and {w[0] for w in words} == {"Ġ"} and all(w[1:].isascii() and w[1:].isalpha() for w in words)


@pytest.mark.parametrize("change", ["normalizer", "digits", "letters"])
def test_other_tokenizers_get_whole_pieces(tmp_path, change):
    t = Tokenizer.from_file(tokenizer_path())
    if change == "normalizer":
        t.normalizer = normalizers.Lowercase()
    elif change == "digits":
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Digits(), t.pre_tokenizer])
    else:
        t.add_tokens([AddedToken("pad", normalized=False)])
    t.save(str(tmp_path / "t.json"))
    assert same_as_library(tmp_path / "t.json", ["A padded Word and 12 more", " pad it", "the pad pad stays"]) == []
