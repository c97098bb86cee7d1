import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from perptide.llm import bpe

PATH = public_tokenizers.path(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.Vocabulary(PATH, most=500)


def ids(encoded):
    return np.frombuffer(encoded, "<u4").tolist()


ODD = [
    "", " ", "  ", "\n\n \t", "a", "aaaaaaa", "I'm you'll they've 'sx 's", "\x00\x1c\x1f\x85  　x",
    "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "  <|endoftext|>  ", "�﻿​",
    "é \U0001f469‍\U0001f469 \U0010ffff", "12 3456789 ١٢ Ⅰ ½", "ക്ഷ 힣 中文",
]


def samples(seed, n):
    rng = random.Random(seed)
    kinds = ["ab", "aA bB", "aaaa ", "'s't ve", "é中\U0001f600 a", "01 \n\t\r", "\x85   x", "etaoin shrdlu "]
    for _ in range(n):
        letters = "".join(rng.sample(kinds, rng.randint(1, 3)))
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))
        if rng.random() < 0.2:
            text = text[:9] + "<|endoftext|>" + text[9:]
        if rng.random() < 0.3:
            points = [rng.randrange(0x20000) for _ in range(12)]
            text += "".join(chr(c) for c in points if not 0xD800 <= c < 0xE000)
        yield text


def test_equal_to_the_library(library, own):
    for text in [*ODD, *samples(1, 4000)]:
        expected = library.encode(text, add_special_tokens=False).ids
        encoded = own.encode(text)
        assert ids(encoded) == expected, repr(text)
        assert own.decode(encoded) == library.decode(expected, skip_special_tokens=False)


def test_every_character_is_parted_as_in_the_library(library, own):
    for start in range(0, 0x110000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1{c}!{c}{c} {c}" for c in chars)
        assert [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)] == own._split(text)


def test_every_token_encodes_to_itself(own):
    for i, token in own.bytes_of.items():
        if token.decode("latin-1") not in own.added:
            assert own.piece_ids(token) == [i]


def test_long_pieces(library, own):
    rng = random.Random(2)
    for text in ("a" * 100_000, "".join(rng.choice("abcdefghij") for _ in range(100_000)), " " * 50_000 + "x"):
        assert ids(own.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_decoding_of_any_ids(library, own):
    rng = random.Random(4)
    for _ in range(300):
        chosen = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert own.decode(np.array(chosen, "<u4").tobytes()) == library.decode(chosen, skip_special_tokens=False)
    assert own.decode(np.array([70000, 64], "<u4").tobytes()) == "a"
    assert own.decode(None) == own.decode(b"") == ""


def test_tables(spark, documents, library):
    texts = [None, *ODD, ODD[5], "word " * 40_000, *samples(3, 100)]
    docs = documents([(i, t, "s") for i, t in enumerate(texts)])
    rows = bpe.decoded(bpe.encoded(docs), keep=["doc_id", "ids", "node"]).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        expected = library.encode(text or "", add_special_tokens=False).ids
        assert ids(row["ids"]) == expected and row["decoded"] == (text or "") and row["node"] == "x"
    digest = bpe.encoded(docs, keep=["doc_id"]).where("doc_id = 3").select(F.sha2("ids", 256)).first()[0]
    assert digest == hashlib.sha256(rows[3]["ids"]).hexdigest()
    assert bpe.decoded(bpe.encoded(documents([]))).count() == 0
    with pytest.raises(ValueError, match="already"):
        bpe.encoded(docs, ids="NODE")
