import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pagemill.llm import bpe
from pagemill.llm.queries import QUERIES
from tests.llm.corners import TEXTS, corner_docs, no_docs

SF = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path):
    tool = Tokenizer.from_file(path)
    tool.no_truncation()
    tool.no_padding()
    return tool


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_like_the_library(name):
    rng = random.Random(4)
    letters = "aAbBeEoOtThHsS  \n\t'’.,!?0123456789Äöß漢字🙂́ΣςİÇ\x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(800)]
    texts += [t for _, t in TEXTS if t] + ["a" * 3000, "ab" * 999, "<|startoftext|>x <|ENDOFTEXT|> <|endoftext|>"]
    path = public_tokenizers.path(name)
    own, tool = bpe.Vocabulary(open(path, encoding="utf-8").read()), library(path)
    for text, ids in zip(texts, own.encode(texts), strict=True):
        expected = tool.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert own.decode(ids) == tool.decode(expected, skip_special_tokens=False)


def test_corners(spark):
    done = bpe.encode_decode(corner_docs(spark), WORDS)
    assert sorted(done.columns) == sorted(corner_docs(spark).columns)  # token_ids and decoded are replaced
    rows = done.collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        if not (row.text or "").strip():
            assert row.token_ids == b"" and row.decoded == ""
        assert row.key == "own key"
    assert bpe.encode(no_docs(spark), WORDS).count() == 0
    again = bpe.decode(bpe.encode(corner_docs(spark).select("text"), WORDS), WORDS)
    assert sorted(r.decoded for r in again.collect()) == sorted(r.decoded for r in rows)


def test_query(spark):
    tool = library(WORDS)
    expected = {}
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = tool.encode(row.text or "", add_special_tokens=False).ids
        text = tool.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), text.encode())]
        expected[row.doc_id] = (len(ids), *digests)
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op1_bpe"](spark, SF).collect()}
    assert got == expected
