"""BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskweave.llm import bpe, queries
from tests.conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return bpe.Vocabulary(PATH), Tokenizer.from_file(PATH)


def same(both, text):
    mine, theirs = both
    ids = theirs.encode(text, add_special_tokens=False).ids
    packed = mine.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids, text
    assert mine.decode(packed).decode("utf-8", "replace") == theirs.decode(ids, skip_special_tokens=False)


def test_random_texts(both):
    rng = random.Random(3)
    letters = " \t\n\r\x0b\x0c\x1c\x85\xa0 'sdtrevml019²¼abcXYZ_-.,!<|éßñ你好😀́​ǅ"
    for _ in range(3000):
        same(both, "".join(rng.choice(letters) for _ in range(rng.randrange(40))))


def test_joined_tokens_and_special_tokens(both):
    rng = random.Random(4)
    words = [t.decode("utf-8", "replace") for t in both[0].tokens]
    for _ in range(3000):
        same(both, "".join(rng.choice(words) for _ in range(3)))
    for text in ("<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext", "a" * 3000, " " * 999, "ab" * 700, "=-" * 400):
        same(both, text)


def test_every_token_encodes_to_itself(both):
    mine = both[0]
    for i in range(len(mine.tokens) - 1):
        assert mine._apart(*mine.parts[i]) is False if i in mine.parts else True


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (2, "", "k"), (3, "hi there", "k")], "doc_id int, text string, ids string")
    rows = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted((r.doc_id, len(r.ids) // 4, r.decoded) for r in rows) == [(1, 0, ""), (2, 0, ""), (2, 0, ""), (3, 2, "hi there")]
    assert bpe.round_trip(df.limit(0), PATH).count() == 0


def test_query(spark, both):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op8_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = both[1].encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(both[1].decode(ids, skip_special_tokens=False).encode()).hexdigest()
