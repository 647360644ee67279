import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from statlake.llm.pieces import PieceBpe, decoded_texts, encode_pieces, encoded_ids

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a", "aa", "the", "  ", "   ", " ", "\n", "\n\n", "\t", "▁", "▁▁", "é", "中文", "😀", "<s>", "</s>", "<0x0A>",
    "<unk>", "\x00", "ﬁ", "ing", "ation", "\r\n", "0", "123", " " * 20, "x" * 20, "ab" * 9, " the",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as file:
        return PieceBpe(file.read())


def test_odd_texts_against_the_library(own, library):
    rng = random.Random(2)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += ["".join(rng.choice("abcdeinorst  \n") for _ in range(40)) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(9))
              for _ in range(2000)]
    for text in texts:
        ids = library.encode(text)
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids)


def test_words_without_a_table(own, library, monkeypatch):
    """Words whose letters all have pieces need neither the prefix table nor merges of pairs."""

    def unwanted(*_):
        raise AssertionError("by table or by merging")

    rng = random.Random(5)
    parts = ["the", "an", "re", "ing", "ble", "tion", "ou", "er", "sh", "wh", "aa", "a", "aaa", "ly", "Th", ".", "ﬁ", "é"]
    words = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(5000)]
    words = [w for w in words if all(letter in own.ids for letter in w)]
    monkeypatch.setattr(own, "by_table", unwanted)
    monkeypatch.setattr(own, "merged", unwanted)
    assert len(words) > 1000
    for word in words:
        assert own.encode(word) == library.encode(word)


def test_any_ids_decode_as_in_the_library(own, library):
    rng = random.Random(3)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(259), rng.randrange(32_000)]) for _ in range(rng.randrange(9))]
        assert own.decode(ids) == library.decode(ids)


def test_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(-1, None), (-2, ""), (-3, "word  " * 400_000), (-4, "x" * 50_000), (-5, "a b"), (-5, "a b"), (-6, " ")]
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema)).withColumn("n_tokens", F.lit("old"))
    for r in encode_pieces(docs, PATH).collect():
        ids = library.encode(r.text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    back = decoded_texts(encoded_ids(docs, PATH), PATH).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    assert encode_pieces(docs.limit(0), PATH).count() == 0
