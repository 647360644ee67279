import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statlake.llm.token_counts import WordBpe, count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "a", "aa", "aaaa", "<|endoftext|>", "<|startoftext|>", "<|endof", "'s", "'LL", " ", "\n", "\t", "\x1c", "\x85",
    "\xa0", " ", "é", "é", "Σ", "ΑΣ", "İ", "ß", "ﬁ", "😀", "中文", "ᄒ", "ᅡ", "ᆫ", "²", "Ⅷ", "__", "..",
    "\x00", "​", "ǅ", "Ω", "𐐀", "٣", "hello", "WORLD", "don't",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [
        len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    ]


def test_odd_texts_against_the_library(library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randrange(14))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randrange(1, 0xD800), rng.randrange(0xE000, 0x1FFFF)])) for _ in range(9))
              for _ in range(2000)]
    with open(PATH, encoding="utf-8") as file:
        assert WordBpe(file.read()).count(texts).tolist() == library(texts)


def test_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(-1, None), (-2, ""), (-3, "word " * 600_000), (-4, "x" * 50_000), (-5, "a b"), (-5, "a b")]
    docs = docs.unionByName(spark.createDataFrame(rows, docs.schema)).withColumn("n_tokens", F.lit("old"))
    got = count_tokens(docs, PATH).collect()
    assert [r.n_tokens for r in got] == library([r.text for r in got])
    assert all(r.n_bytes == len((r.text or "").encode()) for r in got)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert count_tokens(docs.limit(0), PATH).count() == 0
