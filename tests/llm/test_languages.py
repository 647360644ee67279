import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from statlake.llm.languages import GRAM, LanguageFilter, grams_of, has_letter, held_out, identify, learn

SF_DIR = "/root/testdata/sf0.01"


def brute_grams(text):
    folded = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower())
    raw = b" " + b" ".join(w.encode() for w in folded.split(" ") if w) + b" "
    grams = [raw[i : i + GRAM] for i in range(len(raw) - GRAM + 1)]
    return [g for g in grams if g[1] != 32 and g[2] != 32]


def test_grams_against_brute_force():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abÉñ中 .1\nZ") for _ in range(rng.randrange(30))) for _ in range(300)]
    grams, owner = grams_of(texts)
    for i, text in enumerate(texts):
        want = brute_grams(text)
        assert [int(g).to_bytes(4, "big") for g in grams[owner == i]] == want


def test_filter_has_all_it_was_given_and_few_more():
    rng = np.random.default_rng(1)
    sets = {f"l{i}": rng.integers(0, 2**32, 3000, dtype=np.uint32) for i in range(70)}
    made = LanguageFilter.of(sets, list(sets))
    for i, name in enumerate(sets):
        found = made.languages_of(sets[name])
        assert ((found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).all()
    strange = made.languages_of(rng.integers(0, 2**32, 100_000, dtype=np.uint32))
    rate = np.mean((strange[:, 0] & np.uint64(1)) != 0)
    assert abs(rate - made.false_rate[0]) < 0.003


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    rows = identify(docs.where(held_out(F.col("doc_id"))), model).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_nulls_no_letters_ties_long_texts_and_clashing_names(spark):
    train = [("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), (None, "en")]
    train += [("nothing", None), ("nothing", ""), ("the dog and the cat", "en")]
    model = learn(spark.createDataFrame(train, "text string, lang string"), min_share=0)
    assert model.languages == ["en", "fr"]
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "x"), (5, "the cat " * 500_000), (6, "sur la table")]
    rows += [(6, "sur la table"), (7, "中")]
    frame = spark.createDataFrame(rows, "doc_id int, text string").withColumn("score", F.lit("old"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(frame, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4] == ("en", 0.0) and got[5][0] == "en" and got[6][0] == "fr" and got[7] == ("en", 0.0)
    assert identify(frame, model).count() == 8
    nothing = learn(frame.select("text", F.lit(None).cast("string").alias("lang")))
    assert {r.lang_pred for r in identify(frame, nothing).collect()} == {"und"}
    assert identify(frame.limit(0), model).count() == 0
    assert not has_letter("١٢٣") and has_letter("é")
