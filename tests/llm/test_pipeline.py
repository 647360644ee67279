import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import STAGES

WORDS = {"en": "the and of that with river stone light house walk", "fr": "le la une avec pierre maison lumiere ciel"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with one case for each stage; ids tell which are to stay."""
    rng = random.Random(8)
    make = lambda lang, n: " ".join(rng.choice(WORDS[lang].split()) + str(rng.randrange(9)) for _ in range(n))
    texts = {i: make("en" if i % 2 else "fr", 80) for i in range(40)}
    item = make("en", 30)
    texts[100], texts[101] = texts[1], texts[1]  # the largest id stays
    texts[200] = texts[2] + " tail"  # near copy of 2, which stays
    texts[300] = f"{make('en', 60)} {item}"  # contaminated
    texts[301] = f"{make('en', 900)} {item} {make('en', 900)}"  # less than a twentieth
    texts.update({400: None, 401: "", 402: "123 456"})
    stay = {*range(40), 101, 301} - {1}
    rows = [(i, t, "en" if i % 2 else "fr", "s", len(t or ""), 0.5) for i, t in texts.items()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), stay


def test_each_stage_drops_what_it_should(spark, folder):
    path, stay = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    gone = [{400, 401, 402}, {1, 100}, {200}, {300}, set()]
    for (_, stage), want in zip(STAGES, gone, strict=True):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        columns = docs.columns
        docs = stage(spark, docs, path)
        assert before - {r.doc_id for r in docs.select("doc_id").collect()} == want
        if stage is not STAGES[-1][1]:
            assert docs.columns == columns
    assert {r.doc_id for r in corpus_pipeline.run(spark, path).collect()} == stay


def test_repeated_rows_and_ids(spark, folder):
    """Of rows with the same id and text one stays; other texts of an id are other documents."""
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").where("doc_id < 6")
    other = docs.where("doc_id in (0, 1)").withColumn("text", F.reverse("text"))
    docs = docs.unionByName(docs).unionByName(docs.where("doc_id = 3")).unionByName(other)
    want = [0, 0, 1, 1, 2, 3, 4, 5]
    for name, stage in STAGES[1:3]:
        docs = stage(spark, docs, folder[0])
        assert sorted(r.doc_id for r in docs.select("doc_id").collect()) == want, name


def test_empty_table(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet").limit(0)
    for _, stage in STAGES:
        docs = stage(spark, docs, folder[0])
    assert docs.count() == 0


def test_stages_keep_texts_as_they_are(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in STAGES[:-1]:
        made = stage(spark, docs, folder[0])
        assert made.exceptAll(docs).isEmpty() and made.agg(F.sum("n_chars")).first()[0] > 0
