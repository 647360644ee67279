import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from statlake.llm import exact
from statlake.llm.exact import ambiguous_hashes, chunks_of, drop_exact_copies, exact_groups, recipe_of


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = {}
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i, times in Counter(ids).items():
            digest = hashlib.sha256(text.encode()).hexdigest()
            out[i, text] = [(keep, len(ids), i == keep and not k, digest) for k in range(times)]
    return out


def table():
    long = "".join(f"line {k} of it\n" * (k % 40) for k in range(300))
    texts = ["", None, "\n", "a", "a\n", "é" * 9000, "é" * 9001, long, long + "x", "x" + long, "\U0001f600" * 5000]
    rows = [(i, t) for i, t in enumerate(texts * 3)] + [(100 + i, long) for i in range(300)]
    return rows + [(5, texts[5]), (None, "alone"), (None, "a"), (7, "other text of the same id")]


def test_against_brute_force(spark):
    frame = spark.createDataFrame(table(), "doc_id long, text string").withColumn("recipe", F.lit(1))
    got = exact_groups(frame).join(frame, "doc_id").count()
    assert got > 0
    rows = exact_groups(frame).collect()
    want = brute(table())
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows) == Counter(
        (i, *row) for (i, _), rows in want.items() for row in rows
    )
    kept = drop_exact_copies(frame)
    assert kept.columns == frame.columns
    assert exact_groups(frame.limit(0)).count() == 0


def test_chunks_join_to_the_text_and_follow_the_content(spark):
    frame = spark.createDataFrame(table(), "doc_id long, text string")
    chunks = frame.select("text", chunks_of(F.col("text")).alias("c")).collect()
    assert all("".join(r.c) == (r.text or "") for r in chunks)
    long = max((r.c for r in chunks), key=len)
    moved = next(r.c for r in chunks if r.text and r.text.startswith("xline"))
    assert len(set(long) & set(moved)) > len(set(long)) * 0.8


def test_ambiguous_hashes_go_by_their_content(spark, monkeypatch):
    frame = spark.createDataFrame([("a" * 600,), ("b" * 600,)], "text string")
    assert ambiguous_hashes(frame, "text").count() == 0
    hashes = [r[0] for r in frame.select(F.xxhash64("text")).collect()]
    for ambiguous in (hashes[:1], None):
        got = frame.select(recipe_of(chunks_of(F.col("text")), ambiguous).alias("r")).collect()
        assert [len(x) for x in got[0].r] == [64]
    same = F.lit(1)
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: same)
    assert ambiguous_hashes(frame, "text").count() == 1
    assert exact_groups(frame.withColumn("doc_id", F.length("text"))).count() == 2


def test_one_row_of_each_text_is_kept(spark):
    rows = [(1, "a"), (1, "a"), (5, "x"), (5, "q"), (9, "x"), (None, "n"), (None, "n"), (None, "x"), (7, None), (8, "")]
    frame = spark.createDataFrame([(*r, k, {"k": k}) for k, r in enumerate(rows)], "doc_id long, text string, place int, more map<string,int>")
    kept = drop_exact_copies(frame.repartition(4))
    assert kept.columns == frame.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert Counter(found) == Counter([(1, "a"), (5, "q"), (9, "x"), (None, "n"), (8, "")])
    assert all(rows[r.place] == (r.doc_id, r.text) and r.more == {"k": r.place} for r in kept.collect())
    groups = exact_groups(frame).collect()
    assert len(groups) == len(rows) and sum(r.kept for r in groups) == 5
    assert drop_exact_copies(frame.limit(0)).count() == 0
