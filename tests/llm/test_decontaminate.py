import random

import pytest
from pyspark.sql import functions as F
from word_rule import split

from statlake.llm.decontaminate import ItemAutomaton, find_contamination, without_spans, words_of

def brute(text, items, window):
    words = split(text)
    hit, found = set(), set()
    for name, item in items:
        own = split(item)
        if not own:
            continue
        size = min(window, len(own))
        runs = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                hit.update(range(i, i + size))
                found.add(str(name))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(150))
def test_automaton_against_brute_force(seed):
    rng = random.Random(seed)
    letters = "abc"[: rng.randrange(1, 4)]
    some = lambda n: " ".join(rng.choice(letters) for _ in range(rng.randrange(n)))
    items = [(i, some(14)) for i in range(rng.randrange(1, 9))]
    window = rng.choice([2, 3, 5])
    automaton = ItemAutomaton([(str(i), words_of(t.encode())) for i, t in items if t], window)
    for _ in range(20):
        text = some(60)
        spans, found = automaton.scan(words_of(text.encode()))
        hit = {k for a, b in spans for k in range(a, b)}
        got = (len(split(text)), len(hit), sorted({automaton.names[i] for i in found}))
        assert got == brute(text, items, window)


def test_table_with_nulls_blocks_and_clashing_names(spark):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(50)] + ["É", "ß1", "x's"]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(40)]
    items += [(100, None), (101, ""), (102, "..."), (3, "one more of three"), (None, "nobody asks")]
    rows = [(0, None, 1), (1, "", 2), (2, "... !", 3), (2, "... !", 3)]
    for i in range(3, 60):
        text = " ".join(rng.choice(words).upper() for _ in range(30))
        rows.append((i, f"{text}; {items[i % 40][1]}, {text}", i))
    docs = spark.createDataFrame(rows, "doc_id long, text string, hits int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    real = [(i, t) for i, t in items if i is not None]
    for size in (1_000, 60):
        got = find_contamination(docs, bench, block_words=size).collect()
        assert len(got) == len(rows)
        texts = dict((i, t) for i, t, _ in rows)
        for r in got:
            assert (r.n_words, r.n_hit, r["items"]) == brute(texts[r.doc_id], real, 13)
    none = find_contamination(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert none == 0
    assert find_contamination(docs.limit(0), bench).count() == 0


def test_spans_are_cut(spark):
    item = " ".join(f"q{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"Aa, {item}; bb {item}."), (2, None)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, item)], "item_id int, text string")
    found = find_contamination(docs, bench)
    got = found.select(without_spans(F.col("text"), F.col("hits")).alias("t")).collect()
    assert [r.t for r in got] == ["Aa, ; bb .", None]


def test_very_long_text(spark):
    item = " ".join(f"q{k}" for k in range(20))
    docs = spark.createDataFrame([(1, "the of q0 " * 700_000 + item)], "doc_id int, text string")
    row = find_contamination(docs, spark.createDataFrame([(1, item)], "item_id int, text string")).first()
    assert (row.n_words, row.n_hit) == (2_100_020, 20)
