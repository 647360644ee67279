import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa

from statlake.llm.substrings import remove_substrings, repeated_windows
from statlake.llm.window_exchange import pack, unpack, unpack_group

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, size):
    """By definition, over (id, text) with distinct ids."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i in sorted(words):
        for s in range(len(words[i]) - size + 1):
            first.setdefault(tuple(words[i][s : s + size]), (i, s))
    out = {}
    for i, w in words.items():
        gone = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s : s + size])] != (i, s):
                gone.update(range(s, s + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def run(spark, rows, size, schema="doc_id long, text string"):
    got = remove_substrings(spark.createDataFrame(rows, schema), size=size).collect()
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got}


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "é", "wörd", "x\x1cy", "中"]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in rng.sample(range(1000), 60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 40))]
        if i % 3 == 0:
            words[5:5] = passage[rng.randrange(10) :]
        rows.append((i, rng.choice([" ", "\n", "  ", "\t"]).join(words)))
    rows += [(2000, "a " * 300), (2001, "a " * 50), (2002, None), (2003, ""), (2004, " \n")]
    rows += [(3000, rows[0][1]), (-7, rows[1][1])]
    for size in (3, 6, 20):
        assert run(spark, rows, size) == brute(rows, size)


def test_shared_passage_keeps_its_first_place(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(i, f"begin{i} {passage} end{i}") for i in range(200)]
    got = run(spark, rows, 20)
    assert got[0][1] == 0 and all(got[i][:2] == (62, 60) for i in range(1, 200))


def test_empty_table_null_id_repeated_rows_and_extra_columns(spark):
    assert run(spark, [], 3) == {}
    rows = [(None, "a b c d", 1), (5, "a b c d", 2), (5, "a b c d", 2), (7, None, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, starts int")
    got = sorted(((r.doc_id or 0), r.n_removed) for r in remove_substrings(frame, size=3).collect())
    assert got == [(0, 0), (5, 4), (5, 4), (7, 0)]


def test_very_long_text(spark):
    text = " ".join(str(k % 5003) for k in range(600_000))
    got = run(spark, [(1, text)], 20)
    assert got[1][:2] == (600_000, 600_000 - 5003 - 19 + 19)


def test_rounds_bring_the_same_places(spark):
    rng = random.Random(9)
    rows = [(i * 37 - 500, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = [
        {r.id: bytes(r.starts) for r in repeated_windows(frame, size=5, fan=fan).collect()} for fan in (64, 6, 2)
    ]
    assert len(found[0]) > 90 and found[0].keys() == found[1].keys() == found[2].keys()
    assert all({*memoryview(f[i]).cast("I")} == {*memoryview(found[0][i]).cast("I")} for f in found for i in f)


def test_windows_of_a_bucket_are_held_once():
    rng = np.random.default_rng(7)
    n, blocks = 4_000, 100
    raws = []
    for block in range(blocks):
        text = np.sort(rng.integers(0, 20, n))
        ids = np.arange(20, dtype=np.int64) + 20 * block
        raws.append(pack(ids, text, np.arange(n), rng.integers(0, 1 << 50, n).astype(np.uint64), 7))
    table = pa.table({"packed": pa.array(raws, pa.binary())})
    tracemalloc.start()
    found = unpack_group(table, True, 7)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    one_by_one = [unpack(raw, True, 7) for raw in raws]
    for column, parts in zip(found, zip(*one_by_one, strict=True), strict=True):
        assert np.array_equal(column, np.concatenate(parts))
    assert peak < 1.3 * sum(column.nbytes for column in found)
