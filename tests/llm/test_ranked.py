import collections
import math
import random
import re

import numpy as np
import pytest

from statlake.llm import ranked
from statlake.llm.ranked import pieces_of, rank_documents, term_counts
from statlake.llm.text_arrays import word_hashes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(small)


def brute(docs, items, top):
    counted = [(i, collections.Counter(terms_of(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    out = []
    for name, text in items:
        scores = []
        for i, c in counted:
            measure = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = 0
            for t in terms_of(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * measure))
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(name, k + 1, i, -s) for k, (s, _, i) in enumerate(scores[:top])]
    return sorted(out, key=str)


def run(spark, docs, items, top=10):
    made = rank_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"), top=top,
    )
    assert made.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in made.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed, monkeypatch):
    if seed % 2:  # several blocks of items
        monkeypatch.setattr(ranked, "BLOCK_TERMS", 12)
    rng = random.Random(seed)
    words = ["a", "Öl", "the", "The", "x1", "foo", "bar", "日本", "zz"] + [f"w{i}" for i in range(60)]
    some = lambda n: rng.choice([" ", "-", ". "]).join(rng.choices(words, k=rng.randrange(n)))
    docs = [(i, some(rng.choice([3, 30, 400]))) for i in range(300)]
    docs += [(1000 + i, docs[3][1]) for i in range(150)]  # a third are copies of one text
    docs += [docs[5], docs[5], (9, "other text foo"), (None, docs[3][1]), (None, "w1 w2"), (2000, None), (2001, "")]
    items = [(i, some(20)) for i in range(15)] + [(20, None), (21, ""), (None, "foo bar"), (3, "w1 w1"), (22, "nowhere")]
    assert run(spark, docs, items) == brute(docs, items, 10)


def test_empty_tables_and_few_documents(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None), (2, "...")], [(1, "a")]) == []
    docs, items = [(1, "a b"), (2, "a"), (3, "c c c")], [(1, "a b a"), (2, "c")]
    assert run(spark, docs, items, 2) == brute(docs, items, 2)


def test_columns_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6), (2, "c", 7, 8)], "doc_id long, text string, key long, item long")
    items = spark.createDataFrame([("n", "A", 1)], "item_id string, text string, terms int")
    made = rank_documents(docs, items)
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in made.collect()] == [("n", 1, 1)]


def test_terms_of_long_texts_come_whole():
    rng = random.Random(1)
    text = " ".join(rng.choices(["alpha", "Beta", "gämma", "x"], k=5000)).encode()
    assert b"".join(pieces_of(text, 100)) == text
    assert max(map(len, pieces_of(text, 100))) < 120
    unbroken = b"y" * 20000 + b" z"
    assert list(pieces_of(unbroken, 100)) == [b"y" * 20000, b" z"]


def test_term_counts_of_pieces(monkeypatch):
    monkeypatch.setattr(ranked, "PIECE", 64)
    texts = [b"a b A", b"", b"long " * 100 + b"a", b"b"]
    owner, term, count = term_counts(texts)
    data = np.frombuffer(b"a b long ", np.uint8)
    a, b, long = word_hashes(data, np.array([0, 2, 4]), np.array([1, 3, 8]))
    got = {(o, t): c for o, t, c in zip(owner.tolist(), term.tolist(), count.tolist(), strict=True)}
    assert got == {(0, int(a)): 2, (0, int(b)): 1, (2, int(long)): 100, (2, int(a)): 1, (3, int(b)): 1}


@pytest.mark.parametrize("bits", [8, 64, 100_000])
def test_bounds_are_never_below_the_score(bits):
    rng = np.random.default_rng(bits)
    terms = np.unique(rng.integers(0, 1 << 63, 30).astype(np.uint64))
    often = rng.integers(0, 9, (30, 21)) * (rng.random((30, 21)) < 0.3)
    place, owner = np.nonzero(often)
    keys = [(owner[m], ranked.level_keys(terms[place[m]], k)) for k in range(4) if (m := often[place, owner] >= 1 << k).any()]
    owners, keys = (np.concatenate(x) for x in zip(*keys, strict=True))
    raw = ranked.slices_of(owners, keys, 21, bits)
    rows = [{"item": i, "rows": [(int(t), 1 + i, 10 + j) for j, t in enumerate(terms.view(np.int64)) if (i + j) % 3]} for i in range(3)]
    block = ranked.ItemBlock(rows)
    lengths = often.sum(0)
    measure = ranked.length_measure(lengths, 21, int(lengths.sum()))
    bounds = ranked.bounds_of(block, bits, raw, lengths, measure)
    exact = block.sums(ranked.saturated(often, measure))
    assert (bounds >= exact).all()
    if bits == 100_000:  # keys share no bits, so only the levels are above the score
        assert (bounds[exact == 0] == 0).all() and bounds.sum() < 1.5 * exact.sum()
