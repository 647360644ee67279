import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from word_rule import split

from statlake.llm import near
from statlake.llm.near import drop_near_copies, near_classes
from statlake.llm.text_arrays import planes
from statlake.llm.weighted_samples import band_values, samples

SF_DIR = "/root/testdata/sf0.01"


def brute_links(rows, threshold=0.8):
    """By definition, over (id, text) with distinct ids."""
    sets = {}
    for i, text in rows:
        words = split(text)
        if words:
            last = max(len(words) - 4, 1)
            sets[i] = Counter(tuple(words[k : k + 5]) for k in range(last))
    df = Counter(s for own in sets.values() for s in own)
    near = {n: 2 ** (round(8 * math.log2(n)) / 8) for n in set(df.values())}
    idf = {n: math.log((1 + len(rows)) / (1 + x)) / math.log(2 + len(rows)) for n, x in near.items()}
    weight = {i: {s: n * (1 + max(idf[df[s]], 0) / 2) for s, n in own.items()} for i, own in sets.items()}
    total = {i: sum(w.values()) for i, w in weight.items()}
    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            if df[s] > 1:
                holders[s].append(i)
    shared = Counter()
    for s, ids in holders.items():
        for x in ids:
            for y in ids:
                if x < y:
                    shared[x, y] += min(weight[x][s], weight[y][s])
    return {p for p, both in shared.items() if both / (total[p[0]] + total[p[1]] - both) >= threshold}


def classes(links):
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return {x: root(x) for x in label}


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(4)
    keys = rng.integers(0, 2**63, 300, dtype=np.uint64)
    a, b = rng.exponential(size=300) + 0.01, rng.exponential(size=300) + 0.01
    a[200:] = b[200:]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    drawn = samples(np.r_[keys, keys], np.r_[a, b], np.array([0, 300]), 4000)
    assert abs((drawn[0] == drawn[1]).mean() - want) < 0.03
    assert (samples(keys, a, np.array([0]), 4000)[0] == drawn[0]).all()
    assert len(np.unique(band_values(drawn, 5))) > 700


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_against_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([6, 40, 150]))]
        for _ in range(rng.choice([1, 2, 6])):
            own = list(base)
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(len(own))] = "new" + str(rng.random())[2:]
            rows.append((len(rows) * 7 + 3, " ".join(own)))
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = classes(brute_links(rows))
    assert {r.doc_id: r.class_id for r in got} == {i: want.get(i, i) for i, _ in rows}
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_classes_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    want = classes(brute_links([tuple(r) for r in docs.collect()]))
    got = {r.doc_id: r.class_id for r in near_classes(docs).collect()}
    wrong = [i for i, c in got.items() if want.get(i, i) != c]
    assert len(want) > 50 and len(wrong) <= len(want) // 100


def test_blocks_give_the_pairs_of_all(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, 100, dtype=np.uint8)
    rows = []
    for i in range(150):
        own = base.copy()
        own[rng.choice(100, rng.integers(0, 40), replace=False)] += 1
        rows.append((i, bytearray(own.tobytes())))
    want = set()
    for i in range(150):
        for j in range(i):
            if np.mean(np.frombuffer(rows[i][1], np.uint8) == np.frombuffer(rows[j][1], np.uint8)) >= 0.7:
                want.add((j, i))
    sampled = spark.createDataFrame(rows, "id long, signature binary")
    members = sampled.select(F.explode(F.array(F.lit(7).cast("long"), F.lit(9).cast("long"), "id")).alias("value"), "id")
    for size in (1024, 40, 1):
        monkeypatch.setattr(near, "BLOCK_TEXTS", size)
        assert {tuple(r) for r in near.pairs_among(members, sampled, 0.7).collect()} == want


def test_hot_group_nulls_short_texts_repeated_rows_and_clashing_names(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(i, f"{base} own{i}", "x") for i in range(300)]
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "One two.", "x"), (1003, "one two", "x")]
    rows += [(1004, "...", "x"), (1005, "other", "x"), (1005, "other", "x")]
    rows += [(None, "quite another text that stands alone", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    got = {r.doc_id: r for r in near_classes(docs).collect()}
    assert len(got) == 307
    assert all(got[i].class_id == 0 for i in range(300)) and got[1003].class_id == 1002
    assert all(got[i].class_id == i for i in (1000, 1001, 1004, 1005))
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([0, 1000, 1001, 1002, 1004, 1005, None])
    assert near_classes(docs.limit(0)).count() == 0


def test_very_long_texts(spark):
    text = " ".join(str(k) for k in range(300_000))
    rows = [(1, text), (2, text + " tail of it"), (3, "short " * 100)]
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.class_id for r in got.collect()} == {1: 1, 2: 1, 3: 3}
    assert got.agg(F.sum("n_links")).first()[0] == 2


def sampled_texts(spark, sets, bands):
    """Texts by their shingles, as ``sample_texts`` gives them, all of weight one."""
    rows = []
    for i, own in sets.items():
        keys = np.array(sorted(own), np.uint64)
        packed = np.array([len(keys)], np.uint32).tobytes() + planes(keys, near.PAIR_BYTES)
        packed += planes(np.ones(len(keys), np.uint32)) + bytes(np.full(len(keys), 255, np.uint8))
        # A sample per shingle number below 100, so agreement follows the sets.
        signature = bytes(1 if k in own else (i % 200) + 2 for k in range(100))
        rows.append((i, bands[i], signature, float(len(keys)), packed))
    return spark.createDataFrame(
        rows, "id long, bands array<long>, signature binary, weight double, packed binary"
    )


def test_copies_of_copies_behind_one_head(spark, monkeypatch):
    # The head 0 meets most texts. Texts 1..50 are like it; of each k in 51..100, only text k - 50 is like it.
    sets, bands = {0: set(range(100))}, {0: [7, 8]}
    for k in range(1, 51):
        sets[k] = set(range(100)) - set(range(k, k + 10))
        sets[k + 50] = set(range(100)) - set(range(k, k + 24))
        bands[k], bands[k + 50] = [7], [7]
    sets[200], bands[200] = set(range(100)) - set(range(80)), [8]
    sampled = sampled_texts(spark, sets, bands)
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert not [p for p in want if p[0] == 0 and 50 < p[1]]
    for size in (1024, 7):
        monkeypatch.setattr(near, "BLOCK_TEXTS", size)
        links = {tuple(r) for r in near.links_of(sampled, 101, 0.8).collect()}
        assert links <= want and classes(links) == classes(want)


def test_shared_weights_of_blocks(monkeypatch):
    rng = np.random.default_rng(5)
    idf = near.weights_of_codes(100)
    texts = []
    for _ in range(40):
        keys = np.sort(rng.choice(60, rng.integers(1, 50), replace=False)).astype(np.uint64)
        times = rng.choice([1, 1, 1, 2, 5, 90], len(keys)).astype(np.uint32)
        packed = np.array([len(keys)], np.uint32).tobytes() + planes(keys, near.PAIR_BYTES)
        packed += planes(times) + (keys % 7 + 8).astype(np.uint8).tobytes()
        texts.append((packed, float((times * idf[(keys % 7 + 8).astype(int)]).sum())))
    left, right = texts[:25], texts[15:]
    for elements in (1 << 11, 3):
        monkeypatch.setattr(near, "ELEMENTS", elements)
        both = near.shared_weights([raw for raw, _ in left], [raw for raw, _ in right], idf)
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                want = near.similarity(*a, *b, idf)
                assert abs(both[i, j] / (a[1] + b[1] - both[i, j]) - want) < near.MARGIN / 10


def test_pairs_below_the_threshold_make_no_rows(spark, monkeypatch):
    # Of one value, 120 texts of which any two are like each other in 0.74, and two that are links.
    sets = {i: set(range(85)) | {100 + 15 * i + k for k in range(15)} for i in range(120)}
    sets[120] = set(sets[119]) - {0}
    sampled = sampled_texts(spark, sets, {i: [7, 9] for i in sets})
    made = []
    verified = near.verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near, "verified", counted)
    monkeypatch.setattr(near, "FEW_PAIRS", 50)
    for size, length in ((1024, 4 << 20), (50, 4 << 20), (1024, 20_000)):
        made.clear()
        monkeypatch.setattr(near, "BLOCK_TEXTS", size)
        monkeypatch.setattr(near, "BLOCK_BYTES", length)
        assert {tuple(r) for r in near.links_of(sampled, 121, 0.8).collect()} == {(119, 120)}
        assert sum(made) < 121 * 30  # 7,260 pairs


def test_few_pairs_at_the_threshold_are_passed_over():
    n, p = near.BANDS * near.ROWS, near.THRESHOLD
    fewest = math.ceil((p - near.SLACK) * n - 1e-9)
    seldom = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(fewest))
    no_band = (1 - p**near.ROWS) ** near.BANDS
    assert seldom < no_band and seldom + no_band < 0.00051
