"""Hard negatives, ranked search and packing against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import hard_negatives, packing, ranked_search
from tests.llm.tables import documents, odd_rows, words

VECTORS = "vec_id long, embedding array<float>, label int, anchor int, part int, q string, low double"
NAN, INF = float("nan"), float("inf")


def vector_rows(n=400, dims=6, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.2, 0.6) for _ in range(dims)], rng.randrange(4)) for i in range(n)]
    rows += [(i, [0.5] * dims, 1) for i in range(n, n + 60)]  # copies: ties
    rows += [(50, rows[50][1], rows[50][2])] * 2 + [(7, rows[7][1], rows[7][2])]  # repeated rows, an anchor among them
    rows += [(1000, None, 1), (1050, [0.1] * dims, None), (None, [0.1] * dims, 1), (1100, [0.1, None], 1), (1150, [0.1, NAN], 1), (1200, [INF, 0.1], 1)]
    rows += [(1250, [], 2), (1300, [0.3], 3), (1351, [0.9, 0.9], 3)]
    return [(*r, 0, 1, "x", 0.5) for r in rows]


def brute_negatives(rows, least=50, most=95):
    sound = []
    for i, v, label, *_ in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        sound.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for i, v, label in {(i, tuple(v), label) for i, v, label in sound if i % 50 == 0}:
        scored = [(-sum(a * b for a, b in zip(v, u, strict=False)), j, k) for j, u, k in sound]
        good = sorted((s, j) for s, j, k in scored if k == label and j != i)[:5]
        bad = sorted((s, j) for s, j, k in scored if k != label)
        for s, j in good:
            hits = [(t, k) for t, k in bad if least * -s <= 100 * -t <= most * -s][:3]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(hits)]
    return Counter(out)


@pytest.mark.parametrize("part_rows", [16_384, 40])
def test_hard_negatives_are_those_of_all_pairs(spark, part_rows):
    rows = vector_rows()
    whole = hard_negatives.whole_vectors(spark.createDataFrame(rows, VECTORS))
    got = hard_negatives.hard_negatives(whole, F.col("vec_id") % 50 == 0, part_rows=part_rows)
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_hard_negatives_of_nothing_and_of_huge_numbers(spark):
    empty = hard_negatives.whole_vectors(spark.createDataFrame([], VECTORS))
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 50 == 0).count() == 0
    rows = [(50 * i, [1e30 * (i + 1), 0.5], i % 2, 0, 0, "", 0.0) for i in range(4)]
    huge = hard_negatives.whole_vectors(spark.createDataFrame(rows, VECTORS))
    assert hard_negatives.hard_negatives(huge, F.col("vec_id") % 50 == 0).count() == 0  # all scores are at the end of the range
    some = [(i, [3e6 * (i % 5 - 1), 2e6, 0.1 * i], i % 3, 0, 0, "", 0.0) for i in range(120)]  # beyond exact doubles
    large = hard_negatives.whole_vectors(spark.createDataFrame(some, VECTORS))
    assert Counter(map(tuple, hard_negatives.hard_negatives(large, F.col("vec_id") % 50 == 0).collect())) == brute_negatives(some)


def test_tree_search_prunes_and_finds_all():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-50, 50, (500, 3))
    order = hard_negatives.str_order(vectors, 8)
    assert sorted(order) == list(range(500))
    tree = hard_negatives.PartTree(order, order % 3, vectors[order].astype(float), leaf=8, fanout=4)
    spans = (tree.leaves[1] - tree.leaves[0]).sum()
    loose = hard_negatives.PartTree(np.arange(500), np.arange(500) % 3, vectors.astype(float), leaf=8, fanout=4)
    assert spans < 0.6 * (loose.leaves[1] - loose.leaves[0]).sum()  # packed boxes are smaller
    anchors = vectors[:20].astype(float)
    low, high = np.full((20, 2), -1000.0), np.stack([np.full(20, 2000.0), np.full(20, 100.0)], axis=1)
    got = list(zip(*tree.search(np.arange(20), np.arange(20) % 3, anchors, low, high, low, 4, False), strict=True))
    scores = vectors[:20] @ vectors.T
    for a in range(20):
        for w in range(2):
            fits = [j for j in range(500) if j % 3 != a % 3 and -1000 <= scores[a, j] <= high[a, w]]
            best = sorted((-scores[a, j], j) for j in fits)[:4]
            assert sorted((-s, i) for x, v, i, s in got if (x, v) == (a, w)) == best


ITEMS = "item_id long, text string, doc_id long, score double, bundle string"


def brute_ranking(items, rows, n=10):
    pattern = re.compile(ranked_search.TERM)
    lower = str.maketrans(ranked_search.UPPER, ranked_search.LOWER)
    terms = lambda t: pattern.findall((t or "").translate(lower))
    docs = [(r[0], Counter(terms(r[1]))) for r in rows]
    docs = [(i, c) for i, c in docs if c]
    total, length = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in {(r[0], r[1]) for r in items}:
        scores = []
        for i, c in docs:
            m = 10 + (90 * sum(c.values()) * total) // length
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r + 1, None if void else i, -s) for r, (s, void, i) in enumerate(sorted(scores)[:n])]
    return Counter(out)


@pytest.mark.parametrize("sizes", [{}, {"owners": 3, "block_docs": 20, "bundle_items": 4}, {"owners": 1}])
def test_ranking_is_that_of_all_documents(spark, sizes):
    rows = odd_rows() + [(100 + i, words(i, 5 + i % 40, 60) + ("; W3 ÄÖ Äö" if i % 9 else "\x00a_b"), "en", "s", 0, 0, 0.0, "", 0) for i in range(150)]
    items = [(i, words(700 + i, 1 + i, 60), 1, 0.0, "") for i in range(12)]
    items += [(3, items[3][1], 1, 0.0, ""), (20, None, 0, 0.0, ""), (21, "?!", 0, 0.0, ""), (None, "äÖ w5 A", 0, 0.0, ""), (22, "nowhere", 0, 0.0, ""), (23, words(9, 3000, 60), 0, 0.0, "")]
    got = ranked_search.rank_documents(spark.createDataFrame(items, ITEMS), documents(spark, rows), **sizes)
    assert Counter(map(tuple, got.collect())) == brute_ranking(items, rows)


def test_ranking_of_empty_tables(spark):
    items = spark.createDataFrame([(1, "one", 0, 0.0, "")], ITEMS)
    assert ranked_search.rank_documents(items, documents(spark).limit(0)).count() == 0
    assert ranked_search.rank_documents(items.limit(0), documents(spark)).count() == 0


def test_least_squares_meet_the_optimality_conditions():
    rng = np.random.default_rng(2)
    lengths, repeats = packing.combinations(48)
    assert all(int(a @ r) == 48 for a, r in zip(lengths, repeats, strict=True))
    assert len({tuple(sorted((int(x), int(y)) for x, y in zip(a, r, strict=True) if y)) for a, r in zip(lengths, repeats, strict=True)}) == len(lengths)
    target = np.r_[0, rng.integers(0, 500, 48)].astype(float)
    found = packing.nnls(lengths, repeats, target)
    assert min(found.values()) >= 0
    rest = target - sum(w * packing._column(lengths[j], repeats[j], 49) for j, w in found.items())
    gain = (repeats * rest[lengths] * (lengths > 0)).sum(axis=1)
    assert gain.max() < 1e-4 * target.max()  # no column would lower the distance
    assert max(abs(gain[j]) for j in found) < 1e-4 * target.max()


def test_plans_use_no_more_than_there_is():
    rng = np.random.default_rng(4)
    for histogram in (rng.integers(0, 90, 65), np.r_[0, np.zeros(40, int), rng.integers(0, 90, 24)], np.zeros(65, int), np.eye(65, dtype=int)[40] * 1000):
        histogram[0] = 0
        used = np.zeros(65, int)
        for members, n in packing.plan_windows(histogram):
            assert n > 0 and sum(a * r for a, r in members) == 64
            for a, r in members:
                used[a] += r * n
        assert (used <= histogram).all()


def check_packing(rows, texts, window, ids):
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for v in sequences.values():
        at = 0
        for r in sorted(v, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= window
    got = Counter()
    for doc, v in by.items():
        for r in v:
            assert r.length * 4 == len(r.ids)
    # pieces of equal ids belong to equal texts: compare what each document's pieces hold as a whole
    for doc, v in by.items():
        own = [tuple(ids(t)) for i, t in texts if i == doc]
        pieces = Counter((r.start, tuple(np.frombuffer(r.ids, "<u4").tolist()), r.doc_tokens) for r in v)
        assert sum(r.length for r in v) == sum(map(len, own))
        if len(own) == 1:
            assert sum((list(x) for _, x, _ in sorted(pieces)), []) == list(own[0])
            assert {r.doc_tokens for r in v} == {len(own[0])}
        got[doc] += len(own)
    assert sum(got.values()) == len(texts)
    return sequences


def test_packing_is_a_round_trip(spark):
    tokenizers, public_tokenizers = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    machine = tokenizers.Tokenizer.from_file(path)
    ids = lambda t: [*machine.encode(t or "", add_special_tokens=False).ids, 2]
    odd = ["It's THE end. Isn't it?!\r\nΣΊΣΥΦΟΣ ΟΔΟΣ.", "a<|startoftext|>B <|ENDOFTEXT|> c", "İstanbul é É. ≠ .́ x .́ \u0085y z", "…. —. 12,345.67; ok", "\x00\x1c\x1f q"]
    rows = odd_rows() + [(500 + i, t, "en", "s", 0, 0, 0.0, "", 0) for i, t in enumerate(odd)]
    rows += [(600 + i, words(i, 1 + (i * 37) % 300), "en", "s", 0, 0, 0.0, "", 0) for i in range(300)]
    texts = [(r[0], r[1]) for r in rows]
    for window, grain in ((4096, 16), (128, 2)):
        got = packing.pack(documents(spark, rows), path, window=window, grain=grain).collect()
        sequences = check_packing(got, texts, window, ids)
        total = sum(len(ids(t)) for _, t in texts)
        assert len(sequences) <= total / window * (1 + 2 * grain / window) + 2
    assert packing.pack(documents(spark).limit(0), path).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents(spark), public_tokenizers.path("byte_bpe_50k.json"))
