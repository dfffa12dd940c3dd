import random
import re

import numpy as np
import pytest

from tabloom.llm import near_dup
from tabloom.llm.grams import shingles
from tests.llm.tables import SCHEMA, documents, odd_rows, words


def shingle_set(text):
    w = [x.lower() if x.isascii() else re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows):
    """Component and set size by all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root(i)] = min(low.get(root(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), low.get(root(i))) for i, r in enumerate(rows)), key=repr)


def edited(text, k, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(k):
        w[rng.randrange(len(w))] = f"n{rng.randrange(9999)}"
    return " ".join(w)


def copies():
    """Groups of near copies with chains, beside texts that share a long passage only."""
    rows, passage = [], words(900, 60)
    for g in range(12):
        base = words(100 + g, 120 + 30 * g, 3000)
        for c in range(1 + 3 * (g % 5)):
            rows.append((len(rows) * 7 % 1000, edited(base, 2 + c % 4, 31 * g + c)))
        rows.append((len(rows) * 7 % 1000, base.upper()))
        rows.append((len(rows) * 7 % 1000, words(500 + g, 50) + " " + passage))
    return [(*r, "en", "s", None, 1, 0.5, "z", 2) for r in rows]


@pytest.mark.parametrize("rows", [odd_rows(), copies()], ids=["odd", "copies"])
def test_same_as_all_pairs(spark, rows):
    got = near_dup.near_duplicates(documents(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_blocks_alone_find_what_stars_find(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 4)
    monkeypatch.setattr(near_dup, "FAMILY", 3)
    monkeypatch.setattr(near_dup, "WIDTH", 50)
    got = near_dup.near_duplicates(documents(spark, copies()), stars=False).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute(copies())


def test_one_of_each_group_stays(spark):
    left = near_dup.drop_near_duplicates(documents(spark))
    assert left.columns == documents(spark).columns
    got = sorted((r.doc_id for r in left.collect()), key=repr)
    assert got == sorted([0, 1, 2, 3, 4, 5, 7, 8, 9, 10, None, None], key=repr)


def test_empty_table(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(1, 1 << 62, 4000, dtype=np.uint64)
    a, b = np.unique(base[:2500]), np.unique(base[500:3000])
    sig = near_dup.super_minhash(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, 512)
    assert abs((sig[0] == sig[1]).mean() - 2000 / 3000) < 0.07


def test_signature_of_few_elements_fills_every_slot():
    sig = near_dup.super_minhash(np.array([5], dtype=np.uint64), np.array([0]), 2)
    assert (sig[0] != near_dup.U(near_dup.UNSET)).all() and (sig[1] == near_dup.U(near_dup.UNSET)).all()
    assert sorted((sig[0] >> near_dup.U(40)).tolist()) == list(range(near_dup.SLOTS))


def test_shingles_of_repeated_words_stay_apart():
    w = np.arange(1, 3, dtype=np.uint64)
    runs = np.concatenate([np.repeat(w, 20), np.repeat(w[::-1], 20)])
    assert len(np.unique(shingles(runs, 5))) == len({tuple(runs[i : i + 5].tolist()) for i in range(len(runs) - 4)})


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1003), (500, 500)]
    got = near_dup.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r.node: r.comp for r in got} == {**dict.fromkeys(range(201), 0), 1000: 1000, 1001: 1000, 1003: 1000}
