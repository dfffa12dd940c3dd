"""Operators over whole tables, against plain Python; the pipeline against its stages' rules."""

import itertools
import random
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabloom.llm import classifier, decontaminate, mixing, resharding
from tests.llm.tables import SCHEMA, documents, odd_rows, words
from tests.llm.test_texts import WORD

ITEM = "bench_id long, item_id long, text string, doc_id long"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def edited(text, k, rng):
    w = text.split()
    for _ in range(k):
        i, op = rng.randrange(len(w)), rng.randrange(3)
        if op == 0:
            w[i] = f"z{rng.randrange(99)}"
        elif op == 1 and len(w) > 4:
            del w[i]
        else:
            w.insert(i, f"z{rng.randrange(99)}")
    return " ".join(w)


def leak_tables(spark):
    rng = random.Random(11)
    items = [(0, i, words(50 + i, 6 + i, 900), 0) for i in range(50)] + [(0, 900, None, 0), (0, 901, "", 0), (0, 3, words(53, 9, 900), 0), (0, None, "!!", 0)]
    rows, planted = list(odd_rows()), {}
    for i in range(50):
        for k, rate in enumerate((0, 0.08, 0.2)):
            text = items[i][2] if k else items[i][2].upper().replace(" ", "!!  ")
            n = int(len(items[i][2].split()) * rate)
            doc = f"{words(i, 70, 5000)} {edited(text, n, rng)} {words(i + 1, 70, 5000)}"
            planted[1000 + 10 * i + k] = (i, rate)
            rows.append((1000 + 10 * i + k, doc, "en", "s", 0, 0, 0.0, "", 0))
        rows.append((1000 + 10 * i + 9, " ".join(words(i + 7, 200, 5000).split()), "en", "s", 0, 0, 0.0, "", 0))
    return documents(spark, rows), spark.createDataFrame(items, ITEM), rows, items, planted


def test_leaks_are_found_and_true(spark):
    docs, items, rows, plain, planted = leak_tables(spark)
    got = decontaminate.find_leaks(docs, items).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    for rate, least in ((0, 1.0), (0.08, 0.95), (0.2, 0.85)):
        wanted = [(d, i) for d, (i, x) in planted.items() if x == rate]
        assert sum(p in pairs for p in wanted) >= least * len(wanted)
    assert all(d % 10 != 9 for d, _ in pairs if d >= 1000)
    texts, item = {r[0]: r[1] for r in rows if r[0] is not None}, {i[1]: i[2].split() for i in plain if i[2]}
    for r in got:
        w = texts[r.doc_id].encode()[r.first_byte : r.end_byte].decode().lower().replace("!!", "").split()
        assert r.distance <= 0.2 * len(item[r.item_id])
        best = min(edits(item[r.item_id], w[k:]) for k in range(-0, max(1, len(w) // 3)))
        assert best <= r.distance + 2 * int(0.2 * len(item[r.item_id]))


def test_leaky_documents_go(spark):
    docs, items, rows, _, _ = leak_tables(spark)
    found = {r.doc_id for r in decontaminate.find_leaks(docs, items).collect()}
    left = decontaminate.drop_leaks(docs, items)
    assert left.columns == docs.columns
    assert Counter(r.doc_id for r in left.collect()) == Counter(r[0] for r in rows if r[0] not in found)
    assert decontaminate.drop_leaks(docs, items.limit(0)).count() == len(rows)
    assert decontaminate.find_leaks(docs.limit(0), items).count() == decontaminate.find_leaks(docs, items.limit(0)).count() == 0


def test_blocks_of_the_benchmark_change_nothing(spark, monkeypatch):
    docs, items, *_ = leak_tables(spark)
    whole = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.find_leaks(docs, items).collect()}
    small = list(decontaminate.blocks(items, block_bytes=1500))
    assert len(small) > 2 and sum(map(len, small)) == 52
    monkeypatch.setattr(decontaminate, "blocks", lambda b: iter(small))
    assert {(r.doc_id, r.item_id, r.distance) for r in decontaminate.find_leaks(docs, items).collect()} == whole


def test_leaks_of_every_length_and_of_whole_windows():
    rng = random.Random(4)
    items = [(i, words(800 + i, 5 + i % 16, 2000).encode()) for i in range(320)]
    table = decontaminate.Table(items, decontaminate.EDIT_RATIO, decontaminate.REPEATS)
    for rate, longest in ((0, 1.0), (0.2, 0.95)):
        texts = []
        for i, text in items:
            n = len(text.split())
            texts.append(f"{words(i, 30, 5000)} {edited(text.decode(), int(n * rate), rng)} {words(i + 1, 30, 5000)}".encode())
        found = {(a, b) for a, b, *_ in table.matches(texts)}
        got = [(i, i) in found for i in range(320)]
        assert all(x for (_, t), x in zip(items, got) if len(t.split()) < decontaminate.WHOLE)
        assert sum(got) >= longest * 320


def test_leaks_of_short_items_and_of_scripts_without_blanks():
    han = "".join(chr(0x4E00 + 37 * i) for i in range(30))
    items = [(1, b"x = 3 + 4"), (2, b"Paris"), (3, han.encode()), (4, "東京は".encode()), (5, b"!!")]
    table = decontaminate.Table(items, decontaminate.EDIT_RATIO, decontaminate.REPEATS)
    other = f"{han[:12]}丁{han[13:]}"
    texts = ["so x = 3  + 4.", "x - 3 + 4 and x 3 4", "in (paris), now", "parisian", f"前{han}後", f"前 {other}後", "この東京は大きい", "!!", "x 3 4 x = 3 + 4"]
    got = [(a, b, d, texts[a].encode()[i:j].decode()) for a, b, d, i, j in table.matches([t.encode() for t in texts])]
    assert got == [(0, 1, 0, "x = 3  + 4."), (2, 2, 0, "(paris),"), (4, 3, 0, han), (5, 3, 1, other), (6, 4, 0, "東京は"), (8, 1, 0, "x = 3 + 4")]


def least_edits(item, text):
    """Fewest word edits between the whole item and any run of the text, row by row over all runs."""
    ramp, row = np.arange(len(text) + 1), np.zeros(len(text) + 1, dtype=np.int64)
    for i, word in enumerate(item):
        new = np.append(i + 1, np.minimum(row[:-1] + (text != word), row[1:] + 1))
        row = np.minimum.accumulate(new - ramp) + ramp
    return int(row.min())


def test_leaks_as_all_items_against_all_windows(spark):
    """Items from 5 to 512 words, each planted as it is and with edits to the limit; every other pair is compared as well."""
    rng = random.Random(21)
    lengths = [5, 9, 16, 24, 40, 64, 100, 127, 128, 160, 200, 255, 256, 300, 400, 511, 512]
    items = [(0, i, words(900 + i, n, 3000), 0) for i, n in enumerate(lengths)]
    rows = []
    for i, n in enumerate(lengths):
        for k, count in enumerate((0, int(0.1 * n), int(0.2 * n), int(0.2 * n), int(0.3 * n) + 1)):
            doc = f"{words(i, 150, 3000)} {edited(items[i][2], count, rng)} {words(i + 1, 50 + 200 * k, 3000)}"
            rows.append((10 * i + k, doc, "en", "s", 0, 0, 0.0, "", 0))
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(documents(spark, rows), spark.createDataFrame(items, ITEM)).collect()}
    wanted = {}
    for row in rows:
        text = np.array(row[1].split())
        for _, i, item, _ in items:
            least = least_edits(item.split(), text)
            if least <= int(0.2 * lengths[i]):
                wanted[(row[0], i)] = least
    assert len(wanted) >= 4 * len(lengths)
    assert got.items() <= wanted.items() and len(got) >= 0.97 * len(wanted)
    assert all((10 * i + k, i) in got for i in range(len(lengths)) for k in (0, 1))


def test_walks_reach_the_ends_of_long_windows():
    for size in (64, 128, 1024):
        for repeat in range(16):
            steps = decontaminate._steps(size, repeat)
            assert steps == sorted(steps) and steps[0] < decontaminate.EARLY and 4 * size < 3 * steps[-1] < 6 * size
    # a window's last words take part: other coins beyond 64 steps
    hashes = np.arange(1000, dtype=np.uint64)
    assert len({decontaminate._coins(hashes, 0, lot).tobytes() for lot in range(8)}) == 8


def plain_targets(sizes):
    """Share, stop, reshare until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1.0 + i % 3 for i, s in enumerate(names)}
    total, stopped = float(sum(sizes.values())), {}
    while True:
        rest = [s for s in names if s not in stopped]
        level = (total - sum(stopped.values())) / sum(weight[s] for s in rest) if rest else 0
        over = [s for s in rest if level * weight[s] > 3 * sizes[s]]
        if not over:
            return {**stopped, **{s: level * weight[s] for s in rest}}
        stopped |= {s: 3.0 * sizes[s] for s in over}


def mix_rows():
    rng = random.Random(8)
    rows = [(i, words(i, rng.randrange(1, 60)), "en", rng.choice(["a", "b", "b", "b", "b", "b", "é", "tiny", None]), 0, 0, 0.0, "", 0) for i in range(900)]
    return [r for r in rows if r[3] != "tiny" or r[0] < 200] + list(odd_rows())


@pytest.mark.parametrize("leaf", [20_000, 20])
def test_mix_meets_its_targets(spark, monkeypatch, leaf):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN", 3)
    rows = mix_rows()
    plan = mixing.plan_mix(documents(spark, rows)).collect()
    assert sum(r.times for r in plan) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    want = plain_targets(sizes)
    for s in sizes:
        mine = [r for r in plan if r.source == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s]) and 0 <= r.copies <= 3 for r in mine)
        largest = max(r["size"] * r.times for r in mine)
        assert abs(sum(r["size"] * r.times * r.copies for r in mine) - want[s]) <= largest
    again = mixing.plan_mix(documents(spark, rows).repartition(3)).collect()
    assert sorted((r.rkey, r.copies) for r in again) == sorted((r.rkey, r.copies) for r in plan)


def test_mixed_rows_repeat(spark):
    rows = mix_rows()
    docs = documents(spark, rows)
    taken = Counter()
    for r in mixing.plan_mix(docs).collect():
        taken[r.doc_id, r.source, r["size"]] += r.times * r.copies
    out = mixing.mix_sources(docs)
    assert out.columns == docs.columns
    got = Counter((r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in out.collect())
    assert got == Counter({k: n for k, n in taken.items() if n})
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_repeated_rows_meet_the_target_within_one_row(spark):
    equal = [(1, words(1, 10), "en", "a", i, 0, 0.0, "", 0) for i in range(50)]  # equal in id, source and text, not in other columns
    rows = equal + [(100 + i, words(i, 10), "en", "a", 0, 0, 0.0, "", 0) for i in range(50)] + [(300 + i, words(i, 10), "en", "b", 0, 0, 0.0, "", 0) for i in range(100)]
    plan = mixing.plan_mix(documents(spark, rows)).collect()
    for s in "ab":
        mine = [r for r in plan if r.source == s]
        assert abs(sum(r["size"] * r.times * r.copies for r in mine) - mine[0].target) <= 10
    out = mixing.mix_sources(documents(spark, rows)).collect()
    per_row = Counter(r.n_chars for r in out if r.doc_id == 1)
    share = 50 * next(r.target / r.source_size for r in plan if r.source == "a")
    assert abs(sum(per_row.values()) - share) <= 1 and max(per_row.values()) <= 3
    even = {sum(per_row.values()) // 50, -(-sum(per_row.values()) // 50)}
    assert {per_row.get(i, 0) for i in range(50)} <= even


def test_pivot_keeps_mass_and_chances():
    rng = np.random.default_rng(0)
    sizes, shares = rng.integers(1, 50, 200).astype(float), rng.random(200)
    total = np.zeros(200)
    for seed in range(400):
        keys = rng.integers(-(1 << 62), 1 << 62, 200)
        out, left = mixing._pivot(keys, sizes, shares, 0)
        assert abs((out * sizes).sum() - (shares * sizes).sum()) < 1e-6
        assert all(x in (0, 1) for i, x in enumerate(out) if i != left)
        total += out
    assert np.abs(total / 400 - shares).max() < 0.12


def test_flow_is_cheapest():
    rng = random.Random(3)
    for _ in range(30):
        m, n = rng.randrange(1, 4), rng.randrange(1, 4)
        supply = [rng.randrange(4) for _ in range(m)]
        capacity = [rng.randrange(1, 5) for _ in range(n)]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        price = {(i, j): rng.randrange(4) for i in range(m) for j in range(n)}
        flow = resharding.min_cost_flow(supply, capacity, lambda i, j: price[i, j])
        assert [sum(f for (a, _), f in flow.items() if a == i) for i in range(m)] == supply
        assert all(sum(f for (_, b), f in flow.items() if b == j) <= capacity[j] for j in range(n))
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        best = min((sum(price[i, j] for i, j in zip(units, to)) for to in itertools.product(range(n), repeat=len(units))
                    if all(to.count(j) <= capacity[j] for j in range(n))), default=0)
        assert sum(price[k] * f for k, f in flow.items()) == best
    with pytest.raises(ValueError):
        resharding.min_cost_flow([5], [4])


def test_flow_through_the_hub_moves_the_fewest_bytes():
    rng = random.Random(4)
    for m, n in [(3, 3), (4, 2), (2, 5), (1, 1), (2000, 2500), (2500, 2000)]:
        supply = [rng.randrange(10_000) for _ in range(m)]
        capacity = resharding.even_capacities(sum(supply), n)
        flow = resharding.min_cost_flow(supply, capacity)
        old, new = Counter(), Counter()
        for (i, j), f in flow.items():
            old[i] += f
            new[j] += f
        assert [old[i] for i in range(m)] == supply and [new[j] for j in range(n)] == capacity
        assert sum(f for (i, j), f in flow.items() if i == j) == sum(map(min, supply, capacity))
        assert len(flow) < 2 * (m + n)


def test_equal_rows_have_places_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(resharding, "LISTED", 20)
    monkeypatch.setattr(resharding, "BLOCK_ROWS", 7)
    rows = [(i // times, f"text {i // times}", "en", "s", 0, 0, 0.0, str(i), 0) for times in (1, 3, 50) for i in range(1000 * times, 1000 * times + 150)]
    docs = documents(spark, rows)
    plan = resharding.reshard(resharding.sized(docs, 4), 4, 5)
    got = resharding.resharded(spark, docs, plan, tempfile.mkdtemp()).collect()
    assert Counter(tuple(r)[: len(rows[0])] for r in got) == Counter(rows)
    shards = {}
    for r in got:
        shards.setdefault(r[-2], []).append(r[-1])
    assert sorted(shards) == list(range(5)) and all(sorted(v) == list(range(len(v))) for v in shards.values())


def test_shards_are_even(spark):
    rng = random.Random(5)
    rows = [(i, words(i, 5 + int(rng.paretovariate(1.2)) % 300), "en", f"s{min(i % 9, 4)}", 0, 0, 0.0, "", 0) for i in range(1500)] + list(odd_rows())
    docs = documents(spark, rows)
    got = resharding.reshard(resharding.sized(docs, 8), 8, 10).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    total = Counter()
    for r in got:
        total[r.shard] += r["size"]
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in total}
    assert sorted(total) == list(range(10)) and all(v == list(range(len(v))) for v in slots.values())
    # the two long texts have a shard each
    small = sorted(total.values())
    assert small[-1] == max(r["size"] for r in got) and small[-2] == 70_016 and small[-3] - small[0] <= 300
    assert resharding.reshard(resharding.sized(docs.limit(0), 8), 8, 10).count() == 0


def test_an_even_layout_moves_nothing_and_rewrites_nothing(spark, tmp_path):
    docs = documents(spark, [(i, "x" * 84, "en", str(i), 0, 0, 0.0, "", 0) for i in range(120)])
    rows = resharding.sized(docs, 4).withColumn("from", F.pmod("doc_id", F.lit(4)).cast("int"))
    plan = resharding.reshard(rows, 4, 4)
    assert plan.filter("`from` <> shard").count() == 0
    state = resharding.rewrite(spark, docs, plan, str(tmp_path)).collect()
    assert [r.affected for r in state] == [False] * 4
    grown = resharding.reshard(rows, 4, 5).cache()
    assert grown.filter("`from` <> shard").agg({"size": "sum"}).first()[0] == 120 * 100 // 5
    state = resharding.rewrite(spark, docs, grown, str(tmp_path / "g")).collect()
    assert sum(r.rows for r in state if r.affected) == spark.read.parquet(str(tmp_path / "g" / "shards")).count() == 120


def test_a_rewrite_leaves_other_shards_and_empties_lost_ones(spark, tmp_path):
    docs = documents(spark, [(i, "x" * 84, "en", str(i), 0, 0, 0.0, "", 0) for i in range(40)])
    keys = resharding.sized(docs, 4).withColumn("from", F.pmod("doc_id", F.lit(4)).cast("int"))
    old = keys.withColumn("copy", F.lit(1)).withColumn("shard", F.col("from")).withColumn("slot", F.lit(0).cast("long"))
    path = str(tmp_path / "shards")
    resharding.placed(docs, old).write.partitionBy("_shard").parquet(path)
    kept = sorted((tmp_path / "shards" / "_shard=0").glob("*.parquet"))
    # shard 3 goes to shard 2; 0 and 1 keep their documents
    plan = old.withColumn("shard", F.least("from", F.lit(2)))
    state = {r.shard: (r.affected, r.rows) for r in resharding.rewrite(spark, docs, plan, str(tmp_path)).collect()}
    assert state == {0: (False, 10), 1: (False, 10), 2: (True, 20), 3: (True, 0)}
    assert kept and sorted((tmp_path / "shards" / "_shard=0").glob("*.parquet")) == kept
    got = spark.read.parquet(path).select("doc_id", "_shard").collect()
    assert sorted((r.doc_id, r._shard) for r in got) == [(i, min(i % 4, 2)) for i in range(40)]
    whole = resharding.resharded(spark, docs, plan, str(tmp_path / "new"))
    assert sorted((r.doc_id, r._shard) for r in whole.collect()) == [(i, min(i % 4, 2)) for i in range(40)]


def quality_tables(spark):
    rng = random.Random(2)
    rows = [(i, words(i, rng.randrange(5, 90)) + (" ###%% buy now" * 3 if i % 4 == 0 else ""), "en", "s", 0, 0, 0.0, "", 0) for i in range(600)]
    labels = [(i, int(i % 4 != 0), 0) for i in range(400)] + [(3, 0, 0), (None, 1, 0), (5000, 1, 0), (7, None, 0)]
    return documents(spark, rows + list(odd_rows())), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_on_rows_it_has_not_seen(spark):
    docs, labels = quality_tables(spark)
    model = classifier.fit(docs, labels)
    got = classifier.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    unseen = [r for r in got if r.doc_id is not None and 400 <= r.doc_id < 600]
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 4 != 0) for r in unseen]) > 0.97
    kept = classifier.keep_good(docs, model, 0.5)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.score >= 0.5)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1)], 1.0), ([(1, 0)], 0.0)])
def test_classifier_without_both_classes(spark, labels, score):
    docs, _ = quality_tables(spark)
    model = classifier.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert all(abs(r.score - score) < 1e-5 for r in classifier.score(docs, model).collect())
    assert classifier.score(docs.limit(0), model).count() == 0


def test_descent_reaches_the_optimum():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 6))
    y = np.where(x @ rng.normal(size=6) + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - y * (x @ w + b)).sum()

    # rows with all features, each with its own ratio: the ratio row stands for the values
    weight, bias = np.zeros(6), 0.0
    alpha, square = np.zeros(60), (x * x).sum(axis=1) + 1
    for _ in range(3000):
        for i in range(60):
            new = min(max(alpha[i] - (y[i] * (weight @ x[i] + bias) - 1) / square[i], 0), 1)
            weight, bias, alpha[i] = weight + (new - alpha[i]) * y[i] * x[i], bias + (new - alpha[i]) * y[i], new
    rows = [np.flatnonzero(r > 0) for r in x]
    ratio = np.abs(rng.normal(size=6)) + 0.1
    got, b = classifier._descend(rows, ratio, y, np.ones(60), 2000)
    x = np.array([np.where(np.isin(np.arange(6), r), ratio, 0) for r in rows])
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    best = loss(got, b)
    for _ in range(300):
        assert loss(got + 0.02 * rng.normal(size=6), b + 0.02 * rng.normal()) >= best - 1e-3


def test_pipeline_stages(spark, tmp_path):
    docs, labels = quality_tables(spark)
    rows = [r for r in docs.collect() if r.doc_id is not None and r.doc_id >= 20]
    passage = words(7777, 30, 5000)
    extra = [(2000 + i, words(2000, 100) + (" tail" if i else ""), "en", "b", 0, 0, 0.0, "", 0) for i in range(4)]
    extra += [(3000 + i, f"{words(3000 + i, 50)} {passage} {words(4000 + i, 50)}", "en", "c", 0, 0, 0.0, "", 0) for i in range(6)]
    folder = str(tmp_path)
    spark.createDataFrame([*map(tuple, rows), *extra], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    columns, steps = now.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(f"{folder}/out/{name}")
        now = spark.read.parquet(f"{folder}/out/{name}")
        steps.append(now)
    assert all(s.columns == columns for s in steps[:-1])
    ids = [Counter(r.doc_id for r in s.collect()) for s in steps]
    assert {i for i in range(20, 600) if i % 4 == 0} & set(ids[0]) == set()
    assert set(ids[1]) <= set(ids[0]) and ids[1].most_common(1)[0][1] == 1 and [2000 + i in ids[1] for i in range(4)] == [True, False, False, False]
    assert set(ids[1]) - set(ids[2]) == {3000 + i for i in range(6)}
    assert set(ids[3]) <= set(ids[2]) and ids[4] == ids[3]
    whole = corpus_pipeline.run(spark, folder)
    assert Counter(r.doc_id for r in whole.collect()) == ids[4]
    assert set(columns) <= set(whole.columns) and whole.agg({"_shard": "max"}).first()[0] <= 39
