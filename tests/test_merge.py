import random

from pyspark.sql import functions as F

from tabloom.operators import merge, ranking

SCHEMA = "id int, a string, b int, stamp string"


def tables(spark, seed):
    rng = random.Random(seed)
    target = [(i, f"t{i}", i, "old") for i in range(0, 40, 2)]
    # Key 4 takes a third of the batch.
    updates = [
        (seq, rng.choice([4, 4, rng.randint(0, 60)]), rng.choice([None, f"u{seq}"]), rng.choice([None, seq]), "new")
        for seq in range(120)
    ]
    return (
        target, updates,
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(updates, "seq int, " + SCHEMA),
    )


def test_replace_upsert_equals_row_by_row(spark):
    target, updates, t, u = tables(spark, 1)
    state = {r[0]: list(r) for r in target}
    for _, key, a, b, stamp in updates:
        if key in state:
            state[key][1:3] = [a, b]
        else:
            state[key] = [key, a, b, stamp]
    got = merge.replace_upsert(t, u, "id", "seq", keep=("stamp",))
    assert got.columns == t.columns
    assert sorted(map(list, got.collect())) == sorted(state.values())


def test_coalesce_upsert_equals_row_by_row_and_is_idempotent(spark):
    target, updates, t, u = tables(spark, 2)
    state = {r[0]: list(r) for r in target}
    for _, key, a, b, _ in updates:
        row = state.setdefault(key, [key, None, None, None])
        row[1:3] = [a if a is not None else row[1], b if b is not None else row[2]]
    once = merge.coalesce_upsert(t, u, "id", "seq", ["a", "b"])
    assert sorted(map(str, map(list, once.collect()))) == sorted(map(str, state.values()))
    twice = merge.coalesce_upsert(once, u, "id", "seq", ["a", "b"])
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_empty_update_changes_nothing(spark):
    _, _, t, u = tables(spark, 3)
    none = u.where("false")
    for got in (
        merge.replace_upsert(t, none, "id", "seq"),
        merge.coalesce_upsert(t, none, "id", "seq", ["a", "b"]),
        merge.child_replace(t, none.drop("seq"), "id"),
        merge.update_join(t, none, "id", ["a", "b"]),
    ):
        assert sorted(got.collect()) == sorted(t.collect())


def test_child_replace_keeps_untouched_parents_and_takes_last_batch(spark):
    children = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "p int, c string")
    new = spark.createDataFrame([(1, "n1", 1), (1, "n2", 2), (1, "n3", 2), (3, "n4", 1)], "p int, c string, batch int")
    got = merge.child_replace(children, new, "p", "batch")
    assert sorted(map(tuple, got.collect())) == [(1, "n2"), (1, "n3"), (2, "z"), (3, "n4")]


def test_update_join_sets_nulls_and_ignores_unknown_keys(spark):
    t = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, x string, y int")
    u = spark.createDataFrame([(1, None), (9, "q")], "id int, x string")
    assert sorted(map(tuple, merge.update_join(t, u, "id", ["x"]).collect())) == [(1, None, 1), (2, "b", 2)]


def test_referential_actions(spark):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    children = spark.createDataFrame([(1, "a"), (3, "b")], "pid int, v string")
    assert merge.orphans(children, parents, "pid", "id").collect()[0]["v"] == "b"
    assert merge.cascade_delete(children, parents, "pid", "id").collect()[0]["v"] == "a"
    moved = merge.cascade_rename(children, spark.createDataFrame([(1, 7)], "o int, n int"), "pid", "o", "n")
    assert sorted(map(tuple, moved.collect())) == [(3, "b"), (7, "a")]


def test_stamped_upsert_stamps_only_what_it_touches(spark):
    t = spark.createDataFrame([(1, "a", "then"), (2, "b", "then")], "id int, w string, at string")
    u = spark.createDataFrame([(1, "c", 1)], "id int, w string, seq int")
    got = merge.stamped_upsert(t, u, "id", "seq", "at", F.lit("now"))
    assert sorted(map(tuple, got.collect())) == [(1, "c", "now"), (2, "b", "then")]


def test_precedence_union(spark):
    hot = spark.createDataFrame([("a", 1), ("b", 2)], "id string, pos int")
    new = spark.createDataFrame([("b", 1), ("c", 2), ("c", 3)], "id string, pos int")
    got = ranking.precedence_union([hot, new], "id", ["pos"])
    assert sorted(map(tuple, got.collect())) == [("a", 1), ("b", 2), ("c", 2)]
    assert [r["id"] for r in ranking.precedence_union([hot, new], "id", ["pos"], 2).collect()] == ["a", "b"]
    assert ranking.precedence_union([hot, new], "id", ["pos"], 0).count() == 0


def test_group_limit_is_planned_below_the_exchange(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    plan = ranking.top_per_group(rows, ["g"], [F.desc("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Partial") > plan.index("Exchange")


def test_small_batch_is_broadcast_and_the_target_not_shuffled(spark):
    t = spark.range(100_000).select(F.col("id"), F.lit("a").alias("v"))
    u = spark.createDataFrame([(5, "b", 1), (200_000, "c", 2)], "id bigint, v string, seq int")
    got = merge.replace_upsert(t, u, "id", "seq")
    assert got.count() == 100_001
    assert got.where("id = 5").head()["v"] == "b"
