"""Keyed merges that return the new table state.

Update batches are reduced to one row per key first, with an aggregate that
combines on the map side, so a key repeated in a third of the batch is
harmless. An upsert is one full outer join of target and reduced batch: each side is
shuffled once, and the target is neither scanned again nor rewritten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order(seq: str | list[str]) -> Column:
    return F.struct(seq) if isinstance(seq, list) else F.col(seq)


def last_per_key(rows: DataFrame, key: str, seq: str | list[str]) -> DataFrame:
    """The last row of each key in sequence order."""
    value = F.max_by(F.struct(*rows.columns), _order(seq))
    return rows.groupBy(key).agg(value.alias("_row")).select("_row.*")


def first_per_key(rows: DataFrame, key: str | list[str], seq: str | list[str]) -> DataFrame:
    """The first row of each key in sequence order."""
    keys = [key] if isinstance(key, str) else key
    value = F.min_by(F.struct(*rows.columns), _order(seq))
    return rows.groupBy(*keys).agg(value.alias("_row")).select("_row.*")


def _merged(target: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """Key, ``_old`` and ``_new``: both sides side by side from one full outer join, each shuffled once."""
    old = target.select(key, F.struct(*target.columns).alias("_old"))
    new = latest.select(key, F.struct(*latest.columns).alias("_new"))
    return old.join(new, key, "full_outer")


def replace_upsert(
    target: DataFrame, updates: DataFrame, key: str, seq: str | list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Insert or overwrite by key; NULLs overwrite too.

    Columns in ``keep`` (an insertion stamp, say) hold their value on update.
    """
    columns = target.columns
    old, new = F.col("_old"), F.col("_new")

    def value(c: str) -> Column:
        first, second = (old, new) if c in keep else (new, old)
        return F.when(first.isNotNull(), first[c]).otherwise(second[c]).alias(c)

    both = _merged(target, last_per_key(updates, key, seq).select(*columns), key)
    return both.select(*(F.col(c) if c == key else value(c) for c in columns))


def coalesce_upsert(
    target: DataFrame, updates: DataFrame, key: str, seq: str | list[str], columns: list[str]
) -> DataFrame:
    """Insert or fill by key: a NULL never overwrites a value.

    Within a batch the last non-NULL value of each column wins, which is
    what applying the rows one by one gives.
    """
    order = _order(seq)
    latest = updates.groupBy(key).agg(
        *(F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns)
    )
    old, new = F.col("_old"), F.col("_new")

    def value(c: str) -> Column:
        return (F.coalesce(new[c], old[c]) if c in columns else old[c]).alias(c)

    both = _merged(target, latest, key)
    return both.select(*(F.col(c) if c == key else value(c) for c in target.columns))


def child_replace(
    children: DataFrame, new: DataFrame, parent: str, batch: str | None = None
) -> DataFrame:
    """Delete the children of every parent in ``new``, then add ``new``.

    Parents without new children keep theirs. With ``batch`` only
    the last batch of each parent counts, as if applied in turn.
    """
    if batch:
        latest = new.groupBy(parent).agg(F.max(batch).alias(batch))
        new = new.join(latest, [parent, batch], "left_semi").drop(batch)
    kept = children.join(new.select(parent).distinct(), parent, "left_anti")
    return kept.unionByName(new)


def update_join(target: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Set ``columns`` by key, NULLs included; unknown keys are ignored.

    ``updates`` holds one row per key.
    """
    renamed = updates.select(key, F.struct(*columns).alias("_new"))
    return target.join(renamed, key, "left").select(
        *(
            F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c)
            if c in columns
            else F.col(c)
            for c in target.columns
        )
    )


def stamped_upsert(
    target: DataFrame, updates: DataFrame, key: str, seq: str, stamp: str, now: Column | None = None
) -> DataFrame:
    """Replace-upsert that stamps the rows it touches."""
    when = F.current_timestamp() if now is None else now
    return replace_upsert(target, updates.withColumn(stamp, when), key, seq)


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children whose parent does not exist."""
    keys = parents.select(F.col(parent_key).alias(child_key))
    return children.join(keys, child_key, "left_anti")


def cascade_delete(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Children that remain once only ``parents`` are left."""
    keys = parents.select(F.col(parent_key).alias(child_key))
    return children.join(keys, child_key, "left_semi")


def cascade_rename(children: DataFrame, renames: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Children follow parents whose key changed. ``renames`` holds one row per old key."""
    moved = renames.select(F.col(old).alias(key), F.col(new).alias("_key"))
    return children.join(moved, key, "left").select(
        *(F.coalesce("_key", key).alias(key) if c == key else F.col(c) for c in children.columns)
    )


def not_done(items: DataFrame, manifest: DataFrame, key: str) -> DataFrame:
    """Items the manifest does not list yet."""
    return items.join(manifest.select(key), key, "left_anti")
