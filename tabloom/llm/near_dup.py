"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and union-find.

Each element of a document's shingle set draws a pseudo-random permutation of the signature's slots
and offers the value ``j + r_j`` to the ``j``-th slot of that permutation. Ranks within one element are
thus correlated, which lowers the variance, and a document is finished as soon as every slot is filled:
later ranks could not lower any of them.

Cases: null, empty and blank texts have no shingles and stand alone; equal sets are one class, so
repeated rows cost one row each and no pairs; null ids are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.grams import GOLD, U, as_bytes, byte_table, mix, runs, shingles, split_words, stored

SLOTS, ROWS = 128, 4
BANDS = SLOTS // ROWS
BLOCK, FAMILY, WIDTH = 512, 256, 4096
UNSET = (1 << 64) - 1


def super_minhash(elements: np.ndarray, owner: np.ndarray, count: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures of ``count`` sets: ``elements`` are the distinct hashes, ``owner`` the set each belongs to.

    Returns one row per set with 64-bit values, rank in the upper bits; an empty set stays unset.
    """
    best = np.full(count * slots, UNSET, dtype=np.uint64)
    order: np.ndarray | None = None
    for j in range(slots):
        if not len(elements):
            break
        draw = mix(elements + U(GOLD * (j + 1) % (1 << 64)))
        pick = j + (((draw >> U(40)) * U(slots - j)) >> U(24)).astype(np.int64)
        value = (draw & U((1 << 40) - 1)) | U(j << 40)
        lane = np.arange(len(elements))
        slot = pick if order is None else order[lane, pick]
        np.minimum.at(best, owner * slots + slot.astype(np.int64), value)
        filled = (best.reshape(count, slots) != U(UNSET)).all(axis=1)
        live = ~filled[owner]
        elements, owner, pick = elements[live], owner[live], pick[live]
        if order is None:
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
            moved = np.zeros(len(elements), dtype=np.uint16)
        else:
            order = order[live]
            moved = order[:, j].copy()
        order[np.arange(len(elements)), pick] = moved
    return best.reshape(count, slots)


def _signed(values: np.ndarray) -> pa.ListArray:
    """Rows of a matrix as a list column."""
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _distinct(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    hashes, bounds = split_words(texts, byte_table(lower=True))
    return [np.unique(shingles(hashes[a:b], words)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def signature_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Set size, class digest, signature and band keys of each text; the other columns pass."""
    for batch in batches:
        texts, at = as_bytes(batch.column("text")), batch.schema.get_field_index("text")
        for first, last in runs(texts, 1 << 19):
            sets = _distinct(texts[first:last], words)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            elements = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), sizes)
            values = super_minhash(elements, owner, len(sets))
            short = mix(values)
            keys = short.reshape(len(sets), BANDS, ROWS)
            band = np.zeros((len(sets), BANDS), dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * U(GOLD)
            for i in range(ROWS):
                band = mix(band ^ keys[:, :, i])
            sums = []
            for salt in (GOLD, 0xD6E8FEB86659FD93):
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(elements ^ U(salt)))])
                ends = np.cumsum(sizes)
                sums.append(total[ends] - total[ends - sizes])
            digest = np.stack(sums, axis=1).astype(">u8").tobytes()
            rest = batch.slice(first, last - first)
            columns = [c for i, c in enumerate(rest.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sizes), pa.array([digest[16 * i : 16 * i + 16] for i in range(len(sets))], pa.binary()),
                 _signed((short >> U(48)).astype(np.uint16).view(np.int16)), _signed(band.view(np.int64))],
                names=[*names, "n_shingles", "cls", "sig", "bands"],
            )


def set_rows(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Class and full shingle set of each text."""
    for batch in batches:
        texts, cls = as_bytes(batch.column("text")), batch.column("cls")
        for first, last in runs(texts):
            sets = _distinct(texts[first:last], words)
            offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([cls.slice(first, last - first), lists], names=["cls", "items"])


def _blocks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """The rows of each (group, p, q), which arrive sorted: a block never has more than two parts' members."""
    last, held = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ("grp", "p", "q", *columns)], strict=True):
            if row[:3] != last:
                if len(held) > 1:
                    yield last, held
                last, held = row[:3], []
            held.append(row[3:])
    if len(held) > 1:
        yield last, held


def _joining(members: list[tuple], near) -> Iterator[tuple[bytes, bytes]]:
    """Pairs that join members of different components, at most one fewer than members.

    ``members`` begin with class and component; ``near(i, others)`` says which of ``others`` are close to ``i``.
    """
    names = {c: k for k, c in enumerate(dict.fromkeys(m[1] for m in members))}
    root = np.array([names[m[1]] for m in members])
    for i in range(len(members) - 1):
        others = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
        if len(others):
            for k in others[near(i, others)]:
                if root[k] != root[i]:
                    yield tuple(sorted((members[i][0], members[k][0])))
                    root[root == root[k]] = root[i]


def alike_rows(batches: Iterator[pa.RecordBatch], floor: float) -> Iterator[pa.RecordBatch]:
    """Joining pairs whose signatures agree on ``floor`` of the slots, for each block of a bucket."""
    for _, members in _blocks(batches, ("cls", "comp", "sig")):
        sig = np.array([m[2] for m in members], dtype=np.int16)
        pairs = list(_joining(members, lambda i, others, sig=sig: (sig[others] == sig[i]).mean(axis=1) >= floor))
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])


def linked_rows(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Joining pairs whose full sets reach the similarity, for each block of a family.

    Intersections of all pairs of a block are products of 0/1 matrices, some shared shingles at a time.
    """
    for _, members in _blocks(batches, ("cls", "comp", "items")):
        sizes = np.array([len(m[2]) for m in members])
        items = np.concatenate([np.asarray(m[2], dtype=np.int64) for m in members])
        owner = np.repeat(np.arange(len(members)), sizes)
        _, column, times = np.unique(items, return_inverse=True, return_counts=True)
        shared = times[column] > 1
        _, column = np.unique(column[shared], return_inverse=True)
        owner, order = owner[shared], np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        both = np.zeros((len(members), len(members)), dtype=np.float64)
        width = int(column[-1]) + 1 if len(column) else 0
        for at in range(0, width, WIDTH):
            a, b = np.searchsorted(column, [at, at + WIDTH])
            part = np.zeros((len(members), min(WIDTH, width - at)), dtype=np.float32)
            part[owner[a:b], column[a:b] - at] = 1
            both += part @ part.T
        close = both * (100 + percent) >= percent * (sizes[:, None] + sizes[None, :])
        pairs = list(_joining(members, lambda i, others, close=close: close[i, others]))
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _dealt(rows: DataFrame, count: str, size: int, *columns: str) -> DataFrame:
    """Rows of each ``grp`` in pairs of parts of about ``size`` rows, one pair after the other."""
    parts = F.ceil(F.col(count) / size).cast("int")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("cls"), parts).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    rows = rows.select("grp", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), *columns)
    return rows.repartition("grp", "p", "q").sortWithinPartitions("grp", "p", "q")


def components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """(node, comp) for the nodes of undirected ``edges`` (a, b): comp is the smallest node reachable.

    Alternates large-star and small-star steps, which need a number of rounds that grows with the
    logarithm of the links, until the links form stars. Every round is written to the shared folder.
    """
    now = stored(edges.select("a", "b").filter("a <> b").distinct(), "links")
    seen = None
    for _ in range(limit):
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        now = stored(small.filter("a <> b").distinct(), "links")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen = tuple(mark)
    else:
        raise RuntimeError("links did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    one = sets.select(F.col("cls").alias("b"), F.col("items").alias("ib"))
    two = sets.select(F.col("cls").alias("a"), F.col("items").alias("ia"))
    both = F.size(F.array_intersect("ia", "ib")).cast("long")
    joined = pairs.join(one, "b").join(two, "a")
    return joined.filter(both * (100 + percent) >= (F.size("ia") + F.size("ib")) * F.lit(percent)).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 75, stars: bool = True
) -> DataFrame:
    """Groups of documents linked by a similarity of shingle sets of at least ``percent``.

    Returns a row per document: doc_id, text_key (hash of the text), cls (digest of the set), n_shingles,
    component_id (the smallest id reachable), kept. Candidates are classes of equal sets that share a band;
    each is confirmed on full sets. A pair exactly at 75 % shares none of the 32 bands with probability 5e-6.

    A bucket of any size is worked off without emitting its pairs. Every member is compared with the bucket's heaviest member (the one
    with most neighbours), which joins most of a group of copies with as many pairs as members. Members still in different
    components then meet in blocks of ``BLOCK``, and classes with similar signatures form families, each block emitting at most
    one pair per member; in a family all full sets meet in blocks of ``FAMILY``, and what joins components there is a link.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumn("text_key", F.xxhash64("text"))
    rows = stored(
        source.mapInArrow(
            lambda batches: signature_rows(batches, words),
            "doc_id long, text_key long, n_shingles long, cls binary, sig array<smallint>, bands array<long>",
        ),
        "signatures",
    )
    full = rows.filter("n_shingles > 0")
    classes = stored(
        full.groupBy("cls").agg(F.min("doc_id").alias("low"), F.first("text_key").alias("text_key"),
                                F.first("sig").alias("sig"), F.first("bands").alias("bands")), "classes"
    )
    banded = classes.select("cls", F.explode("bands").alias("bkey"))
    shared = banded.groupBy("bkey").agg(F.count("*").alias("n")).filter("n > 1")
    members = stored(banded.join(shared, "bkey"), "members")
    weight = members.groupBy("cls").agg(F.sum("n").alias("weight"))
    wanted = weight.join(classes, "cls").select("cls", "text_key", "weight", "sig")
    wanted = stored(wanted, "wanted")
    once = source.join(wanted.select("cls", "text_key"), "text_key").dropDuplicates(["cls"])
    sets = stored(once.select("cls", "text").mapInArrow(lambda batches: set_rows(batches, words), "cls binary, items array<long>"), "sets")
    sigs = wanted.select("cls", "sig")

    floor = max(0.0, percent / 100 - 0.18)  # four and a half deviations of the estimate
    alike = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    placed = members.join(wanted.select("cls", "weight"), "cls")
    centre = placed.groupBy("bkey").agg(F.max_by("cls", F.struct("weight", "cls")).alias("a"))
    if stars:
        pairs = members.join(centre, "bkey").filter("cls <> a")
        pairs = pairs.select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct()
        near = pairs.join(sigs.select(F.col("cls").alias("a"), F.col("sig").alias("sa")), "a")
        near = near.join(sigs.select(F.col("cls").alias("b"), F.col("sig").alias("sb")), "b")
        near = stored(near.filter(alike >= F.ceil(F.lit(floor * SLOTS))).select("a", "b"), "near")
        links = stored(_verified(near, sets, percent), "found")
        comps = components(links)
    else:
        links = wanted.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
        comps = wanted.select(F.col("cls").alias("node"), F.col("cls").alias("comp")).limit(0)
    named = wanted.join(comps, wanted["cls"] == comps["node"], "left").select("cls", F.coalesce("comp", "cls").alias("comp"), "sig")
    named = stored(named, "named")
    placed = members.join(named.select("cls", "comp"), "cls")
    open_ = placed.groupBy("bkey").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("bkey")
    placed = placed.join(open_, "bkey").join(sigs, "cls").withColumnRenamed("bkey", "grp")
    similar = _dealt(placed, "n", BLOCK, "cls", "comp", "sig").mapInArrow(lambda batches: alike_rows(batches, floor), "a binary, b binary")
    similar = stored(similar.distinct(), "similar")
    ties = named.filter("cls <> comp").select(F.col("cls").alias("a"), F.col("comp").alias("b")).union(similar)
    families = components(ties).withColumnRenamed("comp", "grp")
    family = named.select("cls", "comp").join(families, F.col("cls") == F.col("node")).drop("node")
    mixed = family.groupBy("grp").agg(F.count("*").alias("n"), F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y")
    family = family.join(mixed.select("grp", "n"), "grp").join(sets, "cls")
    more = _dealt(family, "n", FAMILY, "cls", "comp", "items").mapInArrow(lambda batches: linked_rows(batches, percent), "a binary, b binary")
    labels = components(links.union(more))

    lows = labels.join(classes.select("cls", "low"), labels["node"] == classes["cls"])
    lows = lows.groupBy("comp").agg(F.min("low").alias("component_id"))
    joined = labels.join(lows, "comp").select(F.col("node").alias("cls"), "component_id")
    alone = classes.join(joined, "cls", "left").select("cls", F.coalesce("component_id", "low").alias("component_id"))
    out = rows.select("doc_id", "text_key", "cls", "n_shingles")
    joined = out.filter("n_shingles > 0").join(alone, "cls")
    empty = out.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return (
        joined.unionByName(empty)
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select("doc_id", "text_key", "cls", "n_shingles", "component_id", "kept")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents without near duplicates: of each group the row whose id is the group's smallest stays.

    Rows that repeat an id together with an equal set are one document and leave one row.
    """
    verdict = near_duplicates(docs, id_col, text_col, **how).filter("kept")
    verdict = verdict.groupBy("doc_id", "cls", (F.col("n_shingles") == 0).alias("blank")).agg(
        F.min("text_key").alias("text_key"), F.count("*").alias("times")
    )
    keys = verdict.select(F.col("doc_id").alias("__kid"), F.col("text_key").alias("__kkey"))
    marked = docs.withColumns({"__key": F.xxhash64(F.col(text_col).cast("string")), "__id": F.col(id_col).cast("long")})
    joined = marked.join(keys, F.col("__id").eqNullSafe(F.col("__kid")) & (F.col("__key") == F.col("__kkey")))
    return joined.dropDuplicates(["__id", "__key"]).select(*[F.col(f"`{c}`") for c in docs.columns])
