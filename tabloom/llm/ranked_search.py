"""Ranked lexical search by pipelined term partitioning.

Terms are dealt to owners. Items travel in bundles, and documents stand in blocks; a bundle and a block have a sparse
accumulator of (item, document, score). At each owner's stage the accumulators meet, by a cogroup on (bundle, block), the postings of
the owner's terms in that block and the weights of the bundle's terms there; integer contributions are added and the
accumulators go on to the next owner. The last owner selects each item's best documents of the block, a window those of all blocks.

Texts are read once: a document's terms are counted inside its row, and those that no item has are left out by a bitmap of
fixed size over term hashes (the terms themselves decide later). Counts and weights use all documents. No task holds more than a block of
documents times a bundle of items, whatever a term's or a source's share is.

Cases: a null or term-less text is no document and a null or term-less item finds nothing; repeated documents are ranked each, repeated
items once; of equal scores a document without an id comes last; empty tables give no rows; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.grams import as_bytes, kept_in_worker, runs, stored
from tabloom.session import scratch_dir

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS = 1 << 23
KEPT_TERMS = 1_000_000
OWNERS, BLOCK_DOCS, BUNDLE_ITEMS = 4, 4096, 256

_POSTINGS = "key long, doc_id long, n long, terms array<string>, counts array<int>, owner int"
_HELD = "bundle int, block int, keys binary, ids binary, void binary, item binary, doc binary, score binary, terms array<string>, weights array<long>, items array<array<int>>"


def item_terms(text):
    """Distinct terms of a text column."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0)))


def term_bitmap(terms: DataFrame) -> bytes:
    """A bit for each hash of a term, ``BITS`` of them; built from at most ``BITS`` / 64 collected rows."""
    at = F.pmod(F.crc32(F.encode("term", "UTF-8")), F.lit(BITS))
    words = terms.select(F.shiftright(at, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit"))
    out = np.zeros(BITS // 64, dtype=np.int64)
    for row in words.groupBy("w").agg(F.bit_or("bit").alias("bits")).collect():
        out[row["w"]] = row["bits"]
    return out.tobytes()


def _owner(term: bytes, bitmap: bytes, owners: int) -> int:
    """The owner of a term, -1 for a term that surely no item has."""
    h = zlib.crc32(term)
    at = h % BITS
    return (h // BITS) % owners if bitmap[at >> 3] >> (at & 7) & 1 else -1


def _counted(batches: Iterator[pa.RecordBatch], bitmap: bytes, owners: int) -> Iterator[pa.RecordBatch]:
    """Postings of each document by owner; the first owner has a row for every document with a term."""
    table = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
    owned: dict[bytes, int] = kept_in_worker(("owners", zlib.crc32(bitmap), owners), dict)
    for batch in batches:
        for first, stop in runs(as_bytes(batch.column("text")), 1 << 22):
            part = batch.slice(first, stop - first)
            rows: list[list] = [[] for _ in range(6)]
            for key, doc, text in zip(part.column("key").to_pylist(), part.column("doc_id").to_pylist(), as_bytes(part.column("text")), strict=True):
                words = text.translate(table).split()
                if not words:
                    continue
                held: list[tuple[list, list]] = [([], []) for _ in range(owners)]
                for term, n in Counter(words).items():
                    o = owned.get(term)
                    if o is None:
                        o = owned[term] = _owner(term, bitmap, owners)
                    if o >= 0:
                        held[o][0].append(term)
                        held[o][1].append(n)
                for o, (terms, counts) in enumerate(held):
                    if terms or not o:
                        for c, v in zip(rows, (key, doc, len(words), terms, counts, o), strict=True):
                            c.append(v)
                if len(owned) > KEPT_TERMS:  # what is kept between texts is bounded
                    owned.clear()
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.int32()]
            columns = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
            columns[3] = columns[3].cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "n", "terms", "counts", "owner"])


def _array(table: pa.Table, column: str, kind=np.int64) -> np.ndarray:
    return table[column].combine_chunks().to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _board(left: pa.Table, right: pa.Table, docs: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, ids, null marks and the scores (item x document) after an owner's stage."""
    held = [r for r in left.drop_columns(["terms", "weights", "items"]).to_pylist() if r["keys"] is not None]
    new = _array(right, "key")
    keys = [np.frombuffer(r["keys"], np.int64) for r in held]
    all_keys = np.unique(np.concatenate([*keys, new]))
    ids, void = np.zeros(len(all_keys), np.int64), np.zeros(len(all_keys), np.uint8)
    here = np.searchsorted(all_keys, new)
    doc_ids = right["doc_id"].combine_chunks()
    ids[here], void[here] = _array(right.set_column(0, "id", pc.fill_null(doc_ids, 0)), "id"), _array(right.set_column(0, "void", pc.is_null(doc_ids)), "void", np.uint8)
    # the definitions: a bundle's terms of this owner, each with its weight and items
    told = [(t, w, i) for r in left.select(["terms", "weights", "items"]).to_pylist() for t, w, i in zip(r["terms"] or (), r["weights"] or (), r["items"] or (), strict=True)]
    most = max([i for _, _, items in told for i in items] + [int(np.frombuffer(r["item"], np.int32).max(initial=-1)) for r in held], default=-1)
    board = np.zeros((most + 1, len(all_keys)), dtype=np.int64)
    for r, own in zip(held, keys, strict=True):
        at = np.searchsorted(all_keys, own)
        ids[at], void[at] = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["void"], np.uint8)
        board[np.frombuffer(r["item"], np.int32), at[np.frombuffer(r["doc"], np.int32)]] = np.frombuffer(r["score"], np.int64)
    if told and right.num_rows:
        lists = right["terms"].combine_chunks()
        which = pc.index_in(lists.flatten(), value_set=pa.array([t for t, _, _ in told], lists.type.value_type)).fill_null(-1).to_numpy(zero_copy_only=False)
        tf = right["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        size = 10 + (90 * _array(right, "n") * docs) // total
        order = np.argsort(which, kind="stable")
        order = order[np.searchsorted(which[order], 0):]
        which, tf, row = which[order], tf[order], row[order]
        share = (1_000_000_000 * tf) // (1000 * tf + 8 * size[row])
        bounds = np.searchsorted(which, np.arange(len(told) + 1))
        for j, (_, w, items) in enumerate(told):
            a, b = bounds[j], bounds[j + 1]
            if a < b and w:
                board[np.ix_(items, here[row[a:b]])] += w * share[a:b]
    return all_keys, ids, void, board


def _stage(left: pa.Table, right: pa.Table, docs: int, total: int) -> pa.Table:
    """One owner's stage: the accumulator with the owner's contributions."""
    schema = pa.schema([("bundle", pa.int32()), ("block", pa.int32()), *[(c, pa.binary()) for c in ("keys", "ids", "void", "item", "doc", "score")],
                        ("terms", pa.list_(pa.string())), ("weights", pa.list_(pa.int64())), ("items", pa.list_(pa.list_(pa.int32())))])
    if not left.num_rows:
        return schema.empty_table()
    keys, ids, void, board = _board(left, right, docs, total)
    item, doc = np.nonzero(board)
    used = np.unique(doc)
    row = {
        "bundle": left["bundle"][0].as_py(), "block": left["block"][0].as_py(),
        "keys": keys[used].tobytes(), "ids": ids[used].tobytes(), "void": void[used].tobytes(),
        "item": item.astype(np.int32).tobytes(), "doc": np.searchsorted(used, doc).astype(np.int32).tobytes(), "score": board[item, doc].tobytes(),
    }
    return pa.Table.from_pylist([row], schema=schema)


def _last(left: pa.Table, right: pa.Table, docs: int, total: int, n: int) -> pa.Table:
    """The last owner's stage: each item's ``n`` best documents of the block."""
    names = ["bundle", "item", "doc_id", "score"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    out: list[list] = [[] for _ in names]
    if left.num_rows:
        _, ids, void, board = _board(left, right, docs, total)
        bundle = left["bundle"][0].as_py()
        for i, scores in enumerate(board):
            at = np.flatnonzero(scores)
            if len(at) > n:
                at = at[scores[at] >= np.partition(scores[at], len(at) - n)[len(at) - n]]
            at = at[np.lexsort((ids[at], void[at], -scores[at]))][:n]
            for c, v in zip(out, ([bundle] * len(at), [i] * len(at), [None if void[k] else int(ids[k]) for k in at], scores[at].tolist()), strict=True):
                c.extend(v)
    return pa.table([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)


def rank_documents(
    items: DataFrame, docs: DataFrame, n: int = 10, owners: int = OWNERS, block_docs: int = BLOCK_DOCS, bundle_items: int = BUNDLE_ITEMS,
    item_id: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``n`` documents with the highest score above 0 for each item, smaller ids first on ties.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); the rest is integer arithmetic on whole counts.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).dropDuplicates()
    asked = asked.select("item_id", item_terms(F.col("text")).alias("terms"), F.xxhash64("item_id", "text").alias("order")).where(F.size("terms") > 0)
    asked = stored(asked, "items")
    bundles = max(1, -(-asked.count() // bundle_items))
    asked = asked.withColumn("bundle", F.pmod("order", F.lit(bundles)).cast("int"))
    number = Window.partitionBy("bundle").orderBy("order", "item_id")
    asked = stored(asked.withColumn("item", (F.row_number().over(number) - 1).cast("int")), "bundles")
    wanted = asked.select("bundle", "item", F.explode("terms").alias("term"))
    bitmap = term_bitmap(wanted)
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = scratch_dir(spark, "postings")
    # written once: the keys stay as they are
    rows.mapInArrow(lambda b: _counted(b, bitmap, owners), _POSTINGS).write.partitionBy("owner").parquet(path)
    postings = spark.read.schema(_POSTINGS).parquet(path)
    documents, total = postings.where("owner = 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(1, -(-documents // block_docs))
    held = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(documents).cast("double") + 2) / (2 * F.col("df").cast("double") + 1)))
    weights = wanted.groupBy("bundle", "term").agg(F.sort_array(F.collect_list("item")).alias("items")).join(held.select("term", weight.alias("w")), "term")
    owner = F.pmod(F.floor(F.crc32(F.encode("term", "UTF-8")) / BITS), F.lit(owners)).cast("int")
    told = stored(weights.groupBy("bundle", owner.alias("owner")).agg(F.sort_array(F.collect_list(F.struct("term", "w", "items"))).alias("t")), "weights")
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block")
    flow = None
    blank = [F.lit(None).cast("binary").alias(c) for c in ("keys", "ids", "void", "item", "doc", "score")]
    for o in range(owners):
        mine = told.where(F.col("owner") == o).select("bundle", "t.term", "t.w", "t.items")
        mine = mine.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        mine = mine.select("bundle", "block", *blank, F.col("term").alias("terms"), F.col("w").alias("weights"), "items")
        flow = mine if flow is None else flow.unionByName(mine)
        theirs = postings.where(F.col("owner") == o).select("key", "doc_id", "n", "terms", "counts", block)
        theirs = theirs.withColumn("bundle", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))))
        groups = flow.groupBy("bundle", "block").cogroup(theirs.groupBy("bundle", "block"))
        if o < owners - 1:
            flow = groups.applyInArrow(lambda a, b: _stage(a, b, documents, total), _HELD)
        else:
            flow = groups.applyInArrow(lambda a, b: _last(a, b, documents, total, n), "bundle int, item int, doc_id long, score long")
    best = Window.partitionBy("bundle", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = flow.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    return top.join(asked.select("bundle", "item", "item_id"), ["bundle", "item"]).select("item_id", "rank", "doc_id", "score")


SQL = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') AS t FROM documents),
dn AS (SELECT k, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM dn),
tf AS (SELECT k, term, count(*)::BIGINT AS tf FROM (SELECT k, unnest(t) AS term FROM d) GROUP BY 1, 2),
i AS (SELECT DISTINCT item_id, unnest(list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}'))) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * nd::DOUBLE + 2) / (2 * df::DOUBLE + 1)))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY 1), g),
s AS (SELECT item_id, doc_id, k, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN tf USING (term) JOIN dn USING (k), g GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""
