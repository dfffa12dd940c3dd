"""Sequence packing by non-negative least squares.

A document's token ids (and an end id) are cut at multiples of the window; what is left of it, its rest, has a length below the
window. Rests are counted by length in grains, so the histogram has a fixed number of bins. Shallow combinations of lengths
that fill a window (up to three lengths once each, or two lengths repeated) are the columns of a non-negative
least-squares problem whose right side is the histogram; its solution, rounded down to whole windows that the
histogram can supply, says how often each combination is used. Greedy best-fit packs lengths that are left into further full
combinations; what then remains is laid end to end and cut at the windows' bounds, so that only the very last window has padding
beyond the grain of its members.

Only the histogram and the solution (a few numbers per bin) are on the driver. Rests are numbered within their bin by block, and a rest's
number says by arithmetic which window and place it has; ids are joined once, by a unique key.

Cases: a null text is empty and has only the end id; repeated rows and rows with a null id are documents of their own; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.llm.grams import BLOCK_ROWS, as_bytes, byte_table, kept_in_worker, running, size_runs, stored

WINDOW, GRAIN = 4096, 16
KEPT_WORDS, LONG_WORD, RUN = 300_000, 100, 8 << 20
OUT_BYTES = 4 << 20


def combinations(units: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and repeats (three places each, unused ones 0) of the shallow combinations that add up to ``units``."""
    found = [((a, 0, 0), (units // a, 0, 0)) for a in range(1, units + 1) if units % a == 0]
    for a in range(1, units):
        for i in range(1, (units - 1) // a + 1):
            left = units - a * i
            found += [((a, b, 0), (i, left // b, 0)) for b in range(a + 1, left + 1) if left % b == 0]
    for a in range(1, units // 3 + 1):
        found += [((a, b, units - a - b), (1, 1, 1)) for b in range(a + 1, (units - a - 1) // 2 + 1)]
    lengths, repeats = zip(*found, strict=True)
    return np.array(lengths), np.array(repeats)


def _column(lengths: np.ndarray, repeats: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size)
    np.add.at(out, lengths, repeats)
    out[0] = 0
    return out


def nnls(lengths: np.ndarray, repeats: np.ndarray, target: np.ndarray, tolerance: float = 1e-9) -> dict[int, float]:
    """{combination: weight} that minimises the squared distance to ``target`` (by length, place 0 unused) without negative weights.

    The active-set method; the columns are never laid out but for those in use, of which there are at most as many as bins.
    """
    scale = max(float(target.max(initial=0)), 1.0)
    goal = target / scale
    used: list[int] = []
    weights = np.zeros(0)
    columns = np.zeros((len(goal), 0))
    rest = goal.copy()
    for _ in range(4 * len(goal)):
        gain = (repeats * rest[lengths] * (lengths > 0)).sum(axis=1)
        gain[used] = -1
        best = int(gain.argmax())
        if gain[best] <= tolerance or len(used) >= len(goal):
            break
        used.append(best)
        weights = np.append(weights, 0.0)
        columns = np.column_stack([columns, _column(lengths[best], repeats[best], len(goal))])
        while used:
            free = np.linalg.lstsq(columns, goal, rcond=None)[0]
            if free.min() > tolerance:
                weights = free
                break
            low = free <= tolerance
            steps = weights[low] / np.maximum(weights[low] - free[low], 1e-300)
            weights = weights + min(1.0, steps.min(initial=1.0)) * (free - weights)
            keep = weights > tolerance
            keep[np.flatnonzero(low)[steps.argmin()]] = False
            used = [u for u, k in zip(used, keep, strict=True) if k]
            weights, columns = weights[keep], columns[:, keep]
        rest = goal - columns @ weights
    return {u: float(w * scale) for u, w in zip(used, weights, strict=True)}


def plan_windows(histogram: np.ndarray) -> list[tuple[list[tuple[int, int]], int]]:
    """[(length, repeats) ...] and how many windows are made so, from the number of rests by length in grains (place 0 unused).

    No more rests are used than there are; every window planned is full to the grain.
    """
    units = len(histogram) - 1
    left, plan = histogram.astype(np.int64).copy(), []

    def take(members: list[tuple[int, int]], most: int) -> None:
        n = min([most, *(int(left[a]) // r for a, r in members)])
        if n > 0:
            plan.append((members, n))
            for a, r in members:
                left[a] -= n * r

    if left.sum():
        lengths, repeats = combinations(units)
        weights = nnls(lengths, repeats, histogram)
        for j, w in sorted(weights.items(), key=lambda x: (-x[1], x[0])):
            take([(int(a), int(r)) for a, r in zip(lengths[j], repeats[j], strict=True) if a], int(np.floor(w + 0.5)))
    for first in range(units, 0, -1):  # greedy best fit, longest first; a pattern uses up a length or leaves it
        while left[first]:
            members, room = {first: 1}, units - first
            for a in range(min(first, room), 0, -1):
                n = min(room // a, int(left[a]) - members.get(a, 0)) if a <= room else 0
                if n > 0:
                    members[a] = members.get(a, 0) + n
                    room -= a * n
            if room:
                break
            take(sorted(members.items(), reverse=True), int(left[first]))
    return plan


# Letters, then ASCII marks to the end of a part: the two are encoded on their own. Of the letters above ASCII only Latin-1 ones count here.
STEM = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-/:-@\[-`{-~]+)")


class _PartIds:
    """Ids of the parts between blanks, kept between texts in two generations, so that frequent parts stay and the number is bounded."""

    def __init__(self, spec: str, end: int):
        from tokenizers import Tokenizer

        self.machine = Tokenizer.from_str(spec)
        self.code, self.width = ("H", 2) if self.machine.get_vocab_size() <= 1 << 16 and end < 1 << 16 else ("I", 4)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _encode(self, parts: list[bytes]) -> None:
        for i in range(0, len(parts), 20_000):
            some = parts[i : i + 20_000]
            for w, e in zip(some, self.machine.encode_batch_fast([w.decode() for w in some], add_special_tokens=False), strict=True):
                self.young[w] = array(self.code, e.ids).tobytes()

    def _missing(self, parts) -> list[bytes]:
        """Parts without ids; those of the old generation become young again."""
        young, old, out = self.young, self.old, []
        for w in parts:
            if w not in young:
                if w in old:
                    young[w] = old[w]
                else:
                    out.append(w)
        return out

    def encode(self, texts: pa.Array, last: bytes) -> pa.Array:
        """The ids of texts whose white space is blanks, each with the end id."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().cast(pa.binary()).dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        missing = self._missing(parts)
        split = {w: m.groups() for w in missing if (m := STEM.fullmatch(w))}
        self._encode(self._missing({x for pair in split.values() for x in pair} | {w for w in missing if w not in split}))
        young = self.young
        for w, (stem, marks) in split.items():
            young[w] = young[stem] + young[marks]
        ids = pa.array([young[w] for w in parts], pa.binary()).take(coded.indices)
        out = pc.binary_join_element_wise(pc.binary_join(pa.ListArray.from_arrays(lists.offsets, ids), b""), last, b"")
        for w in missing:
            if len(w) > LONG_WORD:
                young.pop(w, None)
        if len(young) > KEPT_WORDS:
            self.young, self.old = {}, young
        return out


def _encoded(batches: Iterator[pa.RecordBatch], spec: str, end: int) -> Iterator[pa.RecordBatch]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the cores
    known = kept_in_worker(("packing", hash(spec), end), lambda: _PartIds(spec, end))
    last, blanks, lower = array(known.code, [end]).tobytes(), byte_table(), byte_table(lower=True)
    for batch in batches:
        column = batch.column("text").cast(pa.binary())
        for first, stop in size_runs(pc.binary_length(column).fill_null(0).to_pylist(), RUN):
            # ASCII white space ends parts and case does not matter; other white space and letters stay with the
            # library, and so does the case of texts that may hold a special string
            texts = [t.translate(blanks if b"<|" in t else lower) for t in as_bytes(column.slice(first, stop - first))]
            ids = known.encode(pa.array(texts, pa.binary()).cast(pa.string()), last)
            rows = batch.slice(first, stop - first)
            counts = pc.divide(pc.binary_length(ids), known.width).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("key"), rows.column("doc_id"), counts, ids], names=["key", "doc_id", "n", "ids"])


def levels_words(spec: str) -> bool:
    """Whether a tokenizer file lowers case, drops white space and splits letters from marks, so that parts can be encoded on their own."""
    told = json.loads(spec)
    before = [n.get("type") for n in (told.get("normalizer") or {}).get("normalizers", [])]
    split = [p for p in (told.get("pre_tokenizer") or {}).get("pretokenizers", []) if p.get("type") == "Split"]
    pattern = split[0]["pattern"].get("Regex", "") if split else ""
    special = all(t["content"].startswith("<|") for t in told.get("added_tokens", []))
    return special and "Lowercase" in before and bool(split) and split[0]["behavior"] == "Removed" and split[0]["invert"] and pattern.endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _places(spark, plan, window: int) -> DataFrame:
    """(bin, first, end, each, sequence, slot): the rests first .. end of a bin lie in ``each`` windows from ``sequence`` on, a copy after the other."""
    rows, taken, sequence = [], {}, 0
    for members, n in plan:
        slot = 0
        for a, r in members:
            at = taken.get(a, 0)
            rows.append((a, at, at + r * n, n, sequence, slot))
            taken[a], slot = at + r * n, slot + r
        sequence += n
    schema = "bin long, first long, end long, each long, sequence long, slot long"
    return spark.createDataFrame(rows, schema)


def _pieces(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Cut every document's ids as planned."""
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    out: list[list] = [[] for _ in names]
    held = 0

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
        for c in out:
            c.clear()
        return batch

    for batch in batches:
        for row in range(batch.num_rows):
            doc, n, ids, whole, sequence, offset, at = (batch.column(c)[row].as_py() for c in ("doc_id", "n", "ids", "whole", "sequence", "offset", "at"))
            values = np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
            cuts = [(i * window, window, whole + i, 0) for i in range(n // window)]
            start, rest = n - n % window, n % window
            if rest and at is None:
                cuts.append((start, rest, sequence, offset))
            while rest and at is not None:
                length = min(rest, window - at % window)
                cuts.append((start, length, sequence + at // window, at % window))
                start, rest, at = start + length, rest - length, at + length
            for s, length, q, o in cuts:
                for c, v in zip(out, (doc, s, length, n, q, o, values[s : s + length].tobytes()), strict=True):
                    c.append(v)
                held += 4 * length
                if held > OUT_BYTES:
                    held = 0
                    yield flush()
    if out[0]:
        yield flush()


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, window: int = WINDOW, grain: int = GRAIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of all documents in sequences of at most ``window`` tokens.

    ``tokenizer`` is the path of a file of the ``tokenizers`` library that lowers case and splits words, digits and marks; ``ids`` are
    little-endian unsigned 32-bit numbers. The file has a fixed size and is shipped with the task.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    if not levels_words(spec):
        raise ValueError("a tokenizer that lowers case and splits words, digits and marks is needed")
    if window % grain:
        raise ValueError("the window must be a multiple of the grain")
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # written once: the keys stay as they are
    texts = stored(rows.mapInArrow(lambda b: _encoded(b, spec, end_id), "key long, doc_id long, n long, ids binary"), "token-ids")
    rest = F.col("n") % window
    sizes = texts.select("key", F.floor(F.col("n") / window).alias("full"), rest.alias("rest"), F.ceil(rest / grain).alias("bin"))
    counted = sizes.groupBy("bin").agg(F.count("*").alias("docs"), F.sum("full").alias("full")).collect()  # a row per bin
    histogram = np.zeros(window // grain + 1, dtype=np.int64)
    for r in counted:
        histogram[r["bin"]] = r["docs"] if r["bin"] else 0
    total, full = sum(r["docs"] for r in counted), sum(r["full"] for r in counted)
    plan = plan_windows(histogram)
    blocks = max(64, -(-total // BLOCK_ROWS))
    sizes = sizes.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    sizes = running(sizes, [], F.col("full"), "whole")
    sizes = running(sizes, ["bin"], F.lit(1), "nth")
    # at most three rows per combination in use, and no more combinations than bins and greedy patterns
    places = F.broadcast(_places(spark, plan, window).withColumnRenamed("bin", "of"))
    hit = (F.col("bin") == F.col("of")) & (F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("end"))
    placed = stored(sizes.join(places, hit, "left").select("key", "rest", "block", "bin", "whole", "first", "nth", "each", "sequence", "slot"), "places")
    made = sum(n for _, n in plan)
    there = F.col("nth") - F.col("first")
    fitted = placed.where("first is not null").select(
        "key", "rest", "whole", (F.lit(full) + F.col("sequence") + there % F.col("each")).alias("sequence"),
        (F.col("slot") + F.floor(there / F.col("each"))).alias("slot"),
    )
    inside = Window.partitionBy("sequence").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    fitted = fitted.select("key", "whole", "sequence", F.coalesce(F.sum("rest").over(inside), F.lit(0)).alias("offset"), F.lit(None).cast("long").alias("at"))
    loose = running(placed.where("first is null"), [], F.col("rest"), "at")
    loose = loose.select("key", "whole", F.lit(full + made).cast("long").alias("sequence"), F.lit(0).cast("long").alias("offset"), "at")
    planned = texts.join(fitted.unionByName(loose), "key").select("doc_id", "n", "ids", "whole", "sequence", "offset", "at")
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return planned.mapInArrow(lambda b: _pieces(b, window), schema)
