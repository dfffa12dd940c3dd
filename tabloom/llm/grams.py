"""Word and shingle hashes of whole text columns, and tables cut into the shared folder.

A word is a maximal run of bytes other than the six ASCII white-space characters.
Hashing works on byte arrays, so a text costs a few vector passes instead of one
Python object per word; the passes work on pieces of a fixed size.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.session import scratch_dir

WHITE = b" \t\n\r\x0b\x0c"
PIECE = 1 << 15
BLOCK_ROWS = 100_000
U = np.uint64
GOLD = 0x9E3779B97F4A7C15


def kept_in_worker(name: str, make):
    """A value built once per Python worker, as shipped functions do not keep module state between tasks."""
    held = sys.__dict__.setdefault("_tabloom_llm", {})
    if name not in held:
        held[name] = make()
    return held[name]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = 0x5851F42D4C957F2D


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    both = []
    for step in (BASE, pow(BASE, -1, 1 << 64)):
        out = np.ones(1, dtype=np.uint64)
        while len(out) < PIECE + 1:
            out = np.concatenate([out, out * U(pow(step, len(out), 1 << 64))])
        both.append(out[: PIECE + 1])
    return both[0], both[1]


def byte_table(lower: bool = False, shapes: bool = False) -> bytes:
    """A table for ``bytes.translate``: every white space becomes a blank.

    With ``lower`` A-Z become a-z; with ``shapes`` letters, digits and bytes above ASCII lose their identity.
    """
    table = bytearray(range(256))
    for i in WHITE:
        table[i] = 32
    if lower:
        table[65:91] = table[97:123]
    if shapes:
        table[97:123], table[65:91], table[48:58], table[128:] = b"a" * 26, b"A" * 26, b"0" * 10, b"a" * 128
    return bytes(table)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of bytes whose only white space is the blank."""
    powers, inverse = kept_in_worker("powers", _powers)
    hashes, firsts, at = [], [], 0
    while at < len(data):
        end = len(data) if len(data) - at <= PIECE else data.rfind(b" ", at, at + PIECE) + 1
        if end <= at:  # a word longer than a piece
            end = data.find(b" ", at + PIECE)
            end = len(data) if end < 0 else end
            hashes.append(mix(_long_word(data, at, end, powers)))
            firsts.append(np.array([at]))
            at = end
            continue
        piece = np.frombuffer(data, dtype=np.uint8, count=end - at, offset=at)
        blank = np.ones(len(piece) + 2, dtype=bool)
        np.equal(piece, 32, out=blank[1:-1])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.multiply(piece, powers[: len(piece)], out=sums[1:])
        np.cumsum(sums, out=sums)
        hashes.append(mix((sums[ends] - sums[starts]) * inverse[starts]))
        firsts.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts)


def _long_word(data: bytes, at: int, end: int, powers: np.ndarray) -> np.ndarray:
    """The hash sum of one word, part by part."""
    total = 0
    for i in range(at, end, PIECE):
        part = np.frombuffer(data, dtype=np.uint8, count=min(PIECE, end - i), offset=i)
        total += int((part * powers[: len(part)]).sum(dtype=np.uint64)) * pow(BASE, i - at, 1 << 64)
    return np.array([total % (1 << 64)], dtype=np.uint64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words; a shorter text gives its whole sequence, an empty one nothing."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * U(GOLD)) | U(1)
    total = np.full(n - k + 1, k, dtype=np.uint64)
    for i in range(k):
        total += words[i : n - k + 1 + i] * factors[i]
    return mix(total)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def runs(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each; a longer text stands alone."""
    yield from size_runs([len(t) for t in texts], limit)


def size_runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges whose sizes add up to about ``limit``; a larger one stands alone."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if sizes:
        yield first, len(sizes)


def split_words(texts: list[bytes], table: bytes, ignored: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts laid end to end and the bounds of each text's words; ignored bytes do not count."""
    texts = [t.translate(table, ignored) for t in texts]
    hashes, firsts = word_hashes(b" ".join(texts))
    return hashes, np.searchsorted(firsts, np.cumsum([0] + [len(t) + 1 for t in texts]))


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read again: the lineage ends here and outlives an executor."""
    path = scratch_dir(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def row_key(*columns: str):
    """A 64-bit key of a row's values; equal rows share it, nulls count as values."""
    parts = []
    for c in columns:
        parts += [F.col(c), F.col(c).isNull()]
    return F.xxhash64(*parts)


def text_key(text):
    """A 128-bit key of a text; null stays null."""
    return F.md5(F.encode(text, "UTF-8"))


def running(rows: DataFrame, group: list[str], value, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the earlier rows of the group, by ``block`` and the unique ``key``; no task holds a group, nulls are values."""
    sums = rows.groupBy(*group, "block").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group, *([] if group else [F.lit(0)])).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*group, "block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*group, "block").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    sums = sums.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate([*group, "block"])], "_base")
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate([*group, "block"])]
    out = rows.join(sums, same).withColumn(name, (F.col("_base") + F.col("_in")).cast("long"))
    return out.drop("_base", "_in", *[f"_{i}" for i in range(len(same))])
