"""Quality rules: compression bands over whole documents and fixed chunks.

The zstandard ratio of a document (compressed by raw bytes) is low for repetitive and high for incompressible text; how
low and how high depends on the length, as a longer text offers more to refer back to. The band of a document's length decides on the
whole; the chunks decide together, so that one odd passage does not sink a document and a document that is junk
in large part does not hide behind the rest.

Cases: null and empty texts have no words and fail the base rule; repeated rows get equal results; very long texts are compressed
whole and in chunks, one at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.grams import WHITE

# (bytes below which the band holds, lowest ratio, highest ratio)
BANDS = ((512, 0.42, 0.95), (2048, 0.40, 0.85), (8192, 0.36, 0.80), (32768, 0.30, 0.75), (float("inf"), 0.25, 0.70))
CHUNK, CHUNK_BAND, ODD_SHARE = 2048, (0.35, 0.85), 0.25
SYMBOLS = b"#*$%&|<>"
CONTINUED = bytes(range(128, 192))


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    chars = len(text.translate(None, CONTINUED + WHITE))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) < len(windows):
        times, reach = Counter(windows), 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def compressed_within_bands(text: bytes, packer: zstandard.ZstdCompressor) -> tuple[bool, float, float]:
    """Whether the ratios lie in their bands; the whole ratio; the share of chunks outside theirs."""
    if not text:
        return False, 0.0, 0.0
    whole = len(packer.compress(text)) / len(text)
    low, high = next((a, b) for end, a, b in BANDS if len(text) < end)
    ends = [*range(CHUNK, len(text) - CHUNK // 2 + 1, CHUNK), len(text)]  # the last chunk takes a short rest
    odd, at = 0, 0
    for end in ends:
        ratio = len(packer.compress(text[at:end])) / (end - at)
        odd += not (CHUNK_BAND[0] <= ratio <= CHUNK_BAND[1] or end - at < CHUNK // 2)
        at = end
    share = odd / len(ends)
    return low <= whole <= high and share <= ODD_SHARE, whole, share


def _ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False)
    for batch in batches:
        rows = []
        for value in batch.column("text").cast(pa.binary()):
            text = value.as_py() or b""
            n, chars, symbols, dup, repeat = base_counts(text)
            failed = n < 50 or 100 * repeat > 50 * n
            good, whole, odd = compressed_within_bands(text, packer)
            rows.append((n, chars, symbols, dup, repeat, failed, not failed and good, whole, odd))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "odd_chunks"]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
        columns = [pa.array([r[i] for r in rows], kinds[i]) for i in range(len(names))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])


def compression_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, the ratios and the verdict of every document; one narrow pass over whole texts."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(
        _ruled, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, ratio double, odd_chunks double",
    )
