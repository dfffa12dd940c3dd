"""Benchmark decontamination by CGK embedding, bit sampling and exact edit verification.

The CGK embedding walks over a word sequence with one fair coin per word and step: the pointer stays or
advances, and the symbol under it is the output. Two sequences at a small edit distance fall back into step, so
their outputs are at a small Hamming distance. A repetition samples a few steps of the walk; equal samples make a
candidate, and repetitions with independent coins bring the recall to its target: 8 of 9 steps, and for windows of 64 words and
more 16 of 4 steps, spread from the window's first words to its last. Windows of an item's size class
are embedded at every word of every document; all of an item's own windows of that size are in the table of
keys. A walk stays inside its window on both sides, so equal windows have equal keys. Items of fewer than ``WHOLE`` words are
found by exact pieces instead: of one piece more than the edits allowed, one is unedited. The walk of a window is stopped after the first sampled step at which no item has the word under the pointer.
Each candidate is confirmed by the edit distance between the whole item and the text around the window.

A word is compared without its case and without characters other than letters, digits and bytes above ASCII. In scripts
written without blanks each character is a word. Items of fewer than ``LEAST`` words allow no edit, and their whole
tokens must stand in the text: all characters between the first and the last letter or digit count.

Cases: null and empty texts or items match nothing, nor do items without a letter, digit or byte above ASCII; a repeated item reports under each of its ids; rows with a null id are checked like the others.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm.grams import GOLD, U, as_bytes, byte_table, kept_in_worker, mix, runs, split_words, stored

REPEATS, SAMPLES = 8, 9
WHOLE = 16
EDIT_RATIO, LEAST = 0.2, 5
BLOCK_BYTES = 4 << 20
STEP = 1 << 14
# Windows from SPREAD words on (items from 128) take an early sampled step below EARLY, and the others spread to the window's end; as
# more edits fall between them, samples are fewer and repetitions more.
SPREAD, EARLY, WIDE_SAMPLES, WIDE_REPEATS = 64, 8, 4, 2
LOT = 0xD1B54A32D192ED03


IGNORED = bytes(i for i in range(33, 127) if not chr(i).isalnum())
# Characters of scripts without blanks, as UTF-8: Thai, Lao, Myanmar, Khmer, kana, Han.
SOLO = (rb"(?:\xe0[\xb8-\xbb][\x80-\xbf]|\xe1(?:[\x80\x81\x9e\x9f][\x80-\xbf]|\x82[\x80-\x9f])|\xe3[\x81-\x83\x90-\xbf][\x80-\xbf]"
        rb"|[\xe4-\xe9][\x80-\xbf]{2}|\xef[\xa4-\xab][\x80-\xbf]|\xf0[\xa0-\xbf][\x80-\xbf]{2})")
APART = re.compile(SOLO)
TOKEN = re.compile(SOLO + rb"|(?:(?!" + SOLO + rb")[^ \t-\r])+")


def _words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    texts = [folded(t) for t in texts]
    return split_words([t if t.isascii() else APART.sub(rb" \g<0> ", t) for t in texts], byte_table(lower=True), IGNORED)


def _places(text: bytes) -> list[tuple[int, int]]:
    """First and end byte of each word."""
    return [m.span() for m in TOKEN.finditer(text) if m.group().translate(None, IGNORED)]


def _plain(text: bytes) -> bytes:
    """The text as short items are compared: without case, outer punctuation and kinds of white space."""
    return b" ".join(folded(text).translate(byte_table(lower=True)).split()).strip(IGNORED + b" ")


def folded(text: bytes) -> bytes:
    """The text in lower case; letters whose lower case has another length stay, so that places keep their bytes."""
    if text.isascii():
        return text
    whole = text.decode()
    low = whole.lower().encode()
    if len(low) == len(text) and len(whole.lower()) == len(whole):
        return low
    return "".join(c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in whole).encode()


def window_size(n: int) -> int:
    """Words in a window for items of ``n`` words: half its size class; 0 for items that are found by pieces."""
    return 0 if n < WHOLE else 1 << (n.bit_length() - 2)


def _steps(size: int, repeat: int) -> list[int]:
    """The sampled steps of the walk over windows of ``size`` words."""
    if size >= SPREAD:
        # an early step, so that most places go at once, and one in each equal share of the steps to the window's end
        rng = np.random.default_rng(1000 * repeat + 17)
        shares = np.linspace(EARLY, 2 * size, WIDE_SAMPLES).astype(np.int64)
        return [int(rng.integers(EARLY)), *(int(rng.integers(a, b)) for a, b in zip(shares, shares[1:]))]
    last = max(1, size * 3 // 2)
    draw = np.random.default_rng(1000 * repeat + 17).choice(last + 1, size=min(SAMPLES, last + 1), replace=False)
    return sorted(int(x) for x in draw)


def _coins(words: np.ndarray, repeat: int, lot: int = 0) -> np.ndarray:
    """64 fair coins for each word, for the steps from ``64 * lot`` on."""
    return mix(words + U((GOLD * (repeat + 1) + LOT * lot) % (1 << 64)))


def _place(key: np.ndarray) -> np.ndarray:
    """Place of a running key in a table of 65,536 bits."""
    return ((key * U(GOLD)) >> U(48)).astype(np.int64)


class Table:
    """Keys of all windows of a block of items, by repetition and window size."""

    def __init__(self, items: list[tuple[int, bytes]], ratio: float, repeats: int):
        self.ids, self.words, self.limit, self.plain = [], [], [], []
        for ident, text in items:
            words, _ = _words([text])
            if len(words):
                self.ids.append(ident)
                self.words.append(words)
                self.limit.append(int(len(words) * ratio) if len(words) >= LEAST else 0)
                self.plain.append(_plain(text))
        lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        every = np.concatenate(self.words) if self.words else np.zeros(0, np.uint64)
        self.known = np.unique(every)
        self.maybe = np.zeros(1 << 16, dtype=bool)
        self.maybe[(self.known >> U(48)).astype(np.int64)] = True
        number = np.searchsorted(self.known, every).astype(np.uint64) + U(1)
        begins = np.cumsum(lengths) - lengths
        classes = np.array([window_size(int(n)) for n in lengths], dtype=np.int64)
        self.plan = []
        for repeat in range(repeats * WIDE_REPEATS):
            coins = functools.cache(lambda lot, repeat=repeat: _coins(every, repeat, lot))
            for size in np.unique(classes[classes >= (1 if repeat < repeats else SPREAD)]):
                steps, chosen = _steps(int(size), repeat), np.flatnonzero(classes == size)
                many = lengths[chosen] - size + 1
                owner = np.repeat(chosen, many)
                offset = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                p = begins[owner] + offset
                last = p + size - 1
                key, masks, j = np.zeros(len(p), dtype=np.uint64), [], 0
                for step in steps:
                    while j < step:
                        p = np.minimum(p + ((coins(j >> 6)[p] >> U(j & 63)) & U(1)).astype(np.int64), last)
                        j += 1
                    if not masks:
                        first = np.zeros(len(self.known) + 1, dtype=bool)
                        first[number[p].astype(np.int64)] = True
                    key = key * U(GOLD) + number[p]
                    mask = np.zeros(1 << 16, dtype=bool)
                    mask[_place(key)] = True
                    masks.append(mask)
                order = np.argsort(key, kind="stable")
                self.plan.append((repeat, int(size), steps, key[order], owner[order], offset[order], first, masks))

        cuts: dict[int, list[tuple[int, int]]] = {}
        for item in np.flatnonzero(classes == 0):
            n, parts = int(lengths[item]), min(int(lengths[item]), self.limit[item] + 1)
            for i in range(parts):
                cuts.setdefault(n * (i + 1) // parts - n * i // parts, []).append((int(item), n * i // parts))
        self.pieces = []
        for size, places in sorted(cuts.items()):
            owner, offset = np.array(places, dtype=np.int64).T
            p, key = begins[owner] + offset, np.zeros(len(places), dtype=np.uint64)
            for i in range(size):
                key = key * U(GOLD) + number[p + i]
            mask = np.zeros(1 << 16, dtype=bool)
            mask[_place(key)] = True
            order = np.argsort(key, kind="stable")
            self.pieces.append((size, key[order], owner[order], offset[order], mask))

    def pieced(self, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Item and estimated first word of the item, for every place of an exact piece of a short item."""
        live = np.flatnonzero(numbers)
        for size, keys, owner, offset, mask in self.pieces:
            at = live[live + size <= len(numbers)]
            key = numbers.take(at).view(np.uint64)
            for i in range(1, size):
                seen = numbers.take(at + i)
                both = np.flatnonzero(seen)
                at, key = at.take(both), key.take(both) * U(GOLD) + seen.take(both).view(np.uint64)
            both = np.flatnonzero(mask.take(_place(key)))
            at, key = at.take(both), key.take(both)
            left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            many = right - left
            which = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            yield owner[which], np.repeat(at, many) - offset[which]

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Each word's number among the items' words; 0 if no item has it."""
        out = np.zeros(len(words), dtype=np.int64)
        near = np.flatnonzero(self.maybe[(words >> U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.known, words[near]), len(self.known) - 1)
        out[near] = np.where(self.known[at] == words[near], at + 1, 0)
        return out

    def candidates(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and estimated first word of the item, for windows of the word sequence that share a key with one."""
        found_item, found_at = [], []
        total = len(words)
        numbers = np.zeros(total, dtype=np.int64)
        last = total - 1
        # a walk stays inside its window
        wide = max([64, *(size for _, size, *_ in self.plan)])
        for lo in range(0, total, STEP):
            part = words[lo : lo + STEP + wide]
            number = self.numbers(part)
            numbers[lo : lo + len(part)] = number
            repeat, coins, end = -1, None, len(part) - 1
            count = min(STEP, total - lo)
            for r, size, steps, keys, owner, offset, first, masks in self.plan:
                if r != repeat:
                    repeat, coins = r, functools.cache(lambda lot, part=part, r=r: _coins(part, r, lot))
                at = p = np.arange(count)
                key, j = np.zeros(count, dtype=np.uint64), 0
                for i, step in enumerate(steps):
                    while j < step:
                        move = coins(j >> 6).take(p)
                        move >>= U(j & 63)
                        move &= U(1)
                        p = p + move.view(np.int64)
                        if j + 2 > size or lo + count > last - wide:
                            np.minimum(p, np.minimum(at + (size - 1), end), out=p)
                        j += 1
                    seen = number.take(p)
                    if not i:
                        live = np.flatnonzero(first.take(seen))
                        at, p, key = at.take(live), p.take(live), seen.take(live).view(np.uint64)
                    else:
                        key = key * U(GOLD) + seen.view(np.uint64)
                        live = np.flatnonzero(masks[i].take(_place(key)))
                        at, p, key = at.take(live), p.take(live), key.take(live)
                    if not len(at):
                        break
                if not len(at):
                    continue
                left, right = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                many = right - left
                which = np.repeat(left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                found_item.append(owner[which])
                found_at.append(np.repeat(at, many) - offset[which] + lo)
        for item, place in self.pieced(numbers):
            found_item.append(item)
            found_at.append(place)
        if not found_item:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.unique((np.concatenate(found_item) << 40) | (np.concatenate(found_at) + (1 << 20)))
        items, places = both >> 40, (both & ((1 << 40) - 1)) - (1 << 20)
        return self.plausible(numbers, items, places)

    def plausible(self, numbers: np.ndarray, items: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates with enough of the item's words around the place: each missing word costs an edit."""
        keep = np.zeros(len(items), dtype=bool)
        for item in np.unique(items):
            chosen = np.flatnonzero(items == item)
            n, slack = len(self.words[item]), self.limit[item]
            own = np.zeros(len(self.known) + 1, dtype=bool)
            own[np.searchsorted(self.known, self.words[item]) + 1] = True
            if len(chosen) * (n + 2 * slack) > len(numbers):
                counts = np.zeros(len(numbers) + 1, dtype=np.int32)
                np.cumsum(own.take(numbers), out=counts[1:])
                low = np.clip(places[chosen] - slack, 0, len(numbers))
                high = np.clip(places[chosen] + n + slack, 0, len(numbers))
                keep[chosen] = counts[high] - counts[low] >= n - slack
            else:
                columns = places[chosen][:, None] + np.arange(-slack, n + slack)[None, :]
                inside = (columns >= 0) & (columns < len(numbers))
                keep[chosen] = (own.take(numbers.take(columns, mode="clip")) & inside).sum(axis=1) >= n - slack
        return items[keep], places[keep]

    def distances(self, words: np.ndarray, item: int, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Smallest edit distance of the item to a run of words near each place, and the end of that run.

        ``low`` and ``high`` bound the words of the document each place is in.
        """
        pattern, slack = self.words[item], self.limit[item]
        n = len(pattern)
        width = n + 2 * slack
        columns = at[:, None] - slack + np.arange(width)[None, :]
        inside = (columns >= low[:, None]) & (columns < high[:, None])
        text = words[np.clip(columns, 0, len(words) - 1)]
        ramp = np.arange(width + 1, dtype=np.int32)
        row = np.zeros((len(at), width + 1), dtype=np.int32)
        for i in range(n):
            cost = np.where(inside & (text == pattern[i]), 0, 1).astype(np.int32)
            new = np.empty_like(row)
            new[:, 0] = i + 1
            new[:, 1:] = np.minimum(row[:, :-1] + cost, row[:, 1:] + 1)
            row = np.minimum.accumulate(new - ramp, axis=1) + ramp
        best = row.argmin(axis=1)
        return row[np.arange(len(at)), best], at - slack + best

    def matches(self, texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
        """(text, item id, distance, first byte, end byte) of the best place of each item in each text."""
        words, bounds = _words(texts)
        if not len(words) or not self.words:
            return []
        items, places = self.candidates(words)
        out: dict[tuple[int, int], tuple[int, int]] = {}
        spans = functools.cache(lambda k: _places(texts[k]))
        for item in np.unique(items):
            at, n, slack = places[items == item], len(self.words[item]), self.limit[item]
            owner = np.searchsorted(bounds, np.clip(at + n // 2, 0, len(words) - 1), "right") - 1
            for i in range(0, len(at), 512):
                a, o = at[i : i + 512], owner[i : i + 512]
                distance, end = self.distances(words, int(item), a, bounds[o], bounds[o + 1])
                for k in np.flatnonzero(distance <= slack):
                    key, found = (int(o[k]), int(item)), (int(distance[k]), int(end[k]))
                    if n < LEAST:
                        if key in out:
                            continue
                        stop = found[1] - int(bounds[o[k]])
                        run = spans(key[0])[stop - n : stop]
                        if _plain(texts[key[0]][run[0][0] : run[-1][1]]) != self.plain[item]:
                            continue
                    if key not in out or found < out[key]:
                        out[key] = found
        rows = []
        for (text, item), (distance, end) in sorted(out.items()):
            stop = end - int(bounds[text])
            first = max(0, stop - len(self.words[item]))
            rows.append((text, self.ids[item], distance, spans(text)[first][0], spans(text)[max(stop, first + 1) - 1][1]))
        return rows


def _found(batches: Iterator[pa.RecordBatch], items: list, ratio: float, repeats: int) -> Iterator[pa.RecordBatch]:
    table = kept_in_worker(("bench", hash(tuple(items)), ratio, repeats), lambda: Table(items, ratio, repeats))
    for batch in batches:
        texts, ids = as_bytes(batch.column("text")), batch.column("doc_id").to_pylist()
        for first, last in runs(texts):
            rows = table.matches(texts[first:last])
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[first + i] for i in columns[0]], pa.int64()), *[pa.array(c, t) for c, t in zip(columns[1:], [pa.int64(), pa.int32(), pa.int64(), pa.int64()], strict=True)]],
                    names=["doc_id", "item_id", "distance", "first_byte", "end_byte"],
                )


def _clean(batches: Iterator[pa.RecordBatch], items: list, ratio: float, repeats: int, text: str) -> Iterator[pa.RecordBatch]:
    table = kept_in_worker(("bench", hash(tuple(items)), ratio, repeats), lambda: Table(items, ratio, repeats))
    for batch in batches:
        texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
        keep = np.ones(len(texts), dtype=bool)
        for first, last in runs(texts):
            for row in table.matches(texts[first:last]):
                keep[first + row[0]] = False
        yield batch.filter(pa.array(keep))


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark in blocks of about ``block_bytes``: what the driver holds and ships at once is bounded."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-total // block_bytes))
    for part in range(parts):
        got = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        if got:
            yield sorted({(r["item_id"], r["text"].encode()) for r in got}, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               ratio: float = EDIT_RATIO, repeats: int = REPEATS) -> DataFrame:
    """Each document and item with a run of words within ``ratio`` edits of the item's words: doc_id, item_id,
    distance (word edits), first_byte and end_byte of the place in the text.

    One narrow pass over the documents for each block of the benchmark; nothing is shuffled.
    """
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, item_id long, distance int, first_byte long, end_byte long"
    found = None
    for items, more in _ahead(blocks(benchmark)):
        part = rows.mapInArrow(lambda batches, items=items: _found(batches, items, ratio, repeats), schema)
        if more or found is not None:
            part = stored(part, "leaks")
        found = part if found is None else found.union(part)
    return spark.createDataFrame([], schema) if found is None else found


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", ratio: float = EDIT_RATIO, repeats: int = REPEATS) -> DataFrame:
    """The documents without any leak, with all their columns."""
    for items, more in _ahead(blocks(benchmark)):
        docs = docs.mapInArrow(lambda batches, items=items: _clean(batches, items, ratio, repeats, text_col), docs.schema)
        if more:
            docs = stored(docs, "clean")
    return docs


def _ahead(values: Iterator) -> Iterator[tuple]:
    """Each value and whether another follows."""
    values = iter(values)
    for now in values:
        for following in values:
            yield now, True
            now = following
        yield now, False
