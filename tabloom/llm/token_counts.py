"""Token counts of byte-level BPE by compiled transducers.

Two deterministic transducers read a text. The first reads one character class at a time, splits the text
as the tokenizer's pattern does and marks where a piece begins. Texts are cut into chunks of equal length; for
every chunk its whole state map (the state after the chunk for each state before it) is computed at once, the
maps compose by a parallel prefix scan, and with the entry states known every chunk emits its marks.

The second reads the bytes of a piece. Its state holds the longest end of what was read that some token begins with, and for
every place in it the last token and relative token count of the encoding up to there; a transition is annotated with the
change of the number of tokens emitted. The next token is the one compatible with the token before it, where two tokens
are compatible if merging their bytes yields these two. States and transitions are compiled when they are first
needed and kept by the worker, as are the sums over whole pieces.

Cases: a null text counts as empty and has no tokens; special strings in a text count one token each, as the
library's default has it; rows with a null id are counted like others.
"""

from __future__ import annotations

import gc
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.grams import kept_in_worker, size_runs

CHUNK = 128
KEPT = 150_000
STATE = -1

# Character classes of the splitting pattern.
LETTER, NUMBER, OTHER, BLANK, SPACE, MARK, END = range(7)
# Symbols of the transducer: a class, with what the next characters decide.
S_LETTER, S_NUMBER, S_OTHER, S_SHORT, S_LONG, S_RUN, S_LAST_BLANK, S_LAST_SPACE, S_END = range(9)
# States: what piece the last character is in.
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, PREFIX, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)


def _transitions() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece begins, for state * 9 + symbol."""
    state, begins = np.zeros((8, 9), dtype=np.uint8), np.zeros((8, 9), dtype=bool)
    for s in range(8):
        if s in (ONE_LEFT, TWO_LEFT):  # inside 's, 're and the like: nothing but the count matters
            state[s, :] = ONE_LEFT if s == TWO_LEFT else FRESH
        else:
            for symbol, inside in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHER)):
                state[s, symbol], begins[s, symbol] = inside, s not in (inside, PREFIX)
            for symbol, left in ((S_SHORT, ONE_LEFT), (S_LONG, TWO_LEFT)):
                joins = s in (IN_OTHER, PREFIX)
                state[s, symbol], begins[s, symbol] = (IN_OTHER, False) if joins else (left, True)
            state[s, S_RUN], begins[s, S_RUN] = IN_SPACE, s != IN_SPACE
            state[s, S_LAST_BLANK], begins[s, S_LAST_BLANK] = PREFIX, True
            state[s, S_LAST_SPACE], begins[s, S_LAST_SPACE] = FRESH, True
        state[s, S_END] = FRESH
    return state.ravel(), begins.ravel()


def _classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            out[i] = LETTER
        elif kind == "N":
            out[i] = NUMBER
    for first, last in ((9, 13), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)):
        out[first : last + 1] = SPACE
    out[32], out[39] = BLANK, MARK
    return out


def _symbols(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbols of code points that end with an end mark (the code 0x110000 stands for the end of a text)."""
    padded = np.concatenate([codes, np.full(2, 0x110000, dtype=codes.dtype)])
    kind = classes[padded]
    here, following = kind[:-2], kind[1:-1]
    symbol = np.array([S_LETTER, S_NUMBER, S_OTHER, S_LAST_BLANK, S_LAST_SPACE, S_OTHER, S_END], dtype=np.uint8)[here]
    space = (here == BLANK) | (here == SPACE)
    symbol[space & ((following == BLANK) | (following == SPACE) | (following == END))] = S_RUN
    at = np.flatnonzero(here == MARK)
    one, two = padded[at + 1], padded[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long_ = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    symbol[at[short]] = S_SHORT
    symbol[at[long_]] = S_LONG
    return symbol


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (rows), in a logarithmic number of vector steps."""
    maps = maps.copy()
    step = 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.int64), axis=1)
        step *= 2
    return maps


def piece_starts(symbols: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """Marks where pieces begin, from state maps of chunks and their prefix composition."""
    following, begins = kept_in_worker("split", _transitions)
    n = len(symbols)
    count = -(-n // chunk)
    grid = np.full(count * chunk, S_END, dtype=np.int64)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(count, chunk).T)
    maps = np.tile(np.arange(8, dtype=np.int64), (count, 1))
    for k in range(chunk):
        maps = following.take(maps * 9 + grid[k][:, None]).astype(np.int64)
    entry = np.zeros(count, dtype=np.int64)
    entry[1:] = compose_scan(maps)[:-1, FRESH]
    out = np.zeros((chunk, count), dtype=bool)
    for k in range(chunk):
        at = entry * 9 + grid[k]
        out[k] = begins.take(at)
        entry = following.take(at).astype(np.int64)
    return out.T.ravel()[:n]


class Transducer:
    """Counts the tokens of a piece; built from the vocabulary and merges of a byte-level BPE file."""

    def __init__(self, spec: dict):
        model, kind = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or kind.get("type") != "ByteLevel" or kind.get("add_prefix_space") or not kind.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError("a byte-level BPE file without normalizer and prefix blank is needed")
        letters = {chr(c): i for i, c in enumerate(_printable())}
        raw = lambda s: bytes(letters[c] for c in s)
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in reversed(list(enumerate(merges)))}
        known = {raw(t) for t in model["vocab"] if all(c in letters for c in t)}
        # only tokens that merging can reach occur in an encoding
        self.tokens = {bytes([i]) for i in range(256)} | {a + b for a, b in self.rank if a + b in known}
        self.beginnings = {t[:i] for t in self.tokens for i in range(len(t))}
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self.forget()
        self.sums: dict[str, int] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        """The encoding by merging the pair of lowest rank first, leftmost among equals."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min((self.rank.get((a, b), len(self.rank)), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if best[0] == len(self.rank):
                break
            pair = (parts[best[1]], parts[best[1] + 1])
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(pair[0] + pair[1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def compatible(self, left: bytes | None, token: bytes) -> bool:
        """Whether ``token`` can follow ``left`` in an encoding; None is the beginning of the piece."""
        key = (left or b"", token)
        if key not in self.fits:
            self.fits[key] = self.merged((left or b"") + token) == ([token] if left is None else [left, token])
        return self.fits[key]

    def forget(self) -> None:
        """Start again without compiled states."""
        self.root: dict = {STATE: (b"", ((None, 0),))}
        self.nodes: dict[tuple, dict] = {self.root[STATE]: self.root}

    def step(self, node: dict, byte: int) -> tuple[dict, int]:
        """Compile one transition: the next state and the change of the token count."""
        end, places = node[STATE]
        grown = end + bytes([byte])
        for i in range(len(grown)):  # the token that ends here, from the longest
            token = grown[i:]
            if token in self.tokens and self.compatible(places[i][0], token):
                last, delta = token, places[i][1] + 1
                break
        else:
            raise ValueError("a byte without a token")
        # a place counts only while some longer token may begin there
        open_ = [(p[0], p[1] - delta) if p and grown[i:] in self.beginnings else None for i, p in enumerate(places)]
        cut = next((i for i, p in enumerate(open_) if p), len(grown))
        state = (grown[cut:], (*open_[cut:], (last, 0)))
        following = self.nodes.setdefault(state, {STATE: state})
        node[byte] = (following, delta)
        return following, delta

    def count(self, piece: str) -> int:
        """Tokens of one piece: the sum of the annotations on its path."""
        node, total = self.root, 0
        for byte in piece.encode():
            got = node.get(byte)
            node, delta = got or self.step(node, byte)
            total += delta
        return total

    def count_text(self, text: str, starts: np.ndarray) -> int:
        """Tokens of a text whose pieces begin at ``starts``."""
        bounds = starts.tolist()
        bounds.append(len(text))
        sums, total = self.sums, 0
        for a, b in zip(bounds, bounds[1:], strict=False):
            piece = text[a:b]
            n = sums.get(piece)
            if n is None:
                n = sums[piece] = self.count(piece)
            total += n
        return total

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special string in a text is one token."""
        out, segments, owner = [0] * len(texts), [], []
        for i, text in enumerate(texts):
            parts = [text]
            for special in self.special:
                split = [p.split(special) for p in parts]
                out[i] += sum(len(p) - 1 for p in split)
                parts = [x for p in split for x in p]
            for part in parts:
                if part:
                    segments.append(part)
                    owner.append(i)
        if not segments:
            return out
        classes = kept_in_worker("classes", lambda: np.append(_classes(), np.uint8(END)))
        stop = np.full(1, 0x110000, dtype=np.uint32)
        codes = [x for s in segments for x in (np.frombuffer(s.encode("utf-32-le"), dtype=np.uint32), stop)]
        marks = piece_starts(_symbols(np.concatenate(codes), classes))
        at = 0
        for i, segment in zip(owner, segments, strict=True):
            out[i] += self.count_text(segment, np.flatnonzero(marks[at : at + len(segment)]))
            at += len(segment) + 1
        # what is kept between texts is bounded; compiling again costs time only
        if len(self.sums) > 2 * KEPT:
            self.sums = {}
        if len(self.nodes) > KEPT:
            self.forget()
        if len(self.fits) > 2 * KEPT:
            self.fits = {}
        return out


def _printable() -> list[int]:
    """The character that stands for each byte in byte-level BPE files: printable Latin-1 ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [i if i in plain else next(others) for i in range(256)]


def _counted(batches: Iterator[pa.RecordBatch], spec: str) -> Iterator[pa.RecordBatch]:
    machine = kept_in_worker(("bpe", hash(spec)), lambda: Transducer(json.loads(spec)))
    gc.disable()  # hundreds of thousands of states and no cycle that could go before them
    for batch in batches:
        column = batch.column("text")
        sizes = pc.binary_length(column).fill_null(0).to_pylist()
        tokens = []
        for first, last in size_runs(sizes, 1 << 19):
            tokens += machine.counts([x or "" for x in column.slice(first, last - first).to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every text. ``tokenizer`` is the path of a byte-level BPE file.

    The file has a fixed size and is shipped with the task; one narrow pass.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(lambda batches: _counted(batches, spec), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
