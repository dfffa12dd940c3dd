"""Secret scans by dictionary-primed zstandard novelty, beside three fixed patterns.

A candidate is a long string within ``reach`` characters of a sensitive word or of a string already reported, before or after it
and across lines; a string with such a word inside also counts from the word on. Its novelty is the number of bytes it adds to its compressed
surroundings, in relation to what random strings of its length and alphabets add to the same surroundings: about 1 for a random
string, less for words, paths and names that the dictionary or the surroundings hold or whose letters are as frequent as in prose. The compressor's dictionary
has identifiers, prose and the words of a public tokenizer's vocabulary, and its tables of letter costs make short surroundings cost
what long ones do. Strings at the limit or above are reported as ``novel``.

Cases: a null text is empty and has no spans; candidates that touch a span of a fixed pattern are that span's; offsets are code points.
"""

from __future__ import annotations

import hashlib
import json
import random
import re
import string
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|pwd|secret|token|api[_-]?key|credential|(?:private|access|signing|encryption)[ _-]?key|bearer|authorization", re.I | re.A)
LEAST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.~-]{{{LEAST},}}")
REACH, AROUND, LIMIT = 512, 512, 0.88
CLOSE, LEVEL, WORDS_BYTES, CONTROL_BYTES = 60, 19, 110_000, 256
IDENTIFIERS = (
    "public static final String private const return import from class def self this new function var let async await export default module require "
    "config configuration settings environment variable value example placeholder changeme your_password_here your-api-key-here xxxxxxxxxxxxxxxx "
    "username password secret token api_key access_key private_key client_id client_secret authorization bearer header content-type application/json "
    "http:// https:// www. .example.com .org/ /api/v1/ /usr/local/ /etc/ .json .yaml .properties localhost 127.0.0.1 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ get_token set_password refresh_token access_token id_token session csrf cookie oauth database connection_string "
)
PROSE = (
    "The committee met on Tuesday and agreed that the second report should be published before the end of the year, together with the figures for every region. "
    "When the water level rises, the gates are opened by hand; nobody remembers who wrote down the rule, but people follow it anyway. "
    "She quickly packed five dozen jugs and asked the judge about zones, taxes, exchange and equipment. "
    "Die Sitzung wurde verschoben, weil die Unterlagen nicht rechtzeitig vorlagen und die Mitglieder noch Fragen zur Verwaltung hatten. "
    "Les habitants du quartier souhaitent que la place reste ouverte pendant les travaux. "
    "El proyecto fue aprobado por la comunidad despues de una larga discusion. "
    'for index, value in enumerate(items): if value is None: continue; result.append(transform(value, options=options)); return {"name": name, "version": 2, '
    '"created_at": "2020-11-05T10:20:30Z", "count": 1024} '
    "The international information about development, government, management, environment, communication, organization, administration, understanding, "
    "responsibility, transportation, characteristics, architecture, distribution, implementation, performance, relationship, agriculture, technology, "
    "network, machine, science, history, language, question, university, president, population. "
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def vocabulary_words(path: str, limit: int = WORDS_BYTES) -> bytes:
    """The first words of a tokenizer's vocabulary, of four letters or more and in lower case, the most frequent last; at most ``limit`` bytes."""
    with open(path, encoding="utf-8") as file:
        entries = json.load(file)["model"]["vocab"]
    words, size = {}, 0
    for entry in sorted(entries, key=entries.get):
        word = re.sub(r"</w>|[\u0120\u2581]", "", entry).lower()
        if re.fullmatch("[a-z]{4,}", word) and word not in words:
            size += len(word)
            if size > limit:
                break
            words[word] = None
    return "".join(reversed(words)).encode()


def dictionary(words: bytes = b"") -> bytes:
    """A zstandard dictionary: tables trained on prose and identifiers, then their text, ``words`` and the identifiers as content."""
    text = (IDENTIFIERS + PROSE).encode()
    windows = [text[i : i + 160] for i in range(0, len(text) - 160, 7)]
    return zstandard.train_dictionary(4096, windows, k=64, d=6, level=9).as_bytes() + words + IDENTIFIERS.encode()


class Novelty:
    """Marginal compressed size of strings in their surroundings, in relation to random strings."""

    def __init__(self, primed: bytes | None = None):
        self.primed = zstandard.ZstdCompressionDict(dictionary() if primed is None else primed, dict_type=zstandard.DICT_TYPE_FULLDICT)
        self.primed.precompute_compress(level=LEVEL)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=self.primed, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(self, text: str) -> int:
        return len(self.packer.compress(text.encode()))

    def __call__(self, before: str, candidate: str, after: str) -> float:
        """By three surroundings: what stands before, what stands after, and the nearest of both; long strings need fewer random ones."""
        controls = random_like(candidate, max(1, min(8, CONTROL_BYTES // len(candidate))))
        own, random_cost = 0, 0
        for around in (before, after, before[-CLOSE:] + "\n" + after[:CLOSE]):
            base = self.size(around)
            own += self.size(around + candidate) - base
            random_cost += sum(self.size(around + c) - base for c in controls) / len(controls)
        return own / max(1.0, random_cost)


def random_like(candidate: str, n: int) -> list[str]:
    """Strings with random letters and digits from the alphabets of the candidate, its other signs in place; always the same ones."""
    signs = "".join(a for a in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if not set(a).isdisjoint(candidate))
    if not set(candidate) - set("0123456789abcdef") and not candidate.isdigit():
        signs = "0123456789abcdef"
    rng = random.Random(len(candidate))
    return ["".join(rng.choice(signs) if c.isalnum() else c for c in candidate) for _ in range(n)]


def novel_spans(text: str, taken: list[tuple[int, int, int]], novelty: Novelty, reach: int = REACH) -> list[tuple[int, int, int]]:
    """Incompressible strings near a sensitive word that no fixed pattern has."""
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    stops = [b for _, b in words]
    closed: list[list[int]] = []  # the fixed patterns' spans, joined where they overlap
    for a, _, b in taken:
        if closed and a < closed[-1][1]:
            closed[-1][1] = max(closed[-1][1], b)
        else:
            closed.append([a, b])
    ends = [b for _, b in closed]
    found, following, until = [], 0, -1
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while following < len(words) and words[following][0] < end:
            until = max(until, words[following][1] + reach)
            following += 1
        if start > until and (following == len(words) or words[following][0] - end > reach):
            continue
        inner = bisect_left(stops, end) - 1
        firsts = [start, stops[inner]] if inner >= 0 and stops[inner] > start else [start]
        for first in firsts:
            at = bisect_left(ends, first + 1)
            if end - first < LEAST or (at < len(closed) and closed[at][0] < end):
                continue
            if novelty(text[max(0, first - AROUND) : first], text[first:end], text[end : end + AROUND]) >= LIMIT:
                found.append((first, 3, end))
                until = max(until, end + reach)
                break
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scanner(primed: bytes, reach: int):
    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty(primed)
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + novel_spans(text, base, novelty, reach))
                kinds = [k for _, k, _ in spans]
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), kinds.count(3), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            names = ["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"]
            columns = [pa.array([r[i] for r in rows], pa.int64() if i < 4 else pa.string()) for i in range(6)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])

    return scanned


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, reach: int = REACH) -> DataFrame:
    """Counts and spans of secrets in every text; one narrow pass.

    ``vocabulary`` is the path of a tokenizer's .json on the driver; its words (``WORDS_BYTES`` at most) travel in the dictionary.
    """
    primed = dictionary(vocabulary_words(vocabulary) if vocabulary else b"")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scanner(primed, reach), "doc_id long, n_assign long, n_access long, n_hex long, n_novel long, base_sha256 string, spans string")
