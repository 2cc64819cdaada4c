"""Secret scans: one keyword automaton over the text, anchored patterns only where it hits, checksums last.

The automaton (Aho-Corasick) finds all keywords in one pass. At each hit the pattern of the keyword's kind is matched
right there, so no pattern searches the text. Runs of hex digits have no keyword; they are looked for by themselves, each
run once. Token formats with an embedded checksum are reported only when the checksum is right.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tablespoon.llm.spans import Span, ascii_lower, digest, listed

#: Kinds in their order and their patterns; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm", "xprv")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
XPRV = re.compile(r"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])")
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"


def crc_matches(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the others in base 62."""
    value = 0
    for c in check:
        value = value * 62 + _BASE62.index(c)
    return value == zlib.crc32(body.encode())


def base58_matches(text: str) -> bool:
    """The last four bytes are the head of the double SHA-256 of the others."""
    value = 0
    for c in text:
        value = value * 58 + _BASE58.index(c)
    raw = value.to_bytes((value.bit_length() + 7) // 8, "big")
    return len(raw) > 4 and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


class Scanner:
    def __init__(self):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for word in ASSIGN_WORDS:
            self.words.add_word(word, ("assign", len(word)))
        for word, kind in {"akia": "access", "npm_": "npm", "xprv": "xprv"}.items():
            self.words.add_word(word, (kind, len(word)))
        for letter in "pousr":
            self.words.add_word(f"gh{letter}_", ("github", 4))
        self.words.make_automaton()

    def scan(self, text: str) -> list[Span]:
        """All spans by start, then kind."""
        low = ascii_lower(text)
        found: list[Span] = []
        free = dict.fromkeys(KINDS, 0)  # leftmost, not overlapping: a kind's next match starts here at the earliest
        for last, (kind, size) in self.words.iter(low):
            at = last + 1 - size
            if at < free[kind]:
                continue
            if kind == "assign":
                m = ASSIGN.match(low, at)
                good = m and m.end(1) - m.start(1) >= LEAST_ASSIGNED
            elif kind == "access":
                m = ACCESS.match(text, at)
                good = m and m.end() - m.start() >= LEAST_ACCESS
            elif kind == "xprv":
                m = XPRV.match(text, at)
                good = m and base58_matches(m.group())
            else:
                m = (GITHUB if kind == "github" else NPM).match(text, at)
                good = m and crc_matches(m.group(1), m.group(2))
            if m:
                free[kind] = m.end()
            if good:
                found.append((kind, at, m.end()))
        found += [("hex", *m.span()) for m in HEX.finditer(text)]
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_scanner: list[Scanner] = []


def _run(key: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _scanner:
            _scanner.append(Scanner())
        for batch in batches:
            out = [
                _row(_scanner[0].scan(body.as_py() or ""))
                for body in batch.column(batch.schema.get_field_index(text))
            ]
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(key))]
                + [pa.array(c, pa.int64()) for c in columns[:3]]
                + [pa.array(c, pa.string()) for c in columns[3:5]]
                + [pa.array(columns[5], pa.int64())],
                [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_checked"],
            )

    return run


def _row(spans: list[Span]) -> tuple:
    base = [s for s in spans if s[0] in KINDS[:3]]
    counts = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
    return (*counts, digest(base), listed(spans), len(spans) - len(base))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_checked) of every row.

    Spans are in code points, end exclusive, by start and kind; ``n_checked`` counts those with a right checksum. A null
    or empty text has no spans (the digest is that of the empty string); repeated rows are scanned one by one.
    """
    kind = dict(docs.dtypes)[key]
    schema = f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long"
    return docs.select(key, text).mapInArrow(_run(key, text), schema)
