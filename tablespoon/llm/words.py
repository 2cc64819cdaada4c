"""Text columns as byte arrays: blocks of whole documents and 64-bit hashes of their words, all in numpy.

A word is a maximal run of bytes of one class, so UTF-8 is never decoded. Word hashes are polynomial sums over random
byte values, finished by a mixer; two different words agree with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 4 << 20  # text handled at once inside a task; a longer document is a block of its own
SLICE_BYTES = 1 << 18  # bytes hashed at once, whatever the length of a document or of a word

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd and 5 modulo 8: its powers repeat as late as possible
_VALUES = np.random.default_rng(20240301).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_class(outside: bytes) -> np.ndarray:
    """Table that marks every byte but ``outside`` as part of a word."""
    table = np.ones(256, dtype=bool)
    table[list(outside)] = False
    return table


#: ``[^\x20\x09-\x0D]+``
NON_SPACE = byte_class(b" \t\n\x0b\x0c\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text whose A-Z are lower-cased
ALNUM = byte_class(bytes(x for x in range(128) if not chr(x).isalnum() or chr(x).isupper()))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Consecutive rows of a batch with their text as bytes; row ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""

    rows: pa.RecordBatch
    data: np.ndarray
    bounds: np.ndarray


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row bounds of a text column; null is the empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(bounds) == 0:
        bounds = np.zeros(len(column) + 1, dtype=np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut batches into runs of whole rows with at most ``block_bytes`` of text (or one longer row)."""
    for batch in batches:
        data, bounds = text_bytes(batch.column(batch.schema.get_field_index(text)))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(bounds, bounds[row] + block_bytes, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield Block(
                batch.slice(row, end - row), data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
            )
            row = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every word; a word ends with its row."""
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    word = inside[data]
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    ends[:-1] &= ~word[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    begins[inner] |= word[inner]
    ends[inner - 1] |= word[inner - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1 - starts


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(1 << 12)


def hash_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each span; works through the spans in slices, and through a very long one in pieces."""
    global _POWERS
    out = np.zeros(len(starts), dtype=np.uint64)
    total = np.cumsum(lengths)
    at = 0
    while at < len(starts):
        done = int(total[at - 1]) if at else 0
        end = max(int(np.searchsorted(total, done + SLICE_BYTES, side="right")), at + 1)
        if int(lengths[at:end].max()) > len(_POWERS):
            _POWERS = _powers(min(int(lengths[at:end].max()), SLICE_BYTES))
        if lengths[at] > SLICE_BYTES:  # alone in its slice
            value, step = np.uint64(0), np.uint64(1)
            for piece in range(int(starts[at]), int(starts[at] + lengths[at]), SLICE_BYTES):
                part = _VALUES[data[piece : min(piece + SLICE_BYTES, int(starts[at] + lengths[at]))]]
                with np.errstate(over="ignore"):
                    value = value + np.sum(part * _POWERS[: len(part)], dtype=np.uint64) * step
                    step = step * _POWERS[-1] * _BASE
            out[at] = value
        else:
            size = lengths[at:end]
            heads = np.cumsum(size) - size
            first = int(starts[at])
            part = data[first : int(starts[end - 1] + lengths[end - 1])]
            inner = np.arange(int(size.sum()), dtype=np.int32) - np.repeat(heads.astype(np.int32), size)
            where = inner + np.repeat((starts[at:end] - first).astype(np.int32), size)
            value = _VALUES.take(part.take(where))
            value *= _POWERS.take(inner)
            out[at:end] = np.add.reduceat(value, heads)
        at = end
    return mix64(out ^ (lengths.astype(np.uint64) << np.uint64(1)))


@dataclass
class Words:
    """Word hashes of a block; the words of row ``i`` are ``hashes[rows[i]:rows[i + 1]]``."""

    hashes: np.ndarray
    rows: np.ndarray


def hashed_words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> Words:
    """Hashes of the words of every row, A-Z lower-cased."""
    data = lower_ascii(data)
    starts, lengths = word_spans(data, bounds, inside)
    return Words(hash_spans(data, starts, lengths), np.searchsorted(starts, bounds))
