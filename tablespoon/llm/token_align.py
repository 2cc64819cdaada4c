"""Alignment of two tokenizers over the bytes of a text, composed from fragments of byte ranges.

Token A and token B are linked where their byte ranges overlap; bytes where tokens of both end cut the tokens into groups.
A byte range of a document yields a fragment: the tokens up to its first common end (open prefix), the groups between its
common ends (closed), and the tokens after its last one (open suffix). Two neighbouring fragments compose: the suffix of
the left and the prefix of the right are one group. Composition is associative and the empty range is its unit, so the
ranges of a very long document are aligned by different tasks and composed in a tree, in any bracketing. A short document
is one range. Ranges may end anywhere: their task encodes up to the next place where both tokenizers cut.

A pair's count over the corpus comes from pair dictionaries of blocks of about ``DICTIONARY_BYTES`` of text, which also
meet the counts again, so what is shuffled are distinct pairs of a block, neither links nor texts.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablespoon.llm.words import blocks, hash_spans
from tablespoon.session import LARGE_ROWS, intermediates, stored

CHUNK_BYTES = 1 << 15  # byte range of a fragment
BLOCK_BYTES = 1 << 18  # text aligned at once
DICTIONARY_BYTES = 4 << 20
FAN = 8  # fragments composed by one group of a round
KEPT_PIECES = 500_000
PER_CALL = 1024

_SUMS = "n_a long, n_b long, n_groups long, n_links long"
_UNIT = "rid long, idx int, of int, base long, low long, high long, body binary"
_FRAGMENT = (
    f"rid long, idx int, good boolean, parted boolean, head array<long>, head_b array<long>, tail array<long>, tail_b array<long>, {_SUMS}, "
    "groups binary, pairs array<long>, times array<long>"
)
_OPEN_NEXT = np.zeros(256, dtype=bool)  # bytes after a space that may be white space or its first byte
_OPEN_NEXT[:0x21] = True
_OPEN_NEXT[[0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_OPEN_LAST = np.zeros(256, dtype=bool)  # bytes before a space that may be a space or end a space mark
_OPEN_LAST[[0x20, 0x81]] = True


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def _table(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in strings], dtype=np.int64)
    return np.frombuffer(b"".join(strings), dtype=np.uint8), np.cumsum(size) - size, size


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places where both tokenizers begin a token whatever stands around: row starts, and a space between two words."""
    cut = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        cut[1:-1] = (data[1:-1] == 0x20) & ~_OPEN_LAST[data[:-2]] & ~_OPEN_NEXT[data[2:]]
        inner = bounds[1:-1]
        cut[inner[inner > 0] - 1] = False  # a space that ends a row
    cut[bounds[:-1][np.diff(bounds) > 0]] = True
    return np.flatnonzero(cut)


class Tokenizers:
    """Both tokenizers with the bytes of their tokens; made once per worker. Pieces between cuts are encoded once and kept."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        words = self.a.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            entries[i] = bytes(letters[c] for c in word) if all(c in letters for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        marks = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.bytes = [_table(entries), _table(marks)]
        self.decimals = _table([str(i).encode() for i in range(max(len(entries), len(marks)))])
        splits = json.loads(self.a.pre_tokenizer.__getstate__()) if self.a.pre_tokenizer else {}
        # a space between two words ends a token of either kind
        self.by_piece = (
            self.a.normalizer is None and splits.get("type") == "ByteLevel" and bool(splits.get("use_regex"))
            and not splits.get("add_prefix_space") and not any("▁" in p.lstrip("▁") for p in pieces)
            and self.b.decode(self.b.encode(_PROBE)) == _PROBE
        )
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.good = np.zeros(0, dtype=bool)
        self.begin = [np.zeros(0, dtype=np.int64) for _ in "ab"]
        self.count = [np.zeros(0, dtype=np.int64) for _ in "ab"]
        self.ids = [np.zeros(0, dtype=np.int64) for _ in "ab"]

    def encode(self, data: np.ndarray, bounds: np.ndarray):
        """Tokens of rows that begin with a space: per tokenizer (ids, first byte, byte after the last, row), and good rows.

        A row is good if the bytes of both kinds of tokens are its bytes; others have no tokens.
        """
        starts = cuts(data, bounds) if self.by_piece else bounds[:-1][np.diff(bounds) > 0]
        lengths = np.diff(np.append(starts, len(data)))
        row = np.searchsorted(bounds, starts, side="right") - 1
        hashes = hash_spans(data, starts, lengths)
        found, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > KEPT_PIECES:
            self._forget()
        new = ~np.isin(found, self.hashes, assume_unique=True)
        if new.any():
            self._learn(found[new], data.tobytes(), starts[first[new]].tolist(), lengths[first[new]].tolist())
        slot = np.searchsorted(self.hashes, found)[back]
        good = np.bincount(row[~self.good[slot]], minlength=len(bounds) - 1) == 0
        good &= np.diff(bounds) > 1  # more than the space before an empty text
        out = []
        for kind in (0, 1):
            count = np.where(good[row], self.count[kind][slot], 0)
            ids = self.ids[kind][_spread(self.begin[kind][slot], count)]
            size = self.bytes[kind][2][ids]
            end = np.cumsum(size)
            before = np.concatenate([[0], end])[np.cumsum(count) - count]
            end += np.repeat(starts - before, count)
            out.append((ids, end - size, end, np.repeat(row, count)))
        return out[0], out[1], good

    def _learn(self, hashes: np.ndarray, raw: bytes, starts: list[int], lengths: list[int]) -> None:
        pieces = [raw[a : a + n] for a, n in zip(starts, lengths)]
        at = np.searchsorted(self.hashes, hashes)
        good = np.ones(len(pieces), dtype=bool)
        counts, ids = ([], []), ([], [])
        for k in range(0, len(pieces), PER_CALL):
            some = pieces[k : k + PER_CALL]
            texts = [p.decode() for p in some]
            encoded = [[x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)], self.b.encode([t[1:] for t in texts], num_threads=1)]
            for kind, lists in enumerate(encoded):
                entries, begins, sizes = self.bytes[kind]
                counts[kind].append(np.array([len(x) for x in lists], dtype=np.int64))
                ids[kind].append(np.array([i for x in lists for i in x], dtype=np.int64))
                own = ids[kind][-1]
                joined = entries[_spread(begins[own], sizes[own])].tobytes()
                ends = np.concatenate([[0], np.cumsum(sizes[own])])[np.concatenate([[0], np.cumsum(counts[kind][-1])])].tolist()
                good[k : k + PER_CALL] &= np.array([joined[a:b] == p for a, b, p in zip(ends[:-1], ends[1:], some)], dtype=bool)
        for kind in (0, 1):
            count = np.concatenate(counts[kind])
            self.begin[kind] = np.insert(self.begin[kind], at, len(self.ids[kind]) + np.cumsum(count) - count)
            self.count[kind] = np.insert(self.count[kind], at, count)
            self.ids[kind] = np.concatenate([self.ids[kind], *ids[kind]])
        self.good = np.insert(self.good, at, good)
        self.hashes = np.insert(self.hashes, at, hashes)


_PROBE = "A éﬁ x"  # unchanged by a tokenizer that normalises nothing


def _byte_letters() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable bytes are themselves, the others follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


# --- fragments -----------------------------------------------------------------------------------------------------

Side = tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, first byte, byte after the last
_NONE: Side = (np.zeros(0, dtype=np.int64),) * 3


def _plus(x: Side, y: Side) -> Side:
    return tuple(np.concatenate(z) for z in zip(x, y))


@dataclass
class Fragment:
    """What a byte range knows; without a common end all its tokens are its head."""

    parted: bool = False
    head: tuple[Side, Side] = (_NONE, _NONE)
    tail: tuple[Side, Side] = (_NONE, _NONE)
    sums: np.ndarray = None  # n_a, n_b, n_groups, n_links of the closed groups
    groups: bytes = b""
    pairs: np.ndarray = None  # distinct A << 32 | B of the closed groups, sorted
    times: np.ndarray = None
    good: bool = True

    def __post_init__(self):
        none = np.zeros(0, dtype=np.int64)
        self.sums = np.zeros(4, dtype=np.int64) if self.sums is None else self.sums
        self.pairs = none if self.pairs is None else self.pairs
        self.times = none if self.times is None else self.times

    def __add__(self, other: Fragment) -> Fragment:
        good = self.good and other.good
        if not other.parted:
            open_ = tuple(map(_plus, self.tail if self.parted else self.head, other.head))
            head, tail = (self.head, open_) if self.parted else (open_, self.tail)
            return Fragment(self.parted, head, tail, self.sums, self.groups, self.pairs, self.times, good)
        if not self.parted:
            head = tuple(map(_plus, self.head, other.head))
            return Fragment(True, head, other.tail, other.sums, other.groups, other.pairs, other.times, good)
        middle = one_group(*map(_plus, self.tail, other.head))
        pairs, times = _summed([self.pairs, middle.pairs, other.pairs], [self.times, middle.times, other.times])
        groups = b";".join(x for x in (self.groups, middle.groups, other.groups) if x)
        return Fragment(True, self.head, other.tail, self.sums + middle.sums + other.sums, groups, pairs, times, good)


def _summed(keys: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, times = np.concatenate(keys), np.concatenate(times)
    found, back = np.unique(keys, return_inverse=True)
    return found, np.bincount(back, weights=None if not len(times) else times, minlength=len(found)).astype(np.int64)


def one_group(a: Side, b: Side) -> Fragment:
    """The closed group of these tokens; no tokens are no group."""
    if not len(a[0]) and not len(b[0]):
        return Fragment(True)
    i, j = _overlaps(a, b)
    pairs, times = np.unique((a[0][i] << 32) | b[0][j], return_counts=True)
    groups = ",".join(map(str, a[0].tolist())) + "|" + ",".join(map(str, b[0].tolist()))
    return Fragment(True, sums=np.array([len(a[0]), len(b[0]), 1, len(i)]), groups=groups.encode(), pairs=pairs, times=times)


def closed(fragment: Fragment) -> Fragment:
    """A fragment that begins and ends with its document: its prefix is a whole group."""
    return Fragment(True) + fragment + Fragment(True)


def _overlaps(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all A-B pairs with overlapping bytes; both sides are sorted and without gaps."""
    low = np.searchsorted(b[2], a[1], side="right")
    many = np.maximum(np.searchsorted(b[1], a[2], side="left") - low, 0)
    return np.repeat(np.arange(len(a[0])), many), _spread(low, many)


def fragments(tokens: Tokenizers, data: np.ndarray, bounds: np.ndarray, low: np.ndarray, high: np.ndarray, whole: np.ndarray):
    """Aligns all rows at once. Row ``i`` stands for its tokens that end in (low[i], high[i]]; ``whole`` rows are documents.

    Returns (sums by row, bytes of the closed groups and their bounds by row, links as (row, pair), good rows, open tokens
    by side as (ids, start, end, row, before the first common end)).
    """
    sides = list(tokens.encode(data, bounds))
    good = sides.pop()
    if not whole.all():
        for k, (ids, start, end, row) in enumerate(sides):
            mine = (end > low[row]) & (end <= high[row])
            sides[k] = (ids[mine], start[mine], end[mine], row[mine])
    a, b = sides
    slot = np.searchsorted(b[2], a[2])
    slot[slot == len(b[2])] = 0
    common = np.flatnonzero(b[2][slot] == a[2]) if len(b[2]) else np.zeros(0, dtype=np.int64)
    ends, its = a[2][common], a[3][common]
    first = np.concatenate([[True], its[1:] != its[:-1]]) if len(its) else np.zeros(0, dtype=bool)
    shut = ~first | whole[its]  # groups whose beginning lies in the row as well
    open_, inside = [], []
    for ids, start, end, row in (a, b):
        group = np.searchsorted(ends, end)
        ended = group < len(ends)
        ended[ended] = its[group[ended]] == row[ended]
        before = ended.copy()
        before[ended] = ~shut[group[ended]]
        some = ~ended | before
        open_.append((ids[some], start[some], end[some], row[some], before[some]))
        keep = ~some
        inside.append((ids[keep], start[keep], end[keep], row[keep], group[keep]))
    a, b = inside
    i, j = _overlaps(a[:3], b[:3])
    same = a[4][i] == b[4][j]
    i, j = i[same], j[same]
    n = len(bounds) - 1
    sums = np.stack([np.bincount(x, minlength=n) for x in (a[3], b[3], its[shut], a[3][i])], axis=1)
    # A tokens of a group, then its B tokens
    groups = len(ends)
    in_a, in_b = (np.bincount(x[4], minlength=groups) for x in (a, b))
    place_a = np.arange(len(a[0])) + np.repeat(np.cumsum(in_b) - in_b, in_a)
    place_b = np.arange(len(b[0])) + np.repeat(np.cumsum(in_a), in_b)
    ids = np.empty(len(a[0]) + len(b[0]), dtype=np.int64)
    ids[place_a], ids[place_b] = a[0], b[0]
    mark = np.full(len(ids), ord(","), dtype=np.uint8)
    some = in_a > 0
    mark[place_a[np.cumsum(in_a)[some] - 1]] = ord("|")
    mark[place_b[np.cumsum(in_b)[some] - 1]] = ord(";")
    letters, begins, sizes = tokens.decimals
    size = sizes[ids] + 1
    stop = np.cumsum(size)
    text = np.empty(int(stop[-1]) if len(stop) else 0, dtype=np.uint8)
    text[np.delete(np.arange(len(text)), stop - 1) if len(stop) else stop] = letters[_spread(begins[ids], sizes[ids])]
    text[stop - 1] = mark
    many = np.cumsum(sums[:, 0] + sums[:, 1])
    edges = np.concatenate([[0], np.concatenate([[0], stop])[many]])
    return sums, text, edges, a[3][i], (a[0][i] << 32) | b[0][j], good, open_


def _spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a space before each."""
    out = np.full(len(data) + len(bounds) - 1, 0x20, dtype=np.uint8)
    wider = bounds + np.arange(len(bounds))
    keep = np.ones(len(out), dtype=bool)
    keep[wider[:-1]] = False
    out[keep] = data
    return out, wider


class Blocks:
    """Aligned documents gathered into rows with one pair dictionary each."""

    def __init__(self, kind: pa.DataType):
        self.kind = kind
        self._clear()

    def _clear(self):
        self.keys, self.sums, self.shas, self.links, self.docs, self.size = [], [], [], [], 0, 0

    def add(self, keys: pa.Array, sums: np.ndarray, shas: list[str], row: np.ndarray, pair: np.ndarray, times, size: int):
        self.keys.append(keys)
        self.sums.append(sums)
        self.shas += shas
        found, back = np.unique(pair, return_inverse=True)
        cell = (row << 32) | back
        if times is None:
            cell, times = np.unique(cell, return_counts=True)
        self.links.append((found, (cell >> 32) + self.docs, cell & 0xFFFFFFFF, times))
        self.docs += len(shas)
        self.size += size

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        pairs = np.unique(np.concatenate([x[0] for x in self.links]))
        slot = np.concatenate([np.searchsorted(pairs, x[0])[x[2]] for x in self.links])
        doc, times = (np.concatenate([x[k] for x in self.links]) for k in (1, 3))
        total = np.bincount(slot, weights=times, minlength=len(pairs)).astype(np.int64)
        sums = np.concatenate(self.sums)
        ends = np.searchsorted(doc, np.arange(self.docs + 1))
        one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        raw = lambda values: pa.array([np.ascontiguousarray(values).tobytes()], pa.binary())
        columns = [
            one(pa.concat_arrays(self.keys)), raw(sums.astype("<i8")), one(pa.array(self.shas, pa.string())),
            raw(ends.astype("<i8")), raw(slot.astype("<i4")), raw(times.astype("<i8")), one(pa.array(pairs)), one(pa.array(total)),
        ]
        self._clear()
        yield pa.RecordBatch.from_arrays(columns, ["keys", "sums", "shas", "ends", "slot", "times", "pairs", "total"])


def _block_schema(kind: str) -> str:
    return (
        f"keys array<{kind}>, sums binary, shas array<string>, ends binary, slot binary, times binary, "
        "pairs array<long>, total array<long>"
    )


def _sha(groups) -> str:
    return hashlib.sha256(groups).hexdigest()


def _short(paths: tuple[str, str], key: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, out = Tokenizers(*paths), None
        for block in blocks(batches, text, BLOCK_BYTES):
            keys = block.rows.column(block.rows.schema.get_field_index(key))
            out = out or Blocks(keys.type)
            data, bounds = _spaced(block.data, block.bounds)
            whole = np.ones(len(bounds) - 1, dtype=bool)
            sums, groups, edges, row, pair, _, _ = fragments(tokens, data, bounds, bounds[:-1], bounds[1:], whole)
            view = memoryview(groups)
            shas = [_sha(view[a : b - 1]) if b > a else "" for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            out.add(keys, sums, shas, row, pair, None, len(data))
            if out.size >= DICTIONARY_BYTES:
                yield from out.flush()
        if out:
            yield from out.flush()

    return run


def _ranges(chunk: int):
    """Rows of a long text: a byte range each, with the text from the cut before to the cut after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(b" " + batch.column(1)[i].as_py().encode(), dtype=np.uint8)
                safe = np.append(cuts(data, np.array([0, len(data)])), len(data))
                at = np.arange(chunk, len(data), chunk)
                left = safe[np.searchsorted(safe, at, side="right") - 1]
                right = safe[np.searchsorted(safe, at)]
                near = right - left <= chunk  # else this range goes on to the next cut
                low = np.concatenate([[0], at[near]])
                high = np.append(at[near], len(data))
                first, last = np.concatenate([[0], left[near]]), np.append(right[near], len(data))
                for k in range(len(low)):
                    body = data[first[k] : last[k]].tobytes()
                    rest = [batch.column(0)[i].as_py(), k, len(low), int(first[k]), int(low[k] - first[k]), int(high[k] - first[k]), body]
                    yield pa.RecordBatch.from_pylist([dict(zip(("rid", "idx", "of", "base", "low", "high", "body"), rest))], _UNIT_ARROW)

    return run


_UNIT_ARROW = pa.schema(
    [("rid", pa.int64()), ("idx", pa.int32()), ("of", pa.int32()), ("base", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("body", pa.binary())]
)


def _aligned(paths: tuple[str, str]):
    """The fragment of each byte range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokenizers(*paths)
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["body"], dtype=np.uint8)
                yield _packed(row["rid"], row["idx"], _fragment(tokens, data, row["base"], row["low"], row["high"]))

    return run


def _fragment(tokens: Tokenizers, data: np.ndarray, base: int, low: int, high: int) -> Fragment:
    bounds = np.array([0, len(data)])
    sums, groups, _, _, pair, good, open_ = fragments(tokens, data, bounds, np.array([low]), np.array([high]), np.zeros(1, dtype=bool))
    pairs, times = np.unique(pair, return_counts=True)
    ends = [tuple((ids[m], start[m] + base, end[m] + base) for m in (before, ~before)) for ids, start, end, _, before in open_]
    parted = bool(ends[0][0][0].size)  # a common end lies in the range, so tokens stand before the first one
    head, tail = tuple(x[0] for x in ends), tuple(x[1] for x in ends)
    if not parted:
        head, tail = tail, (_NONE, _NONE)
    return Fragment(parted, head, tail, sums[0], groups[:-1].tobytes(), pairs, times, bool(good[0]))


def _packed(rid: int, idx: int, f: Fragment) -> pa.RecordBatch:
    flat = lambda side: pa.array([np.stack(side, axis=1).ravel()], pa.list_(pa.int64()))
    columns = [
        pa.array([rid], pa.int64()), pa.array([idx], pa.int32()), pa.array([f.good]), pa.array([f.parted]),
        flat(f.head[0]), flat(f.head[1]), flat(f.tail[0]), flat(f.tail[1]), *(pa.array([int(x)], pa.int64()) for x in f.sums),
        pa.array([f.groups], pa.binary()), pa.array([f.pairs], pa.list_(pa.int64())), pa.array([f.times], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in _FRAGMENT.split(", ")])


def _unpacked(rows: pa.Table) -> list[Fragment]:
    out = []
    for r in rows.sort_by("idx").to_batches():
        for i in range(r.num_rows):
            get = lambda c: r.column(r.schema.get_field_index(c))[i]
            side = lambda c: tuple(np.array(get(c).values, dtype=np.int64).reshape(-1, 3).T)
            sums = np.array([get(c).as_py() for c in ("n_a", "n_b", "n_groups", "n_links")])
            numbers = [np.array(get(c).values, dtype=np.int64) for c in ("pairs", "times")]
            ends = ((side("head"), side("head_b")), (side("tail"), side("tail_b")))
            out.append(Fragment(get("parted").as_py(), *ends, sums, get("groups").as_py(), *numbers, get("good").as_py()))
    return out


def _compose(rows: pa.Table) -> pa.Table:
    """Neighbouring fragments of one document, ``FAN`` at most."""
    total = Fragment()
    for one in _unpacked(rows):
        total = total + one
    return pa.Table.from_batches([_packed(rows["rid"][0].as_py(), rows["idx"][0].as_py() // FAN, total)])


def _finished(rows_by: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(rows_by))
            out = Blocks(keys.type)
            for i, one in enumerate(_unpacked(pa.Table.from_batches([batch.set_column(batch.schema.get_field_index("idx"), "idx", pa.array(range(batch.num_rows), pa.int32()))]))):
                f = closed(one) if one.good else Fragment()
                none = np.zeros(len(f.pairs), dtype=np.int64)
                out.add(keys.slice(i, 1), f.sums[None, :], [_sha(f.groups) if f.groups else ""], none, f.pairs, f.times, len(f.groups))
            yield from out.flush()

    return run


def composed(fragments_: DataFrame) -> DataFrame:
    """One fragment per document: rounds that compose ``FAN`` neighbours each, until every document has one."""
    while True:
        last = fragments_.agg(F.max("idx").alias("m")).first().m
        if not last:
            return fragments_
        grouped = fragments_.groupBy("rid", F.floor(F.col("idx") / FAN).alias("part"))
        fragments_ = stored(grouped.applyInArrow(_compose, _FRAGMENT), "fragments", LARGE_ROWS)


def _scored(key: str):
    """The documents of a block, from its row and from what is known of its pairs by their place."""

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        get = lambda c: block.column(c)[0]
        sums = np.frombuffer(get("sums").as_py(), dtype="<i8").reshape(-1, 4)
        ends, times = (np.frombuffer(get(c).as_py(), dtype="<i8") for c in ("ends", "times"))
        slot = np.frombuffer(get("slot").as_py(), dtype="<i4")
        count, best = np.zeros((2, get("n_pairs").as_py()), dtype=np.int64)
        place = known.column("place").to_numpy()
        count[place], best[place] = known.column("count").to_numpy(), known.column("best").to_numpy()
        run_ = [np.concatenate([[0], np.cumsum(x[slot] * times)]) for x in (best, count)]
        columns = [get("keys").values, *(pa.array(sums[:, k]) for k in range(4)), *(pa.array(np.diff(x[ends])) for x in run_), get("shas").values]
        return pa.Table.from_arrays(columns, [key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best) over the corpus from aligned blocks; ``best`` is 1 where no pair of the same B id has more links.

    A pair is ``A << 32 | B``.
    """
    pairs = rows.select(F.explode(F.arrays_zip("pairs", "total")).alias("x")).select("x.pairs", "x.total")
    counts = stored(pairs.groupBy(F.col("pairs").alias("pair")).agg(F.sum("total").alias("count")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def align_tokens(
    docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", *, chunk: int = CHUNK_BYTES
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Tokenizer A encodes a space and the text, tokenizer B the text; special tokens are plain text. ``n_best`` counts links
    whose pair is the most frequent of its B id over all rows (ties included), ``count_sum`` adds up the counts of the pairs
    of all links. Groups are written ``a1,a2|b1;a3|b2,b3`` and hashed.

    Rows without text, and those whose tokens do not give their bytes back, have zeros and an empty hash. Repeated rows
    count each time. An empty table gives no rows. Other columns are not read.
    """
    paths, kind = (path_a, path_b), dict(docs.dtypes)[key]
    with intermediates(docs.sparkSession, keep=("aligned", "known")):
        rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        size = F.coalesce(F.octet_length("text"), F.lit(0))
        aligned = rows.where(size <= chunk).mapInArrow(_short(paths, "key", "text"), _block_schema(kind))
        numbered = stored(rows.where(size > chunk).withColumn("rid", F.monotonically_increasing_id()), "long", LARGE_ROWS)
        ranges = numbered.select("rid", "text").mapInArrow(_ranges(chunk), _UNIT)
        spread = ranges.repartition("rid", "idx").mapInArrow(_aligned(paths), _FRAGMENT)
        whole = composed(stored(spread, "fragments", LARGE_ROWS)).join(numbered.select("rid", "key"), "rid")
        aligned = aligned.unionByName(whole.mapInArrow(_finished("key"), _block_schema(kind)))
        aligned = stored(aligned.withColumn("block", F.monotonically_increasing_id()), "aligned", LARGE_ROWS)
        counts = pair_counts(aligned)
        asked = aligned.select("block", F.posexplode("pairs").alias("place", "pair"))
        known = stored(asked.join(counts, "pair").select("block", "place", "count", "best"), "known")
    # Both sides come to Python sorted, a block at a time, so memory does not depend on the blocks of a task.
    cells = aligned.select("block", "keys", "sums", "shas", "ends", "slot", "times", F.size("pairs").alias("n_pairs"))
    schema = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return cells.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_scored(key), schema)
