"""Removal of long strings that repeat, by merged Burrows-Wheeler transforms of bounded shards.

A string of ``length`` bytes contains ``span`` grams; the leftmost gram of least hash is its anchor, so equal strings have
equal anchors at equal places, and each anchor owns a run of string starts. The owned run with all its strings is the
anchor's context, at most ``span + length - 1`` bytes. Only contexts of one anchor can share a string, so the corpus falls
into collections of short texts that tasks treat independently:

1. One scan counts anchors; a bitmap of fixed size holds those that occur again.
2. A second scan writes the contexts of these. Equal contexts are one text of the collection; all but the first go.
3. Different contexts of an anchor are gathered into shards of bounded size, small anchors together. Each shard's suffixes
   are sorted once into a transform, to the depth of a string; suffixes that do not part are the repeated strings. Where an
   anchor has several shards, their transforms are merged by refining their interleave, one symbol of two bytes a round:
   the order of all suffixes by ``h`` symbols, taken through the symbols that stand before them, is the order by
   ``h + 1``. The round in which two neighbours part is their common prefix. After ``length / 2`` rounds the intervals
   that are left are the repeated strings. Shards of different anchors share no string and are not merged.
4. An anchor with very many different contexts (a line that stands in a large part of all documents) is cut: its strings
   go by their place around the anchor, eight places together, then one, each with the bytes they all share as the key.

Text bytes are shuffled only for different contexts of one anchor, and once at the end, when documents meet their spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespoon.llm.words import _BASE, _VALUES, blocks, hash_spans, mix64
from tablespoon.session import intermediates, scratch_dir, stored

LENGTH = 100
FILTER_BITS = 27  # the bitmaps have 2**27 bits, 16 MB, whatever the input
SLICE = 1 << 20  # string starts treated at once, also inside a longer document
CHUNK = 1 << 14  # places hashed at once
SHARD_BYTES = 1 << 16
MERGE_BYTES = 1 << 20  # contexts merged at once
LARGEST = 1024  # different contexts of an anchor that are merged as they are
_NO_ID = -(1 << 63)
_CONTEXT = "h long, c long, doc long, t long, p long, n int, o int, body binary"
_SPAN = "doc long, t long, a long, b long"


def _shape(length: int) -> tuple[int, int]:
    """Grams per string (a power of two) and bytes per gram."""
    span = 1 << (max(2 * length // 3, 1).bit_length() - 1)
    return span, length - span + 1


@lru_cache(maxsize=2)
def _scales(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse modulo 2**64."""
    out = []
    for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        power = np.full(n, base, dtype=np.uint64)
        power[0] = 1
        out.append(np.multiply.accumulate(power, out=power))
    return out[0], out[1]


def _scales_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _scales(max(SLICE, 1 << n.bit_length()))


def _mixed(x: np.ndarray) -> np.ndarray:
    """:func:`mix64` in place."""
    y = x >> np.uint64(30)
    x ^= y
    x *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(x, np.uint64(27), out=y)
    x ^= y
    x *= np.uint64(0x94D049BB133111EB)
    np.right_shift(x, np.uint64(31), out=y)
    x ^= y
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Polynomial sums of the bytes before each place; the hash of any span is a difference of two."""
    up, _ = _scales_for(len(data))
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    for at in range(0, len(data), CHUNK):
        value = _VALUES.take(data[at : at + CHUNK])
        value *= up[at : at + len(value)]
        value[:1] += out[at : at + 1]
        np.cumsum(value, out=out[at + 1 : at + 1 + len(value)])
    return out


def gram_hashes(sums: np.ndarray, first: int, last: int, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each of the places ``first`` to ``last - 1`` on."""
    out = sums[first + size : last + size] - sums[first:last]
    out *= _scales_for(len(sums) - 1)[1][first:last]
    return _mixed(out)


def _sums_of(sums: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return (sums[starts + lengths] - sums[starts]) * _scales_for(len(sums) - 1)[1][starts]


def span_hashes(sums: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """:func:`hash_spans`, by the prefix sums of the data."""
    return _mixed(_sums_of(sums, starts, lengths) ^ (lengths.astype(np.uint64) << np.uint64(1)))


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, sums: np.ndarray | None = None):
    """(hash, place, first string start, number of starts) of every anchor in ``data``; strings stay within rows.

    The places of a chunk are taken together, so that its numbers stay in the cache.
    """
    span, gram = _shape(length)
    size = np.diff(bounds)
    long = size >= length
    if not long.any():
        none = np.zeros(0, dtype=np.int64)
        return np.zeros(0, dtype=np.uint64), none, none, none
    sums = prefix_sums(data) if sums is None else sums
    total = len(data) - length + 1
    places = np.empty(total, dtype=np.int64)
    low = (np.uint64(1) << np.uint64((CHUNK + span).bit_length())) - np.uint64(1)
    for at in range(0, total, CHUNK):
        many = min(CHUNK, total - at) + span - 1
        least = gram_hashes(sums, at, at + many, gram)
        least &= ~low
        least |= np.arange(many, dtype=np.uint64)  # the leftmost of equal hashes
        other, width = np.empty_like(least), 1
        while width < span:
            many -= width
            np.minimum(least[:many], least[width : many + width], out=other[:many])
            least, other, width = other, least, 2 * width
        least[:many] &= low
        np.add(least[:many].view(np.int64), at, out=places[at : at + many])
    fits = np.zeros(total + 1, dtype=np.int8)
    fits[bounds[:-1][long]] = 1
    fits[bounds[1:][long] - length + 1] = -1
    fits = np.cumsum(fits[:-1], dtype=np.int8).view(bool)
    head = np.ones(total, dtype=bool)
    np.not_equal(places[1:], places[:-1], out=head[1:])
    head[1:] |= ~fits[:-1]
    start = np.flatnonzero(head & fits)
    place = places[start]
    stop = bounds[np.searchsorted(bounds, start, side="right")] - length + 1
    many = np.minimum(np.append(start[1:], total), stop) - start
    hashes = _mixed(_sums_of(sums, place, np.int64(gram)))
    # least hashes share their leading bits, which the bitmaps go by, so they are mixed again
    return _mixed(hashes ^ _BASE), place, start, many


def _pieces(batches: Iterator[pa.RecordBatch], text: str, length: int):
    """(rows, data, bounds, first byte in its row) of runs of whole rows, or of parts of a long row that overlap."""
    for block in blocks(batches, text, SLICE):
        if len(block.data) <= 2 * SLICE:
            yield block.rows, block.data, block.bounds, 0
            continue
        for at in range(0, len(block.data), SLICE):
            part = block.data[at : at + SLICE + length - 1]
            yield block.rows, part, np.array([0, len(part)]), at


def _counted(text: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, bounds, _ in _pieces(batches, text, length):
            found, n = np.unique(anchors(data, bounds, length)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(np.minimum(n, 2), pa.int32())], ["h", "n"])

    return run


def bitmap(hashes: DataFrame, h: str = "h", bits: int = FILTER_BITS) -> np.ndarray:
    """Set bits at the leading ``bits`` bits of every hash; the driver gets at most ``2**(bits - 6)`` numbers."""
    place = F.shiftrightunsigned(h, 64 - bits)
    words = hashes.select(F.shiftright(place, 6).alias("w"), F.expr("1L << 0").alias("one"), (place % 64).cast("int").alias("b"))
    words = words.select("w", F.call_function("shiftleft", "one", "b").alias("m")).groupBy("w").agg(F.bit_or("m").alias("m"))
    found = words.toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found["w"].to_numpy()] = found["m"].to_numpy()
    return out.view(np.uint64)


def _marked(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - (len(filter_).bit_length() + 5))
    return (filter_[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)


def _binary(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    view = memoryview(np.ascontiguousarray(data))
    raw = b"".join([view[a:b] for a, b in zip(first.tolist(), (first + size).tolist())])
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def _long(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _contexts(kept, text: str, length: int):
    """Contexts of marked anchors. Of equal ones in a piece the first stays; a row without body is a span that goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, bounds, offset in _pieces(batches, text, length):
            sums = prefix_sums(data)
            hashes, place, start, many = anchors(data, bounds, length, sums)
            some = _marked(kept.value, hashes)
            hashes, place, start, many = hashes[some], place[some], start[some], many[some]
            if not len(hashes):
                continue
            row = np.searchsorted(bounds, start, side="right") - 1
            doc, t = (_long(rows.column(rows.schema.get_field_index(c)))[row] for c in ("__doc", "__t"))
            whole = span_hashes(sums, start, many + length - 1) ^ mix64((place - start + 1).astype(np.uint64))
            p = start - bounds[row] + offset
            order = np.lexsort((p, t, doc, whole, hashes))
            same = np.zeros(len(order), dtype=bool)
            same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (whole[order][1:] == whole[order][:-1])
            again = np.zeros(len(order), dtype=bool)
            again[order] = same
            lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            first = np.empty(len(order), dtype=np.int64)
            first[order] = lead
            # rows that repeat as a whole are one document: its place is no second one
            equal = (doc == doc[first]) & (t == t[first]) & (p == p[first])
            new, gone = np.flatnonzero(~again), np.flatnonzero(again & ~equal)
            yield _batch(hashes[new], whole[new], doc[new], t[new], p[new], many[new], (place - start)[new], _binary(data, start[new], many[new] + length - 1))
            if len(gone):
                a, b, whose = _joined(doc[gone], t[gone], p[gone], p[gone] + many[gone] + length - 1)
                gone = gone[whose]
                none = np.zeros(len(gone), dtype=np.int64)
                yield _batch(none, none, doc[gone], t[gone], a, b - a, none, pa.nulls(len(gone), pa.binary()))

    return run


def _batch(h, c, doc, t, p, n, o, body) -> pa.RecordBatch:
    numbers = [pa.array(np.asarray(x).view(np.int64)) for x in (h, c, doc, t, p)]
    return pa.RecordBatch.from_arrays([*numbers, pa.array(n, pa.int32()), pa.array(o, pa.int32()), body], ["h", "c", "doc", "t", "p", "n", "o", "body"])


def _joined(doc, t, a, b):
    """Spans of each document put together where they touch: (a, b, index of a span of the same document)."""
    order = np.lexsort((a, t, doc))
    doc, t, a, b = doc[order], t[order], a[order], b[order]
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (t[1:] != t[:-1])])
    group = np.cumsum(fresh)
    reach = np.maximum.accumulate(b + group * (np.int64(1) << 40)) - group * (np.int64(1) << 40)
    head = np.flatnonzero(fresh | np.concatenate([[True], a[1:] > reach[:-1]]))
    return a[head], reach[np.append(head[1:], len(a)) - 1], order[head]


# --- merged transforms ---------------------------------------------------------------------------------------------


def _symbols(data: np.ndarray, bounds: np.ndarray):
    """Symbol of two bytes at each place of each text, and the place before (two bytes back) as a slot.

    A text has two places after its last byte, which close the two chains of its even and odd places; before the first
    places of a chain stands its end.
    """
    size = np.diff(bounds)
    n = len(data) + 2 * len(size)
    begin = bounds[:-1] + 2 * np.arange(len(size))
    padded = np.zeros(n + 1, dtype=np.uint16)
    padded[_spread(begin, size)] = data
    symbol = (padded[:-1] << np.uint16(8)) | padded[1:]
    symbol[begin + size], symbol[begin + size + 1] = 0, 0
    before = np.arange(n) - 2
    for chain in (0, 1):
        before[begin + chain] = begin + size + (size + chain) % 2
    return symbol, before, begin


def _order(ranks: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of their ranks of ``bits`` bits, equal ones by place; and where a new rank begins."""
    n = len(ranks[0])
    low = max(n - 1, 1).bit_length()
    if bits * len(ranks) + low > 64:
        order = np.lexsort(ranks[::-1])
        parted = np.zeros(n, dtype=bool)
        for rank in ranks:
            parted[1:] |= rank[order[1:]] != rank[order[:-1]]
    else:
        key = ranks[0].astype(np.uint64)
        for rank in ranks[1:]:
            key <<= np.uint64(bits)
            key |= rank.astype(np.uint64)
        key <<= np.uint64(low)
        key |= np.arange(n, dtype=np.uint64)
        key.sort()
        order = (key & ((np.uint64(1) << np.uint64(low)) - np.uint64(1))).astype(np.int64)
        key >>= np.uint64(low)
        parted = np.zeros(n, dtype=bool)
        np.not_equal(key[1:], key[:-1], out=parted[1:])
    parted[:1] = True
    return order, parted


def ordered(symbol: np.ndarray, before: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``rounds`` symbols, equal ones by place; and which ones differ from the one before.

    Sorted by prefix doubling, or tripling where three ranks and a place fit into 64 bits.
    """
    n = len(before)
    after = np.empty(n, dtype=np.int64)
    after[before] = np.arange(n)
    bits = max(n - 1, 1).bit_length()
    ranks, jump = [symbol], after
    while len(ranks) < min(rounds, max((64 - bits) // 16, 1)):
        ranks.append(symbol[jump])
        jump = after[jump]
    known = len(ranks)  # ``jump`` goes as many symbols ahead
    order, parted = _order(ranks, 16)
    while known < rounds and not parted.all():
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(parted) - 1
        depth = min(known * max(64 // bits - 1, 2), rounds)
        ranks, at, far = [rank], 0, np.arange(n)
        while at + known < depth:
            step = min(known, depth - known - at)
            far = (jump if step == known else _ahead(after, step))[far]
            ranks.append(rank[far])
            at += step
        if depth < rounds:
            jump, known = jump[far], depth
        else:
            known = rounds
        order, parted = _order(ranks, bits)
    return order, parted


def _ahead(after: np.ndarray, steps: int) -> np.ndarray:
    """Places ``steps`` symbols ahead."""
    out, power = np.arange(len(after)), after
    while steps:
        if steps & 1:
            out = power[out]
        steps >>= 1
        power = power[power] if steps else power
    return out


def transform(data: np.ndarray, bounds: np.ndarray, rounds: int):
    """Burrows-Wheeler transform of a shard of short texts, to a depth of ``rounds`` symbols.

    Returns (symbol before each sorted suffix, slot of the suffix that starts there, place of each slot, whether its first
    ``rounds`` symbols differ from the slot's before).
    """
    symbol, before, _ = _symbols(data, bounds)
    order, parted = ordered(symbol, before, rounds)
    slot = np.empty(len(order), dtype=np.int64)
    slot[order] = np.arange(len(order))
    back = before[order]
    return symbol[back], slot[back], order, parted


def merged(shards: list, rounds: int):
    """Interleave of the shards' transforms, refined ``rounds`` times.

    Returns (slots in merged order, with the shards' slots numbered one after the other; common prefix in symbols of each
    slot and the one before, ``rounds`` where it is longer). The interleave starts as one shard after the other. A round
    deals the slots, in their order so far, into the symbols that stand before them, and steps to the suffixes that start
    with these; the order within a shard never changes beyond what its transform says. Once few slots change their block
    in a round, only the suffixes before these are looked at.
    """
    base = np.cumsum([0, *(len(s[0]) for s in shards)])
    symbol = np.concatenate([s[0] for s in shards])
    step = np.concatenate([s[1] + b for s, b in zip(shards, base)]).astype(np.int32)
    n, done = len(symbol), 0
    order, place = np.arange(n, dtype=np.int32), np.arange(n, dtype=np.int32)
    first = np.zeros(n, dtype=np.int32)  # of the block, by place
    common = np.full(n, rounds, dtype=np.int16)
    changed = np.ones(n, dtype=bool)
    while done < rounds and 8 * int(changed.sum()) > n:
        seen = symbol[order]
        dealt = np.argsort(seen, kind="stable")  # 16-bit numbers: a counting sort
        seen, block = seen[dealt], first[dealt]
        order = step[order[dealt]]
        parted = np.empty(n, dtype=bool)
        parted[:1] = True
        parted[1:] = (seen[1:] != seen[:-1]) | (block[1:] != block[:-1])
        common[parted & (common == rounds)] = done
        new = np.maximum.accumulate(np.where(parted, place, 0))
        changed = new != first
        first, done = new, done + 1
    block = np.empty(n, dtype=np.int32)
    block[order] = first
    size = np.bincount(first, minlength=n)
    moved = order[changed]
    while done < rounds and len(moved):
        before = step[moved]
        old, key = block[before], block[moved]
        some = size[old] > 1
        before, old, key = before[some], old[some], key[some]
        sort = np.argsort(old.astype(np.int64) * n + key)
        before, old, key = before[sort], old[sort], key[sort]
        head = np.flatnonzero(np.concatenate([[True], (old[1:] != old[:-1]) | (key[1:] != key[:-1])])) if len(old) else sort
        many = np.diff(np.append(head, len(old)))
        its = old[head]
        lead = np.concatenate([[True], its[1:] != its[:-1]]) if len(its) else np.zeros(0, dtype=bool)
        ahead = np.cumsum(many) - many  # slots of earlier parts of the block
        ahead -= np.repeat(ahead[lead], np.diff(np.append(np.flatnonzero(lead), len(lead))))
        total = np.add.reduceat(many, np.flatnonzero(lead)) if len(its) else many
        kept = np.repeat(size[its[lead]] - total, np.diff(np.append(np.flatnonzero(lead), len(lead))))  # unmoved ones come first
        new = its + kept + ahead
        fresh = new != its
        size[its[lead]] = np.where(size[its[lead]] > total, size[its[lead]] - total, many[lead])
        size[new[fresh]] = many[fresh]
        common[new[fresh]] = done
        block[before] = np.repeat(new, many)
        moved = before[np.repeat(fresh, many)]
        done += 1
    return np.argsort(block, kind="stable"), common


def _collections(ends: np.ndarray, cuts: np.ndarray, shard_bytes: int) -> Iterator[list[tuple[int, int]]]:
    """Texts to be compared, as shards (first text, text after the last) of at most ``shard_bytes`` places or one text.

    ``cuts`` has the first text of each anchor and the number of texts. Whole anchors share a shard; only the shards of
    one large anchor have strings in common and are merged.
    """
    marks, at = ends[cuts], 0
    while at < len(cuts) - 1:
        to = int(np.searchsorted(marks, marks[at] + shard_bytes, side="right")) - 1
        if to > at:
            yield [(int(cuts[at]), int(cuts[to]))]
            at = to
            continue
        text, last, shards = int(cuts[at]), int(cuts[at + 1]), []
        while text < last:
            end = int(np.searchsorted(ends, ends[text] + shard_bytes, side="right")) - 1
            end = min(max(end, text + 1), last)
            shards.append((text, end))
            text = end
        yield shards
        at += 1


def repeats(
    data: np.ndarray, bounds: np.ndarray, starts: np.ndarray, length: int, shard_bytes: int = SHARD_BYTES, anchor: np.ndarray | None = None
):
    """Repeated strings of a collection: (interval, text, place) of every string start whose ``length`` bytes occur twice.

    String starts of text ``i`` are its first ``starts[i]`` places. Texts come sorted by ``anchor``, and only those of one
    share strings; without it all may. An odd ``length`` is compared by its last byte after the even part.
    """
    rounds, texts = length // 2, len(bounds) - 1
    cuts = [0, texts] if anchor is None else [0, *(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1).tolist(), texts]
    found, last = [], 0
    for shards in _collections(bounds + 2 * np.arange(texts + 1), np.unique(cuts), shard_bytes):
        made, text, place = [], [], []
        for a, b in shards:
            part = bounds[a : b + 1] - bounds[a]
            made.append(transform(data[bounds[a] : bounds[b]], part, rounds))
            begin, order = part[:-1] + 2 * np.arange(b - a), made[-1][2]
            whose = np.repeat(np.arange(b - a), np.diff(part) + 2)[order]
            text.append(whose + a)
            place.append(order - begin[whose])
        if len(made) == 1:
            parted, text, place = made[0][3], text[0], place[0]
        else:
            order, common = merged(made, rounds)
            parted, text, place = common < rounds, np.concatenate(text)[order], np.concatenate(place)[order]
        some = place < starts[text]
        interval = last + np.cumsum(parted)
        last = int(interval[-1])
        found.append((interval[some], text[some], place[some]))
    interval, text, place = (np.concatenate(x) if found else np.zeros(0, dtype=np.int64) for x in (zip(*found) if found else ((),) * 3))
    if length % 2 and len(interval):
        last = data[bounds[text] + place + length - 1].astype(np.int64)
        again = np.lexsort((last, interval))
        interval, text, place, last = interval[again], text[again], place[again], last[again]
        interval = np.cumsum(np.concatenate([[0], (interval[1:] != interval[:-1]) | (last[1:] != last[:-1])]))
    if not len(interval):
        return interval, text, place
    many = np.bincount(interval)[interval] > 1
    return interval[many], text[many], place[many]


def _merge(length: int, merge_bytes: int, shard_bytes: int):
    """Spans that go: strings of a collection of which an earlier text has the same. Rows come sorted by anchor."""

    def judged(rows: pa.Table) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        body = rows["body"].chunk(0) if rows["body"].num_chunks else pa.array([], pa.binary())
        bounds = np.frombuffer(body.buffers()[1], dtype=np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
        data = np.frombuffer(body.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
        doc, t, p, n = (rows[c].to_numpy() for c in ("doc", "t", "p", "n"))
        age = np.empty(len(doc), dtype=np.int64)
        age[np.lexsort((p, t, doc))] = np.arange(len(doc))
        interval, text, place = repeats(data, bounds - bounds[0], n, length, shard_bytes, rows["h"].to_numpy())
        order = np.lexsort((place, age[text], interval))
        interval, text, place = interval[order], text[order], place[order]
        later = np.flatnonzero(np.concatenate([[False], interval[1:] == interval[:-1]])) if len(interval) else order
        text, start = text[later], p[text[later]] + place[later]
        if not len(text):
            return _spans([], [], [], [])
        a, b, whose = _joined(doc[text], t[text], start, start + length)
        return _spans(doc[text[whose]], t[text[whose]], a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            h = _long(batch.column(batch.schema.get_field_index("h")))
            last = waiting[-1]["h"][-1].as_py() if waiting else None
            begin = 0
            cuts = np.flatnonzero(np.concatenate([[last is not None and h[0] != last], h[1:] != h[:-1]]))
            for cut in cuts.tolist():
                if size + 128 * (cut - begin) >= merge_bytes:
                    yield judged(pa.concat_tables([*waiting, pa.Table.from_batches([batch.slice(begin, cut - begin)])]))
                    waiting, size, begin = [], 0, cut
            rest = batch.slice(begin)
            if rest.num_rows:
                waiting.append(pa.Table.from_batches([rest]))
                size += 128 * rest.num_rows
        if waiting:
            yield judged(pa.concat_tables(waiting))

    return run


def _spans(doc, t, a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x, dtype=np.int64)) for x in (doc, t, a, b)], ["doc", "t", "a", "b"])


def _kept_rows(kept):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_marked(kept.value, _long(batch.column(0)).view(np.uint64))))

    return run


def _cut(length: int, step: int):
    """Contexts cut into the strings of ``step`` neighbouring places before the anchor; the bytes these share are the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 12):
                yield _cut_rows(batch.slice(at, 1 << 12), length, step)

    return run


def _cut_rows(batch: pa.RecordBatch, length: int, step: int) -> pa.RecordBatch:
    h, _, doc, t, p, n, o = (_long(batch.column(i)) for i in range(7))
    body = batch.column(7)
    bounds = np.frombuffer(body.buffers()[1], dtype=np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
    data = np.frombuffer(body.buffers()[2], dtype=np.uint8)
    n, o = n.astype(np.int64), o.astype(np.int64)
    low, high = (o - n + 1) // step, o // step  # cells of places before the anchor
    row = np.repeat(np.arange(len(n)), high - low + 1)
    cell = _spread(low, high - low + 1)
    first = o[row] - np.minimum(o[row], cell * step + step - 1)  # string starts of the cell, in the context
    last = o[row] - np.maximum(o[row] - n[row] + 1, cell * step)
    shared = bounds[row] + o[row] - cell * step
    key = hash_spans_any(data, shared, np.full(len(row), length - step + 1))
    key = mix64(key ^ h[row].view(np.uint64) ^ (cell.astype(np.uint64) << np.uint64(40)))
    many = last - first + 1
    begin = bounds[row] + first
    whole = hash_spans_any(data, begin, many + length - 1) ^ mix64((o[row] - first).astype(np.uint64) + np.uint64(1))
    return _batch(key, whole, doc[row], t[row], p[row] + first, many, o[row] - first, _binary(data, begin, many + length - 1))


def hash_spans_any(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """:func:`hash_spans` of spans in any order."""
    order = np.argsort(starts, kind="stable")
    out = np.empty(len(starts), dtype=np.uint64)
    out[order] = hash_spans(data, starts[order], lengths[order])
    return out


def _resolved(rows: DataFrame, length: int, step: int, largest: int, merge_bytes: int, shard_bytes: int, bits: int) -> list[DataFrame]:
    """Spans that go because of ``rows``, contexts with their anchors; cut ones are resolved in turn."""
    place = F.struct("doc", "t", "p")
    one = stored(rows.groupBy("h", "c").agg(F.min(place).alias("first"), F.count("*").alias("n")), "contexts")
    again = one.where("n > 1").select("h", "c", "first")
    out = [
        rows.select("h", "c", "doc", "t", "p", "n").join(again, ["h", "c"]).where(place > F.col("first")).select(
            "doc", "t", F.col("p").alias("a"), (F.col("p") + F.col("n") + length - 1).alias("b")
        )
    ]
    if step == 1:  # all strings of a key are equal
        return out
    many = stored(one.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1"), "kinds")
    kept = rows.sparkSession.sparkContext.broadcast(bitmap(many, bits=bits))
    mixed = rows.select("h", "c", "doc", "t", "p", "n", "o", "body").mapInArrow(_kept_rows(kept), _CONTEXT)
    texts = mixed.groupBy("h", "c").agg(F.min(F.struct("doc", "t", "p")).alias("f"), *(F.any_value(x).alias(x) for x in ("n", "o", "body")))
    texts = texts.join(many, "h").select("h", "c", "f.doc", "f.t", "f.p", "n", "o", "body", "kinds")
    texts = _zstd(texts, "texts")
    small = texts.where(F.col("kinds") <= largest).drop("kinds")
    gathered = small.repartition("h").sortWithinPartitions("h")
    out.append(gathered.mapInArrow(_merge(length, merge_bytes, shard_bytes), _SPAN))
    if not many.where(F.col("kinds") > largest).isEmpty():
        step = max(step // 8, 1)
        cut = _zstd(texts.where(F.col("kinds") > largest).drop("kinds").mapInArrow(_cut(length, step), _CONTEXT), "cut")
        out += _resolved(cut, length, step, largest, merge_bytes, shard_bytes, bits)
    return out


def _zstd(df: DataFrame, purpose: str) -> DataFrame:
    """:func:`stored`, packed more tightly: neighbouring contexts overlap."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, *, largest: int = LARGEST, merge_bytes: int = MERGE_BYTES,
    shard_bytes: int = SHARD_BYTES, bits: int = FILTER_BITS,
) -> DataFrame:
    """(doc, t, spans) of the documents that lose something; ``docs`` has __doc, __t and __text."""
    assert length >= 3
    scan = docs.select("__doc", "__t", "__text")
    counted = scan.select("__text").mapInArrow(_counted("__text", length), "h long, n int")
    again = counted.groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    kept = docs.sparkSession.sparkContext.broadcast(bitmap(again, bits=bits))
    found = _zstd(scan.mapInArrow(_contexts(kept, "__text", length), _CONTEXT), "anchors")
    span, _ = _shape(length)
    parts = _resolved(found.where("body IS NOT NULL"), length, span, largest, merge_bytes, shard_bytes, bits)
    parts.append(found.where("body IS NULL").select("doc", "t", F.col("p").alias("a"), (F.col("p") + F.col("n")).alias("b")))
    spans = parts[0]
    for one in parts[1:]:
        spans = spans.unionByName(one)
    spans = stored(spans, "spans")
    # at most about one span per anchor of a document
    return spans.groupBy("doc", "t").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def _without(columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield _row_results(batch.slice(at, 256), columns)

    return run


def _row_results(batch: pa.RecordBatch, columns: list[str]) -> pa.RecordBatch:
    size, removed, runs, kept = [], [], [], []
    texts = batch.column(batch.schema.get_field_index("__text"))
    spans = batch.column(batch.schema.get_field_index("__spans"))
    for i in range(batch.num_rows):
        raw = (texts[i].as_py() or "").encode()
        ends: list[list[int]] = []
        if spans[i].is_valid:
            own = spans[i].values
            a, b = (x.to_numpy(zero_copy_only=False) for x in own.flatten())
            order = np.argsort(a, kind="stable")
            a, b = a[order], np.maximum.accumulate(b[order])
            head = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1]]))
            ends = np.stack([a[head], b[np.append(head[1:], len(a)) - 1]], axis=1).tolist()
        size.append(len(raw))
        removed.append(sum(b - a for a, b in ends))
        runs.append([{"start": a, "end": b} for a, b in ends])
        edges = [0, *(x for pair in ends for x in pair), len(raw)]
        kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
    made = [
        pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
        pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary()),
    ]
    own = [batch.column(batch.schema.get_field_index(c)) for c in columns]
    return pa.RecordBatch.from_arrays([*own, *made], [*columns, "n_bytes", "n_removed", "removed", "kept_bytes"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep: list[str] | None = None, **options) -> DataFrame:
    """``docs[keep]`` with ``n_bytes``, ``n_removed``, ``removed`` (maximal runs of bytes) and ``kept_bytes`` (the rest).

    A byte goes if a string of ``length`` bytes covers it that also starts earlier: in a document of smaller ``key``, or
    in the same at an earlier byte. Strings are judged on the input and never cross documents. ``key`` is an integer.

    Null and empty texts have no bytes; a null key is the smallest. Rows that are equal in key and text are one document
    and get equal results; of other rows that share a key, the one with the smaller hash of its text is earlier. The four
    columns replace columns of the same names. An empty table gives no rows.
    """
    own = ["n_bytes", "n_removed", "removed", "kept_bytes"]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in own and not c.startswith("__")]
    named: list[Column] = [
        F.coalesce(F.col(key).cast("long"), F.lit(_NO_ID)).alias("__doc"), F.xxhash64(text).alias("__t"), F.col(text).alias("__text"),
    ]
    with intermediates(docs.sparkSession, keep=("spans",)):
        spans = repeated_spans(docs.select(*named), length, **options)
    spans = spans.select(F.col("doc").alias("__d"), F.col("t").alias("__u"), F.col("spans").alias("__spans"))
    rows = docs.select(*keep, *named)
    both = rows.join(spans, (F.col("__doc") == F.col("__d")) & (F.col("__t") == F.col("__u")), "left").select(*keep, "__text", "__spans")
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(
        [*(f"`{c}` {kinds[c]}" for c in keep), "n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, kept_bytes binary"]
    )
    return both.mapInArrow(_without(keep), schema)
